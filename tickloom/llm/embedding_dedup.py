"""Near-duplicate vectors: sign hashes of random hyperplanes in several tables, exact cosines, connected components.

Equal vectors are first made one class, so copies are never compared. The sign bits of a class in each table name its
buckets; bits grow with the logarithm of the number of classes, and tables with the bits, so that a link at the threshold
is found with probability `RECALL`, one above it with more. Vectors that share a bucket are compared in blocks, in double
precision. A pair counts in the first table where it shares a bucket, so links are counted once and no pair leaves a task:
a block sends each vector's number of links and one edge to the smallest vector it is connected to there. Buckets above
`BLOCK` vectors are divided into blocks, and every pair of blocks is a group of its own.

Edge cases: a vector that is null, empty or zero, or holds a null or non-finite component, links with nothing, and so does a
row without an id; vectors of different lengths never link; rows that repeat both id and vector are one row of the result;
an id that stands for several vectors is one node; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import list_array, runs
from .components import components

THRESHOLD = 0.9
RECALL = 0.999
BUCKET = 256  # vectors in a bucket on average
BLOCK = 2048
SEED = 20240229


def usable(vector: str = "embedding") -> Column:
    """Whether a vector can link at all."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def tables_and_bits(classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    bits = max(0, math.ceil(math.log2(max(1, classes) / BUCKET)))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return (1 if agree == 1 else math.ceil(math.log(1 - recall) / math.log(1 - agree))), bits


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def signed(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    """`classes` with the array `sigs`: the sign bits of the vector in each table."""
    schema = classes.select("*", F.array().cast("array<int>").alias("sigs")).schema

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = batch.column("embedding")
            sigs = np.zeros((len(vectors), tables), np.int32)
            lengths = np.diff(vectors.offsets.to_numpy())
            for d in np.unique(lengths).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, d]).standard_normal((d, tables * bits))
                at = np.flatnonzero(lengths == d)
                side = (matrix(vectors.take(pa.array(at))) @ planes[d] > 0).reshape(len(at), tables, bits)
                sigs[at] = (side * (1 << np.arange(bits))).sum(axis=2)
            yield batch.append_column("sigs", list_array(sigs.ravel(), [tables] * len(vectors), pa.int32()))

    return classes.mapInArrow(sign, schema)


def linked(sigs_of: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links within buckets: cls, links (vectors behind the linked classes), a, b (an edge to the least vector near)."""
    placed = sigs_of.select("*", F.posexplode("sigs").alias("t", "sig"))
    placed = placed.withColumn("bucket", F.xxhash64("t", "sig", F.size("embedding")))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    sizes = materialise(sizes, "vector-buckets")
    blocks = F.ceil(F.col("many") / BLOCK).cast("int")
    rows = placed.join(sizes, "bucket").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select(F.xxhash64("bucket", "t", low, high).alias("task"), "t", "own", (low == high).alias("alone"), "cls", "rep", "copies", "embedding", "sigs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "task"):
            task = batch.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            out: list[list[np.ndarray]] = [[], [], [], []]
            for start, end in zip(cuts, cuts[1:]):  # noqa: B905
                if end - start < 2:
                    continue
                part = batch.slice(start, end - start)
                found = _block(part, threshold)
                for column, values in zip(out, found, strict=True):
                    column.append(values)
            if any(len(x) for x in out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["cls", "links", "a", "b"])

    dealt = rows.repartition("task").sortWithinPartitions("task", "rep", "cls")
    return dealt.mapInArrow(compare, "cls bigint, links bigint, a bigint, b bigint")


def _block(part: pa.RecordBatch, threshold: float) -> tuple[np.ndarray, ...]:
    """What one group finds; its rows are in order of rep."""
    x = matrix(part.column("embedding"))
    own, t = part.column("own").to_numpy(), part.column("t")[0].as_py()
    sigs = part.column("sigs").flatten().to_numpy().reshape(len(x), -1)
    near = np.triu(x @ x.T >= threshold, 1)
    if not part.column("alone")[0].as_py():
        near &= own[:, None] != own[None, :]
    p, q = np.nonzero(near)
    for earlier in range(t):
        new = sigs[p, earlier] != sigs[q, earlier]
        p, q = p[new], q[new]
    copies, rep = part.column("copies").to_numpy(), part.column("rep").to_numpy()
    links = np.zeros(len(x), np.int64)
    np.add.at(links, p, copies[q])
    np.add.at(links, q, copies[p])
    least = local_components(len(x), p, q)
    at = np.flatnonzero(links)
    return part.column("cls").to_numpy()[at], links[at], rep[at], rep[least[at]]


def local_components(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that the links p - q connect it to."""
    least = np.arange(n)
    while len(p):
        lower = np.minimum(least[p], least[q])
        before = least.copy()
        np.minimum.at(least, p, lower)
        np.minimum.at(least, q, lower)
        least = least[least]
        if (least == before).all():
            break
    return least


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").distinct()
    rows = materialise(rows.withColumn("fine", usable() & F.col("vec_id").isNotNull()), "vectors")
    classes = rows.filter("fine").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    tables, bits = tables_and_bits(classes.count(), threshold)
    sigs_of = materialise(signed(classes, tables, bits), "vector-signs")
    found = materialise(linked(sigs_of, threshold), "vector-links")
    links = materialise(found.groupBy("cls").agg(F.sum("links").alias("links")), "vector-counts")
    roots = components(found.select("a", "b"))
    known = classes.join(links, "cls", "left").join(roots, classes["rep"] == roots["node"], "left")
    known = materialise(known.select(
        F.col("embedding").alias("_e"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"),
    ), "vector-results")
    out = rows.join(known, F.col("fine") & (F.col("embedding") == F.col("_e")), "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))
