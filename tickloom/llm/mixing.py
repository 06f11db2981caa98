"""Mixing sources to target weights by balanced sampling with the cube method.

Targets: sources in order of code points, null last, weigh `weights` in turn and share all words; no target exceeds `most`
times its source's words, and the excess is shared again by weight. A document of a source with rate r = target / words is
taken floor(r) times, and once more with probability r - floor(r). The cube method decides these extras: it moves the
vector of inclusion probabilities along the null space of the constraints (the sum of sizes, the number of documents) until
all but two probabilities of a block are 0 or 1. Blocks hold some thousand documents of a source; what a block leaves open
goes to the next flight, whose blocks are made of the leftovers, until a source has one block, whose last two documents
land on the choice nearest to the totals. So a source misses its target by less than its largest document.

A flight sees only id, size and probability of a document. Blocks are dealt by a hash of `doc_id`; a block that one
repeated or null id would make too large is divided by row, so no id fills a task.

Edge cases: a null or empty text has size 0 and is taken as often as its source's rate says, which adds no words; a null
source is a source; a source without words has target 0; repeated rows are decided one by one; an empty table gives an
empty result; other columns are kept by `mixed`, whatever their names.
"""
from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import WORD_CLASS, runs, text_of

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 4096
ROW, SIZE = "_tl_row", "_tl_size"


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(f"{WORD_CLASS}+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: source, docs, source_size, target. The windows run over one row per source.

    A target is min(most * size, level * weight). In order of size / weight the capped sources come first, so the level
    follows from sums along that order.
    """
    totals = sizes.groupBy("source").agg(F.sum(SIZE).alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    df = totals.withColumn("_w", weight)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    capped = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    open_size = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(capped), F.lit(0))
    open_weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(capped), F.lit(0))
    df = df.withColumn("_level", open_size / open_weight)
    # the first source, in that order, whose cap its level does not reach sets the level of all that follow
    fits = F.col("_level") * F.col("_w") <= most * F.col("source_size")
    df = df.withColumn("_level", F.coalesce(F.min_by(F.when(fits, F.col("_level")), F.when(fits, F.col("source_size") / F.col("_w"))).over(everything), F.lit(float("inf"))))
    capped_at = (most * F.col("source_size")).cast("double")
    level = F.when(F.col("source_size") > 0, F.col("_level") * F.col("_w")).otherwise(0.0)
    return df.select("source", "docs", "source_size", F.least(capped_at, level).alias("target"))


def flight(probabilities: list[float], sizes: list[int], seed: int) -> list[float]:
    """Probabilities after the flight over one block: at most two differ from 0 and 1, sums of p and p * size are kept."""
    dice = random.Random(seed)
    p = list(probabilities)
    held: list[int] = []
    for k in range(len(p)):
        if p[k] in (0.0, 1.0):
            continue
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if not any(u):
            u = (1, -1, 0)
        up, down = math.inf, math.inf
        for i, d in zip(held, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if dice.random() * (up + down) < down else -down
        for i, d in zip(held, u, strict=True):
            p[i] = min(1.0, max(0.0, p[i] + step * d))
            if p[i] < 1e-9 or p[i] > 1 - 1e-9:
                p[i] = float(round(p[i]))
        held = [i for i in held if p[i] not in (0.0, 1.0)]
    return p


def landing(p: list[float], sizes: list[int]) -> list[float]:
    """The open probabilities, at most two, set to the pair of 0 and 1 nearest to their sum of sizes, then to their sum."""
    open_ = [k for k, x in enumerate(p) if x not in (0.0, 1.0)]
    want = sum(p[k] * sizes[k] for k in open_)
    choices = [[(n >> i) & 1 for i in range(len(open_))] for n in range(1 << len(open_))]

    def miss(choice: list[int]) -> tuple[float, float]:
        return abs(sum(c * sizes[k] for c, k in zip(choice, open_, strict=True)) - want), abs(sum(choice) - sum(p[k] for k in open_))

    for k, c in zip(open_, min(choices, key=miss), strict=True):
        p[k] = float(c)
    return p


def _flown(rows: DataFrame, last: Column) -> DataFrame:
    """One flight over every block of `rows` (row, key, size, p, block, hash); `last` marks blocks that also land."""
    schema = f"{ROW} bigint, _tl_source bigint, {SIZE} bigint, _tl_p double, _tl_hash bigint"

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "_tl_block"):
            block = batch.column("_tl_block").to_numpy()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            p, sizes = batch.column("_tl_p").to_pylist(), batch.column(SIZE).to_pylist()
            land = batch.column("_tl_last").to_pylist()
            for a, b in zip(cuts, cuts[1:]):  # noqa: B905
                p[a:b] = flight(p[a:b], sizes[a:b], int(block[a]))
                if land[a]:
                    p[a:b] = landing(p[a:b], sizes[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("_tl_source"), batch.column(SIZE), pa.array(p, pa.float64()), batch.column("_tl_hash")],
                names=[ROW, "_tl_source", SIZE, "_tl_p", "_tl_hash"],
            )

    dealt = rows.withColumn("_tl_last", last).select(ROW, "_tl_source", SIZE, "_tl_p", "_tl_hash", "_tl_block", "_tl_last")
    return dealt.repartition("_tl_block").sortWithinPartitions("_tl_block", "_tl_hash", ROW).mapInArrow(fly, schema)


def extras(open_rows: DataFrame) -> DataFrame:
    """Decisions (row, extra 0 or 1) for rows (row, _tl_source as a number, size, p strictly between 0 and 1, hash)."""
    done: DataFrame | None = None
    rows = open_rows
    while True:
        groups = materialise(rows.groupBy("_tl_source").agg(F.count(F.lit(1)).alias("_tl_many")), "mix-groups")
        largest = groups.agg(F.max("_tl_many")).first()[0] or 0
        blocks = F.ceil(F.col("_tl_many") / BLOCK)
        named = rows.join(groups, "_tl_source").withColumn("_tl_bucket", F.pmod("_tl_hash", blocks))
        # a bucket that repeated ids make too large is divided by row
        sizes = materialise(named.groupBy("_tl_source", "_tl_bucket").agg(F.count(F.lit(1)).alias("_tl_here")).filter(F.col("_tl_here") > 3 * BLOCK), "mix-large")
        named = named.join(sizes, ["_tl_source", "_tl_bucket"], "left")
        share = F.when(F.col("_tl_here").isNotNull(), F.pmod(F.xxhash64(ROW), F.ceil(F.col("_tl_here") / BLOCK))).otherwise(0)
        single = (F.col("_tl_many") <= BLOCK) & F.col("_tl_here").isNull()
        flown = materialise(_flown(named.withColumn("_tl_block", F.xxhash64("_tl_source", "_tl_bucket", share)), single), "mix-flight")
        decided = flown.filter(F.col("_tl_p").isin(0.0, 1.0)).select(ROW, F.col("_tl_p").cast("int").alias("extra"))
        done = decided if done is None else done.unionByName(decided)
        if largest <= BLOCK and sizes.isEmpty():
            return done
        rows = flown.filter(~F.col("_tl_p").isin(0.0, 1.0))


def decisions(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per row of `docs` with row number `ROW`: ROW, doc_id, source, size, source_size, target, copies."""
    slim = docs.select(ROW, "doc_id", "source", word_count().alias(SIZE))
    slim = materialise(slim, "mix-sizes")
    goals = materialise(targets(slim, weights, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    a, b = slim.alias("a"), goals.alias("b")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.*", "source_size", "target", rate.alias("_tl_rate"))
    whole = F.floor(F.col("_tl_rate") + 1e-9)
    part = F.greatest(F.col("_tl_rate") - whole, F.lit(0.0))
    rows = rows.withColumns({"_tl_whole": whole, "_tl_p": part})
    hashed = F.xxhash64("doc_id", F.coalesce("source", F.lit("")))
    open_rows = rows.filter(F.col("_tl_p") > 1e-9).select(
        ROW, F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("_tl_source"), SIZE, "_tl_p", hashed.alias("_tl_hash"))
    return rows.join(extras(open_rows), ROW, "left").select(
        ROW, "doc_id", "source", F.col(SIZE).alias("size"), "source_size", "target",
        (F.col("_tl_whole") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies"))


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a row number that holds within one job; what is to be read again has to be stored with it, as in `mixed`."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix: every row of `docs` as often as it is taken.

    Rows are stored with their number, since a number that is worked out anew follows how files are split, and that follows
    the cores there are. They stand in one struct, so no column's name matters. Decisions are as many as rows, too many to be
    sent everywhere, so rows and decisions meet by number at every size.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_tl_doc")
    stored = materialise(docs.select(F.monotonically_increasing_id().alias(ROW), whole), "mix-rows")
    known = stored.select(ROW, *(F.col(f"_tl_doc.{c}").alias(c) for c in ("doc_id", "source", "text")))
    taken = materialise(decisions(known, weights, most).filter("copies > 0").select(ROW, F.col("copies").alias("_tl_copies")), "mix-copies")
    joined = stored.join(taken.hint("shuffle_hash"), ROW)
    return joined.select("_tl_doc", F.explode(F.sequence(F.lit(1), "_tl_copies"))).select("_tl_doc.*")
