"""Near-duplicate documents: b-bit MinHash with band candidates, links confirmed on full shingle sets.

1. `signed` reads each text once: its shingles as 64-bit hashes, the fingerprint of their set, `K` minima of which the low
   `B` bits are packed into `LONGS` numbers, and a key per band of minima.
2. Documents with equal sets are one class, shown by its smallest id; copies are never compared.
3. Classes that share a band key are compared by their packed bits: the share of equal bits, corrected for collisions,
   estimates the similarity. Pairs estimated high enough, far below the threshold, tie classes into candidate
   groups. Only one edge a class leaves a bucket; buckets above `BUCKET` classes are tied together whole, unseen.
4. The full sets of a candidate group meet and every pair whose sizes allow it is compared exactly. Large groups are
   divided into blocks that share some pivots; classes that this leaves outside the group's main part are then compared to
   all of it, block by block. So each class ends in its true component, and nothing is compared that is joined already.
5. Components of the confirmed links, and from classes back to documents.

The threshold is a parameter, to which `fitted` fits the bands and the least estimate. A link at the threshold, 0.85, shares a
band with probability 1 - (1 - 0.85**6)**20 = 0.99992 and is estimated too low with probability below 1e-9; a class has more
than one way into its component.

Edge cases: a null, empty or blank text has the empty set and links with nothing; texts with fewer than `SHINGLE` words have
one shingle, the whole sequence; a row without an id links with nothing, is kept, and has no component; rows that share an
id are one node; an empty table gives an empty result; other columns are kept by `deduplicated`.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import arrow_rows, list_array, runs, text_of, utf8, worker_table
from .components import components
from .embedding_dedup import local_components

SHINGLE = 5
B = 4  # low bits kept of each minimum
K = 128  # minima; bands use the first of them
LONGS = K * B // 64
PERCENT = 85  # of the op4 contract; every function takes another
BUCKET = 1024
BLOCK_HASHES = 1 << 20  # shingles of the sets that meet in one block, on average
PIVOTS = 16
REMEMBERED = 150_000
LONG_WORD = 64
_SEEDS = np.random.default_rng(5).integers(0, 1 << 63, (2, K), np.uint64)
_FACTORS, _OFFSETS = (_SEEDS[0] << np.uint64(1)) | np.uint64(1), _SEEDS[1]
_ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache
def fitted(percent: int) -> tuple[int, int, float]:
    """Bands, minima in each, and the least estimate of a candidate, for links at `percent`.

    Bands are as long as K minima allow when a link at the threshold is to share one with probability 0.9999, and as many as
    that takes; 85 gives 20 bands of 6, 80 gives 24 of 5. Such a link has fewer equal bits than the least estimate asks for
    with probability below 1e-9.
    """
    share = percent / 100
    if not 0 < share <= 1:
        raise ValueError(f"percent has to be in 1 to 100, not {percent}")
    needed = lambda rows: 1 if share == 1 else math.ceil(math.log(1e-4) / math.log1p(-(share**rows)))
    rows = max((r for r in range(1, 33) if r * needed(r) <= K), default=0)
    if not rows:
        raise ValueError(f"{K} minima do not find links at {percent} percent")
    p = share + (1 - share) * 2.0**-B
    least, below = 0, (1 - p) ** K
    while below < 1e-9 and least < K:
        least += 1
        below += math.comb(K, least) * p**least * (1 - p) ** (K - least)
    return needed(rows), rows, (least / K - 2.0**-B) / (1 - 2.0**-B) - 1e-9


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = made
        return made


def word_hashes() -> WordHashes:
    """One table per Python worker, which the tasks it runs one after the other share."""
    return worker_table("shingle words", WordHashes)


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Distinct hashes of the text's shingles, ascending. bytes.lower() changes A-Z alone, bytes.split() cuts at the word rule."""
    words = text.lower().split()
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(w):
        return w
    width = min(SHINGLE, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        h = (h ^ w[k : k + len(h)]) * _ODD
        h ^= h >> np.uint64(32)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def minima(hashes: np.ndarray) -> np.ndarray:
    """K minima of the set, each of 32 bits."""
    low = np.full(K, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), 512):
        part = hashes[at : at + 512]
        mixed = part[None, :] * _FACTORS[:, None]
        mixed += _OFFSETS[:, None]
        np.minimum(low, mixed.min(axis=1), out=low)
    low = (low ^ low >> np.uint64(29)) * _ODD  # the low bits of a minimum are even only after mixing
    return low >> np.uint64(32)


def packed_bits(low: np.ndarray) -> np.ndarray:
    """The low B bits of the minima in LONGS numbers."""
    part = (low & np.uint64((1 << B) - 1)).reshape(LONGS, 64 // B)
    return (part << (np.arange(64 // B, dtype=np.uint64) * np.uint64(B))).sum(axis=1, dtype=np.uint64).view(np.int64)


_LOW_BIT = np.uint64(sum(1 << k for k in range(0, 64, B)))


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of signatures (..., LONGS), corrected for equal bits of different minima."""
    z = x.view(np.uint64) ^ y.view(np.uint64)
    z = z | z >> np.uint64(1)
    z = (z | z >> np.uint64(2)) & _LOW_BIT
    equal = 1 - np.bitwise_count(z).sum(axis=-1, dtype=np.int64) / K
    return (equal - 2.0**-B) / (1 - 2.0**-B)


def band_keys(low: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    bands, size, _ = fitted(percent)
    rows = low[: bands * size].reshape(bands, size)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for k in range(size):
        key = (key ^ rows[:, k]) * _ODD
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


SIGNED = "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, sig array<bigint>, bands array<bigint>"


def signed(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, a fingerprint of the set, packed signature and band keys."""
    n_bands = fitted(percent)[0]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in arrow_rows(batch, 512):
                hashes = word_hashes()
                sets = [shingles(t, hashes) for t in utf8(rows.column(1))]
                low = np.array([minima(s) for s in sets]).reshape(-1, K)
                prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                fp = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
                sig = np.array([packed_bits(x) for x in low]).reshape(-1)
                bands = np.array([band_keys(x, percent) for x in low]).reshape(-1)
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp[:, 0]), pa.array(fp[:, 1]),
                     list_array(sig, [LONGS] * n, pa.int64()), list_array(bands, [n_bands] * n, pa.int64())],
                    names=["doc_id", "n_shingles", "fp1", "fp2", "sig", "bands"],
                )

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(sign, SIGNED)


def _groups(batch: pa.RecordBatch, key: str) -> list[tuple[int, int]]:
    """Start and end of each run of a key that has two rows or more."""
    values = batch.column(key).to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
    many = np.flatnonzero(np.diff(cuts) > 1)
    return [(int(cuts[k]), int(cuts[k + 1])) for k in many]


def candidate_edges(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) between classes (rep, sig, bands) whose similarity is estimated high enough for a link at `percent`."""
    likely = fitted(percent)[2]
    placed = classes.select("rep", F.explode("bands").alias("band"))
    counted = placed.groupBy("band").agg(F.min("rep").alias("first"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("many"))
    buckets = materialise(counted.filter("many > 1"), "dedup-buckets")
    # a bucket of two is known from its ends, and a pair that shares several bands is met once
    pairs = buckets.filter("many = 2 and first < last").select("first", "last").distinct()
    pairs = pairs.select(F.xxhash64("first", "last").alias("band"), F.explode(F.array("first", "last")).alias("rep"))
    shared = materialise(placed.join(buckets.filter("many > 2").drop("last"), "band"), "dedup-shared")
    large = shared.filter(F.col("many") > BUCKET).select(F.col("rep").alias("a"), F.col("first").alias("b"))
    small = shared.filter(F.col("many") <= BUCKET).select("band", "rep").unionByName(pairs)
    # signatures travel only to rows that share a bucket
    small = small.join(classes.select("rep", "sig"), "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "band"):
            rep = batch.column("rep").to_numpy()
            sig = batch.column("sig").flatten().to_numpy().reshape(-1, LONGS)
            groups = _groups(batch, "band")
            pairs = np.array([s for s, e in groups if e - s == 2], np.int64)
            near = pairs[estimates(sig[pairs], sig[pairs + 1]) >= likely] if len(pairs) else pairs
            a, b = [rep[near + 1]], [rep[near]]
            for start, end in groups:
                if end - start > 2:
                    x = sig[start:end]
                    p, q = np.nonzero(np.triu(estimates(x[:, None, :], x[None, :, :]) >= likely, 1))
                    least = local_components(end - start, p, q)
                    tied = np.flatnonzero(least != np.arange(end - start))
                    a.append(rep[start + tied])
                    b.append(rep[start + least[tied]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    dealt = small.select("band", "rep", "sig").repartition("band").sortWithinPartitions("band", "rep")
    return dealt.mapInArrow(compare, "a bigint, b bigint").unionByName(large)


def shingle_sets(docs: DataFrame, groups: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The sets of the classes in `groups` (rep, grp): grp, rep, n, hashes (64-bit, as bytes)."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("rep"), text_of(text).alias("text")).join(groups, "rep")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            for part in arrow_rows(batch, 512):
                sets = [shingles(t, hashes) for t in utf8(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("grp"), part.column("rep"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["grp", "rep", "n", "hashes"],
                )

    return rows.select("grp", "rep", "text").mapInArrow(make, "grp bigint, rep bigint, n bigint, hashes binary")


def confirmed(sets: list[np.ndarray], left: np.ndarray | None = None, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (p, q) of sets with 100 * intersection >= percent * union that connect all sets that such pairs connect.

    With `left` (a mask) only pairs of a set inside and one outside or inside it are looked at, not two outside. Sets are
    met in order of size, so only those large enough are compared; pairs that are connected already are passed over.
    """
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    root = list(range(len(sets)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    # shingles as small numbers, so that an intersection is a sum over a mask
    every, code = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_inverse=True)
    cuts = np.cumsum([0, *map(len, sets)])
    codes = [code[a:b] for a, b in zip(cuts, cuts[1:])]  # noqa: B905
    mask = np.zeros(len(every), bool)
    p, q = [], []
    for i, a in enumerate(order):
        if not len(sets[a]):
            continue
        mask[codes[a]] = True
        for b in order[i + 1 :]:
            if 100 * len(sets[a]) < percent * len(sets[b]):
                break
            if left is not None and not left[a] and not left[b]:
                continue
            x, y = top(a), top(b)
            if x == y:
                continue
            both = int(np.count_nonzero(mask[codes[b]]))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[max(x, y)] = min(x, y)
                p.append(a)
                q.append(b)
        mask[codes[a]] = False
    return np.array(p, np.int64), np.array(q, np.int64)


def _confirm(rows: DataFrame, use_left: bool, percent: int) -> DataFrame:
    """Edges (a, b) of the confirmed links within each `task` of rows (task, rep, hashes, left)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "task"):
            rep, left = batch.column("rep").to_numpy(), batch.column("left").to_numpy(zero_copy_only=False)
            blobs = batch.column("hashes")
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for start, end in _groups(batch, "task"):
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in blobs.slice(start, end - start)]
                p, q = confirmed(sets, left[start:end] if use_left else None, percent)
                a.append(rep[start + p])
                b.append(rep[start + q])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return rows.select("task", "rep", "hashes", "left").repartition("task").sortWithinPartitions("task", "rep").mapInArrow(compare, "a bigint, b bigint")


def links(docs: DataFrame, classes: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Confirmed edges (a, b) between classes; their components are those of all links."""
    groups = components(candidate_edges(classes, percent)).select(F.col("node").alias("rep"), F.col("component").alias("grp"))
    groups = materialise(groups, "dedup-groups")
    sets = materialise(shingle_sets(docs, groups, text).dropDuplicates(["grp", "rep", "hashes"]), "dedup-sets")
    sizes = sets.groupBy("grp").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("many"))
    sizes = materialise(sizes.withColumn("blocks", F.ceil(F.col("total") / BLOCK_HASHES).cast("int")), "dedup-sizes")
    block = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int")
    rows = sets.join(sizes, "grp").withColumn("own", block)
    small = rows.filter("blocks <= 1").select(F.col("grp").alias("task"), "rep", "hashes", F.lit(True).alias("left"))
    edges = materialise(_confirm(small, False, percent), "dedup-links")
    if sizes.filter("blocks > 1").isEmpty():
        return edges
    # large groups: blocks with the same pivots, then what is outside the main part against all
    large = rows.filter("blocks > 1")
    pivot = F.pmod(F.xxhash64("rep", F.lit("pivot")), F.col("many")) < PIVOTS
    everywhere = F.when(pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    first = large.withColumn("at", F.explode(everywhere)).select(F.xxhash64("grp", "at").alias("task"), "rep", "hashes", F.lit(True).alias("left"))
    inner = materialise(_confirm(first, False, percent), "dedup-links")
    parts = components(inner).select(F.col("node").alias("rep"), F.col("component").alias("part"))
    placed = materialise(large.select("grp", "rep").join(parts, "rep", "left").select("grp", "rep", F.coalesce("part", "rep").alias("part")), "dedup-parts")
    counted = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))
    main = materialise(counted.groupBy("grp").agg(F.max_by("part", F.struct("n", F.col("part"))).alias("main")), "dedup-main")
    outside = materialise(placed.join(main, "grp").filter("part <> main").select("rep").distinct(), "dedup-outside")
    marked = large.join(outside.withColumn("left", F.lit(True)), "rep", "left").withColumn("left", F.coalesce("left", F.lit(False)))
    # a class outside meets every block of its group, in portions; two classes outside meet wherever their portions do
    sent = marked.filter("left").withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    portions = materialise(marked.filter("left").groupBy("grp").agg(F.ceil(F.sum("n") / BLOCK_HASHES).cast("int").alias("portions")), "dedup-portions")
    portion = F.pmod(F.xxhash64("rep", F.lit("portion")), F.col("portions"))
    here = marked.join(portions, "grp").withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))
    there = sent.join(portions, "grp").withColumn("portion", portion.cast("int"))
    meet = lambda at: F.xxhash64("grp", at, "portion").alias("task")
    both = here.select(meet("own"), "rep", "hashes", F.lit(False).alias("left")).unionByName(there.select(meet("at"), "rep", "hashes", F.lit(True).alias("left")))
    outer = materialise(_confirm(both, True, percent), "dedup-links")
    return edges.unionByName(inner).unionByName(outer)


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id that links reach), kept (doc_id = component_id)."""
    signs = materialise(signed(docs, text, percent=percent), "dedup-signs")
    usable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = signs.filter(usable).groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"))
    classes = materialise(classes, "dedup-classes")
    edges = links(docs, classes, text, percent)
    # an id that stands for several sets ties their classes
    sets = signs.filter(usable).groupBy("doc_id").agg(F.min(F.struct("fp1", "fp2")).alias("lo"), F.max(F.struct("fp1", "fp2")).alias("hi"))
    several = materialise(sets.filter("lo <> hi").select("doc_id"), "dedup-several")
    if not several.isEmpty():
        tied = signs.filter(usable).join(several, "doc_id").join(classes.select("fp1", "fp2", "rep"), ["fp1", "fp2"])
        edges = edges.unionByName(tied.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    roots = components(edges)
    # only classes of several documents, or with links, differ from their own document
    known = classes.select("fp1", "fp2", "rep", "n").join(roots, classes["rep"] == roots["node"], "left").filter("n > 1 or component is not null")
    known = materialise(known.select("fp1", "fp2", F.coalesce("component", "rep").alias("component_id")), "dedup-known")
    slim = signs.select("doc_id", "n_shingles", "fp1", "fp2", usable.alias("usable"))
    a, b = slim.alias("a"), known.alias("b")
    out = a.join(b, F.col("a.usable") & (F.col("a.fp1") == F.col("b.fp1")) & (F.col("a.fp2") == F.col("b.fp2")), "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, that with the smallest id, and all rows that link with nothing.

    Of rows that share an id one is kept, that with the largest text; rows without an id all stay.
    """
    columns = docs.columns
    found = materialise(near_duplicates(docs, text, percent), "dedup-found")
    gone = materialise(found.filter("not kept").select("doc_id").distinct(), "dedup-gone")
    repeated = materialise(found.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_tl_n")).filter("_tl_n > 1"), "dedup-repeated")
    rest = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, rest["doc_id"] == repeated["doc_id"], "left_anti")
    several = rest.join(repeated, rest["doc_id"] == repeated["doc_id"], "left_semi")
    row = F.struct(*(F.col(f"`{c}`") for c in [text, *(c for c in columns if c != text)]))
    one = several.groupBy("doc_id").agg(F.max(row).alias("_tl_row"))
    return once.unionByName(one.select(*(F.col(f"_tl_row.`{c}`").alias(c) for c in columns)))
