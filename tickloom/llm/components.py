"""Connected components by alternating stars, on Spark.

Each round lets every node send its larger neighbours to the smallest node it knows (large star), then its smaller ones
(small star). The edges shrink to stars around the smallest node of each component in few rounds, as paths halve in each.
Least neighbours are partial aggregates, and joins are between stored tables, so that a star's centre with a third of all
edges is split by adaptive execution. Nothing but two sums per round reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

ROWS_PER_TASK = 200_000


def _stored(df: DataFrame, name: str, rows: int) -> DataFrame:
    """`df`, of at most so many rows, stored in as few files as they need, whatever the number of shuffle partitions."""
    return materialise(df.coalesce(-(-rows // ROWS_PER_TASK) or 1), name)


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One star step on directed edges (a, b), a > b, without repeats."""
    both = edges.select(F.col("b").alias("u"), F.col("a").alias("v")) if large else edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # the least of the smaller nodes that u knows; a node without any is the least itself
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = _stored(least, "cc-least", rows)
    if large:
        out = both.join(least, "u", "left").select(F.col("v").alias("a"), F.coalesce("m", "u").alias("b"))
    else:
        sent = both.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = sent.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return _stored(out.filter("a <> b").distinct(), "cc-edges", 2 * rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): component is the smallest node that it reaches, itself included.

    Edges may stand in either direction and repeat; loops and edges with a null end are passed over.
    """
    df = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    df = materialise(df.filter("a <> b").filter(F.col("a").isNotNull() & F.col("b").isNotNull()).distinct(), "cc-edges")
    rows, mark = _mark(df)
    while rows:
        df = _star(_star(df, True, rows), False, rows)
        before = mark
        rows, mark = _mark(df)
        if mark == before:
            break
    roots = df.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return df.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple[int, tuple]:
    """The number of edges, and two sums that tell whether a round changed them."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], tuple(row)
