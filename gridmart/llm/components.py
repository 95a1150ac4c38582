"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import forget, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on the smallest of them.

    Large: only neighbours greater than the node move; small: the others, with the
    node itself. The minimum is an aggregate with a partial sum on each map task, so a
    node with very many neighbours costs one row a task in its shuffle.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    joined = both.join(least, "a")
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    moved = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.filter("a <> least").select("a", F.col("least").alias("b")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """The smallest node that each linked node reaches: columns ``node``, ``root``.

    ``edges`` has two columns of one orderable type, in any direction; repeated edges and
    loops are allowed. Nodes without an edge to another node are not returned, and an
    empty table gives an empty one. Each round ends in a stored table. The driver sees
    two numbers a round.
    """
    first, second = edges.columns
    now = stored(
        edges.select(F.col(first).alias("a"), F.col(second).alias("b"))
        .filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    for _ in range(rounds):
        last, now = now, stored(_star(_star(now, True).distinct(), False).distinct(), "edges")
        forget(last)
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"no end after {rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    """A digest of the set of edges."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
