"""Connected components of a table of links, by alternating large and small stars.

Each round is two aggregations and joins; a hub never becomes one group or one list.
Rounds are cut with checkpoint(), in the folder the cluster names. The links of a corpus
are few beside its texts, so a round's tables have partitions by their rows, not by the
session's number: hundreds of nearly empty ones would cost more than the work.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import ensure_checkpoint_dir


#: Rows of a partition of links: some megabytes.
PARTITION_ROWS = 250_000


def _parts(table: DataFrame) -> int:
    return max(1, math.ceil(table.count() / PARTITION_ROWS))


def sized(table: DataFrame) -> DataFrame:
    """A checkpointed table in as many partitions as its rows need."""
    return table.coalesce(_parts(table))


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(parts)
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
    return moved.where("u <> v").distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
    return moved.union(least.select("u", F.col("m").alias("v"))).coalesce(parts).distinct().coalesce(parts)


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root): each node of ``edges`` (u, v: long) with its component's least
    node. Nodes without a link are not in it. Raises if it doesn't end."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.where("u <> v").select("u", "v").distinct().checkpoint()
    state, parts = None, _parts(now)
    now = now.coalesce(parts)
    for _ in range(max_rounds):
        large = _large_star(now, parts).checkpoint()
        now = _small_star(large, parts).checkpoint()
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
