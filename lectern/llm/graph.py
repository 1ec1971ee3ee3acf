"""Connected components of an edge table, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import settle


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node ``u`` to the smaller ``v``."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node of ``edges`` (``u``, ``v`` bigint).

    Rounds of two star operations: all larger neighbours of a node move to the smallest
    neighbour, then all smaller ones. Paths shorten by a constant factor each round. The
    edges of a round are written to the shared folder; a round that changes nothing ends.
    The minimum per node is taken before the shuffle, so a hot node is one row per task.
    """
    held = settle(_downward(edges))
    mark = _mark(held)
    while mark[0]:
        both = held.union(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _downward(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        held = settle(_downward(small))
        now = _mark(held)
        if now == mark:
            break
        mark = now
    return held.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
