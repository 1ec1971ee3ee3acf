"""Keeping hot keys out of single tasks.

Three rules hold in every operator:

* a group is reduced by an aggregate with map-side combine, never by a window over
  raw rows or by collecting them;
* a result per group goes back to its rows through ``attach``, which salts the keys
  that hold a large share of all rows;
* numbering and filling along an order run inside blocks of bounded size, with the
  state carried over from block to block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import ensure_checkpoint_dir

# a key is hot when it holds more than this share of all rows, or more than HOT_TASKS times
# the fair share of a task: at most 100, or width / HOT_TASKS, keys can
HOT_SHARE, HOT_TASKS = 0.01, 8
# rows that share one block when numbering or filling along an order
BLOCK_ROWS = 262_144


def shuffle_width(frame: DataFrame) -> int:
    return max(2, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, spread: Column, how: str = "left",
           hot_share: float | None = None) -> DataFrame:
    """Join per-group results back to their rows.

    ``groups`` has one row per key and its row count in ``size``. Keys above the share
    (``HOT_SHARE``, less with many tasks) are at most 1/share many, so their list is small
    enough to broadcast whatever the data. Their rows are spread over salts by a hash of ``spread`` (something that
    differs within the group, such as the row id), their group result is repeated once
    per salt, and everything else joins as usual. Rows without a key match nothing and
    are spread the same way.
    """
    salts = shuffle_width(rows)
    total = groups.agg(F.sum(size)).scalar()
    is_hot = F.col(size) > total * (hot_share or min(HOT_SHARE, HOT_TASKS / salts))
    hot_keys = groups.where(is_hot).select(*keys, F.lit(True).alias("_hot"))
    keyless = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in keys])
    salted_rows = rows.join(F.broadcast(hot_keys), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | keyless, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)
    ).drop("_hot")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_groups = groups.withColumn("_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
    return salted_rows.join(salted_groups, [*keys, "_salt"], how).drop("_salt")


def dense_ids(frame: DataFrame, block_by: Column, order_by: list, id_name: str, start: int = 1) -> DataFrame:
    """Consecutive ids along an order, without one task sorting everything.

    ``block_by`` is an integer that grows with the order and is shared by a bounded
    number of rows. Rows are counted per block, the running total of the block counts
    gives each block its first id, and only rows of one block are sorted together.
    """
    blocked = frame.withColumn("_block", block_by)
    counts = blocked.groupBy("_block").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy(*order_by)
    return (
        blocked.join(offsets, "_block")
        .withColumn(id_name, F.col("_before") + F.row_number().over(inside) + F.lit(start - 1))
        .drop("_block", "_before")
    )


def sequential_ids(frame: DataFrame, order_by: list, id_name: str, start: int = 1) -> DataFrame:
    """Consecutive ids along any order, text included.

    The sorted rows are checkpointed with their partition number, so a lost executor
    cannot change them between the counting and the numbering. The per-partition
    offsets are one row per partition.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = frame.orderBy(*order_by).select(
        "*", F.spark_partition_id().alias("_part"), in_partition.alias("_place")
    ).checkpoint()
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(id_name, F.col("_before") + F.col("_place") + F.lit(start))
        .drop("_part", "_place", "_before")
    )


def fill_forward(frame: DataFrame, value: str, order: str, within: list[str], where: Column | None = None,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Replace NULLs of ``value`` by the last one above it, per ``within`` group.

    ``order`` is an integer row position. A file may hold a third of all rows, so the
    fill runs inside blocks of positions and each block receives the last value of the
    blocks before it. ``where`` limits which NULLs are filled.
    """
    blocked = frame.withColumn("_block", F.floor(F.col(order) / block_rows))
    last_known = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))
    ends = blocked.groupBy(*within, "_block").agg(last_known.alias("_last"))
    above = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*within, "_block", F.last("_last", ignorenulls=True).over(above).alias("_carried"))
    inside = Window.partitionBy(*within, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carried"))
    joined = blocked.join(carried, [*within, "_block"])
    wanted = F.col(value).isNull() if where is None else F.col(value).isNull() & where
    return joined.withColumn(value, F.when(wanted, filled).otherwise(F.col(value))).select(*frame.columns)
