"""The batch-incremental operators, applied to each micro-batch of a stream.

Facts are deduplicated against what is already stored and against the batch itself; both
steps are joins and aggregates on the business key. A fact with a NULL in its key equals
nothing and always stays.

The store is a folder per stream and batch. A batch that is run again replaces its own
folder and looks only at what came before it, so a replay gives the same store, facts with
a NULL in the key included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lectern.operators.dedup import keep_first_null_unsafe
from lectern.operators.enrich import not_yet_done

#: more values of the partition column than this in one batch, and the whole store is looked at
MOST_PARTITIONS = 366


def new_facts(batch: DataFrame, stored: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of the batch that no stored fact has; a NULL in the key equals nothing.

    The stored keys are cut down to those of the batch first, by a semi-join that the
    planner can turn into a runtime filter of the store's scan.
    """
    first = keep_first_null_unsafe(batch, keys, order)
    seen = stored.select(*keys).join(first.select(*keys).dropna().distinct(), keys, "left_semi")
    return first.join(seen, keys, "left_anti")


def stream_name(checkpoint: str) -> str:
    """Names a stream by its checkpoint: batch numbers count within that."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def fact_store(spark: SparkSession, path: str, schema) -> DataFrame:
    """All stored facts with the ``stream`` and ``batch_id`` that brought them; none where there is no store yet."""
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    placed = f"{fields}, stream string, batch_id bigint"
    try:
        return spark.read.schema(placed).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], placed)


def earlier_facts(batch: DataFrame, path: str, stream: str, batch_id: int, partition: str | None = None) -> DataFrame:
    """What the store held before this batch, cut to the batch's values of ``partition``, one of the key columns."""
    stored = fact_store(batch.sparkSession, path, batch.schema).where(
        (F.col("stream") != stream) | (F.col("batch_id") < batch_id))
    if partition is None:
        return stored
    values = [row[0] for row in batch.select(partition).dropna().distinct().limit(MOST_PARTITIONS + 1).collect()]
    return stored if len(values) > MOST_PARTITIONS else stored.where(F.col(partition).isin(values))


def store_batch(batch: DataFrame, batch_id: int, path: str, stream: str, keys: list[str], order: list,
                partition: str | None = None) -> None:
    """Write the batch's new facts into the batch's own folder, replacing what an earlier attempt left there.

    ``partition``, one of ``keys``, lays the facts out by its values, so that a batch of a
    few years reads those years of the store only.
    """
    if partition is not None and partition not in keys:
        raise ValueError("the partition column must be part of the key")
    held = batch.persist()  # it is read for the partition values and for the facts
    try:
        fresh = new_facts(held, earlier_facts(held, path, stream, batch_id, partition), keys, order)
        writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/stream={stream}/batch_id={batch_id}")
    finally:
        held.unpersist()


def append_new_facts(stream: DataFrame, path: str, keys: list[str], order: list, checkpoint: str,
                     partition: str | None = None) -> DataStreamWriter:
    """Append each micro-batch's unseen facts to a store.

    The checkpoint belongs to the store: its batch numbers name the folders. Another
    checkpoint is another stream, which finds the facts of all others.
    """
    name = stream_name(checkpoint)

    def append(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, path, name, keys, order, partition)

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


def consult_new(work: DataFrame, state: DataFrame, keys: list[str], mark: str,
                consult: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Look up only what the state table has no mark for."""
    return consult(not_yet_done(work, state, keys, mark))
