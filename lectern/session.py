"""Session settings the operators count on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only; cluster sizing (memory, cores, shuffle partitions) stays with the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the next aggregate would have liked its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the windows-1252 reader needs the full Java character set list
    "spark.sql.legacy.javaCharsets": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a scratch folder only where none is named (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lectern-checkpoint-"))
    return context.getCheckpointDir()


def settle(frame: DataFrame) -> DataFrame:
    """Write a table that several later steps read, and go on from the written copy.

    It lies in the shared checkpoint folder, so losing an executor costs a re-read and
    not the whole lineage; being Parquet, later steps read only the columns they need
    and joins see its real size.
    """
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/settled-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per session.

    Functions that run in Python workers are found there by module name, and a worker
    need not have the repository on its path. Spark distributes the archive itself.
    """
    context = spark.sparkContext
    if getattr(context, "_lectern_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lectern-ship-"), "lectern.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("lectern", os.path.relpath(path, package)))
    context.addPyFile(archive)
    context._lectern_shipped = True
