"""A set of tables that readers see as one.

A run writes its tables into a folder of its own, under ``runs``. Only when all are there
does it append one file to ``manifest``, which names the run and its tables; that append is
the publication. Readers go by the newest manifest entry, so they see all tables of one
complete run: a run that fails halfway, or is still writing, changes nothing for them.

Earlier runs stay readable until ``drop_expired`` removes them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "sequence bigint, run string, table_name string, rows bigint"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per published table: ``sequence``, ``run``, ``table_name`` and its ``rows``."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Published runs, newest first. Of two that took one sequence number the larger name is the newer."""
    return manifest(spark, folder).select("sequence", "run").distinct().orderBy(F.desc("sequence"), F.desc("run"))


class Publication:
    """One run: tables are written one by one, then published together by ``commit``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.run = spark, folder, uuid.uuid4().hex
        self.tables: dict[str, DataFrame] = {}
        self.committed = False

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        """Write a table of this run, and return the written copy, which later tables can be built on."""
        if self.committed or name in self.tables:
            raise ValueError(f"table {name} cannot be written: the run is published" if self.committed
                             else f"table {name} is already written")
        path = f"{self.folder}/runs/{self.run}/{name}"
        frame.write.mode("errorifexists").parquet(path)
        self.tables[name] = self.spark.read.schema(frame.schema).parquet(path)
        return self.tables[name]

    def commit(self) -> str:
        """Publish the tables written so far; returns the name of the run."""
        if self.committed or not self.tables:
            raise ValueError("nothing to publish")
        last = manifest(self.spark, self.folder).agg(F.max("sequence")).first()[0]
        entries = [((last or 0) + 1, self.run, name, table.count()) for name, table in self.tables.items()]
        # one task, so one file: it is there as a whole or not at all
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        self.committed = True
        return self.run


def publish(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> str:
    """Write and publish a set of tables; returns the name of the run."""
    publication = Publication(spark, folder)
    for name, frame in tables.items():
        publication.write(name, frame)
    return publication.commit()


def published(spark: SparkSession, folder: str, run: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest published run, or of a named one."""
    if run is None:
        newest = runs(spark, folder).first()
        if newest is None:
            raise ValueError(f"nothing is published in {folder}")
        run = newest.run
    names = [row.table_name for row in manifest(spark, folder).where(F.col("run") == run).collect()]
    if not names:
        raise ValueError(f"run {run} is not published in {folder}")
    return {name: spark.read.parquet(f"{folder}/runs/{run}/{name}") for name in names}


def drop_expired(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove the files of published runs but for the ``keep`` newest. Runs that were never published are left alone."""
    if keep < 1:
        raise ValueError("at least the newest run stays")
    expired = [row.run for row in runs(spark, folder).collect()[keep:]]
    gone = []
    for run in expired:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/runs/{run}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            gone.append(run)
    return gone
