"""Readers. Cells of exports are read as text; types are decided by explicit casts later."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import fixed_values as fixed
from lectern.operators.conform import conform, union_all
from lectern.sources.documents import read_records

# names of files an office program leaves next to an open workbook
TEMPORARY_PREFIX = "~$"
# a JSON document above this size is not read by one task
SPLIT_BYTES = 64 << 20

RECORD_SCHEMA = "struct<isbn13: string, match_status: string, cited_by_count_demo: int>"
FIXTURE_SCHEMA = f"about string, generated_with_seed int, records array<{RECORD_SCHEMA}>"
CANDIDATE_SCHEMA = (
    "results array<struct<id: string, doi: string, display_name: string, title: string, cited_by_count: bigint, "
    "type: string, authorships: array<struct<author: struct<display_name: string>>>>>"
)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_csv(spark: SparkSession, path, columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """A CSV export with declared columns, all text (identifiers never become numbers)."""
    return (
        spark.read.schema(text_schema(columns)).option("header", "true").option("enforceSchema", "false")
        .option("encoding", encoding).csv(path)
    )


def read_csv_windows(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """A Windows-1252 export. Needs ``session.tune`` for the character set."""
    return read_csv(spark, path, columns, "windows-1252")


def read_folder(spark: SparkSession, path, columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """All exports of a folder with their path; office temporaries are left out."""
    name = F.col("_metadata.file_name")
    rows = read_csv(spark, path, columns, encoding).where(~F.startswith(name, F.lit(TEMPORARY_PREFIX)))
    return rows.select("*", F.col("_metadata.file_path").alias("origin_file"))


def number_rows(placed: DataFrame, file: str, split: str, place: str, name: str, first: int) -> DataFrame:
    """Consecutive row numbers per file.

    Rows are numbered inside each file split, whose size the reader bounds, and the
    split's first number is the running count of the splits before it.
    """
    counts = placed.groupBy(file, split).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(file).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(file, split, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(file, split).orderBy(place)
    numbered = placed.join(offsets, [file, split]).withColumn(
        name, F.col("_before") + F.row_number().over(inside) + F.lit(first - 1))
    return numbered.drop("_before", split, place)


def placed_in_file(rows: DataFrame, file: str) -> DataFrame:
    """Path, split and position in the split of every row; office temporaries are left out.

    Files are told apart by their path: folders may hold files of one name.
    """
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_place"),
    )
    return placed.where(~F.startswith("_name", F.lit(TEMPORARY_PREFIX))).drop("_name")


def numbered_csv(spark: SparkSession, path, columns: list[str], encoding: str = "UTF-8",
                 first: int = fixed.FIRST_SHEET_ROW, name: str = "source_row") -> DataFrame:
    """A CSV export with its path and sheet row numbers."""
    placed = placed_in_file(read_csv(spark, path, columns, encoding), "origin_file")
    return number_rows(placed, "origin_file", "_split", "_place", name, first).select(*columns, "origin_file", name)


def numbered_parquet(spark: SparkSession, path, first: int = fixed.FIRST_SHEET_ROW,
                     name: str = "source_row") -> DataFrame:
    """A Parquet export with sheet row numbers taken from the file's own row index."""
    return with_sheet_rows(spark.read.parquet(path), first, name)


def with_sheet_rows(rows: DataFrame, first: int = fixed.FIRST_SHEET_ROW, name: str = "source_row") -> DataFrame:
    """Rows as read from Parquet files, each with its place in its file."""
    return rows.select("*", (F.col("_metadata.row_index") + first).alias(name))


def read_sources(spark: SparkSession, folder: str, specs: dict[str, dict[str, str]] = fixed.SOURCE_COLUMNS,
                 form: str = "csv") -> DataFrame:
    """Every declared catalogue export, conformed and stacked into the staging table."""
    staged = []
    for source_name, columns in specs.items():
        path = f"{folder}/{source_name}.{form}"
        if form == "parquet":
            rows = numbered_parquet(spark, path)
        else:
            rows = numbered_csv(spark, path, list(columns.values()))
        staged.append(conform(rows, columns, source_name, F.col("source_row")))
    return union_all(staged)


def read_fixture(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stored match records; a missing file reads as none.

    A file above ``split_bytes`` is read by many tasks (``documents.read_records``).
    """
    try:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
        if largest > split_bytes:
            return read_records(spark, path, RECORD_SCHEMA).select("record_no", "record.*")
        document = spark.read.schema(FIXTURE_SCHEMA).option("multiLine", "true").json(path)
    except AnalysisException:
        document = spark.createDataFrame([], FIXTURE_SCHEMA)
    return document.select(F.posexplode("records").alias("record_no", "_record")).select("record_no", "_record.*")


def read_candidates(spark: SparkSession, path: str, key: str = "isbn13") -> DataFrame:
    """Stored search responses, one JSON document per line with its ``key``, as a candidates table."""
    document = spark.read.schema(f"{key} string, {CANDIDATE_SCHEMA}").json(path)
    return document.select(key, F.posexplode("results").alias("_place", "_hit")).select(
        key, (F.col("_place") + 1).alias("cand_rank"), "_hit.*"
    )


def read_table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A table, a view or a query."""
    return spark.sql(name_or_sql) if " " in name_or_sql.strip() else spark.table(name_or_sql)
