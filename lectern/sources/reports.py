"""Sales reports: a preamble, a period line, a header row somewhere, then data.

Input rows are header-less: (file, row_no, cells array<string>). The facts about a file
(its year, its header row) are aggregates over its rows, so a very large file is read
by many tasks and only one row per file is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.text import strip
from lectern.operators.skew import attach
from lectern.sources.readers import number_rows, placed_in_file


def read_cells(spark: SparkSession, path, width: int, row_name: str = "row_no") -> DataFrame:
    """Header-less CSV reports as (file, row_no, cells, overflow).

    ``overflow`` holds the whole line where it has a value beyond ``width`` cells; such
    rows are no data rows and come back from ``overflowing_rows``.
    """
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{name} string" for name in [*names, "_beyond", "_line"])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_line").csv(path)
    numbered = number_rows(placed_in_file(rows, "file"), "file", "_split", "_place", row_name, 1)
    beyond = F.when(F.col("_beyond").isNotNull(), F.coalesce("_line", F.concat_ws(",", *names, "_beyond")))
    return numbered.select("file", row_name, F.array(*names).alias("cells"), beyond.alias("overflow"))


def overflowing_rows(cells: DataFrame) -> DataFrame:
    """Rows with more cells than declared, with the reason: for the quarantine."""
    return cells.where(F.col("overflow").isNotNull()).select(
        "file", "row_no", "overflow", F.lit("more cells than declared").alias("reason"))


def _period_cells() -> Column:
    return F.filter("cells", lambda cell: F.contains(cell, F.lit(fixed.REPORT_FROM_WORD))
                    & F.contains(cell, F.lit(fixed.REPORT_TO_WORD)))


def _full_year(cell: Column) -> Column:
    year = F.nullif(F.regexp_extract(cell, fixed.REPORT_LAST_DAY + r"(\d{4})", 1), F.lit(""))
    return F.when(F.contains(cell, F.concat(F.lit(fixed.REPORT_FIRST_DAY), year)), year)


def file_facts(cells: DataFrame) -> DataFrame:
    """Per file: rows, year of a full calendar year (last such cell wins), header row and its layout."""
    years = F.filter(F.transform(_period_cells(), _full_year), lambda year: year.isNotNull())
    last_year = F.try_element_at(years, F.lit(-1))
    classic = F.array(*[F.lit(name) for name in fixed.REPORT_HEADER])
    ebook = F.array(*[F.lit(name) for name in fixed.REPORT_HEADER_EBOOK])
    layout = F.when(F.col("cells") == classic, "classic").when(F.col("cells") == ebook, "ebook")
    seen = cells.select("file", "row_no", last_year.alias("_year"), layout.alias("_layout"))
    return seen.groupBy("file").agg(
        F.count("*").alias("file_rows"),
        F.max_by("_year", F.when(F.col("_year").isNotNull(), F.col("row_no"))).cast("int").alias("sale_year"),
        F.min(F.when(F.col("_layout").isNotNull(), F.struct("row_no", F.col("_layout").alias("layout")))).alias("_header"),
    ).select("file", "file_rows", "sale_year", F.col("_header.row_no").alias("header_row"),
             F.col("_header.layout").alias("layout"))


def file_status(facts: DataFrame) -> DataFrame:
    """Which files are loaded, and why the others are not."""
    status = (
        F.when(F.col("sale_year").isNull(), "not_a_full_year")
        .when(F.col("header_row").isNull(), "no_header")
        .otherwise("accepted")
    )
    return facts.withColumn("status", status)


def report_rows(cells: DataFrame) -> DataFrame:
    """Data rows of the accepted files, projected by the column order of their header."""
    if "overflow" in cells.columns:
        cells = cells.where(F.col("overflow").isNull()).drop("overflow")
    accepted = file_status(file_facts(cells)).where(F.col("status") == "accepted").drop("status")
    body = attach(cells, accepted, ["file"], "file_rows", F.col("row_no"), how="inner").where(
        F.col("row_no") > F.col("header_row"))

    def cell(name: str) -> Column:
        return strip(
            F.when(F.col("layout") == "classic", F.get("cells", F.lit(fixed.REPORT_HEADER.index(name))))
            .otherwise(F.get("cells", F.lit(fixed.REPORT_HEADER_EBOOK.index(name)))))

    named = {"isbn": "Isbn", "channel": "Canal", "store": "Tienda", "mode": "Modalidad", "country": "País",
             "area": "Área", "subarea": "Subárea", "commercial_format": "Formato", "edition": "Edición",
             "quantity": "Cantidad"}
    return body.select("file", "row_no", "sale_year", *[
        F.nullif(cell(heading), F.lit("")).alias(name) for name, heading in named.items()
    ])
