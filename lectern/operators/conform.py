"""From exports with different schemas to one staging table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.codes import clean_isbn, is_isbn13
from lectern.functions.text import normalize_text


def project(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select and rename; a missing export column is an analysis error."""
    return frame.select([F.col(f"`{found}`").alias(name) for name, found in columns.items()])


def conform(frame: DataFrame, columns: dict[str, str], source_name: str, source_row: Column) -> DataFrame:
    """One export in staging shape: conformed columns, provenance, raw and derived fields."""
    staged = frame.withColumn("_row", source_row).select(
        *[F.col(f"`{found}`").alias(name) for name, found in columns.items()], F.col("_row")
    )
    return staged.select(
        *columns,
        F.lit(source_name).alias("source_name"),
        F.col("_row").cast("long").alias("source_row"),
        F.col("isbn").cast("string").alias("raw_isbn"),
        F.col("title").cast("string").alias("raw_title"),
        clean_isbn("isbn").alias("isbn13"),
        # missing with the title, so that both survive from the same row
        F.when(F.nullif(F.trim(F.col("title").cast("string")), F.lit("")).isNotNull(), normalize_text("title")).alias("normalized_title"),
        is_isbn13("isbn").alias("valid_isbn"),
    )


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def reindex(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly the given columns (name -> type); those the frame lacks are NULL."""
    return frame.select([
        (F.col(name) if name in frame.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in columns.items()
    ])


def status_of(valid: str = "valid_isbn") -> Column:
    return F.when(F.col(valid), fixed.ACCEPTED).otherwise(fixed.REJECTED)


def source_trace(records: DataFrame) -> DataFrame:
    """Every staging row with its outcome; rejected rows stay visible here."""
    return records.select(
        "source_name", "source_row", "raw_isbn", F.col("isbn13").alias("normalized_isbn"), "raw_title",
        "normalized_title", status_of().alias("status"),
    )


def accepted(records: DataFrame, valid: str = "valid_isbn") -> DataFrame:
    return records.where(F.col(valid))


def rejected(records: DataFrame, valid: str = "valid_isbn") -> DataFrame:
    return records.where(~F.coalesce(F.col(valid), F.lit(False)))


def drop_empty_rows(frame: DataFrame) -> DataFrame:
    return frame.dropna(how="all")


def keep_members(frame: DataFrame, column: str, chosen: list) -> DataFrame:
    """Rows whose value was chosen; no choice means no filter."""
    return frame.where(F.col(column).isin(list(chosen))) if chosen else frame


def not_blank(column: str) -> Column:
    """SQL's ``COALESCE(TRIM(x), '') <> ''``."""
    return F.coalesce(F.trim(F.col(column)), F.lit("")) != ""


def between_years(frame: DataFrame, column: str, first: int = fixed.YEAR_FROM, last: int = fixed.YEAR_TO) -> DataFrame:
    return frame.where(F.col(column).between(first, last))


def sane_facts(frame: DataFrame, date: str, quantities: list[str]) -> DataFrame:
    """Readable date and non-negative numbers; text that does not parse counts as failing."""
    readable = F.col(date).cast("string").try_cast("timestamp").isNotNull()
    for name in quantities:
        number = F.col(name).cast("string").try_cast("double")
        readable = readable & F.coalesce((number >= 0) & ~F.isnan(number), F.lit(False))
    return frame.where(readable)
