"""Writers. Each run replaces its target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.conform import rejected


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet table per entry."""
    for name, frame in tables.items():
        write_extract(frame, f"{folder}/{name}")


def write_extract(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def write_quarantine(records: DataFrame, path: str, valid: str = "valid_isbn") -> None:
    """The rejected rows, whole."""
    write_extract(rejected(records, valid), path)


def identifier_list(frame: DataFrame, column: str) -> DataFrame:
    """Identifiers fit for a lookup service: 13 long, prefix 97."""
    return frame.where((F.length(column) == 13) & F.startswith(column, F.lit("97"))).select(column)


def write_identifier_list(frame: DataFrame, column: str, path: str) -> None:
    identifier_list(frame, column).select(F.col(column).alias("value")).write.mode("overwrite").text(path)
