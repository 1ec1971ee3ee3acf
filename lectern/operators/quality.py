"""Profiles, audits, constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.codes import clean_isbn, is_isbn13, printable
from lectern.functions.text import as_column, is_blank
from lectern.operators.conform import union_all


def audit_identifiers(frame: DataFrame, key: str, identifier: str) -> DataFrame:
    """Original, escaped, cleaned form, its length and whether the checksum holds."""
    original = F.col(identifier).cast("string")
    return frame.select(
        key, original.alias("original"), printable(original).alias("escaped"), clean_isbn(original).alias("cleaned"),
        F.length(clean_isbn(original)).alias("length"), is_isbn13(original).alias("valid"),
    )


def value_digest(value: Column) -> Column:
    """What tells values apart in a shuffle, 16 bytes whatever their length; NULL stays NULL."""
    return F.unhex(F.md5(value.cast("binary")))


def _cells(frame: DataFrame, names: list[str], with_value: bool) -> Column:
    """Per row one struct for each column: its name, digest, whether it is blank, and the value if asked for."""
    types = dict(frame.dtypes)
    return F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), value_digest(F.col(name).cast("string")).alias("digest"),
            (is_blank(name) if types[name] == "string" else F.lit(False)).alias("blank"),
            *([F.col(name).cast("string").alias("value")] if with_value else []),
        )
        for name in names
    ])


def profile_columns(frame: DataFrame, row: str, columns: list[str] | None = None, samples: int = 3) -> DataFrame:
    """Per column: type, nulls, blank texts, distinct values, first distinct values as a sample.

    Every value is folded to (column, digest, count, first row) before anything else, so
    texts do not travel and the second step sees distinct values only. The ranking keeps
    ``samples`` rows per column and task before it shuffles; only the values that it chose
    are read again, by their row.
    """
    names = columns or [name for name in frame.columns if name != row]
    types = dict(frame.dtypes)
    values = (
        frame.select(F.col(row).alias("_row"), F.inline(_cells(frame, names, False)))
        .groupBy("column_name", "digest", "blank")
        .agg(F.count("*").alias("n"), F.min("_row").alias("first_row"))
    )
    counts = values.groupBy("column_name").agg(
        F.sum(F.when(F.col("digest").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank_strings"),
        F.count("digest").alias("distinct_values"),
    )
    sampled = first_values(frame, row, names, values.where(F.col("digest").isNotNull()), samples)
    type_of = F.create_map(*[F.lit(part) for name in names for part in (name, types[name])])
    return counts.join(sampled, "column_name", "left").select(
        "column_name", F.element_at(type_of, F.col("column_name")).alias("data_type"),
        "nulls", "blank_strings", "distinct_values", "sample",
    )


def first_values(frame: DataFrame, row: str, names: list[str], values: DataFrame, samples: int) -> DataFrame:
    """Per column the ``samples`` values that appear first, joined by `` | ``."""
    place = F.row_number().over(Window.partitionBy("column_name").orderBy("first_row", "digest"))
    top = values.select("column_name", F.col("first_row").alias("_row"), "digest", place.alias("place")).where(F.col("place") <= samples)
    # the rows chosen are at most ``samples`` per column, whatever the data
    found = frame.select(F.col(row).alias("_row"), F.inline(_cells(frame, names, True))).join(
        F.broadcast(top), ["_row", "column_name", "digest"]).select("column_name", "place", "value").distinct()
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda item: item["value"])
    return found.groupBy("column_name").agg(F.array_join(ordered, " | ").alias("sample"))


# --- profiles by sketch: small, stored, merged ------------------------------------------------------

#: 2^LG_K registers: the distinct count is within 1.6 % at one standard deviation
LG_K = 12


def column_sketches(frame: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Per group and column: rows, nulls, and a sketch of the distinct values.

    One scan with map-side combine; a sketch has a bounded size, whatever it has seen. Write
    the result per file or day and merge the pieces with ``merged_profile``.
    """
    cells = F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for name in columns]))
    return frame.select(*by, cells).groupBy(*by, "column_name").agg(
        F.count("*").alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"),
        F.hll_sketch_agg("value", LG_K).alias("distinct_sketch"))


def merged_profile(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows, nulls and estimated distinct values per column over all pieces, or per ``by``."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"))


def exact_duplicates(frame: DataFrame, columns: list[str], name: str = "exact_duplicates") -> DataFrame:
    """Rows that repeat an earlier row in every column; NULLs are equal here."""
    groups = frame.groupBy(*columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))


def count_checks(frame: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One scan, one row per named condition: how many rows meet it."""
    names = list(checks)
    row = frame.agg(*[F.count_if(F.coalesce(condition, F.lit(False))).alias(f"c{i}")
                      for i, condition in enumerate(checks.values())])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("control"), F.col(f"c{i}").alias("rows")) for i, name in enumerate(names)
    ]))
    return row.select(pairs.alias("_pair")).select("_pair.*")


def negative(column) -> Column:
    return as_column(column).cast("string").try_cast("double") < 0


def unreadable_number(column) -> Column:
    return as_column(column).cast("string").try_cast("double").isNull()


def unreadable_date(column) -> Column:
    return as_column(column).cast("string").try_cast("timestamp").isNull()


# --- constraints ------------------------------------------------------------------------------------


def not_unique(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty when the constraint holds."""
    return frame.groupBy(*keys).agg(F.count("*").alias("key_rows")).where(F.col("key_rows") > 1)


def broken_references(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent; empty when the constraint holds."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.where(F.col(key).isNotNull()).join(keys, key, "left_anti")


def reference_report(pairs: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """One row per foreign key with the number of violations."""
    return union_all([
        broken_references(child, parent, key).agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("constraint_name"), "violations")
        for name, (child, parent, key) in pairs.items()
    ])


def uniqueness_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return union_all([
        not_unique(frame, keys).agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("constraint_name"), "violations")
        for name, (frame, keys) in tables.items()
    ])


def integrity_report(catalogue: DataFrame, records: DataFrame) -> DataFrame:
    """The named checks before a load, as (control, result) rows."""
    duplicate_keys = not_unique(catalogue, ["isbn13"]).agg(F.count("*").alias("bad")).select(
        F.lit("canonical identifier is unique").alias("control"), (F.col("bad") == 0).alias("result"))
    of_catalogue = count_checks(catalogue, {
        "all identifiers pass the checksum": ~is_isbn13("isbn13"),
        "no empty normalized titles": F.col("normalized_title") == "",
    })
    of_records = count_checks(records, {
        "every row keeps its source": F.col("source_name").isNull(),
        "every row keeps its position": F.col("source_row").isNull(),
        "no row lost: accepted + rejected = staging": F.col("valid_isbn").isNull(),
    })
    counted = of_catalogue.unionByName(of_records).select("control", (F.col("rows") == 0).alias("result"))
    return duplicate_keys.unionByName(counted)


def require(report: DataFrame, control: str = "control", result: str = "result") -> None:
    """Stop when a check failed. The report has one row per check."""
    failed = [row[control] for row in report.where(~F.col(result)).collect()]
    if failed:
        raise ValueError(f"integrity checks failed: {failed}")


def constraint_violations(frame: DataFrame, positive: list[str], present: list[str]) -> DataFrame:
    """CHECK and NOT NULL as counted violations."""
    checks = {f"{name} >= 0": F.col(name) < 0 for name in positive}
    checks.update({f"{name} not null": F.col(name).isNull() for name in present})
    return count_checks(frame, checks)


def unreadable_fields(frame: DataFrame, types: dict[str, str]) -> Column:
    """Names of the columns whose text is present but does not read as the wanted type, else NULL."""
    bad = F.array_compact(F.array(*[
        F.when(F.col(name).isNotNull() & F.col(name).cast("string").try_cast(kind).isNull(), F.lit(name))
        for name, kind in types.items()
    ]))
    return F.nullif(F.array_join(bad, ","), F.lit(""))


def split_by_types(frame: DataFrame, types: dict[str, str], required: list[str] = (),
                   strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed rows and quarantined rows with a reason; ``strict`` raises at run time instead."""
    missing = F.array_join(F.array_compact(F.array(*[
        F.when(F.col(name).isNull(), F.lit(name)) for name in required
    ] or [F.lit(None).cast("string")])), ",")
    reason = F.concat_ws("; ", F.nullif(F.concat(F.lit("missing "), missing), F.lit("missing ")),
                         F.concat(F.lit("unreadable "), unreadable_fields(frame, types)))
    if strict:
        typed = [F.col(name).cast(types[name]).alias(name) if name in types else F.col(name) for name in frame.columns]
        wrong = F.when(reason != "", F.raise_error(F.concat(F.lit("bad row: "), reason))).otherwise(F.lit(True))
        return frame.where(wrong.cast("boolean")).select(*typed), frame.where(F.lit(False))
    marked = frame.withColumn("reason", reason)
    typed = [F.col(name).cast("string").try_cast(types[name]).alias(name) if name in types else F.col(name)
             for name in frame.columns]
    return marked.where(F.col("reason") == "").select(*typed), marked.where(F.col("reason") != "")

