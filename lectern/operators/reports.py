"""Reports over the model and the audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import split_list
from lectern.operators.conform import not_blank, union_all
from lectern.operators.enrich import money_total


def sales_by(sales: DataFrame, group, name: str, units: str = "units", revenue: str = "revenue_eur") -> DataFrame:
    return sales.groupBy(group.alias(name)).agg(
        F.sum(units).alias("units"), money_total(revenue).alias("revenue_eur")
    )


def sales_by_year(sales: DataFrame, date: str = "sale_date") -> DataFrame:
    return sales_by(sales, F.year(date), "year")


def sales_by_channel(sales: DataFrame, channel: str = "channel") -> DataFrame:
    return sales_by(sales, F.col(channel), "channel").orderBy(F.desc("revenue_eur"), "channel")


def count_by(frame: DataFrame, columns: list[str], name: str = "rows") -> DataFrame:
    return frame.groupBy(*columns).agg(F.count("*").alias(name))


def category_values(frame: DataFrame, source: str, fields: list[str]) -> DataFrame:
    """(field, source, value) with every distinct value once: rows, so of any number."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("value")) for name in fields
    ]))
    return frame.select(F.col(source).alias("source"), cells.alias("_cell")).select("source", "_cell.*").where(
        F.col("value").isNotNull()).distinct().select("field", "source", "value")


def category_listing(frame: DataFrame, source: str, fields: list[str], separator: str = "; ") -> DataFrame:
    """Per field and source the sorted distinct values in one cell.

    A display form for vocabulary columns, whose values are few; ``category_values`` has
    the same in rows for columns of any kind.
    """
    return category_values(frame, source, fields).groupBy("field", "source").agg(
        F.array_join(F.array_sort(F.collect_list("value")), separator).alias("values")
    )


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, NULL first."""
    return frame.select(column).distinct().orderBy(F.asc_nulls_first(column))


def changed_values(frame: DataFrame, changes: dict[str, tuple]) -> DataFrame:
    """(field, before, after) with every distinct pair once, in one scan.

    ``changes``: field -> (column before, column after).
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(field).alias("field"), before.cast("string").alias("before"), after.cast("string").alias("after"))
        for field, (before, after) in changes.items()
    ]))
    return frame.select(cells.alias("_cell")).select("_cell.*").distinct()


def before_after(frame: DataFrame, changes: dict[str, tuple]) -> DataFrame:
    """Per field the sorted distinct values before and after a standardisation, each in one cell.

    A display form for vocabulary columns; ``changed_values`` has the same in rows.
    """
    return changed_values(frame, changes).groupBy("field").agg(
        F.array_join(F.array_sort(F.collect_set("before")), "; ").alias("before"),
        F.array_join(F.array_sort(F.collect_set("after")), "; ").alias("after"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, frame in tables.items()
    ])


def top(frame: DataFrame, order: list, n: int = 5) -> DataFrame:
    """Ordered head; the plan keeps n rows per task."""
    return frame.orderBy(*order).limit(n)


def titles_per_name(rows: DataFrame, name: str, key: str, title: str, n: int | None = 5,
                    count_name: str = "key_count", separator: str = "; ") -> DataFrame:
    """Names with the most distinct keys, and their distinct titles.

    The names are ranked first; titles are listed only for those that stay.
    """
    pairs = rows.select(name, key).distinct()
    ranked = pairs.groupBy(name).agg(F.count("*").alias(count_name))
    leaders = top(ranked, [F.desc(count_name), name], n) if n else ranked
    titles = rows.join(leaders.select(name), name, "left_semi").select(name, title).distinct()
    listed = titles.groupBy(name).agg(F.array_join(F.array_sort(F.collect_list(title)), separator).alias("titles"))
    return leaders.join(listed, name, "left")


def work_report(works: DataFrame, identifiers: DataFrame, authors: DataFrame) -> DataFrame:
    """Works with their identifiers and authors; two rollups, no fan-out.

    ``identifiers``: work_id, identifier. ``authors``: work_id, name.
    """
    def listed(frame, value, name):
        present = frame.where(not_blank(value)).select("work_id", value)
        return present.groupBy("work_id").agg(F.array_join(F.array_sort(F.collect_list(value)), "; ").alias(name))

    return (
        works.where(not_blank("title"))
        .join(listed(identifiers, "identifier", "identifiers"), "work_id", "left")
        .join(listed(authors, "name", "authors"), "work_id", "left")
        .select("work_id", "title", "identifiers", "authors")
    )


def shared_codes(rows: DataFrame, code: str, work: str, title: str) -> DataFrame:
    """Non-blank codes that stand on works with different titles, with those works."""
    listed = rows.where(not_blank(code)).select(F.trim(code).alias(code), work, title).distinct()
    conflicting = listed.groupBy(code).agg(F.count_distinct(title).alias("_titles")).where(F.col("_titles") > 1)
    return listed.join(conflicting.select(code), code, "left_semi")


def count_per_listed_name(names: DataFrame, name: str, rows: DataFrame, cell: str, counted: str,
                          count_name: str) -> DataFrame:
    """For each name, the rows whose ``;`` cell lists it and whose ``counted`` is not blank; 0 for none.

    The cell is exploded and counted per item before it meets the names.
    """
    items = rows.where(not_blank(counted)).select(F.explode(F.array_distinct(split_list(cell))).alias("_item"))
    counts = items.groupBy("_item").agg(F.count("*").alias("_n"))
    return names.join(counts, F.trim(names[name]) == counts["_item"], "left").select(
        *names.columns, F.coalesce("_n", F.lit(0)).alias(count_name)
    )
