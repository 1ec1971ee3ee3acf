"""Duplicates: survivorship, merging, flags, first-writer rules, continuation rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import as_column, collapse_spaces, is_blank, split_list, strip
from lectern.operators.skew import attach
from lectern.session import settle


def priority_of(source: str, priority: dict[str, int]) -> Column:
    """Rank of a source from a small fixed table; unknown sources come last."""
    ranks = F.create_map(*[F.lit(part) for pair in priority.items() for part in pair])
    return F.coalesce(F.try_element_at(ranks, F.col(source)), F.lit(max(priority.values()) + 1))


def golden_record(records: DataFrame, key: str, values: list[str], source: str, row: str,
                  priority: dict[str, int]) -> DataFrame:
    """One row per key: per column the first present value by source priority, then row.

    A golden row may mix sources. Provenance (how many sources, which) comes out of the
    same aggregate, so there is one shuffle and a hot key is combined before it.
    """
    rank = F.struct(priority_of(source, priority), F.col(row))
    survivors = [
        F.min_by(F.col(name), F.when(F.col(name).isNotNull(), rank)).alias(name) for name in values
    ]
    grouped = records.groupBy(key).agg(*survivors, F.collect_set(source).alias("_sources"))
    return grouped.select(
        key, *values,
        F.size("_sources").alias("source_count"),
        F.array_join(F.array_sort("_sources"), ", ").alias("source_names"),
    )


def provenance(records: DataFrame, key: str, source: str) -> DataFrame:
    """Number and sorted names of the sources of each key."""
    grouped = records.groupBy(key).agg(F.collect_set(source).alias("_sources"))
    return grouped.select(
        key, F.size("_sources").alias("source_count"),
        F.array_join(F.array_sort("_sources"), ", ").alias("source_names"),
    )


def _cells_of(frame: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """(keys, column number, value, first position) with every distinct value once.

    Equal values are folded before the shuffle and the shuffle key includes the value,
    so the rows of a hot key spread over its different values.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(place).alias("place"), F.col(name).cast("string").alias("value"))
        for place, name in enumerate(columns)
    ]))
    long = frame.select(*keys, F.col(order).alias("_at"), cells.alias("_cell")).select(
        *keys, "_at", F.col("_cell.place").alias("_place"), F.col("_cell.value").alias("_value")
    )
    return long.where(F.col("_value").isNotNull()).groupBy(*keys, "_place", "_value").agg(F.min("_at").alias("_at"))


def _in_order(condition: Column | None, value: str = "_value", at: str = "_at") -> Column:
    pair = F.struct(F.col(at).alias("at"), F.col(value).alias("value"))
    kept = pair if condition is None else F.when(condition, pair)
    return F.transform(F.array_sort(F.collect_list(kept)), lambda item: item["value"])


def merge_values(frame: DataFrame, key: str, columns: list[str], order: str, separator: str = ";",
                 within: list[str] = ()) -> DataFrame:
    """One row per key; each column lists its distinct trimmed values in row order.

    ``order`` comes back as the first row of the key. Rows without a key are not
    grouped: they pass through as they are. ``within`` (never NULL, such as the file)
    keeps equal keys of different files apart. A key with one row needs no list: only the
    rows of keys with several are taken apart into cells.
    """
    keys = [*within, key]
    keyed = frame.where(F.col(key).isNotNull())
    trimmed = keyed.select(*keys, order, *[strip(F.col(name).cast("string")).alias(name) for name in columns])
    sizes = settle(group_sizes(trimmed, keys))
    marked = settle(attach(trimmed, sizes, keys, "group_rows", F.col(order), how="inner"))
    alone = marked.where("group_rows = 1").select(*keys, order, *[F.nullif(F.col(name), F.lit("")).alias(name) for name in columns])
    several = marked.where("group_rows > 1").drop("group_rows")
    cells = _cells_of(several, keys, columns, order)
    merged = cells.groupBy(*keys).agg(*[
        F.array_join(_in_order(F.col("_place") == place), separator).alias(f"_c{place}")
        for place in range(len(columns))
    ])
    merged = merged.select(*keys, *[
        F.nullif(F.col(f"_c{place}"), F.lit("")).alias(name) for place, name in enumerate(columns)
    ])
    # a key whose columns are all empty has no cells but is still one row
    bare = several.groupBy(*keys).agg(F.min(order).alias(order))
    together = bare.join(merged, keys, "left").unionByName(alone)
    unkeyed = frame.where(F.col(key).isNull()).select(
        *keys, order, *[F.col(name).cast("string").alias(name) for name in columns]
    )
    return together.unionByName(unkeyed)


def group_sizes(frame: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("group_rows"), *extra)


def _null_safe_keys(frame: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The frame with text keys that are never NULL, so that missing keys equal each other."""
    safe = {}
    for at, key in enumerate(keys):
        safe[f"_key{at}"] = F.coalesce(F.col(key).cast("string"), F.lit(""))
        safe[f"_missing{at}"] = F.col(key).isNull()
    return frame.withColumns(safe), list(safe)


def flag_duplicates(frame: DataFrame, keys: list[str], row: str, name: str = "is_duplicate") -> DataFrame:
    """True on every row whose key occurs more than once, false on the others; missing keys are equal."""
    keyed, safe = _null_safe_keys(frame, keys)
    marked = attach(keyed, settle(group_sizes(keyed, safe)), safe, "group_rows", F.col(row))
    return marked.withColumn(name, F.col("group_rows") > 1).drop("group_rows", *safe)


def flag_repeats(frame: DataFrame, keys: list[str], row: str, name: str = "is_repeat") -> DataFrame:
    """True on every row of a key except the first in row order; missing keys are equal."""
    keyed, safe = _null_safe_keys(frame, keys)
    first = settle(group_sizes(keyed, safe, F.min(row).alias("_first")))
    marked = attach(keyed, first, safe, "group_rows", F.col(row))
    return marked.withColumn(name, F.col(row) > F.col("_first")).drop("group_rows", "_first", *safe)


def duplicate_row_count(frame: DataFrame, keys: list[str], name: str = "duplicate_rows") -> DataFrame:
    """Rows (not keys) that belong to a key with more than one row."""
    sizes = group_sizes(frame, keys)
    in_groups = F.sum(F.when(F.col("group_rows") > 1, F.col("group_rows")))
    return sizes.agg(F.coalesce(in_groups, F.lit(0)).alias(name))


def keep_first(frame: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The whole first row of each key by ``order``; NULL keys count as one key.

    An aggregate, so only one candidate row per key and task is shuffled.
    """
    others = [name for name in frame.columns if name not in keys]
    whole = F.struct(*[F.col(name) for name in others])
    first = frame.groupBy(*keys).agg(F.min_by(whole, F.struct(*[as_column(part) for part in order])).alias("_row"))
    return first.select(*keys, "_row.*").select(*frame.columns)


def keep_first_null_unsafe(frame: DataFrame, keys: list[str], order: list) -> DataFrame:
    """As ``keep_first`` when every key is present; a NULL equals nothing, so such rows all stay."""
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in keys])
    return keep_first(frame.where(complete), keys, order).unionByName(frame.where(~complete))


def conflict_report(frame: DataFrame, key: str, counted: dict[str, str]) -> DataFrame:
    """For keys with several rows: how many different values each column shows.

    Values travel as digests. Equal (key, column, digest) fold into one row before the
    shuffle, which spreads a hot key over its values; the second step counts what is left.
    """
    def digest(column: str) -> Column:
        return F.unhex(F.md5(F.col(column).cast("string").cast("binary")))

    row = F.struct(F.lit(-1).alias("place"), F.lit(None).cast("binary").alias("digest"))
    cells = F.array(row, *[F.struct(F.lit(place).alias("place"), digest(column).alias("digest"))
                           for place, column in enumerate(counted.values())])
    folded = frame.select(key, F.inline(cells)).where("place = -1 OR digest IS NOT NULL").groupBy(key, "place", "digest").agg(
        F.count("*").alias("n"))
    report = folded.groupBy(key).agg(
        F.sum(F.when(F.col("place") == -1, F.col("n"))).alias("group_rows"),
        *[F.count_if(F.col("place") == place).alias(name) for place, name in enumerate(counted)],
    )
    return report.where(F.col("group_rows") > 1).drop("group_rows")


# --- continuation rows --------------------------------------------------------------------------


def _is_complete(columns: list[str]) -> Column:
    present = [F.col(name).isNotNull() & ~is_blank(F.col(name).cast("string")) for name in columns]
    return reduce(lambda a, b: a & b, present)


def destination_rows(frame: DataFrame, record: str, row: str, columns: list[str]) -> DataFrame:
    """Per record the row that will hold the merged value: its first complete row, else its first."""
    return frame.groupBy(record).agg(
        F.count("*").alias("group_rows"),
        F.min(row).alias("first_row"),
        F.coalesce(F.min(F.when(_is_complete(columns), F.col(row))), F.min(row)).alias("destination_row"),
    )


def _distinct_parts(frame: DataFrame, record: str, row: str, parts: Column, name: str, separator: str) -> DataFrame:
    exploded = frame.select(record, F.col(row).alias("_row"), F.posexplode(parts).alias("_pos", "_part"))
    once = exploded.groupBy(record, "_part").agg(F.min(F.struct("_row", "_pos")).alias("_at"))
    return once.groupBy(record).agg(
        F.array_join(_in_order(None, "_part"), separator).alias(name)
    )


def merge_list_cells(frame: DataFrame, record: str, row: str, column: str, name: str) -> DataFrame:
    """Per record the distinct items of all its ``;`` cells, in row order."""
    return _distinct_parts(frame, record, row, split_list(column), name, ";")


def merge_text_pieces(frame: DataFrame, record: str, row: str, column: str, name: str) -> DataFrame:
    """Per record the distinct text pieces, blanks collapsed, joined by a space in row order."""
    piece = collapse_spaces(column)
    return _distinct_parts(frame, record, row, F.when(piece != "", F.array(piece)), name, " ")


def has_items(column: str) -> Column:
    """Something other than separators and blanks."""
    return F.coalesce(strip(F.replace(F.col(column), F.lit(";"), F.lit(""))) != "", F.lit(False))


def _with_record(frame: DataFrame, record: str, within: list[str]) -> DataFrame:
    """The frame with ``_record``, the record id inside its file (or whatever ``within`` names); NULL without an id."""
    parts = [F.to_json(F.array(*[F.col(name).cast("string") for name in [*within, record]]))] if within else [F.col(record)]
    return frame.withColumn("_record", F.when(F.col(record).isNotNull(), parts[0]))


def consolidate_list_column(frame: DataFrame, record: str, row: str, column: str, within: list[str] = (),
                            drop_late_destination: bool = False) -> DataFrame:
    """Merge a category spread over several rows of a record into its destination row.

    Other later rows of the record that still show a category are dropped; the complete
    row, which holds the merged list, stays, and so do rows without a category. With
    ``drop_late_destination`` a destination that is not the first row is dropped as well.
    Records are told apart by ``within`` (their file) and their id.
    """
    columns = [name for name in frame.columns if name != row]
    named = _with_record(frame, record, list(within))
    keyed = named.where(F.col("_record").isNotNull())
    target = destination_rows(keyed, "_record", row, columns)
    merged = merge_list_cells(keyed, "_record", row, column, "_merged")
    groups = settle(target.join(merged, "_record", "left"))
    marked = attach(keyed, groups, ["_record"], "group_rows", F.col(row))
    is_target = F.col(row) == F.col("destination_row")
    written = marked.withColumn(column, F.when(is_target, F.col("_merged")).otherwise(F.col(column)))
    dropped = (F.col(row) > F.col("first_row")) & has_items(column)
    if not drop_late_destination:
        dropped = dropped & ~is_target
    return written.where(~dropped).select(*frame.columns).unionByName(frame.where(F.col(record).isNull()))


def consolidate_text_column(frame: DataFrame, record: str, row: str, column: str, within: list[str] = ()) -> DataFrame:
    """Merge text fragments of a record into its destination row and drop the other fragments."""
    columns = [name for name in frame.columns if name != row]
    named = _with_record(frame, record, list(within))
    keyed = named.where(F.col("_record").isNotNull())
    target = destination_rows(keyed, "_record", row, columns)
    merged = merge_text_pieces(keyed, "_record", row, column, "_merged")
    groups = settle(target.join(merged, "_record", "left"))
    marked = attach(keyed, groups, ["_record"], "group_rows", F.col(row))
    is_target = F.col(row) == F.col("destination_row")
    fragment = ~is_target & (collapse_spaces(column) != "")
    kept = marked.where(~fragment).withColumn(column, F.when(is_target, F.col("_merged")).otherwise(F.col(column)))
    return kept.select(*frame.columns).unionByName(frame.where(F.col(record).isNull()))

