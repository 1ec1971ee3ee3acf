"""Relational model: dimensions with surrogate keys, bridges, facts, integrity by rebuild."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import as_column
from lectern.operators.dedup import keep_first_null_unsafe
from lectern.operators.skew import attach, dense_ids

# consecutive identifiers that share one block when ids are assigned
ID_BLOCK = 1_000_000


def dimension(rows: DataFrame, name: str, order: list[str], id_name: str, block: int = ID_BLOCK) -> DataFrame:
    """Distinct names with ids in first-seen order, and how many rows refer to each.

    The first element of ``order`` is an integer position (a row number or a numeric
    identifier).
    """
    first = rows.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.min(F.struct(*order)).alias("_first"), F.count("*").alias("uses")
    )
    numbered = dense_ids(
        first, F.floor(F.col(f"_first.{order[0]}") / block),
        [*[F.col(f"_first.{part}") for part in order], F.col(name)], id_name,
    )
    return numbered.select(F.col(id_name), F.col(name), F.col("uses"))


def grow(stored: DataFrame, rows: DataFrame, names: list[str], order: list[str], id_name: str,
         block: int = ID_BLOCK) -> DataFrame:
    """The names of ``rows`` that ``stored`` (id and names) lacks, with ids that go on from its largest, and their ``uses``.

    Names that are stored keep their ids, whatever later runs bring; the new ones are
    numbered in first-seen order. A load adds the result to the stored dimension. Rows with a
    NULL among the names have no id. The first element of ``order`` is an integer position.
    """
    first = rows.dropna(subset=names).groupBy(*names).agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("uses"))
    unknown = first.join(stored.select(*names), names, "left_anti")
    numbered = dense_ids(
        unknown, F.floor(F.col(f"_first.{order[0]}") / block),
        [*[F.col(f"_first.{part}") for part in order], *[F.col(name) for name in names]], "_number")
    last = stored.agg(F.coalesce(F.max(id_name), F.lit(0)).cast("bigint").alias("last")).scalar()
    return numbered.select((F.col("_number") + last).alias(id_name), *names, "uses")


def grown_dimension(stored: DataFrame, rows: DataFrame, names: list[str], order: list[str], id_name: str,
                    block: int = ID_BLOCK) -> DataFrame:
    """The stored dimension and the new names of ``rows``, without the uses, which are those of one batch."""
    return stored.select(id_name, *names).unionByName(grow(stored, rows, names, order, id_name, block).select(id_name, *names))


def to_ids(rows: DataFrame, dim: DataFrame, name: str, id_name: str, spread: Column) -> DataFrame:
    """Replace a business name by its id; a very frequent name is salted."""
    return attach(rows, dim.select(name, id_name, "uses"), [name], "uses", spread, how="inner").drop(name, "uses")


def bridge(rows: DataFrame, left: str, dim: DataFrame, name: str, id_name: str, spread: Column,
           extra: list[str] = ()) -> DataFrame:
    """Distinct (left, id, extra) pairs; repeated names in one cell count once."""
    return to_ids(rows.select(left, name, *extra), dim, name, id_name, spread).select(left, id_name, *extra).distinct()


def works(rows: DataFrame, title: str, people: str, order: str, id_name: str = "work_id") -> DataFrame:
    """Distinct (title, contributors) works; a NULL in either makes no work."""
    complete = rows.where(F.col(title).isNotNull() & F.col(people).isNotNull())
    grouped = complete.groupBy(title, people).agg(F.min(order).alias("_first"), F.count("*").alias("uses"))
    numbered = dense_ids(grouped, F.floor(F.col("_first") / ID_BLOCK), [F.col("_first"), title, people], id_name)
    return numbered.select(id_name, title, people, "uses")


def work_bridge(rows: DataFrame, work: DataFrame, title: str, people: str, key: str,
                id_name: str = "work_id") -> DataFrame:
    """(key, work id) pairs by title and contributors."""
    linked = attach(rows.select(key, title, people), work.select(title, people, id_name, "uses"),
                    [title, people], "uses", F.col(key), how="inner")
    return linked.select(key, id_name).distinct()


def load_facts(rows: DataFrame, dim: DataFrame, key: str, id_name: str) -> DataFrame:
    """Fact rows whose business key is known, with the surrogate key instead."""
    return rows.join(dim.select(key, id_name), key, "inner").drop(key)


def dedup_facts(facts: DataFrame, keys: list[str], order: list) -> DataFrame:
    return keep_first_null_unsafe(facts, keys, order)


def store_facts(rows: DataFrame, key: str, stores, order: str, extra: list[str] = ()) -> DataFrame:
    """One fact per (key, store); no year and no quantity."""
    one = rows.select(key, order, *extra, F.posexplode(as_column(stores)).alias("_place", "store"))
    ordered = one.withColumn("_order", F.struct(order, "_place")).drop("_place")
    first = keep_first_null_unsafe(ordered, [key, "store"], ["_order"])
    return first.select(key, "store", *extra)


# --- removing identifiers and what only they referred to -------------------------------------------


def keep_referenced(rows: DataFrame, keys: list[str], by: list[DataFrame]) -> DataFrame:
    """Rows whose key occurs in any of the referring tables."""
    referring = reduce(lambda a, b: a.union(b), [frame.select(*keys) for frame in by]).distinct()
    return rows.join(referring, keys, "left_semi")


def cascade(kept: DataFrame, key: str, bridges: dict[str, DataFrame], work_people: DataFrame,
            dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rebuild bridges and dimensions on the kept identifiers.

    Bridges follow the identifiers, works follow their bridge, the work-to-author
    bridge follows the works, and an author stays while either bridge refers to it.
    """
    left = {name: frame.join(kept.select(key).distinct(), key, "left_semi") for name, frame in bridges.items()}
    out = dict(left)
    out["works"] = keep_referenced(dims["works"], ["work_id"], [left["identifier_works"]])
    out["work_authors"] = work_people.join(out["works"].select("work_id"), "work_id", "left_semi")
    out["authors"] = keep_referenced(dims["authors"], ["author_id"], [left["identifier_authors"], out["work_authors"]])
    out["publishers"] = keep_referenced(dims["publishers"], ["publisher_id"], [left["identifier_publishers"]])
    return out


# the dimension of each bridge, and its id
REFERENCES = {
    "identifier_authors": ("authors", "author_id"), "work_authors": ("authors", "author_id"),
    "identifier_works": ("works", "work_id"), "identifier_publishers": ("publishers", "publisher_id"),
}


def reference_counts(bridges: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per dimension its ids and ``uses``: how many bridge rows refer to each. ``bridges`` include ``work_authors``."""
    found: dict[str, DataFrame] = {}
    for name, frame in bridges.items():
        dim, id_name = REFERENCES[name]
        ids = frame.select(id_name).dropna()
        found[dim] = found[dim].union(ids) if dim in found else ids
    return {dim: ids.groupBy(*ids.columns).agg(F.count("*").alias("uses")) for dim, ids in found.items()}


def removal(removed: DataFrame, key: str, bridges: dict[str, DataFrame], counts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What goes with the removed identifiers: for each bridge its rows, for each dimension the new ``uses`` of touched ids.

    The stored counts are lowered by the bridge rows that go, so only rows that the removal
    touches are grouped; nothing is built again. An id whose ``uses`` fall to 0 goes; a work
    that goes takes its rows of ``work_authors`` along, and these count against their
    authors. The result holds changes only: the caller deletes these rows, or rewrites the
    partitions that hold them. Identifiers that no bridge has, and repeated ones, change
    nothing; dimension rows to which nothing referred before are left to ``cascade``.
    """
    going = {name: frame.join(removed.select(key), key, "left_semi") for name, frame in bridges.items() if name != "work_authors"}

    def lowered(dim: str) -> DataFrame:
        id_name = {dim_name: column for dim_name, column in REFERENCES.values()}[dim]
        lost = reduce(lambda a, b: a.union(b), [
            going[name].select(id_name) for name, (of, _) in REFERENCES.items() if of == dim and name in going])
        lost = lost.groupBy(id_name).agg(F.count("*").alias("_lost"))
        return counts[dim].join(lost, id_name).select(id_name, (F.col("uses") - F.col("_lost")).alias("uses"))

    works = lowered("works")
    going["work_authors"] = bridges["work_authors"].join(works.where("uses = 0").select("work_id"), "work_id", "left_semi")
    return going | {"works": works, "authors": lowered("authors"), "publishers": lowered("publishers")}


def after_removal(frame: DataFrame, change: DataFrame, keys: list[str]) -> DataFrame:
    """A stored bridge, dimension or table of counts after its ``change``: rows that go leave, counts are brought up to date."""
    if "uses" not in change.columns:
        return frame.join(change.select(*keys), keys, "left_anti")
    if "uses" not in frame.columns:
        return frame.join(change.where("uses = 0").select(*keys), keys, "left_anti")
    new = change.select(*keys, F.col("uses").alias("_uses"))
    return frame.join(new, keys, "left").withColumn("uses", F.coalesce("_uses", "uses")).drop("_uses").where("uses > 0")
