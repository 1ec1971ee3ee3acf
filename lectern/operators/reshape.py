"""Wide to long, long to wide, multi-valued cells to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.text import as_column, is_blank, natural_name, split_list


def one_row_per_edition(frame: DataFrame, formats: dict[str, str] = fixed.EDITION_FORMATS,
                        once: list[str] = ()) -> DataFrame:
    """One row per filled identifier column, with its format.

    The identifier columns of one row are ordered by column name and exploded in
    place, so no shuffle is needed. Columns in ``once`` (a DOI) stay on the first of
    the new rows only.
    """
    filled = F.array_compact(F.array(*[
        F.when(
            F.col(f"`{name}`").isNotNull() & ~is_blank(F.col(f"`{name}`").cast("string")),
            F.struct(F.lit(label).alias("format"), F.col(f"`{name}`").cast("string").alias("identifier")),
        )
        for name, label in sorted(formats.items())
    ]))
    rest = [name for name in frame.columns if name not in formats]
    long = frame.select(*[F.col(f"`{name}`") for name in rest], F.posexplode(filled).alias("_place", "_edition"))
    kept = [
        F.when(F.col("_place") == 0, F.col(f"`{name}`")).alias(name) if name in once else F.col(f"`{name}`")
        for name in rest
    ]
    return long.select(*kept, F.col("_edition.identifier").alias("identifier"),
                       F.col("_edition.format").alias("edition_format"))


def unpivot(frame: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """Long form without empty values."""
    cells = [F.col(column).cast("string").alias(column) for column in values]
    long = frame.select(*ids, *cells).unpivot(ids, values, name, value)
    return long.where(F.col(value).isNotNull() & ~is_blank(value))


def pivot_first(frame: DataFrame, rows: str, columns: str, values: list[str], cell: str) -> DataFrame:
    """Long to wide over a declared list of column values."""
    return frame.groupBy(rows).pivot(columns, values).agg(F.min(cell))


def split_keyed(frame: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return frame.where(F.col(key).isNotNull()), frame.where(F.col(key).isNull())


def contributors(roles: dict[str, str] = fixed.CONTRIBUTOR_ROLES) -> Column:
    """array<struct<role, name>> from one ``;`` cell per role, in the order of the roles."""

    def tagged(role: str):
        return lambda name: F.struct(F.lit(role).alias("role"), natural_name(name).alias("name"))

    return F.concat(*[F.transform(split_list(column), tagged(role)) for column, role in roles.items()])


def contributor_cell(people) -> Column:
    return F.array_join(F.transform(as_column(people), lambda person: person["name"]), ";")


def publisher_roles(publisher, copublishers, same: str = "editor", other: str = "coeditor") -> Column:
    """Publishers then co-publishers as (role, name); a co-publisher that equals a publisher is an editor."""
    main, more = split_list(publisher), split_list(copublishers)
    tagged = F.transform(F.concat(main, more), lambda name: F.struct(
        F.when(F.array_contains(main, name), same).otherwise(other).alias("role"), name.alias("name")))
    return F.array_distinct(tagged)


def _exploded(frame: DataFrame, keys: list[str], items: Column, name: str) -> DataFrame:
    """One row per item. The plain form makes the planner test the list's size first, which computes the list again."""
    return frame.select(*keys, F.posexplode_outer(items).alias("position", name)).where(F.col("position").isNotNull())


def explode_people(frame: DataFrame, keys: list[str], people) -> DataFrame:
    """(keys, position, role, name) rows out of a people array."""
    return _exploded(frame, keys, as_column(people), "_person").select(*keys, "position", "_person.*")


def explode_list(frame: DataFrame, keys: list[str], cell, name: str) -> DataFrame:
    """(keys, position, item) rows out of a ``;`` cell."""
    return _exploded(frame, keys, split_list(cell), name)
