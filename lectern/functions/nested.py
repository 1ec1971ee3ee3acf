"""Cells that hold a serialised list of key/value pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.text import as_column, bind, natural_name

PAIR_LIST = "array<array<string>>"
PAIR_LISTS = "array<array<array<string>>>"


def _as_json(value) -> Column:
    # literals only where they are the value of a pair; most cells have none and skip the pattern
    cell = as_column(value)
    for literal, spelled in (("None", "null"), ("True", "true"), ("False", "false")):
        cell = bind(cell, _respelled(literal, spelled))
    return cell


def _respelled(literal: str, spelled: str):
    pattern = rf"(?<=['\"],\s{{0,4}}){literal}(?=\s*\])"
    return lambda cell: F.when(F.contains(cell, F.lit(literal)), F.regexp_replace(cell, pattern, spelled)).otherwise(cell)


def unreadable(value, parsed) -> Column:
    """Whether a cell holds something and could not be read; such rows go to quarantine."""
    cell = as_column(value)
    return F.coalesce(F.trim(cell) != "", F.lit(False)) & parsed.isNull()


def parse_pairs(value) -> Column:
    """One object; NULL when the cell cannot be read."""
    return F.from_json(_as_json(value), PAIR_LIST)


def parse_pair_lists(value) -> Column:
    """A list of objects; NULL when the cell cannot be read."""
    return F.from_json(_as_json(value), PAIR_LISTS)


def pair_value(pairs, key: str) -> Column:
    """Value of ``key``; the last one when it is repeated."""
    hits = F.filter(as_column(pairs), lambda pair: F.get(pair, 0) == key)
    return F.get(F.try_element_at(hits, F.lit(-1)), 1)


def creators(value) -> Column:
    """array<struct<role, name>>: role in the catalogue's words, name in natural order."""
    words = F.create_map(*[F.lit(word) for pair in fixed.CREATOR_ROLES.items() for word in pair])

    def one(pairs: Column) -> Column:
        return F.struct(
            bind(pair_value(pairs, "role"), lambda role: F.coalesce(F.try_element_at(words, role), role)).alias("role"),
            bind(pair_value(pairs, "full_name"), natural_name).alias("name"),
        )

    return F.transform(parse_pair_lists(value), one)


def object_title(value) -> Column:
    return pair_value(parse_pairs(value), "title")


def stores(value) -> Column:
    return F.transform(parse_pair_lists(value), lambda pairs: pair_value(pairs, "store"))
