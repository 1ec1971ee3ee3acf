"""Value standardisation: equivalence tables, ordered rules, sentinels, priorities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import as_column, bind


def by_table(value, table: dict[str, list[str]], caseless: bool = True) -> Column:
    """Replace known variants by their standard form; everything else stays. Idempotent."""
    column = as_column(value)
    probe = F.lower(F.trim(column)) if caseless else column
    result = None
    for standard, variants in table.items():
        hit = probe.isin(*variants)
        result = F.when(hit, standard) if result is None else result.when(hit, standard)
    return result.otherwise(column)


def _swap(old: str, new: str):
    return lambda now: F.when(now == old, F.lit(new)).otherwise(now)


def by_rules(value, rules: list[tuple[str, str, str]]) -> Column:
    """Apply exact (``is``) and substring (``has``) replacements one after the other."""
    column = as_column(value)
    for kind, old, new in rules:
        if kind == "is":
            column = bind(column, _swap(old, new))
        else:
            column = F.replace(column, F.lit(old), F.lit(new))
    return column


def yes_no(value) -> Column:
    """``no`` when missing or when the text says no anywhere; else ``si``."""
    says_no = F.contains(F.lower(as_column(value)), F.lit("no"))
    return F.when(F.coalesce(says_no, F.lit(True)), "no").otherwise("si")


def yes_no_from_presence(value) -> Column:
    return F.when(as_column(value).isNotNull(), "si").otherwise("no")


def only_if_yes(flag, value) -> Column:
    return F.when(as_column(flag) == "si", as_column(value))


def minus_one_to_null(value) -> Column:
    column = as_column(value)
    return F.nullif(column, F.lit(-1).cast("int"))


def first_present(*values) -> Column:
    """Priority fill: the first value that is not NULL."""
    return F.coalesce(*[as_column(value) for value in values])
