"""Declared rules over tables: every violation counted, and kept with its row.

A table is read once for all its rules. Rows are marked with the names of the rules they
break: conditions are evaluated in place, referenced keys are joined as distinct keys, and
key counts are attached to the rows with hot keys salted. Only what is asked for is worked
out: the report counts the marks, the rejected rows are written when someone reads them,
and the accepted rows of a table need the marks of that table alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.skew import attach
from lectern.session import settle


@dataclass(frozen=True)
class Check:
    """Rows for which ``broken`` is true violate the rule; NULL does not."""

    name: str
    table: str
    broken: Column


@dataclass(frozen=True)
class Unique:
    """All rows of a key that occurs more than once violate the rule; a NULL in the key equals nothing."""

    name: str
    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """Rows whose ``key`` is present but not in the parent violate the rule."""

    name: str
    table: str
    key: str
    parent: str
    parent_key: str | None = None


Rule = Check | Unique | Reference


def present(name: str, table: str, column: str) -> Check:
    return Check(name, table, F.col(column).isNull())


def not_negative(name: str, table: str, column: str) -> Check:
    return Check(name, table, F.col(column) < 0)


BROKEN = "_broken_rules"


def marked(tables: dict[str, DataFrame], table: str, rules: Iterable[Rule]) -> DataFrame:
    """The table with the names of the rules that each row breaks."""
    frame, flags, helpers = tables[table], [], []
    for number, rule in enumerate(rules):
        helper = f"_rule_{number}"
        if isinstance(rule, Check):
            broken = rule.broken
        elif isinstance(rule, Reference):
            keys = tables[rule.parent].select(F.col(rule.parent_key or rule.key).alias(rule.key)).where(
                F.col(rule.key).isNotNull()).distinct().withColumn(helper, F.lit(True))
            frame = frame.join(keys, rule.key, "left")
            broken = F.col(rule.key).isNotNull() & F.col(helper).isNull()
            helpers.append(helper)
        else:
            keys = list(rule.keys)
            counts = frame.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(helper))
            spread = F.struct(*[F.col(name) for name in tables[table].columns if name not in keys] or [F.lit(0)])
            frame = attach(frame, counts, keys, helper, spread)
            broken = F.col(helper) > 1
            helpers.append(helper)
        flags.append(F.when(F.coalesce(broken, F.lit(False)), F.lit(rule.name)))
    return frame.withColumn(BROKEN, F.array_compact(F.array(*flags))).drop(*helpers).select(*tables[table].columns, BROKEN)


class Audit:
    """What the rules found in some tables; each result is worked out when it is first read."""

    def __init__(self, tables: dict[str, DataFrame], rules: list[Rule], row_keys: dict[str, Column]):
        self._rules, self._row_keys = rules, row_keys
        by_table: dict[str, list[Rule]] = {}
        for rule in rules:
            by_table.setdefault(rule.table, []).append(rule)
        self._marked = {table: marked(tables, table, own) for table, own in by_table.items()}
        self.accepted = {table: self._marked[table].where(F.size(BROKEN) == 0).drop(BROKEN) if table in by_table else frame
                         for table, frame in tables.items()}
        """The tables without the rows that break any rule."""

    @cached_property
    def rejected(self) -> DataFrame:
        """(rule, table_name, row_key, row), one row for each rule that a row breaks, the row as JSON."""
        found = []
        for table, rows in self._marked.items():
            whole = F.to_json(F.struct(*[F.col(name) for name in rows.columns if name != BROKEN]))
            found.append(rows.where(F.size(BROKEN) > 0).select(
                F.explode(BROKEN).alias("rule"), F.lit(table).alias("table_name"), self._row_keys[table].alias("row_key"), whole.alias("row")))
        return settle(reduce(DataFrame.unionByName, found))

    @cached_property
    def report(self) -> DataFrame:
        """(rule, table_name, violations) for every rule, zero included; counted from the marks, without the rows."""
        counted = reduce(DataFrame.unionByName, [
            rows.select(F.explode(BROKEN).alias("rule")).groupBy("rule").agg(F.count("*").alias("violations"))
            for rows in self._marked.values()])
        listed = F.inline(F.array(*[
            F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.table).alias("table_name")) for rule in self._rules]))
        every = counted.sparkSession.range(1).select(listed)
        return every.join(counted, "rule", "left").select("rule", "table_name", F.coalesce("violations", F.lit(0)).alias("violations"))


def audit(tables: dict[str, DataFrame], rules: list[Rule], row_keys: dict[str, Column]) -> Audit:
    """Evaluate the rules. ``row_keys`` names a row of each table, as text; only the rejected rows need it."""
    names = [rule.name for rule in rules]
    if len(set(names)) < len(names):
        raise ValueError("rules need different names")
    return Audit(tables, rules, row_keys)
