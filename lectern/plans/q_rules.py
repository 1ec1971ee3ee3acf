"""Queries: declared rules over inputs that break them, ids and facts over several loads.

Sales, metrics and staging rows are derived from the given tables with faults that follow
from their values: missing dates and channels, negative units, revenue in fractions of a cent, metrics
that come twice, identifiers that no catalogue has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.codes import is_isbn13
from lectern.operators import model, rules
from lectern.plans import inputs
from lectern.plans.inputs import STAGING_SQL, with_identifier_sql
from lectern.plans.registry import query
from lectern.session import ensure_checkpoint_dir, settle
from lectern.streaming import incremental

FAULTY_SALES = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS sale,
  concat(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '979' ELSE '978' END,
         lpad(CAST(l_partkey AS STRING), 9, '0')) AS stem,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS sale_date,
  CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN -CAST(l_quantity AS INT) ELSE CAST(l_quantity AS INT) END AS units,
  CASE WHEN l_returnflag = 'A' AND l_tax = 0 THEN -l_extendedprice WHEN l_linenumber = 2 THEN l_extendedprice / 1000 ELSE l_extendedprice END AS revenue_eur,
  CASE WHEN l_discount = 0.01 THEN NULL WHEN l_returnflag = 'N' THEN 'Google Play' ELSE 'Web' END AS channel
FROM lineitem
"""
FAULTY_METRICS = """
SELECT c_custkey AS place, concat('978', lpad(CAST(CASE WHEN c_nationkey = 3 THEN c_custkey - c_custkey % 4 ELSE c_custkey END AS STRING), 9, '0')) AS stem,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS mentions
FROM customer
"""

def declared() -> list[rules.Rule]:
    return [
        rules.not_negative("units >= 0", "sales", "units"),
        rules.not_negative("revenue >= 0", "sales", "revenue_eur"),
        rules.Check("revenue in whole cents", "sales", F.col("revenue_eur") * 100 != F.floor(F.col("revenue_eur") * 100 + 0.5)),
        rules.present("sale has a date", "sales", "sale_date"),
        rules.present("sale has a channel", "sales", "channel"),
        rules.Reference("sale is of a known edition", "sales", "isbn13", "editions"),
        rules.present("mentions are known", "metrics", "mentions"),
        rules.Unique("one metric row an edition", "metrics", ("isbn13",)),
        rules.Reference("metrics are of a known edition", "metrics", "isbn13", "editions"),
        rules.Check("identifier passes the checksum", "editions", ~is_isbn13("isbn13")),
        rules.Unique("one staging row an edition", "editions", ("isbn13",)),
        rules.Unique("one staging row a title and source", "editions", ("source_name", "normalized_title")),
        rules.present("edition has a country", "editions", "country"),
    ]


def row_keys() -> dict[str, Column]:
    return {
        "sales": F.col("sale"), "metrics": F.col("place").cast("string"),
        "editions": F.concat_ws(":", "source_name", F.col("source_row").cast("string")),
    }


def faulty_tables(t) -> dict[str, DataFrame]:
    return {
        "sales": inputs.with_identifier(inputs.derive(t, "lineitem", FAULTY_SALES), "isbn13"),
        "metrics": inputs.with_identifier(inputs.derive(t, "customer", FAULTY_METRICS), "isbn13"),
        "editions": inputs.records(t).select("source_name", "source_row", "isbn13", "normalized_title", "country"),
    }


def _once(table: str, keys: str) -> str:
    return f"({keys}) IN (SELECT ({keys}) FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


_SQL_RULES = {
    "units >= 0": ("sales", "units < 0"), "revenue >= 0": ("sales", "revenue_eur < 0"),
    "revenue in whole cents": ("sales", "revenue_eur * 100 <> floor(revenue_eur * 100 + 0.5)"),
    "sale has a date": ("sales", "sale_date IS NULL"), "sale has a channel": ("sales", "channel IS NULL"),
    "sale is of a known edition": ("sales", "isbn13 NOT IN (SELECT isbn13 FROM editions)"),
    "mentions are known": ("metrics", "mentions IS NULL"), "one metric row an edition": ("metrics", _once("metrics", "isbn13")),
    "metrics are of a known edition": ("metrics", "isbn13 NOT IN (SELECT isbn13 FROM editions)"),
    "identifier passes the checksum": ("editions", "NOT valid_isbn"), "one staging row an edition": ("editions", _once("editions", "isbn13")),
    "one staging row a title and source": ("editions", _once("editions", "source_name, normalized_title")),
    "edition has a country": ("editions", "country IS NULL"),
}
_SQL_KEYS = {"sales": "sale", "metrics": "CAST(place AS VARCHAR)", "editions": "concat(source_name, ':', CAST(source_row AS VARCHAR))"}
FAULTY_SQL = ",\n".join([STAGING_SQL, with_identifier_sql("sales", FAULTY_SALES, "isbn13"),
                         with_identifier_sql("metrics", FAULTY_METRICS, "isbn13"), "editions AS (SELECT * FROM records)"])


@query("rule_report", f"WITH {FAULTY_SQL} " + " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{table}' AS table_name, count(*) AS violations FROM {table} WHERE {broken}"
    for name, (table, broken) in _SQL_RULES.items()))
def rule_report(t):
    return rules.audit(faulty_tables(t), declared(), row_keys()).report


@query("rule_rejections", f"WITH {FAULTY_SQL} " + " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{table}' AS table_name, {_SQL_KEYS[table]} AS row_key FROM {table} WHERE {broken}"
    for name, (table, broken) in _SQL_RULES.items()))
def rule_rejections(t):
    return rules.audit(faulty_tables(t), declared(), row_keys()).rejected.drop("row")


@query("rule_accepted_sales", f"WITH {FAULTY_SQL} SELECT sale, isbn13, units, revenue_eur, channel FROM sales WHERE NOT (" + " OR ".join(
    f"coalesce({broken}, FALSE)" for table, broken in _SQL_RULES.values() if table == "sales") + ")")
def rule_accepted_sales(t):
    accepted = rules.audit(faulty_tables(t), declared(), row_keys()).accepted["sales"]
    return accepted.select("sale", "isbn13", "units", "revenue_eur", "channel")


# --- several loads ---------------------------------------------------------------------------------


@query("grown_titles", f"""WITH {STAGING_SQL},
loads AS (SELECT normalized_title, source_row, CASE source_name WHEN 'plantilla_propia' THEN 1 WHEN 'simeh' THEN 2 ELSE 3 END AS load FROM records),
firsts AS (SELECT normalized_title, min(load) AS load, min_by(source_row, load * 1000000000000 + source_row) AS place FROM loads
  WHERE normalized_title IS NOT NULL GROUP BY 1)
SELECT row_number() OVER (ORDER BY load, place, normalized_title) AS title_id, normalized_title, CAST(load AS INT) AS load FROM firsts""")
def grown_titles(t):
    """Title ids over three loads: the second and third bring their sources and all rows of the loads before."""
    rows = inputs.records(t).select("source_name", "source_row", "normalized_title")
    held = rows.sparkSession.createDataFrame([], "title_id bigint, normalized_title string")
    loads, seen = [], []
    for number, source in enumerate(("plantilla_propia", "simeh", "scielo"), 1):
        seen.append(source)
        added = settle(model.grow(held, rows.where(F.col("source_name").isin(seen)), ["normalized_title"], ["source_row"], "title_id"))
        held = held.unionByName(added.drop("uses"))
        loads.append(added.select("title_id", "normalized_title", F.lit(number).alias("load")))
    return loads[0].unionByName(loads[1]).unionByName(loads[2])


FACTS_SQL = """SELECT l_orderkey AS n, l_linenumber AS line, l_partkey AS part, CAST(year(l_shipdate) AS INT) AS year,
  CASE WHEN l_discount = 0.02 THEN NULL ELSE l_returnflag END AS channel, l_linestatus AS batch FROM lineitem"""


@query("incremental_facts", f"""WITH facts AS ({FACTS_SQL}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part, year, channel ORDER BY batch, n, line) AS place FROM facts)
SELECT n, line, part, year, channel, CAST(CASE batch WHEN 'F' THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM ranked
WHERE place = 1 OR channel IS NULL""")
def incremental_facts(t):
    """Facts of two batches, both of them run twice."""
    lines = t("lineitem")
    facts = lines.sparkSession.sql(FACTS_SQL.replace("FROM lineitem", "FROM {lines}"), lines=lines)
    path = f"{ensure_checkpoint_dir(lines.sparkSession)}/facts-{uuid.uuid4().hex}"
    batches = [facts.where("batch = 'F'").drop("batch"), facts.where("batch = 'O'").drop("batch")]
    for number in (0, 1, 1, 0):
        incremental.store_batch(batches[number], number, path, "sales", ["part", "year", "channel"], ["n", "line"], "year")
    return incremental.fact_store(lines.sparkSession, path, batches[0].schema).drop("stream")
