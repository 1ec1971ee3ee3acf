"""Queries: duplicates, continuation rows, reshaping, bridges, facts, reports over works."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.nested import stores
from lectern.operators import conform, dedup, enrich, model, quality, reports, reshape
from lectern.operators.skew import fill_forward
from lectern.plans.inputs import derive
from lectern.plans.q_cleaning import items_sql
from lectern.plans.registry import query
from lectern.session import settle
from lectern.sources import reports as sales_reports

# --- duplicates -------------------------------------------------------------------------------------


@query("repeat_flags", """SELECT event_id, user_id, event_type,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 AS is_repeat FROM events""")
def repeat_flags(t):
    rows = t("events").select("event_id", "user_id", "event_type")
    return dedup.flag_repeats(rows, ["user_id", "event_type"], "event_id")


@query("first_writer", """SELECT user_id, event_id, event_type, value, props FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END,
   event_id) AS place FROM events) WHERE place = 1""")
def first_writer(t):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    rows = t("events").select("user_id", "event_id", "event_type", "value", "props")
    return dedup.keep_first(rows, ["user_id"], [rank, "event_id"])


LOADS = """
SELECT event_id, user_id, CAST(year(ts) AS INT) AS sale_year, CASE WHEN event_type <> 'error' THEN event_type END AS channel,
  CASE WHEN value < 40 THEN 'low' WHEN value < 80 THEN 'high' END AS store, value FROM events
"""


@query("first_fact", f"""WITH f AS ({LOADS}), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, sale_year, channel, store
  ORDER BY event_id) AS place FROM f)
SELECT event_id, user_id, sale_year, channel, store, value FROM k WHERE place = 1 OR channel IS NULL OR store IS NULL""")
def first_fact(t):
    rows = derive(t, "events", LOADS)
    return model.dedup_facts(rows, ["user_id", "sale_year", "channel", "store"], ["event_id"])


MERGED = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, concat(' ', o_orderpriority, ' ') AS priority,
  CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS status, CAST(year(o_orderdate) AS STRING) AS year FROM orders
"""


@query("merged_values", f"""WITH m AS ({MERGED}),
c AS (SELECT o_custkey, 'priority' AS name, trim(priority) AS value, min(o_orderkey) AS pos FROM m WHERE o_custkey IS NOT NULL GROUP BY ALL UNION ALL
  SELECT o_custkey, 'status', status, min(o_orderkey) FROM m WHERE o_custkey IS NOT NULL GROUP BY ALL UNION ALL
  SELECT o_custkey, 'year', year, min(o_orderkey) FROM m WHERE o_custkey IS NOT NULL GROUP BY ALL)
SELECT o_custkey, string_agg(value, ';' ORDER BY pos) FILTER (WHERE name = 'priority') AS priority,
  string_agg(value, ';' ORDER BY pos) FILTER (WHERE name = 'status') AS status,
  string_agg(value, ';' ORDER BY pos) FILTER (WHERE name = 'year') AS year FROM c GROUP BY o_custkey UNION ALL
SELECT o_custkey, priority, status, year FROM m WHERE o_custkey IS NULL""")
def merged_values(t):
    return dedup.merge_values(derive(t, "orders", MERGED), "o_custkey", ["priority", "status", "year"], "o_orderkey").drop("o_orderkey")


CONTINUED = """
SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS file, CASE WHEN event_type = 'signup' THEN concat('R', CAST(event_id AS STRING)) END AS record,
  CASE event_type WHEN 'signup' THEN 'JW;K' WHEN 'view' THEN 'K; JW' WHEN 'click' THEN concat('C', CAST(user_id AS STRING)) WHEN 'error' THEN ' ; ' END AS thema,
  CASE WHEN value > 15 THEN props END AS note FROM events
"""
FILLED_SQL = f"""WITH c AS ({CONTINUED}),
filled AS (SELECT event_id, file, CASE WHEN record IS NULL AND thema IS NOT NULL
  THEN last_value(record IGNORE NULLS) OVER (PARTITION BY file ORDER BY event_id) ELSE record END AS record, thema, note FROM c)"""


@query("forward_fill", FILLED_SQL + " SELECT * FROM filled")
def forward_fill(t):
    rows = derive(t, "events", CONTINUED)
    return fill_forward(rows, "record", "event_id", ["file"], F.col("thema").isNotNull())


CONSOLIDATED_SQL = FILLED_SQL + """,
rows AS (SELECT *, file IS NOT NULL AND record IS NOT NULL AND coalesce(trim(thema), '') <> '' AND coalesce(trim(note), '') <> '' AS complete
  FROM filled WHERE record IS NOT NULL),
targets AS (SELECT record, min(event_id) AS first_row, coalesce(min(event_id) FILTER (WHERE complete), min(event_id)) AS target FROM rows GROUP BY 1),
items AS (SELECT record, trim(item) AS item, min(event_id * 100 + place) AS pos FROM (SELECT record, event_id, unnest(string_split(thema, ';')) AS item,
  generate_subscripts(string_split(thema, ';'), 1) AS place FROM rows) WHERE trim(item) <> '' GROUP BY 1, 2),
merged AS (SELECT record, string_agg(item, ';' ORDER BY pos) AS merged FROM items GROUP BY 1),
written AS (SELECT r.event_id, r.file, r.record, CASE WHEN r.event_id = t.target THEN m.merged ELSE r.thema END AS thema, r.note, t.first_row, t.target
  FROM rows r JOIN targets t USING (record) LEFT JOIN merged m USING (record))
SELECT event_id, file, record, thema, note FROM written
WHERE NOT (event_id > first_row AND {kept} coalesce(trim(replace(thema, ';', '')), '') <> '') UNION ALL
SELECT event_id, file, record, thema, note FROM filled WHERE record IS NULL"""


@query("consolidated_lists", CONSOLIDATED_SQL.replace("{kept}", ""))
def consolidated_lists(t):
    """The order that also drops a late complete row."""
    rows = settle(forward_fill(t))
    return dedup.consolidate_list_column(rows, "record", "event_id", "thema", drop_late_destination=True)


@query("consolidated_records", CONSOLIDATED_SQL.replace("{kept}", "event_id <> target AND"))
def consolidated_records(t):
    rows = settle(forward_fill(t))
    return dedup.consolidate_list_column(rows, "record", "event_id", "thema")


@query("merged_pieces", r"""WITH p AS (SELECT conv_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS piece, min(turn) AS pos
  FROM conversations GROUP BY 1, 2)
SELECT conv_id, string_agg(piece, ' ' ORDER BY pos, piece) AS text FROM p WHERE piece <> '' GROUP BY 1""")
def merged_pieces(t):
    return dedup.merge_text_pieces(t("conversations"), "conv_id", "turn", "text", "text")


# --- reshaping ---------------------------------------------------------------------------------------

EDITIONS = """
SELECT p_partkey, p_name AS title, concat('10.1/', CAST(p_partkey AS STRING)) AS doi,
  CASE WHEN p_type <> 'SMALL' THEN concat('1', CAST(p_partkey AS STRING)) END AS print_code,
  CASE WHEN p_size > 25 THEN concat('2', CAST(p_partkey AS STRING)) ELSE ' ' END AS pdf_code,
  CASE WHEN p_brand <> 'Brand#1' THEN concat('3', CAST(p_partkey AS STRING)) END AS epub_code FROM part
"""


@query("editions_long", f"""WITH e AS ({EDITIONS}), l AS (
  SELECT p_partkey, title, doi, epub_code AS identifier, 'ebook' AS edition_format, 1 AS place FROM e UNION ALL
  SELECT p_partkey, title, doi, print_code, 'impreso', 2 FROM e UNION ALL SELECT p_partkey, title, doi, pdf_code, 'pdf', 3 FROM e)
SELECT p_partkey, title, CASE WHEN row_number() OVER (PARTITION BY p_partkey ORDER BY place) = 1 THEN doi END AS doi,
  identifier, edition_format FROM l WHERE coalesce(trim(identifier), '') <> ''""")
def editions_long(t):
    wide = derive(t, "part", EDITIONS).withColumnsRenamed(
        {"print_code": "ISBN IMPRESO", "pdf_code": "ISBN PDF", "epub_code": "ISBN EPUB"})
    return reshape.one_row_per_edition(wide, once=["doi"])


@query("unpivoted", """SELECT c_custkey, attribute, value FROM (SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer)
UNPIVOT (value FOR attribute IN (c_name, c_mktsegment, c_nationkey))""")
def unpivoted(t):
    return reshape.unpivot(t("customer"), ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"], "attribute", "value")


PEOPLE = """
SELECT o_orderkey, concat('Clerk, ', o_orderpriority, ' ;  C', CAST(o_custkey AS STRING), ';') AS main_names,
  CASE WHEN o_orderstatus = 'F' THEN concat('Ed ', o_orderpriority) END AS editors,
  CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE concat('Comp, ', o_orderstatus) END AS compilers, CAST(NULL AS STRING) AS coordinators,
  concat(o_orderpriority, ';House ', o_orderstatus) AS publisher,
  CASE WHEN o_orderstatus <> 'O' THEN concat('House ', o_orderstatus, '; Press ', CAST(o_custkey AS STRING), ';House') END AS copublishers FROM orders
"""
PEOPLE_SQL = f"""WITH o AS ({PEOPLE}), people AS (
  SELECT o_orderkey, 1 AS place, 'autor' AS role, concat(split_part(trim(split_part(main_names, ';', 1)), ', ', 2), ' Clerk') AS name FROM o UNION ALL
  SELECT o_orderkey, 2, 'autor', trim(split_part(main_names, ';', 2)) FROM o UNION ALL
  SELECT o_orderkey, 3, 'editor', editors FROM o WHERE editors IS NOT NULL UNION ALL
  SELECT o_orderkey, 4, 'compilador', concat(split_part(compilers, ', ', 2), ' Comp') FROM o WHERE trim(compilers) <> '')"""


def _with_people(t):
    return derive(t, "orders", PEOPLE).withColumnsRenamed({
        "main_names": "Autor", "editors": "Editor", "compilers": "Compilador", "coordinators": "Coordinador",
    }).withColumn("people", reshape.contributors())


@query("contributor_roles", PEOPLE_SQL + """ SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY place) - 1 AS INT) AS position,
  role, name FROM people""")
def contributor_roles(t):
    return reshape.explode_people(_with_people(t), ["o_orderkey"], "people")


@query("contributor_cells", PEOPLE_SQL + " SELECT o_orderkey, string_agg(name, ';' ORDER BY place) AS contributors FROM people GROUP BY 1")
def contributor_cells(t):
    cells = _with_people(t).select("o_orderkey", reshape.contributor_cell("people").alias("contributors"))
    return cells.where(F.col("contributors") != "")


@query("publisher_roles", f"""WITH o AS ({PEOPLE}), n AS (SELECT o_orderkey, publisher, unnest({items_sql("concat_ws(';', publisher, copublishers)")}) AS name FROM o)
SELECT DISTINCT o_orderkey, CASE WHEN list_contains({items_sql('publisher')}, name) THEN 'editor' ELSE 'coeditor' END AS role, name FROM n""")
def publisher_roles(t):
    rows = derive(t, "orders", PEOPLE).withColumn("roles", reshape.publisher_roles("publisher", "copublishers"))
    return reshape.explode_people(rows, ["o_orderkey"], "roles").drop("position")


@query("listed_items", """SELECT p_partkey, CAST(place - 1 AS INT) AS position, item FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS item,
  generate_subscripts(string_split(p_name, ' '), 1) AS place FROM part)""")
def listed_items(t):
    return reshape.explode_list(t("part"), ["p_partkey"], F.replace("p_name", F.lit(" "), F.lit("; ")), "item")


@query("reindexed", """SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, CAST(c_mktsegment AS VARCHAR) AS segment, CAST(NULL AS INT) AS pages FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation""")
def reindexed(t):
    wanted = {"key": "long", "name": "string", "segment": "string", "pages": "int"}
    specs = {"customer": {"key": "c_custkey", "name": "c_name", "segment": "c_mktsegment"},
             "supplier": {"key": "s_suppkey", "name": "s_name"}, "nation": {"key": "n_nationkey", "name": "n_name"}}
    return conform.union_all([
        conform.reindex(conform.project(t(table), columns), wanted) for table, columns in specs.items()])


@query("non_empty_rows", """SELECT a, b FROM (SELECT CASE WHEN event_type = 'view' THEN user_id END AS a, CASE WHEN value > 50 THEN props END AS b FROM events)
WHERE a IS NOT NULL OR b IS NOT NULL""")
def non_empty_rows(t):
    rows = t("events").select(
        F.when(F.col("event_type") == "view", F.col("user_id")).alias("a"), F.when(F.col("value") > 50, F.col("props")).alias("b"))
    return conform.drop_empty_rows(rows)


FACTS = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS sale_date,
  CASE o_orderpriority WHEN '5-LOW' THEN 'n/a' WHEN '1-URGENT' THEN CAST(0 - o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END AS units,
  CASE WHEN o_totalprice > 300000 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS revenue, o_orderstatus AS channel FROM orders
"""


@query("sane_facts", f"""SELECT o_orderkey, sale_date, units, revenue, channel FROM ({FACTS})
WHERE try_cast(sale_date AS DATE) IS NOT NULL AND try_cast(units AS DOUBLE) >= 0 AND try_cast(revenue AS DOUBLE) >= 0""")
def sane_facts(t):
    return conform.sane_facts(derive(t, "orders", FACTS), "sale_date", ["units", "revenue"])


@query("numeric_checks", f"""WITH f AS ({FACTS})
SELECT 'negative units' AS control, count(*) FILTER (WHERE try_cast(units AS DOUBLE) < 0) AS rows FROM f UNION ALL
SELECT 'unreadable units', count(*) FILTER (WHERE try_cast(units AS DOUBLE) IS NULL) FROM f UNION ALL
SELECT 'unreadable revenue', count(*) FILTER (WHERE try_cast(revenue AS DOUBLE) IS NULL) FROM f UNION ALL
SELECT 'unreadable dates', count(*) FILTER (WHERE try_cast(sale_date AS DATE) IS NULL) FROM f UNION ALL
SELECT 'flagged', count(*) FILTER (WHERE channel = 'F') FROM f""")
def numeric_checks(t):
    return quality.count_checks(derive(t, "orders", FACTS), {
        "negative units": quality.negative("units"), "unreadable units": quality.unreadable_number("units"),
        "unreadable revenue": quality.unreadable_number("revenue"), "unreadable dates": quality.unreadable_date("sale_date"),
        "flagged": F.col("channel") == "F"})


@query("type_quarantine", f"""WITH f AS ({FACTS}), r AS (SELECT *, concat_ws('; ', CASE WHEN revenue IS NULL THEN 'missing revenue' END,
  CASE WHEN try_cast(sale_date AS DATE) IS NULL OR try_cast(units AS BIGINT) IS NULL THEN concat('unreadable ',
    concat_ws(',', CASE WHEN try_cast(sale_date AS DATE) IS NULL THEN 'sale_date' END, CASE WHEN try_cast(units AS BIGINT) IS NULL THEN 'units' END)) END) AS reason FROM f)
SELECT o_orderkey, reason FROM r WHERE reason <> ''""")
def type_quarantine(t):
    _, bad = quality.split_by_types(derive(t, "orders", FACTS), {"sale_date": "date", "units": "bigint", "revenue": "double"}, ["revenue"])
    return bad.select("o_orderkey", "reason")


@query("exact_duplicates", """SELECT CAST(sum(n - 1) AS BIGINT) AS exact_duplicates FROM
  (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""")
def exact_duplicates(t):
    return quality.exact_duplicates(t("lineitem"), t("lineitem").columns)


PROFILED = """
SELECT c_custkey, c_name, CASE c_mktsegment WHEN 'MACHINERY' THEN '  ' WHEN 'FURNITURE' THEN NULL ELSE c_mktsegment END AS segment, c_nationkey FROM customer
"""


def _profile_sql(column: str, kind: str) -> str:
    blank = f"count(*) FILTER (WHERE {column} IS NOT NULL AND trim({column}) = '')" if kind == "string" else "0"
    return f"""SELECT '{column}' AS column_name, '{kind}' AS data_type, count(*) - count({column}) AS nulls, {blank} AS blank_strings,
  count(DISTINCT {column}) AS distinct_values, (SELECT string_agg(v, ' | ' ORDER BY pos) FROM (SELECT CAST({column} AS VARCHAR) AS v,
    min(c_custkey) AS pos FROM p WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY 2 LIMIT 3)) AS sample FROM p"""


@query("column_profile", f"WITH p AS ({PROFILED}) " + " UNION ALL ".join(
    _profile_sql(*pair) for pair in [("c_name", "string"), ("segment", "string"), ("c_nationkey", "int")]))
def column_profile(t):
    return quality.profile_columns(derive(t, "customer", PROFILED), "c_custkey")


@query("document_profile", "WITH p AS (SELECT doc_id, text, lang, source FROM documents) " + " UNION ALL ".join(
    _profile_sql(*pair).replace("c_custkey", "doc_id") for pair in [("text", "string"), ("lang", "string"), ("source", "string")]))
def document_profile(t):
    return quality.profile_columns(t("documents").select("doc_id", "text", "lang", "source"), "doc_id")


# --- works, bridges, facts --------------------------------------------------------------------------------

WORKS = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN concat('Work ', CAST(o_custkey AS STRING)) END AS title,
  concat(o_orderpriority, ';C', o_orderstatus) AS people FROM orders
"""
WORKS_SQL = f"""WITH o AS ({WORKS}), works AS (SELECT row_number() OVER (ORDER BY first) AS work_id, title, people FROM
  (SELECT title, people, min(o_orderkey) AS first FROM o WHERE title IS NOT NULL GROUP BY 1, 2))"""


def _works(t):
    rows = derive(t, "orders", WORKS)
    return rows, settle(model.works(rows, "title", "people", "o_orderkey"))


@query("works", WORKS_SQL + " SELECT work_id, title, people FROM works")
def works(t):
    return _works(t)[1].drop("uses")


@query("work_links", WORKS_SQL + " SELECT DISTINCT o_orderkey, work_id FROM o JOIN works USING (title, people)")
def work_links(t):
    rows, work = _works(t)
    return model.work_bridge(rows, work, "title", "people", "o_orderkey")


@query("work_report", WORKS_SQL + """, ids AS (SELECT work_id, string_agg(CAST(o_orderkey AS VARCHAR), '; ' ORDER BY CAST(o_orderkey AS VARCHAR)) AS identifiers
  FROM o JOIN works USING (title, people) GROUP BY 1),
aut AS (SELECT work_id, string_agg(name, '; ' ORDER BY name) AS authors FROM (SELECT work_id, unnest(string_split(people, ';')) AS name FROM works) GROUP BY 1)
SELECT work_id, title, identifiers, authors FROM works LEFT JOIN ids USING (work_id) LEFT JOIN aut USING (work_id) ORDER BY work_id""")
def work_report(t):
    rows, work = _works(t)
    identifiers = model.work_bridge(rows, work, "title", "people", "o_orderkey").select(
        "work_id", F.col("o_orderkey").cast("string").alias("identifier"))
    authors = reshape.explode_list(work, ["work_id"], "people", "name").drop("position")
    return reports.work_report(work, identifiers, authors).orderBy("work_id")


@query("shared_codes", """WITH x AS (SELECT DISTINCT trim(source) AS source, doc_id, lang FROM documents),
d AS (SELECT source FROM x GROUP BY 1 HAVING count(DISTINCT lang) > 1)
SELECT x.source, x.doc_id, x.lang FROM x JOIN d USING (source) ORDER BY 1, 3, 2""")
def shared_codes(t):
    rows = t("documents").select(F.concat(F.col("source"), F.lit(" ")).alias("source"), "doc_id", "lang")
    return reports.shared_codes(rows, "source", "doc_id", "lang").orderBy("source", "lang", "doc_id")


LISTED = """
SELECT p_partkey, replace(p_name, ' ', ' ; ') AS publishers, CASE WHEN p_size > 20 THEN p_brand WHEN p_size > 10 THEN ' ' END AS doi FROM part
"""
NAMED = "SELECT DISTINCT substr(p_name, 1, instr(p_name, ' ') - 1) AS name FROM part"


@query("codes_per_publisher", f"""WITH l AS ({LISTED}), n AS ({NAMED}),
c AS (SELECT name, count(*) AS n FROM (SELECT DISTINCT p_partkey, trim(unnest(string_split(publishers, ';'))) AS name FROM l WHERE coalesce(trim(doi), '') <> '') GROUP BY 1)
SELECT n.name, coalesce(c.n, 0) AS codes FROM n LEFT JOIN c USING (name)""")
def codes_per_publisher(t):
    return reports.count_per_listed_name(derive(t, "part", NAMED), "name", derive(t, "part", LISTED), "publishers", "doi", "codes")


SHOPS = """
SELECT o_orderkey, o_custkey, o_orderstatus, concat('[[[~store~, ~Amazon~], [~url~, None]], [[~store~, ~', o_orderpriority, '~]], [[~store~, ~Amazon~]], [[~url~, ~x~]]]') AS shops FROM orders
"""


@query("store_facts", f"""WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, 'Amazon' AS store, 0 AS place FROM orders UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 1 FROM orders)
SELECT o_custkey, store, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, store ORDER BY o_orderkey, place) AS n FROM s) WHERE n = 1
UNION ALL SELECT o_custkey, NULL, o_orderstatus FROM orders""")
def store_facts(t):
    rows = derive(t, "orders", SHOPS).withColumn("shops", stores(F.replace("shops", F.lit("~"), F.lit("'"))))
    return model.store_facts(rows, "o_custkey", "shops", "o_orderkey", ["o_orderstatus"])


CASCADE_SQL = """WITH kept AS (SELECT p_partkey AS id FROM part WHERE p_type <> 'PROMO'),
ia AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS author_id FROM lineitem), ip AS (SELECT p_partkey AS id, p_brand AS publisher_id FROM part),
iw AS (SELECT p_partkey AS id, p_name AS work_id FROM part), wa AS (SELECT DISTINCT p_name AS work_id, CAST(p_size AS BIGINT) AS author_id FROM part),
works AS (SELECT DISTINCT work_id FROM iw SEMI JOIN kept USING (id)), wa2 AS (SELECT * FROM wa SEMI JOIN works USING (work_id)),
ia2 AS (SELECT * FROM ia SEMI JOIN kept USING (id)), ip2 AS (SELECT * FROM ip SEMI JOIN kept USING (id))"""


def cascade_bridges(t, *work):
    part, lines = t("part"), t("lineitem")
    work_id = F.concat_ws("/", *work) if len(work) > 1 else F.col(*work)
    return {
        "identifier_authors": lines.select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("author_id")).distinct(),
        "identifier_publishers": part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("publisher_id")),
        "identifier_works": part.select(F.col("p_partkey").alias("id"), work_id.alias("work_id")),
    }


@query("cascade_counts", CASCADE_SQL + """
SELECT 'identifier_authors' AS table_name, count(*) AS rows FROM ia2 UNION ALL SELECT 'identifier_publishers', count(*) FROM ip2 UNION ALL
SELECT 'identifier_works', count(*) FROM iw SEMI JOIN kept USING (id) UNION ALL SELECT 'works', count(*) FROM works UNION ALL
SELECT 'work_authors', count(*) FROM wa2 UNION ALL SELECT 'publishers', count(DISTINCT publisher_id) FROM ip2 UNION ALL
SELECT 'authors', count(*) FROM (SELECT s_suppkey AS author_id FROM supplier WHERE s_suppkey IN (SELECT author_id FROM ia2 UNION ALL SELECT author_id FROM wa2))""")
def cascade_counts(t):
    part, bridges = t("part"), cascade_bridges(t, "p_name")
    work_people = part.select(F.col("p_name").alias("work_id"), F.col("p_size").cast("long").alias("author_id")).distinct()
    dims = {
        "works": part.select(F.col("p_name").alias("work_id")).distinct(),
        "authors": t("supplier").select(F.col("s_suppkey").alias("author_id")),
        "publishers": part.select(F.col("p_brand").alias("publisher_id")).distinct(),
    }
    kept = part.where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("id"))
    return reports.row_counts(model.cascade(kept, "id", bridges, work_people, dims))


# works of their own brand and size, and a removal that takes a whole publisher
REMOVAL_SQL = CASCADE_SQL.replace("p_name AS work_id", "concat_ws('/', p_name, p_brand, p_size) AS work_id").replace(
    "p_type <> 'PROMO'", "p_type <> 'PROMO' AND p_brand <> 'Brand#11'")


@query("removal_counts", REMOVAL_SQL + """, refs AS (SELECT 'authors' AS table_name, CAST(author_id AS VARCHAR) AS id FROM ia UNION ALL SELECT 'authors', CAST(author_id AS VARCHAR) FROM wa
  UNION ALL SELECT 'works', work_id FROM iw UNION ALL SELECT 'publishers', publisher_id FROM ip),
refs2 AS (SELECT 'authors' AS table_name, CAST(author_id AS VARCHAR) AS id FROM ia2 UNION ALL SELECT 'authors', CAST(author_id AS VARCHAR) FROM wa2
  UNION ALL SELECT 'works', work_id FROM works UNION ALL SELECT 'publishers', publisher_id FROM ip2)
SELECT 'identifier_authors' AS table_name, (SELECT count(*) FROM ia) - (SELECT count(*) FROM ia2) AS rows UNION ALL
SELECT 'identifier_publishers', (SELECT count(*) FROM ip) - (SELECT count(*) FROM ip2) UNION ALL
SELECT 'identifier_works', count(*) FROM iw ANTI JOIN kept USING (id) UNION ALL
SELECT 'work_authors', (SELECT count(*) FROM wa) - (SELECT count(*) FROM wa2) UNION ALL
SELECT d.column0, (SELECT count(DISTINCT id) FROM refs WHERE table_name = d.column0) - (SELECT count(DISTINCT id) FROM refs2 WHERE table_name = d.column0)
FROM (VALUES ('authors'), ('works'), ('publishers')) AS d(column0)""")
def removal_counts(t):
    part, work = t("part"), ("p_name", "p_brand", "p_size")
    bridges = cascade_bridges(t, *work)
    bridges["work_authors"] = part.select(F.concat_ws("/", *work).alias("work_id"), F.col("p_size").cast("long").alias("author_id")).distinct()
    removed = part.where("NOT coalesce(p_type <> 'PROMO' AND p_brand <> 'Brand#11', false)").select(F.col("p_partkey").alias("id"))
    changes = model.removal(removed, "id", bridges, model.reference_counts(bridges))
    return reports.row_counts({
        name: change.where("uses = 0") if "uses" in change.columns else change for name, change in changes.items()})


UPDATES = """
SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id END AS c_custkey, value AS c_acctbal, CASE WHEN event_type <> 'view' THEN event_type END AS c_mktsegment FROM events
"""


@query("updated_rows", f"""WITH u AS ({UPDATES}), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY event_id DESC) AS n FROM u WHERE c_custkey IS NOT NULL) WHERE n = 1)
SELECT c.c_custkey, c.c_name, c.c_nationkey, CASE WHEN l.n = 1 THEN l.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
  CASE WHEN l.n = 1 THEN l.c_mktsegment ELSE c.c_mktsegment END AS c_mktsegment FROM customer c LEFT JOIN l USING (c_custkey)""")
def updated_rows(t):
    return enrich.update_from(t("customer"), derive(t, "events", UPDATES), "c_custkey", ["c_acctbal", "c_mktsegment"], "event_id")


@query("not_yet_consulted", """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE nullif(quality, 0) IS NOT NULL)""")
def not_yet_consulted(t):
    state = t("labels").select("doc_id", F.nullif("quality", F.lit(0)).alias("mark"))
    return enrich.not_yet_done(t("documents").select("doc_id", "lang"), state, ["doc_id"], "mark")


@query("non_blank", f"""SELECT p_partkey, doi FROM ({LISTED}) WHERE coalesce(trim(doi), '') <> ''""")
def non_blank(t):
    return derive(t, "part", LISTED).where(conform.not_blank("doi")).select("p_partkey", "doi")


@query("head_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 12")
def head_rows(t):
    return reports.top(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 12)


# --- sales reports with preamble ------------------------------------------------------------------------------

PREAMBLE = """
SELECT concat('ventas_', CAST(c_custkey AS STRING)) AS file, c_nationkey, c_mktsegment FROM customer
"""
PERIOD = ("CASE WHEN c_nationkey < 5 THEN 'Desde: 1 de marzo de 2023 Hasta: 31 de diciembre de 2023' "
          "WHEN c_nationkey < 8 THEN 'Desde: 1 de enero de 2021 Hasta: 31 de diciembre de 2022' "
          "ELSE concat('Desde: 1 de enero de ', CAST(2000 + c_nationkey AS STRING), ' Hasta: 31 de diciembre de ', CAST(2000 + c_nationkey AS STRING)) END")
BODY = """
SELECT concat('ventas_', CAST(o_custkey AS STRING)) AS file, o_orderkey + 10 AS row_no, o_orderpriority AS canal, o_orderstatus AS tienda,
  CASE WHEN o_orderstatus <> 'P' THEN ' digital ' ELSE ' ' END AS modalidad, concat('i', CAST(o_orderkey AS STRING)) AS isbn, CAST(o_custkey AS STRING) AS cantidad FROM orders
"""


def _report_cells(t):
    head = derive(t, "customer", PREAMBLE)
    names = {"classic": fixed.REPORT_HEADER, "ebook": fixed.REPORT_HEADER_EBOOK}

    def literal(values):
        return F.array(*[F.lit(value) for value in values])

    empty = [None] * len(fixed.REPORT_HEADER)
    period = F.array(F.expr(PERIOD), *[F.lit(None).cast("string") for _ in empty[1:]])
    header = (F.when(F.col("c_mktsegment") == "MACHINERY", literal(names["ebook"]))
              .when(F.col("c_mktsegment") == "FURNITURE", literal(["Canal", "Tienda"] + [""] * 11)).otherwise(literal(names["classic"])))
    lines = F.explode(F.array(F.struct(F.lit(2).cast("long").alias("row_no"), period.alias("cells")),
                              F.struct(F.lit(5).cast("long").alias("row_no"), header.alias("cells"))))
    top = head.select("file", lines.alias("line")).select("file", "line.*")
    body = derive(t, "orders", BODY)
    filled = {"Canal": "canal", "Tienda": "tienda", "Modalidad": "modalidad", "Isbn": "isbn", "Cantidad": "cantidad"}
    cells = F.array(*[F.col(filled[name]) if name in filled else F.lit("x") for name in fixed.REPORT_HEADER])
    return top.unionByName(body.select("file", "row_no", cells.alias("cells")))


FILES_SQL = f"""WITH h AS ({PREAMBLE}), b AS ({BODY}),
files AS (SELECT file, 2 + coalesce(n, 0) AS file_rows, CASE WHEN c_nationkey >= 8 THEN 2000 + c_nationkey END AS sale_year,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN CAST(5 AS BIGINT) END AS header_row,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'ebook' WHEN 'FURNITURE' THEN NULL ELSE 'classic' END AS layout
  FROM h LEFT JOIN (SELECT file, count(*) AS n FROM b GROUP BY 1) USING (file))"""


@query("report_files", FILES_SQL + """ SELECT *, CASE WHEN sale_year IS NULL THEN 'not_a_full_year' WHEN header_row IS NULL THEN 'no_header' ELSE 'accepted' END AS status FROM files""")
def report_files(t):
    return sales_reports.file_status(sales_reports.file_facts(_report_cells(t)))


@query("report_rows", FILES_SQL + """ SELECT b.file, row_no, sale_year, isbn, canal AS channel, tienda AS store,
  CASE layout WHEN 'classic' THEN nullif(trim(modalidad), '') ELSE 'x' END AS mode, CASE layout WHEN 'classic' THEN 'x' ELSE nullif(trim(modalidad), '') END AS country, cantidad AS quantity
FROM b JOIN files f ON f.file = b.file WHERE sale_year IS NOT NULL AND header_row IS NOT NULL""")
def report_rows(t):
    rows = sales_reports.report_rows(_report_cells(t))
    return rows.select("file", "row_no", "sale_year", "isbn", "channel", "store", "mode", "country", "quantity")


@query("report_facts", FILES_SQL + """, r AS (SELECT o_orderkey, o_custkey, sale_year, canal, tienda, nullif(trim(modalidad), '') AS mode FROM b JOIN files USING (file)
  JOIN orders ON concat('i', CAST(o_orderkey AS VARCHAR)) = isbn WHERE sale_year IS NOT NULL AND layout = 'classic'),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, sale_year, canal, tienda, mode ORDER BY o_orderkey) AS n FROM r)
SELECT o_custkey, sale_year, canal AS channel, tienda AS store, mode, count(*) AS rows FROM k WHERE n = 1 OR mode IS NULL GROUP BY ALL""")
def report_facts(t):
    rows = sales_reports.report_rows(_report_cells(t)).where(F.col("country") == "x")
    known = t("orders").select(F.concat(F.lit("i"), F.col("o_orderkey").cast("string")).alias("isbn"), "o_custkey")
    keys = ["o_custkey", "sale_year", "channel", "store", "mode"]
    facts = model.load_facts(rows, known, "isbn", "o_custkey")
    return reports.count_by(model.dedup_facts(facts, keys, ["row_no"]), keys)
