"""Queries: staging, validation, golden catalogue, model, enrichment, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.codes import has_book_prefix
from lectern.operators import conform, dedup, enrich, guard, quality, reports, reshape
from lectern.plans import catalogue, inputs
from lectern.plans.inputs import GOLDEN_SQL, MODEL_SQL, SALES_SQL, STAGING_SQL
from lectern.plans.registry import query
from lectern.session import settle
from lectern.sources import sinks


def built(t) -> catalogue.CatalogueResult:
    return catalogue.build(inputs.records(t), inputs.sales(t), inputs.metrics(t), inputs.fixture(t))


def relational(t) -> catalogue.RelationalModel:
    return catalogue.RelationalModel(settle(golden_catalogue(t)))


@query("conform_union", f"""WITH {STAGING_SQL}
SELECT source_name, source_row, raw_isbn, raw_title, authors, publisher, year, country, pages, language, source_url,
  isbn13, normalized_title, valid_isbn FROM records""")
def conform_union(t):
    return inputs.records(t).drop("isbn", "title")


@query("source_trace", f"""WITH {STAGING_SQL}
SELECT source_name, source_row, raw_isbn, isbn13 AS normalized_isbn, raw_title, normalized_title,
  CASE WHEN valid_isbn THEN 'accepted' ELSE 'rejected_invalid_isbn' END AS status FROM records""")
def source_trace(t):
    return conform.source_trace(inputs.records(t))


@query("status_counts", f"""WITH {STAGING_SQL}
SELECT source_name, CASE WHEN valid_isbn THEN 'accepted' ELSE 'rejected_invalid_isbn' END AS status,
  count(*) AS rows FROM records GROUP BY 1, 2 ORDER BY 1, 2""")
def status_counts(t):
    trace = conform.source_trace(inputs.records(t))
    return reports.count_by(trace, ["source_name", "status"]).orderBy("source_name", "status")


@query("rejected_rows", f"""WITH {STAGING_SQL}
SELECT source_name, source_row, raw_isbn, isbn13, raw_title FROM records WHERE NOT valid_isbn""")
def rejected_rows(t):
    return conform.rejected(inputs.records(t)).select("source_name", "source_row", "raw_isbn", "isbn13", "raw_title")


@query("identifier_list", f"""WITH {STAGING_SQL}
SELECT DISTINCT isbn13 FROM records WHERE length(isbn13) = 13 AND isbn13 LIKE '97%'""")
def identifier_list(t):
    return sinks.identifier_list(inputs.records(t), "isbn13").distinct()


@query("prefix_check", f"""WITH {STAGING_SQL}
SELECT source_name, length(isbn13) = 13 AND substr(isbn13, 1, 3) IN ('978', '979') AS prefix_ok, valid_isbn,
  count(*) AS rows FROM records GROUP BY ALL""")
def prefix_check(t):
    rows = inputs.records(t).withColumn("prefix_ok", has_book_prefix("isbn13"))
    return reports.count_by(rows, ["source_name", "prefix_ok", "valid_isbn"])


@query("status_filter", f"""WITH {STAGING_SQL}
SELECT source_name, source_row, raw_isbn, isbn13 AS normalized_isbn, raw_title, normalized_title, status FROM
  (SELECT *, CASE WHEN valid_isbn THEN 'accepted' ELSE 'rejected_invalid_isbn' END AS status FROM records)
WHERE status IN ('accepted') AND source_name IN ('simeh', 'scielo')""")
def status_filter(t):
    trace = conform.source_trace(inputs.records(t))
    chosen = conform.keep_members(trace, "status", [fixed.ACCEPTED])
    return conform.keep_members(conform.keep_members(chosen, "source_name", ["simeh", "scielo"]), "raw_title", [])


@query("golden_catalogue", f"""WITH {GOLDEN_SQL}
SELECT isbn13, title, normalized_title, authors, publisher, year, country, pages, language, source_url,
  source_count, source_names FROM golden""")
def golden_catalogue(t):
    return catalogue.canonical_catalogue(inputs.records(t))


@query("provenance", f"""WITH {STAGING_SQL}
SELECT isbn13, CAST(count(DISTINCT source_name) AS INT) AS source_count,
  string_agg(DISTINCT source_name, ', ' ORDER BY source_name) AS source_names
FROM records WHERE valid_isbn GROUP BY 1""")
def provenance(t):
    return dedup.provenance(conform.accepted(inputs.records(t)), "isbn13", "source_name")


@query("duplicate_flags", f"""WITH {STAGING_SQL}
SELECT source_name, source_row, isbn13, count(*) OVER (PARTITION BY isbn13) > 1 AS is_duplicate
FROM records WHERE valid_isbn""")
def duplicate_flags(t):
    flagged = dedup.flag_duplicates(conform.accepted(inputs.records(t)), ["isbn13"], "source_row")
    return flagged.select("source_name", "source_row", "isbn13", "is_duplicate")


@query("duplicate_candidates", f"""WITH {STAGING_SQL}
SELECT isbn13, source_name, raw_title, normalized_title, authors, publisher, year, country, language FROM
  (SELECT *, count(*) OVER (PARTITION BY isbn13) AS key_rows FROM records WHERE valid_isbn) WHERE key_rows > 1
ORDER BY isbn13, source_name""")
def duplicate_candidates(t):
    flagged = dedup.flag_duplicates(conform.accepted(inputs.records(t)), ["isbn13"], "source_row")
    return flagged.where("is_duplicate").select(
        "isbn13", "source_name", "raw_title", "normalized_title", "authors", "publisher", "year", "country", "language"
    ).orderBy("isbn13", "source_name")


@query("duplicate_row_count", f"""WITH {STAGING_SQL}
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM
  (SELECT count(*) AS n FROM records WHERE valid_isbn GROUP BY isbn13) WHERE n > 1""")
def duplicate_row_count(t):
    return dedup.duplicate_row_count(conform.accepted(inputs.records(t)), ["isbn13"])


@query("conflict_report", f"""WITH {STAGING_SQL}
SELECT isbn13, count(DISTINCT source_name) AS sources, count(DISTINCT raw_title) AS raw_titles,
  count(DISTINCT normalized_title) AS normalized_titles, count(DISTINCT authors) AS author_lists,
  count(DISTINCT publisher) AS publishers, count(DISTINCT country) AS countries
FROM records WHERE valid_isbn GROUP BY 1 HAVING count(*) > 1""")
def conflict_report(t):
    return dedup.conflict_report(conform.accepted(inputs.records(t)), "isbn13", {
        "sources": "source_name", "raw_titles": "raw_title", "normalized_titles": "normalized_title",
        "author_lists": "authors", "publishers": "publisher", "countries": "country"})


LISTING_SQL = f"""WITH {STAGING_SQL},
cells AS (SELECT source_name AS source, 'country' AS field, country AS value FROM records UNION ALL
  SELECT source_name, 'language', language FROM records UNION ALL
  SELECT source_name, 'publisher', publisher FROM records),
listing AS (SELECT field, source, string_agg(DISTINCT value, '; ' ORDER BY value) AS "values" FROM cells
  WHERE value IS NOT NULL GROUP BY 1, 2)"""


@query("category_listing", LISTING_SQL + ' SELECT field, source, "values" FROM listing')
def category_listing(t):
    return reports.category_listing(inputs.records(t), "source_name", ["country", "language", "publisher"])


@query("category_values", LISTING_SQL + " SELECT DISTINCT field, source, value FROM cells WHERE value IS NOT NULL")
def category_values(t):
    return reports.category_values(inputs.records(t), "source_name", ["country", "language", "publisher"])


@query("category_matrix", LISTING_SQL + """
SELECT field, max(CASE WHEN source = 'simeh' THEN "values" END) AS simeh,
  max(CASE WHEN source = 'plantilla_propia' THEN "values" END) AS plantilla_propia,
  max(CASE WHEN source = 'scielo' THEN "values" END) AS scielo FROM listing GROUP BY field""")
def category_matrix(t):
    return reshape.pivot_first(category_listing(t), "field", "source", list(fixed.SOURCE_COLUMNS), "values")


# --- model ---------------------------------------------------------------------------------------


@query("publishers", f"WITH {MODEL_SQL} SELECT publisher_id, name FROM pub")
def publishers(t):
    return relational(t).publishers.select("publisher_id", F.col("publisher").alias("name"))


@query("authors", f"WITH {MODEL_SQL} SELECT author_id, name FROM authors")
def authors(t):
    return relational(t).authors.select("author_id", "name")


@query("books", f"""WITH {MODEL_SQL}
SELECT book_id, normalized_title, title, first_publication_year, country FROM books""")
def books(t):
    return relational(t).books.drop("uses")


@query("editions", f"""WITH {MODEL_SQL}
SELECT isbn13, book_id, publisher_id, publication_year, pages, language, source_count, source_names, source_url
FROM editions""")
def editions(t):
    return relational(t).editions


@query("book_authors", f"WITH {MODEL_SQL} SELECT book_id, author_id FROM book_authors")
def book_authors(t):
    return relational(t).book_authors


@query("sales_known", f"""WITH {MODEL_SQL}
SELECT isbn13, sale_date, units, revenue_eur, channel, synthetic FROM sales""")
def sales_known(t):
    return catalogue.clean_sales(inputs.sales(t), golden_catalogue(t).select("isbn13"))


@query("metrics_known", f"WITH {MODEL_SQL} SELECT isbn13, mentions, readers, demo_score, synthetic FROM altmetrics")
def metrics_known(t):
    return catalogue.clean_metrics(inputs.metrics(t), golden_catalogue(t))


@query("sales_orphans", f"""WITH {GOLDEN_SQL}, {SALES_SQL}
SELECT isbn13, count(*) AS rows FROM sales_raw WHERE isbn13 NOT IN (SELECT isbn13 FROM golden) GROUP BY 1""")
def sales_orphans(t):
    return reports.count_by(enrich.orphans(inputs.sales(t), golden_catalogue(t), "isbn13"), ["isbn13"])


@query("enrich_offline", f"""WITH {MODEL_SQL}
SELECT isbn13, query_title, match_status, data_source, CAST(NULL AS VARCHAR) AS openalex_id,
  CAST(NULL AS VARCHAR) AS matched_title, CAST(NULL AS VARCHAR) AS doi, cited_by_count,
  CAST(NULL AS DOUBLE) AS title_score, CAST(NULL AS DOUBLE) AS author_score, CAST(NULL AS DOUBLE) AS match_score,
  CAST(NULL AS VARCHAR) AS error FROM matches""")
def enrich_offline(t):
    return enrich.enrich(golden_catalogue(t), "offline", inputs.fixture(t))


@query("enrich_live", f"""WITH {MODEL_SQL},
state AS (SELECT isbn13, title, language, CASE WHEN language = 'en' OR language IS NULL THEN 'timed out' END AS error,
  coalesce(language NOT IN ('en', 'pt'), FALSE) AS live FROM golden)
SELECT s.isbn13, s.title AS query_title,
  CASE WHEN live THEN 'matched' WHEN f.isbn13 IS NULL THEN 'request_error'
       ELSE coalesce(f.match_status, 'offline_demo') END AS match_status,
  CASE WHEN live THEN 'openalex_live' WHEN f.isbn13 IS NULL THEN 'openalex_error'
       ELSE 'fixture_fallback' END AS data_source,
  CASE WHEN live THEN 7 ELSE CAST(f.cited_by_count_demo AS BIGINT) END AS cited_by_count, s.error
FROM state s LEFT JOIN fixture f USING (isbn13)""")
def enrich_live(t):
    golden = golden_catalogue(t)
    failed = (F.col("language") == "en") | F.col("language").isNull()
    failures = golden.where(failed).select("isbn13", F.lit("timed out").alias("error"))
    # 'pt' keys have neither a result nor a failure
    results = golden.where(~failed & (F.col("language") != "pt")).select(
        "isbn13", F.col("title").alias("query_title"), F.lit(fixed.MATCHED).alias("match_status"),
        F.lit(fixed.FROM_LIVE).alias("data_source"), F.lit(7).cast("long").alias("cited_by_count"))
    rows = enrich.enrich(golden, "live", inputs.fixture(t), results, failures)
    return rows.select("isbn13", "query_title", "match_status", "data_source", "cited_by_count", "error")


SUMMARY_SQL = MODEL_SQL + """,
sold AS (SELECT isbn13, CAST(sum(units) AS BIGINT) AS units_sold,
  CAST(round(sum(CAST(revenue_eur AS DECIMAL(38,10))), 2) AS DOUBLE) AS revenue_eur FROM sales GROUP BY 1),
named AS (SELECT book_id, string_agg(name, '; ' ORDER BY name) AS authors
  FROM book_authors JOIN authors USING (author_id) GROUP BY 1),
book_summary AS (SELECT e.isbn13, b.title, n.authors, p.name AS publisher, e.publication_year, b.country, e.pages,
  e.source_count, e.source_names, coalesce(s.units_sold, 0) AS units_sold, coalesce(s.revenue_eur, 0) AS revenue_eur,
  coalesce(a.mentions, 0) AS mentions, coalesce(a.readers, 0) AS readers, coalesce(a.demo_score, 0) AS demo_score,
  CAST(NULL AS VARCHAR) AS openalex_id, CAST(NULL AS VARCHAR) AS openalex_doi, m.cited_by_count AS openalex_citations,
  m.match_status AS openalex_match_status, m.data_source AS openalex_data_source
  FROM editions e JOIN books b USING (book_id) LEFT JOIN named n USING (book_id)
  LEFT JOIN pub p USING (publisher_id) LEFT JOIN sold s USING (isbn13) LEFT JOIN altmetrics a USING (isbn13)
  LEFT JOIN matches m USING (isbn13))"""


@query("book_summary", f"WITH {SUMMARY_SQL} SELECT * FROM book_summary")
def book_summary(t):
    return built(t).book_summary


@query("match_trace", f"""WITH {SUMMARY_SQL}
SELECT title, isbn13, source_count, source_names, openalex_match_status, openalex_data_source, openalex_citations
FROM book_summary ORDER BY source_count DESC, title""")
def match_trace(t):
    return book_summary(t).select(
        "title", "isbn13", "source_count", "source_names", "openalex_match_status", "openalex_data_source",
        "openalex_citations").orderBy(F.desc("source_count"), "title")


@query("top_books", f"""WITH {SUMMARY_SQL}
SELECT title, authors, publisher, units_sold, revenue_eur FROM book_summary
ORDER BY revenue_eur DESC, title LIMIT 5""")
def top_books(t):
    return reports.top(book_summary(t), [F.desc("revenue_eur"), "title"], 5).select(
        "title", "authors", "publisher", "units_sold", "revenue_eur")


AUTHOR_SQL = """
SELECT name AS author, count(DISTINCT e.isbn13) AS editions, string_agg(DISTINCT b.title, '; ' ORDER BY b.title) AS titles
FROM authors JOIN book_authors USING (author_id) JOIN books b USING (book_id) JOIN editions e USING (book_id)
GROUP BY name ORDER BY editions DESC, author LIMIT 5"""


@query("top_authors", f"WITH {MODEL_SQL} {AUTHOR_SQL}")
def top_authors(t):
    tables = relational(t).tables
    rows = (tables["book_authors"].join(tables["authors"].withColumnRenamed("name", "author"), "author_id")
            .join(tables["books"].select("book_id", "title"), "book_id")
            .join(tables["editions"].select("book_id", "isbn13"), "book_id"))
    return reports.titles_per_name(rows, "author", "isbn13", "title", 5, "editions")


@query("top_authors_count", f"""WITH {MODEL_SQL}
SELECT name AS author, count(DISTINCT isbn13) AS editions FROM people GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def top_authors_count(t):
    tables = relational(t).tables
    pairs = (tables["book_authors"].join(tables["editions"].select("book_id", "isbn13"), "book_id")
             .join(tables["authors"], "author_id").select(F.col("name").alias("author"), "isbn13").distinct())
    return reports.top(reports.count_by(pairs, ["author"], "editions"), [F.desc("editions"), "author"], 5)


@query("sales_by_year", f"""WITH {MODEL_SQL}
SELECT CAST(year(CAST(sale_date AS DATE)) AS INT) AS year, CAST(sum(units) AS BIGINT) AS units,
  CAST(round(sum(CAST(revenue_eur AS DECIMAL(38,10))), 2) AS DOUBLE) AS revenue_eur FROM sales GROUP BY 1""")
def sales_by_year(t):
    return reports.sales_by_year(sales_known(t))


@query("sales_by_channel", f"""WITH {MODEL_SQL}
SELECT channel, CAST(sum(units) AS BIGINT) AS units,
  CAST(round(sum(CAST(revenue_eur AS DECIMAL(38,10))), 2) AS DOUBLE) AS revenue_eur FROM sales GROUP BY 1
ORDER BY revenue_eur DESC, channel""")
def sales_by_channel(t):
    return reports.sales_by_channel(sales_known(t))


@query("guarded_query", f"""WITH {SUMMARY_SQL}
SELECT country, count(*) AS books, CAST(sum(units_sold) AS BIGINT) AS units FROM book_summary GROUP BY 1
ORDER BY books DESC, country NULLS FIRST LIMIT 4""")
def guarded_query(t):
    summary = book_summary(t)
    summary.createOrReplaceTempView("book_summary")
    return guard.read_only_query(summary.sparkSession, """
        SELECT country, count(*) AS books, sum(units_sold) AS units FROM book_summary GROUP BY country
        ORDER BY books DESC, country NULLS FIRST;""", 4)


# --- audit ------------------------------------------------------------------------------------------


def _violations(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS constraint_name, (SELECT count(*) FROM {child} c WHERE c.{key} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})) AS violations"
        for name, (child, parent, key) in pairs.items())


_SQL_NAMES = {"publishers": "pub", "openalex_enrichment": "matches"}


@query("reference_check", f"WITH {MODEL_SQL} " + _violations({
    name: (_SQL_NAMES.get(child, child), _SQL_NAMES.get(parent, parent), key)
    for name, (child, parent, key) in catalogue.REFERENCES.items()}))
def reference_check(t):
    return catalogue.reference_report(built(t).tables)


@query("reference_check_raw", f"""WITH {MODEL_SQL}
SELECT 'sales' AS constraint_name, count(*) AS violations FROM sales_raw WHERE isbn13 NOT IN (SELECT isbn13 FROM editions)
UNION ALL
SELECT 'altmetrics', count(*) FROM metrics_raw WHERE isbn13 NOT IN (SELECT isbn13 FROM editions)""")
def reference_check_raw(t):
    parent = relational(t).editions
    return quality.reference_report({
        "sales": (inputs.sales(t), parent, "isbn13"), "altmetrics": (inputs.metrics(t), parent, "isbn13")})


@query("uniqueness_check", f"WITH {MODEL_SQL} " + " UNION ALL ".join(
    f"SELECT '{name}' AS constraint_name, count(*) AS violations FROM (SELECT 1 FROM {_SQL_NAMES.get(name, name)} "
    f"GROUP BY {', '.join(keys)} HAVING count(*) > 1)" for name, keys in catalogue.UNIQUE_KEYS.items()))
def uniqueness_check(t):
    return catalogue.uniqueness_report(built(t).tables)


@query("title_collisions", f"""WITH {GOLDEN_SQL}
SELECT normalized_title, count(*) AS key_rows FROM golden GROUP BY 1 HAVING count(*) > 1""")
def title_collisions(t):
    return quality.not_unique(golden_catalogue(t), ["normalized_title"])


@query("integrity_checks", f"""WITH {GOLDEN_SQL}
SELECT 'canonical identifier is unique' AS control, count(*) = count(DISTINCT isbn13) AS result FROM golden UNION ALL
SELECT 'all identifiers pass the checksum', bool_and(regexp_full_match(isbn13, '[0-9]{{13}}')
  AND {inputs.digit_sum_sql('isbn13', 13)} % 10 = 0) FROM golden UNION ALL
SELECT 'no empty normalized titles', bool_and(normalized_title <> '') FROM golden UNION ALL
SELECT 'every row keeps its source', bool_and(source_name IS NOT NULL) FROM records UNION ALL
SELECT 'every row keeps its position', bool_and(source_row IS NOT NULL) FROM records UNION ALL
SELECT 'no row lost: accepted + rejected = staging',
  count(*) FILTER (WHERE valid_isbn) + count(*) FILTER (WHERE NOT valid_isbn) = count(*) FROM records""")
def integrity_checks(t):
    return quality.integrity_report(golden_catalogue(t), inputs.records(t))


@query("constraint_violations", f"""WITH {SALES_SQL}
SELECT 'units >= 0' AS control, count(*) FILTER (WHERE units < 0) AS rows FROM sales_raw UNION ALL
SELECT 'revenue_eur >= 0', count(*) FILTER (WHERE revenue_eur < 0) FROM sales_raw UNION ALL
SELECT 'sale_date not null', count(*) FILTER (WHERE sale_date IS NULL) FROM sales_raw UNION ALL
SELECT 'channel not null', count(*) FILTER (WHERE channel IS NULL) FROM sales_raw""")
def constraint_violations(t):
    return quality.constraint_violations(inputs.sales(t), ["units", "revenue_eur"], ["sale_date", "channel"])


@query("flow_metrics", f"""WITH {MODEL_SQL}
SELECT 'source_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM records UNION ALL
SELECT 'invalid_rows', count(*) FROM records WHERE NOT valid_isbn UNION ALL
SELECT 'catalogue_books', count(*) FROM golden UNION ALL
SELECT 'duplicate_rows', coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM records WHERE valid_isbn GROUP BY isbn13)
  WHERE n > 1 UNION ALL
SELECT 'sales_rows', count(*) FROM sales UNION ALL SELECT 'units_sold', sum(units) FROM sales UNION ALL
SELECT 'revenue_eur', CAST(round(sum(CAST(revenue_eur AS DECIMAL(38,10))), 2) AS DOUBLE) FROM sales UNION ALL
SELECT 'openalex_live_rows', count(*) FROM matches WHERE data_source = 'openalex_live' UNION ALL
SELECT 'openalex_matched_rows', count(*) FROM matches WHERE match_status = 'matched'""")
def flow_metrics(t):
    golden = settle(golden_catalogue(t))
    return catalogue.flow_metrics(
        inputs.records(t), golden, catalogue.clean_sales(inputs.sales(t), golden),
        enrich.enrich(golden, "offline", inputs.fixture(t)))


def _step_sql() -> str:
    counted = {2: "invalid", 3: "repeated"}
    flows = [("staged", "staged"), ("staged", "staged"), ("staged", "valid"), ("valid", "gold"), ("gold", "gold"),
             ("gold", "gold")]
    rows = []
    for place, (name, text) in enumerate(zip(fixed.STEP_NAMES, fixed.STEP_DETAILS)):
        details = "'" + text.replace("{mode}", "offline") + "'"
        if place in counted:
            details = f"replace({details}, '{{n}}', CAST({counted[place]} AS VARCHAR))"
        rows.append(f"SELECT {place + 1} AS event_id, '{name}' AS step_name, {flows[place][0]} AS input_rows, "
                    f"{flows[place][1]} AS output_rows, {details} AS details FROM counts")
    return " UNION ALL ".join(rows)


@query("step_log", f"""WITH {GOLDEN_SQL},
counts AS (SELECT count(*) AS staged, count(*) FILTER (WHERE valid_isbn) AS valid,
  count(*) FILTER (WHERE NOT valid_isbn) AS invalid, (SELECT count(*) FROM golden) AS gold,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM records WHERE valid_isbn GROUP BY isbn13)
   WHERE n > 1) AS repeated FROM records) {_step_sql()}""")
def step_log(t):
    return catalogue.step_log(inputs.records(t), golden_catalogue(t), "offline")


@query("table_counts", f"WITH {MODEL_SQL} " + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}" for name, source in {
        "publishers": "pub", "authors": "authors", "books": "books", "editions": "editions",
        "book_authors": "book_authors", "sales": "sales", "altmetrics": "altmetrics",
        "openalex_enrichment": "matches", "source_records": "records"}.items()
) + " UNION ALL SELECT 'pipeline_events', 6")
def table_counts(t):
    return catalogue.table_counts(built(t).tables)
