"""Catalogue inputs derived from the given tables, in Spark and in SQL.

Three exports with different schemas: ``part`` plays the project's own template,
``orders`` (several rows per customer) and ``events`` (many rows per user) the two
institutions. Their keys share one number range, so the identifiers built from them
overlap. Identifiers carry hyphens, blanks or wrong check digits depending on values.
Sales come from ``lineitem``, metrics from ``customer``, stored matches from ``supplier``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.codes import check_digit
from lectern.operators.conform import conform, union_all

Tables = Callable[[str], DataFrame]

# every derived text once, in SQL both engines read
OWN = """
SELECT p_partkey + 2 AS source_row, p_partkey AS n, concat('978-', lpad(CAST(p_partkey AS STRING), 9, '0'), '-') AS stem,
  CASE WHEN p_type = 'PROMO' THEN p_name ELSE concat(p_name, ' ', CAST(p_partkey AS STRING)) END AS title,
  concat(p_brand, '; ', p_type) AS authors, concat('House ', CAST(p_size AS STRING)) AS publisher,
  1950 + p_size AS year, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS country, 100 + p_size AS pages,
  CASE p_type WHEN 'SMALL' THEN 'es' WHEN 'LARGE' THEN 'Spanish' WHEN 'ECONOMY' THEN 'en' END AS language,
  CASE WHEN p_size <= 25 THEN concat('https://books.example.org/', CAST(p_partkey AS STRING)) END AS source_url, 0 AS shift
FROM part
"""
SIMEH = """
SELECT o_orderkey + 2 AS source_row, o_custkey AS n, concat('978', lpad(CAST(o_custkey AS STRING), 9, '0')) AS stem,
  CASE WHEN o_orderstatus = 'F' THEN concat('ORDER BOOK ', CAST(o_custkey AS STRING))
       ELSE concat('Order  book, ', CAST(o_custkey AS STRING)) END AS title,
  concat('Clerk ', o_orderpriority, ' ;Customer ', CAST(o_custkey AS STRING)) AS authors, o_orderpriority AS publisher,
  CAST(year(o_orderdate) AS INT) AS year, CASE o_orderstatus WHEN 'F' THEN 'BR' WHEN 'O' THEN 'Peru' END AS country,
  CAST(floor(o_totalprice / 1000) AS INT) AS pages, CASE WHEN o_orderstatus <> 'F' THEN 'pt' END AS language,
  concat('https://orders.example.org/', CAST(o_orderkey AS STRING)) AS source_url,
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS shift
FROM orders
"""
SCIELO = """
SELECT event_id + 2 AS source_row, user_id AS n, concat('978 ', lpad(CAST(user_id AS STRING), 9, '0'), ' ') AS stem,
  concat('Événement ', CAST(user_id AS STRING), ' / ', event_type) AS title,
  concat(event_type, ' Ñandú;User ', CAST(user_id AS STRING), ';') AS authors, event_type AS publisher,
  CAST(year(ts) AS INT) AS year, CASE WHEN event_type <> 'view' THEN 'México' END AS country,
  CAST(floor(value) AS INT) AS pages, 'Español / Castellano' AS language, props AS source_url,
  CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS shift
FROM events
"""
SALES = """
SELECT concat(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '979' ELSE '978' END,
              lpad(CAST(l_partkey AS STRING), 9, '0')) AS stem,
  CAST(l_shipdate AS DATE) AS sale_date, CAST(l_quantity AS INT) AS units, l_extendedprice AS revenue_eur,
  CASE l_returnflag WHEN 'A' THEN 'Amazon' WHEN 'N' THEN 'Google Play' ELSE 'Web' END AS channel, 1 AS synthetic
FROM lineitem
"""
METRICS = """
SELECT concat('978', lpad(CAST(c_custkey AS STRING), 9, '0')) AS stem, c_nationkey AS mentions,
  CAST(floor(abs(c_acctbal)) AS INT) AS readers, c_acctbal AS demo_score, 1 AS synthetic
FROM customer
"""
FIXTURE = """
SELECT concat('978', lpad(CAST(s_suppkey AS STRING), 9, '0')) AS stem, CAST(s_suppkey AS INT) AS record_no,
  CASE WHEN s_nationkey >= 5 THEN 'offline_demo_checked' END AS match_status, s_nationkey * 3 AS cited_by_count_demo
FROM supplier
"""


def _digits(expression: Column) -> Column:
    return F.regexp_replace(expression, "[^0-9]", "")


def with_identifier(frame: DataFrame, name: str, shift: str | None = None) -> DataFrame:
    """Stem plus its check digit; ``shift`` makes the digit wrong."""
    digit = check_digit(_digits(F.col("stem")))
    if shift:
        digit = (digit + F.col(shift)) % 10
    return frame.withColumn(name, F.concat("stem", digit.cast("string"))).drop("stem")


def derive(tables: Tables, table: str, sql: str) -> DataFrame:
    """One of the texts above over a given table."""
    frame = tables(table)
    return frame.sparkSession.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=frame)


def exports(tables: Tables) -> dict[str, DataFrame]:
    """The three exports under their own column names, with a row number."""
    found = {}
    for source, table, sql in (("simeh", "orders", SIMEH), ("plantilla_propia", "part", OWN),
                               ("scielo", "events", SCIELO)):
        rows = with_identifier(derive(tables, table, sql), "isbn", "shift")
        found[source] = rows.select(
            "source_row", *[F.col(name).alias(export) for name, export in fixed.SOURCE_COLUMNS[source].items()])
    return found


def records(tables: Tables) -> DataFrame:
    """The staging table."""
    return union_all([
        conform(rows, fixed.SOURCE_COLUMNS[source], source, F.col("source_row"))
        for source, rows in exports(tables).items()
    ])


def sales(tables: Tables) -> DataFrame:
    return with_identifier(derive(tables, "lineitem", SALES), "isbn13")


def metrics(tables: Tables) -> DataFrame:
    return with_identifier(derive(tables, "customer", METRICS), "isbn13")


def fixture(tables: Tables) -> DataFrame:
    return with_identifier(derive(tables, "supplier", FIXTURE), "isbn13")


# --- the same in SQL ----------------------------------------------------------------------------


def digit_sum_sql(code: str, places: int) -> str:
    return "(" + " + ".join(
        f"(ascii(substr({code}, {place}, 1)) - 48)" + ("" if place % 2 else " * 3") for place in range(1, places + 1)
    ) + ")"


def check_digit_sql(code: str) -> str:
    return f"((10 - {digit_sum_sql(code, 12)} % 10) % 10)"


def normalize_sql(text: str) -> str:
    return f"lower(trim(regexp_replace(strip_accents({text}), '[^a-zA-Z0-9]+', ' ', 'g')))"


def with_identifier_sql(name: str, sql: str, identifier: str, shift: str = "0") -> str:
    digit = check_digit_sql("digits")
    return (
        f"{name}_stem AS (SELECT *, regexp_replace(stem, '[^0-9]', '', 'g') AS digits FROM ({sql}) q),\n"
        f"{name} AS (SELECT * EXCLUDE (stem, digits), concat(stem, CAST(({digit} + {shift}) % 10 AS VARCHAR)) "
        f"AS {identifier} FROM {name}_stem)"
    )


STAGING_SQL = ",\n".join([
    with_identifier_sql("own", OWN, "isbn", "shift"),
    with_identifier_sql("simeh", SIMEH, "isbn", "shift"),
    with_identifier_sql("scielo", SCIELO, "isbn", "shift"),
    "stacked AS (SELECT *, 'plantilla_propia' AS source_name, 0 AS priority FROM own UNION ALL BY NAME "
    "SELECT *, 'simeh' AS source_name, 1 AS priority FROM simeh UNION ALL BY NAME "
    "SELECT *, 'scielo' AS source_name, 2 AS priority FROM scielo)",
    "cleaned AS (SELECT *, isbn AS raw_isbn, title AS raw_title, "
    "upper(regexp_replace(isbn, '[^0-9Xx]', '', 'g')) AS isbn13, "
    f"{normalize_sql('title')} AS normalized_title FROM stacked)",
    "records AS (SELECT *, CASE WHEN regexp_full_match(isbn13, '[0-9]{13}') "
    f"THEN {digit_sum_sql('isbn13', 13)} % 10 = 0 ELSE FALSE END AS valid_isbn FROM cleaned)",
])

_SURVIVORS = ", ".join(
    f"arg_min({name}, priority * 1000000000000 + source_row) FILTER (WHERE {name} IS NOT NULL) AS {name}"
    for name in ["title", "normalized_title", "authors", "publisher", "year", "country", "pages", "language",
                 "source_url"])

GOLDEN_SQL = STAGING_SQL + f""",
golden AS (SELECT isbn13, {_SURVIVORS}, CAST(count(DISTINCT source_name) AS INT) AS source_count,
  string_agg(DISTINCT source_name, ', ' ORDER BY source_name) AS source_names
  FROM records WHERE valid_isbn GROUP BY isbn13)"""

SALES_SQL = with_identifier_sql("sales_raw", SALES, "isbn13")
METRICS_SQL = with_identifier_sql("metrics_raw", METRICS, "isbn13")
FIXTURE_SQL = with_identifier_sql("fixture", FIXTURE, "isbn13")

MODEL_SQL = ",\n".join([GOLDEN_SQL, SALES_SQL, METRICS_SQL, FIXTURE_SQL, """
pub AS (SELECT row_number() OVER (ORDER BY first) AS publisher_id, name FROM
  (SELECT publisher AS name, min(CAST(isbn13 AS BIGINT)) AS first FROM golden WHERE publisher IS NOT NULL GROUP BY 1)),
books AS (SELECT row_number() OVER (ORDER BY first) AS book_id, normalized_title, title, first_publication_year, country
  FROM (SELECT normalized_title, min(isbn13) AS first, arg_min(title, isbn13) AS title,
    arg_min(year, isbn13) AS first_publication_year,
    nullif(arg_min(coalesce(country, '<null>'), isbn13), '<null>') AS country FROM golden GROUP BY 1)),
editions AS (SELECT isbn13, book_id, publisher_id, year AS publication_year, pages, language, source_count,
  source_names, source_url FROM golden g JOIN books USING (normalized_title)
  LEFT JOIN pub ON pub.name = g.publisher),
people AS (SELECT isbn13, book_id, trim(item) AS name, place FROM
  (SELECT isbn13, book_id, unnest(string_split(authors, ';')) AS item,
    generate_subscripts(string_split(authors, ';'), 1) AS place
   FROM golden JOIN books USING (normalized_title)) WHERE trim(item) <> ''),
authors AS (SELECT row_number() OVER (ORDER BY isbn13, place) AS author_id, name FROM
  (SELECT name, min((isbn13, place)) AS first, arg_min(isbn13, (isbn13, place)) AS isbn13,
    arg_min(place, (isbn13, place)) AS place FROM people GROUP BY name)),
book_authors AS (SELECT DISTINCT book_id, author_id FROM people JOIN authors USING (name)),
sales AS (SELECT isbn13, strftime(sale_date, '%Y-%m-%d') AS sale_date, units, revenue_eur, channel, synthetic
  FROM sales_raw WHERE isbn13 IN (SELECT isbn13 FROM golden)),
altmetrics AS (SELECT * FROM metrics_raw WHERE isbn13 IN (SELECT isbn13 FROM golden)),
matches AS (SELECT g.isbn13, g.title AS query_title,
  CASE WHEN f.isbn13 IS NULL THEN 'not_in_fixture' ELSE coalesce(f.match_status, 'offline_demo') END AS match_status,
  'fixture_offline' AS data_source, CAST(f.cited_by_count_demo AS BIGINT) AS cited_by_count
  FROM golden g LEFT JOIN fixture f USING (isbn13))""".strip()])
