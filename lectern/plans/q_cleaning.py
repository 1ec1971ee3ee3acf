"""Queries: text, codes, dates, nested cells, vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions import codes, dates, nested, text, vocab
from lectern.operators import conform, quality, reports, reshape
from lectern.plans import inputs
from lectern.plans.inputs import SALES_SQL, STAGING_SQL, derive, normalize_sql
from lectern.plans.registry import query
from lectern.sources import readers

TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def items_sql(cell: str) -> str:
    """Trimmed, non-empty items of a ``;`` cell as a DuckDB list."""
    return f"list_filter(list_transform(string_split({cell}, ';'), lambda x: trim(x)), lambda x: x <> '')"


def cell_sql(items: str) -> str:
    return f"nullif(array_to_string({items}, ';'), '')"


@query("text_normalize", f"SELECT doc_id, {normalize_sql('text')} AS normalized FROM documents")
def text_normalize(t):
    return t("documents").select("doc_id", text.normalize_text("text").alias("normalized"))


@query("text_fold", f"SELECT doc_id, strip_accents(lower({TRIM.format('text')})) AS folded FROM documents")
def text_fold(t):
    return t("documents").select("doc_id", text.fold_marks("text").alias("folded"))


@query("search_titles", "SELECT doc_id, "
       + TRIM.format("split_part(split_part(text, ':', 1), '.', 1)") + " AS search_title FROM documents")
def search_titles(t):
    return t("documents").select("doc_id", text.search_title("text").alias("search_title"))


AUDIT = """
SELECT o_orderkey, concat(CASE o_orderstatus WHEN 'F' THEN '​978-' WHEN 'O' THEN '978 ' ELSE 'x97' END,
  lpad(CAST(o_custkey AS STRING), 9, '0'), '-', CAST(o_orderkey % 10 AS STRING)) AS isbn
FROM orders
"""


@query("identifier_audit", f"""WITH cleaned AS (SELECT o_orderkey, isbn AS original,
  upper(regexp_replace(isbn, '[^0-9Xx]', '', 'g')) AS cleaned FROM ({AUDIT}))
SELECT o_orderkey, original, replace(original, chr(8203), '\\xE2808B') AS escaped, cleaned,
  CAST(length(cleaned) AS INT) AS length, CASE WHEN regexp_full_match(cleaned, '[0-9]{{13}}')
    THEN {inputs.digit_sum_sql('cleaned', 13)} % 10 = 0 ELSE FALSE END AS valid FROM cleaned""")
def identifier_audit(t):
    return quality.audit_identifiers(derive(t, "orders", AUDIT), "o_orderkey", "isbn")


CELLS = """
SELECT o_orderkey, concat('  ', o_orderpriority, ' | ', o_orderstatus, ' (', CAST(o_custkey AS STRING), ') ;  ',
  lower(o_orderpriority), ';', o_orderpriority, '; ;') AS cell,
  concat(o_orderstatus, '; ', lower(o_orderpriority)) AS main FROM orders
"""


@query("list_cells", rf"""WITH cells AS ({CELLS}),
tidied AS (SELECT *, regexp_replace(trim(replace(cell, '|', ';')), '\s*;\s*', ';', 'g') AS tidy,
  trim(regexp_replace(cell, '\([^)]*\)', '', 'g')) AS plain FROM cells),
listed AS (SELECT *, {items_sql('tidy')} AS items, {items_sql('lower(main)')} AS taken FROM tidied)
SELECT o_orderkey, tidy, plain, {cell_sql('list_filter(items, lambda x, i: list_position(items, x) = i)')} AS distinct_items,
  {cell_sql('list_filter(items, lambda x: NOT list_contains(taken, lower(x)))')} AS other_items,
  CAST(len(items) AS INT) AS n_items FROM listed""")
def list_cells(t):
    tidied = derive(t, "orders", CELLS).withColumn("tidy", text.tidy_delimiters("cell"))
    return tidied.select(
        "o_orderkey", "tidy", text.drop_parentheses("cell").alias("plain"),
        text.distinct_items("tidy").alias("distinct_items"), text.items_not_in("tidy", "main").alias("other_items"),
        F.size(text.split_list("tidy")).alias("n_items"))


DATES = """
SELECT o_orderkey, CASE
  WHEN o_orderpriority = '5-LOW' THEN 'sin fecha'
  WHEN o_orderstatus = 'F' THEN concat(' ', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/',
    lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', CAST(year(o_orderdate) AS STRING))
  WHEN o_orderstatus = 'P' THEN concat('c. ', CAST(year(o_orderdate) AS STRING), ' (rev. 2)')
  ELSE concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-',
    lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) END AS published
FROM orders
"""
YEARS_SQL = rf"""WITH dated AS (SELECT o_orderkey, trim(published) AS published FROM ({DATES})),
years AS (SELECT o_orderkey, CAST(coalesce(year(try_strptime(published, '%d/%m/%Y')), year(try_strptime(published, '%Y-%m-%d')),
  list_extract(list_filter(list_transform(string_split_regex(published, '[^0-9]+'), lambda n: TRY_CAST(left(n, 4) AS INT)),
    lambda y: y BETWEEN 1900 AND 2099), 1)) AS INT) AS year,
  CAST(year(try_strptime(published, '%Y-%m-%d')) AS INT) AS iso_year FROM dated)"""


@query("years_parsed", YEARS_SQL + " SELECT o_orderkey, year, iso_year FROM years")
def years_parsed(t):
    return derive(t, "orders", DATES).select(
        "o_orderkey", dates.year_day_first("published").alias("year"), dates.year_iso("published").alias("iso_year"))


SHORT_DATES = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN concat(CAST(day(o_orderdate) AS STRING), '.',
    CAST(month(o_orderdate) AS STRING), '.', lpad(CAST(o_custkey % 100 AS STRING), 2, '0'))
  WHEN o_orderstatus = 'F' THEN concat(lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/',
    lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0'))
  ELSE concat('31-13-', lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0')) END AS published
FROM orders
"""


@query("years_short", rf"""SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' AND day(o_orderdate) = 29 AND month(o_orderdate) = 2 AND o_custkey % 4 <> 0 THEN NULL
  WHEN o_orderstatus = 'P' THEN CASE WHEN o_custkey % 100 > 68 THEN 1900 ELSE 2000 END + o_custkey % 100
  WHEN o_orderstatus = 'F' THEN year(o_orderdate) END AS INT) AS year FROM orders""")
def years_short(t):
    return derive(t, "orders", SHORT_DATES).select("o_orderkey", dates.year_day_first("published").alias("year"))


@query("sheet_rows", "SELECT s_suppkey, s_name, row_number() OVER () + 1 AS source_row FROM supplier")
def sheet_rows(t):
    return readers.with_sheet_rows(t("supplier")).select("s_suppkey", "s_name", "source_row")


@query("view_rows", "SELECT n_regionkey, count(*) AS nations FROM nation WHERE n_name <> 'CHINA' GROUP BY n_regionkey")
def view_rows(t):
    t("nation").createOrReplaceTempView("lectern_nations")
    return readers.read_table(
        t("nation").sparkSession,
        "SELECT n_regionkey, count(*) AS nations FROM lectern_nations WHERE n_name <> 'CHINA' GROUP BY n_regionkey")


@query("years_between", YEARS_SQL + " SELECT o_orderkey, year, iso_year FROM years WHERE year BETWEEN 1996 AND 1999")
def years_between(t):
    return conform.between_years(years_parsed(t), "year", 1996, 1999)


@query("iso_dates", """SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_date, count(*) AS rows
FROM lineitem GROUP BY 1, 2""")
def iso_dates(t):
    rows = t("lineitem").select("l_orderkey", dates.iso_text("l_shipdate").alias("ship_date"))
    return reports.count_by(rows, ["l_orderkey", "ship_date"])


NAMES = """
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name
  ELSE concat(c_name, ',  ', c_mktsegment, CASE WHEN c_acctbal < 0 THEN ', Jr.' ELSE '' END) END AS person
FROM customer
"""


@query("natural_names", f"""SELECT c_custkey, CASE WHEN contains(person, ',')
  THEN concat(trim(split_part(person, ',', 2)), ' ', trim(split_part(person, ',', 1))) ELSE person END AS name
FROM ({NAMES})""")
def natural_names(t):
    return derive(t, "customer", NAMES).select("c_custkey", text.natural_name("person").alias("name"))


BLANKS = """
SELECT p_partkey, concat(' ', CAST(p_partkey AS STRING), CASE WHEN p_size > 25 THEN '.0' ELSE '' END) AS code,
  CASE p_type WHEN 'PROMO' THEN '   ' WHEN 'SMALL' THEN NULL ELSE p_name END AS title,
  CASE WHEN p_size > 10 THEN p_brand END AS subtitle FROM part
"""


@query("blanks_and_titles", rf"""SELECT p_partkey, regexp_replace(trim(code), '\.0$', '') AS code,
  nullif(trim(title), '') AS title, coalesce(nullif(trim(title), ''), '<falta_titulo_libro>') AS shown_title,
  CASE WHEN subtitle IS NULL THEN coalesce(nullif(trim(title), ''), '<falta_titulo_libro>')
    ELSE concat(coalesce(nullif(trim(title), ''), '<falta_titulo_libro>'), ': ', subtitle) END AS full_title
FROM ({BLANKS})""")
def blanks_and_titles(t):
    shown = text.or_sentinel("title", fixed.MISSING_TITLE)
    return derive(t, "part", BLANKS).select(
        "p_partkey", text.drop_decimal_zero("code").alias("code"), text.blank_to_null("title").alias("title"),
        shown.alias("shown_title"), text.full_title(shown, "subtitle").alias("full_title"))


PAIRS = """
SELECT o_orderkey, o_orderstatus, replace(concat('[[[~role~, ~organizer~], [~full_name~, ~', o_orderpriority, ', Ana~], [~x~, None]], ',
  CASE WHEN o_orderstatus = 'F' THEN '[[~role~, ~individual_author~], [~full_name~, "O~Brien '
       ELSE '[[~role~, ~translator~], [~full_name~, "O~Neill ' END, CAST(o_custkey AS STRING), '"]]]'), '~', chr(39)) AS people,
  replace(concat('[[~lang~, None], [~title~, ~Serie ', o_orderpriority, '~], [~n~, 3]]'), '~', chr(39)) AS collection,
  replace(concat('[[[~store~, ~Amazon~], [~url~, None]], [[~store~, ~', o_orderpriority, '~]], [[~store~, ~Amazon~]]]'), '~', chr(39)) AS shops
FROM orders
"""


@query("creators", """
SELECT o_orderkey, 0 AS position, 'organizador' AS role, concat('Ana ', o_orderpriority) AS name FROM orders UNION ALL
SELECT o_orderkey, 1, CASE WHEN o_orderstatus = 'F' THEN 'autor' ELSE 'translator' END,
  concat(CASE WHEN o_orderstatus = 'F' THEN 'O''Brien ' ELSE 'O''Neill ' END, o_custkey) FROM orders""")
def creators(t):
    people = derive(t, "orders", PAIRS).withColumn("people", nested.creators("people"))
    return reshape.explode_people(people, ["o_orderkey"], "people")


@query("object_titles", "SELECT o_orderkey, concat('Serie ', o_orderpriority) AS collection FROM orders")
def object_titles(t):
    return derive(t, "orders", PAIRS).select("o_orderkey", nested.object_title("collection").alias("collection"))


@query("props_value", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def props_value(t):
    pair = F.regexp_replace("props", r'^\{("k"): (.*)\}$', "[[$1, $2]]")
    return t("events").select("event_id", nested.pair_value(nested.parse_pairs(pair), "k").alias("k"))


CODES = """
SELECT p_partkey, concat('[', upper(substr(p_type, 1, 3)), lpad(CAST(p_partkey AS STRING), 6, '0'), '] ', p_name,
    ' > x;', upper(substr(p_name, 1, 3)), '00', lpad(CAST(p_size AS STRING), 4, '0'), ' plain;none') AS bisac,
  concat(upper(substr(p_name, 1, 3)), lpad(CAST(p_partkey AS STRING), 6, '0'), CASE WHEN p_size > 9 THEN '  > ' ELSE ' - ' END,
    p_name) AS bisac_arrow,
  concat('[[[~code~, ~', upper(substr(p_name, 1, 3)), '000', CAST(p_size AS STRING), '~]]]') AS bisac_pairs,
  concat('[Q', substr(upper(p_type), 1, 1), ';Q] ', p_name, ';[P] x; ', 'X', CAST(p_size AS STRING), ' > a;low > b; X',
    CAST(p_size AS STRING), ' > c; Q > d') AS thema,
  concat('[', CAST(100 + p_size AS STRING), '.', CAST(p_size AS STRING), '] Edu; x ', CAST(500 + p_size AS STRING), ';none') AS dewey
FROM part
"""


def _picked_sql(cell: str, code: str, wanted: str) -> str:
    """Codes that ``code`` finds in the items x of a list cell and that fit ``wanted``."""
    return cell_sql(f"list_filter(list_transform(string_split({cell}, ';'), lambda x: {code}), lambda c: regexp_full_match(c, '{wanted}'))")


SUBJECT, CLASS_NUMBER = "[A-Z]{3}[0-9]{6}", "[0-9]{3}([.][0-9]+)?"
QUOTED_CODES = CODES.replace("'[[[~code~, ~'", "'[[[''code'', '''").replace("'~]]]'", "''']]]'")
# the word of an item that holds a number, without its brackets
NUMBER_WORD = "trim(list_extract(list_filter(string_split(x, ' '), lambda w: regexp_matches(w, '[0-9]')), 1), '[]')"


@query("classification_codes", f"""WITH c AS ({QUOTED_CODES}),
h AS (SELECT *, list_filter(string_split(split_part(split_part(thema, '[', 2), ']', 1), ';'), lambda x: regexp_full_match(x, '[A-Z0-9]{{1,6}}')) AS bracket,
  list_transform({items_sql('thema')}, lambda x: trim(split_part(x, '>', 1))) AS heads FROM c),
e AS (SELECT *, list_filter(heads, lambda x, i: regexp_full_match(x, '[A-Z0-9]{{1,6}}') AND NOT list_contains(bracket, x)
  AND list_position(heads, x) = i) AS extra FROM h)
SELECT p_partkey, {_picked_sql('bisac', "left(ltrim(x, '['), 9)", SUBJECT)} AS bisac,
  CASE WHEN contains(bisac_arrow, '>') AND regexp_full_match(rtrim(split_part(bisac_arrow, '>', 1)), '{SUBJECT}')
    THEN rtrim(split_part(bisac_arrow, '>', 1)) END AS bisac_arrow,
  split_part(bisac_pairs, '''', 4) AS bisac_pairs,
  {_picked_sql('thema', "CASE WHEN contains(x, ']') THEN split_part(split_part(x, '[', 2), ']', 1) ELSE '' END", '[A-Z0-9]+')} AS thema_brackets,
  {cell_sql('list_concat(bracket, extra)')} AS thema_mixed, {_picked_sql('dewey', NUMBER_WORD, CLASS_NUMBER)} AS dewey,
  split_part(ltrim(dewey, '['), ']', 1) AS dewey_leading FROM e""")
def classification_codes(t):
    rows = derive(t, "part", CODES).withColumn("bisac_pairs", F.replace("bisac_pairs", F.lit("~"), F.lit("'")))
    return rows.select(
        "p_partkey", codes.bisac_list("bisac").alias("bisac"), codes.bisac_before_arrow("bisac_arrow").alias("bisac_arrow"),
        codes.bisac_in_pairs("bisac_pairs").alias("bisac_pairs"), codes.thema_brackets("thema").alias("thema_brackets"),
        codes.thema_mixed("thema").alias("thema_mixed"), codes.dewey_list("dewey").alias("dewey"),
        codes.dewey_leading("dewey").alias("dewey_leading"))


# every name is one more item, none of them with a code
NAMED_CODES, NAMED_SQL = (given.replace("' plain;none'", "' plain;none;', p_name") for given in (CODES, QUOTED_CODES))


@query("unread_fragments", f"""SELECT trim(x) AS fragment, count(*) AS times, min(p_partkey) AS first_key
FROM (SELECT p_partkey, unnest(string_split(bisac, ';')) AS x FROM ({NAMED_SQL}) AS c)
WHERE trim(x) <> '' AND NOT regexp_matches(x, '^\\[?{SUBJECT}') GROUP BY 1""")
def unread_fragments(t):
    items = derive(t, "part", NAMED_CODES).select("p_partkey", F.explode(codes.bisac_unread("bisac")).alias("fragment"))
    return items.groupBy("fragment").agg(F.count("*").alias("times"), F.min("p_partkey").alias("first_key"))


DOIS = """
SELECT page_id, CASE WHEN url LIKE '%.org/%' THEN url END AS url, CASE WHEN url LIKE 'https://m.%' THEN concat('s-', url) END AS doi_simeh,
  CASE WHEN url LIKE '%/en/%' THEN url END AS doi_found, CASE WHEN url LIKE 'http:%' THEN 'c' ELSE url END AS doi_scielo
FROM pages
"""


@query("doi_priority", rf"""SELECT page_id, nullif(regexp_extract(url, '.org/(.*)', 1), '') AS own_doi,
  coalesce(nullif(regexp_extract(url, '.org/(.*)', 1), ''), doi_simeh, doi_found, doi_scielo) AS doi FROM ({DOIS})""")
def doi_priority(t):
    own = codes.doi_from_url("url")
    return derive(t, "pages", DOIS).select(
        "page_id", own.alias("own_doi"), vocab.first_present(own, "doi_simeh", "doi_found", "doi_scielo").alias("doi"))


FLAGS = """
SELECT event_id, CASE event_type WHEN 'view' THEN 'No' WHEN 'click' THEN 'Si' WHEN 'purchase' THEN 'SI, otra' WHEN 'signup' THEN 'nota' END AS shared,
  CASE WHEN event_type <> 'view' THEN event_type END AS partner,
  CASE WHEN event_type IN ('view', 'click') THEN concat('e', CAST(event_id AS STRING)) END AS eisbn,
  CASE WHEN event_type <> 'error' THEN concat('p', CAST(event_id AS STRING)) END AS isbn,
  CASE WHEN event_type = 'error' THEN -1 ELSE CAST(floor(value) AS INT) END AS quantity FROM events
"""


@query("yes_no_fields", f"""WITH f AS (SELECT *, CASE WHEN shared IS NULL OR contains(lower(shared), 'no') THEN 'no' ELSE 'si' END AS flag FROM ({FLAGS}))
SELECT event_id, flag, CASE WHEN flag = 'si' THEN partner END AS partner,
  CASE WHEN partner IS NULL THEN 'no' ELSE 'si' END AS partner_flag, nullif(quantity, -1) AS quantity FROM f""")
def yes_no_fields(t):
    rows = derive(t, "events", FLAGS).withColumn("flag", vocab.yes_no("shared"))
    return rows.select(
        "event_id", "flag", vocab.only_if_yes("flag", "partner").alias("partner"),
        vocab.yes_no_from_presence("partner").alias("partner_flag"),
        vocab.minus_one_to_null("quantity").alias("quantity"))


@query("identifier_fallback", f"""SELECT event_id, coalesce(eisbn, isbn) AS identifier,
  CASE WHEN eisbn IS NOT NULL THEN 'ebook' END AS edition_format FROM ({FLAGS}) WHERE coalesce(eisbn, isbn) IS NOT NULL""")
def identifier_fallback(t):
    rows = derive(t, "events", FLAGS).select(
        "event_id", codes.fallback_identifier("eisbn", "isbn").alias("identifier"),
        codes.fallback_format("eisbn", "ebook").alias("edition_format"))
    return rows.where(F.col("identifier").isNotNull())


# --- vocabularies ----------------------------------------------------------------------------------


def table_sql(column: str, table: dict, caseless: bool = True) -> str:
    probe = f"lower(trim({column}))" if caseless else column
    cases = " ".join(f"WHEN {probe} IN ({', '.join(repr(v) for v in variants)}) THEN '{standard}'"
                     for standard, variants in table.items())
    return f"CASE {cases} ELSE {column} END"


def rules_sql(column: str, rules: list) -> str:
    for kind, old, new in rules:
        column = f"CASE WHEN {column} = '{old}' THEN '{new}' ELSE {column} END" if kind == "is" else f"replace({column}, '{old}', '{new}')"
    return column


@query("standard_values", f"""WITH {STAGING_SQL}
SELECT source_name, source_row, {table_sql('country', fixed.COUNTRY_NAMES)} AS country,
  {table_sql('language', fixed.LANGUAGE_NAMES)} AS language FROM records""")
def standard_values(t):
    return inputs.records(t).select(
        "source_name", "source_row", vocab.by_table("country", fixed.COUNTRY_NAMES).alias("country"),
        vocab.by_table("language", fixed.LANGUAGE_NAMES).alias("language"))


@query("standard_channels", f"""WITH {SALES_SQL}
SELECT {table_sql('channel', fixed.CHANNEL_NAMES, False)} AS channel, {rules_sql('channel', fixed.STORE_RULES)} AS store,
  count(*) AS rows FROM sales_raw GROUP BY ALL""")
def standard_channels(t):
    rows = inputs.sales(t).select(
        vocab.by_table("channel", fixed.CHANNEL_NAMES, caseless=False).alias("channel"),
        vocab.by_rules("channel", fixed.STORE_RULES).alias("store"))
    return reports.count_by(rows, ["channel", "store"])


WIDE = """
SELECT doc_id, CASE lang WHEN 'en' THEN 'Inglés;Español' WHEN 'es' THEN 'Español / Castellano;Gallego' WHEN 'de' THEN 'ita' ELSE 'pt' END AS language,
  CASE lang WHEN 'en' THEN 'print;pdf' ELSE 'ebook' END AS edition_format,
  CASE lang WHEN 'en' THEN 'Monograph' WHEN 'es' THEN 'Monográfica' ELSE 'tesis' END AS work_type,
  CASE lang WHEN 'en' THEN 'translator' WHEN 'es' THEN 'organizador' ELSE 'autor' END AS role,
  CASE lang WHEN 'en' THEN 'BR' WHEN 'es' THEN 'Peru' ELSE 'Chile' END AS country FROM documents
"""


@query("ordered_rules", f"""SELECT doc_id, {rules_sql('language', fixed.LANGUAGE_RULES[:1] + fixed.LANGUAGE_RULES[3:])} AS language,
  {rules_sql('edition_format', fixed.FORMAT_RULES)} AS edition_format, {rules_sql('work_type', fixed.WORK_TYPE_RULES)} AS work_type,
  {rules_sql('role', fixed.ROLE_RULES)} AS role, {rules_sql('country', fixed.COUNTRY_RULES)} AS country FROM ({WIDE})""")
def ordered_rules(t):
    rules = {"language": fixed.LANGUAGE_RULES, "edition_format": fixed.FORMAT_RULES,
             "work_type": fixed.WORK_TYPE_RULES, "role": fixed.ROLE_RULES, "country": fixed.COUNTRY_RULES}
    return derive(t, "documents", WIDE).select(
        "doc_id", *[vocab.by_rules(name, rule).alias(name) for name, rule in rules.items()])


@query("distinct_values", f"WITH {STAGING_SQL} SELECT DISTINCT country FROM records ORDER BY country NULLS FIRST")
def distinct_values(t):
    return reports.distinct_values(inputs.records(t), "country")


CHANGES_SQL = f"""WITH {STAGING_SQL},
cells AS (SELECT 'country' AS field, country AS before, {table_sql('country', fixed.COUNTRY_NAMES)} AS after FROM records UNION ALL
  SELECT 'language', language, {table_sql('language', fixed.LANGUAGE_NAMES)} FROM records)"""


def _changes() -> dict:
    return {"country": (F.col("country"), vocab.by_table("country", fixed.COUNTRY_NAMES)),
            "language": (F.col("language"), vocab.by_table("language", fixed.LANGUAGE_NAMES))}


@query("changed_values", CHANGES_SQL + " SELECT DISTINCT field, before, after FROM cells")
def changed_values(t):
    return reports.changed_values(inputs.records(t), _changes())


@query("before_after", CHANGES_SQL + """
SELECT field, string_agg(DISTINCT before, '; ' ORDER BY before) AS before,
  string_agg(DISTINCT after, '; ' ORDER BY after) AS after FROM cells GROUP BY field""")
def before_after(t):
    return reports.before_after(inputs.records(t), _changes())
