"""Queries: the wider model over exports derived from part, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.plans import wide
from lectern.plans.inputs import derive
from lectern.plans.q_cleaning import rules_sql
from lectern.plans.registry import query

TEMPLATE = """
SELECT p_partkey AS row, concat(p_name, ' ', CAST(p_partkey AS STRING)) AS titulo, CASE WHEN p_size <= 40 THEN '2022' ELSE '2030' END AS anio,
  CASE WHEN p_type <> 'PROMO' THEN concat(p_type, ', ', p_brand, ' ; Clerk') END AS autor, CASE WHEN p_type = 'SMALL' THEN p_brand END AS compilador,
  concat('978', lpad(CAST(p_partkey AS STRING), 10, '0'), '.0') AS impreso,
  CASE WHEN p_size > 25 THEN concat('979', lpad(CAST(p_partkey AS STRING), 10, '0')) ELSE '  ' END AS epub,
  concat('https://doi.org/10.3/', CAST(p_partkey AS STRING)) AS doi, p_brand AS editorial, CASE WHEN p_size > 10 THEN 'Si' ELSE 'no' END AS coedicion,
  concat('House Two;', p_brand) AS coeditora, 'Peru' AS pais FROM part
"""
SERIAL = """
SELECT o_orderkey AS row, CASE WHEN o_orderstatus = 'F' THEN concat('978', lpad(CAST(o_custkey AS STRING), 10, '0')) END AS eisbn,
  CASE WHEN o_orderstatus = 'O' THEN concat('100', lpad(CAST(o_orderkey AS STRING), 10, '0')) END AS isbn,
  concat('T', CAST(o_custkey AS STRING)) AS title, concat(CAST(year(o_orderdate) + 23 AS STRING), '-01-02') AS published,
  concat('[[[~role~, ~organizer~], [~full_name~, ~', o_orderpriority, ', Ana~]], [[~role~, None], [~full_name~, ~Luz~]]]') AS creators,
  o_orderpriority AS publisher, concat('http://dx.doi.org/10.7/', CAST(o_orderkey AS STRING)) AS doi,
  concat('[[[~store~, ~Amazon~]], [[~store~, ~', o_orderpriority, '~]]]') AS shops FROM orders
"""
RECORDS = """
SELECT event_id AS row, concat('R', CAST(event_id AS STRING)) AS record, concat(' 978', lpad(CAST(event_id AS STRING), 10, '0'), '.0') AS isbn,
  CASE WHEN event_type <> 'error' THEN event_type END AS title, CASE WHEN event_type = 'view' THEN props END AS subtitle,
  concat('User ', CAST(user_id AS STRING), ' | Ana;  User ', CAST(user_id AS STRING)) AS people,
  concat('01/02/', CAST(year(ts) AS STRING)) AS published, concat('[', upper(substr(event_type, 1, 1)), '] x (y)') AS thema,
  CASE WHEN event_type = 'click' THEN ' print ' ELSE 'ebook' END AS edition_format, 'Casa' AS publisher,
  CASE WHEN value > 20 THEN concat('CASA (x) | ', event_type) END AS others FROM events
"""


def _quoted(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({name: F.replace(name, F.lit("~"), F.lit("'")) for name in columns})


def _export(frame: DataFrame, given: dict[str, str], columns: list[str]) -> DataFrame:
    """The raw export under its own headings; what the tables do not have is empty."""
    return frame.select("row", F.lit("export").alias("origin_file"), *[
        (F.col(given[name]) if name in given else F.lit(None)).cast("string").alias(name) for name in columns])


TEMPLATE_HEADINGS = [
    "Titulo", "anio_publicacion", "Autor", "Editor", "Compilador", "Coordinador", "palabras_clave", "ISBN IMPRESO", "ISBN PDF", "ISBN EPUB",
    "DOI", "pais_publicacion", "ciudad_publicacion", "editorial_principal_nombre", "coedicion_si_no", "institucion_coeditora_nombre",
    "tipo_coedicion", "tipo_obra", "resumen", "idioma", "coleccion", "bisac", "thema", "dewey"]
SERIAL_HEADINGS = ["_id", "eisbn", "isbn", "title", "publication_date", "creators", "country", "publisher", "synopsis", "language",
                   "collection", "bisac_code", "TYPE", "doi_number", "edition", "shopping_info"]
RECORD_HEADINGS = [
    "RecordReference", "ISBN13", "Título", "Subtítulo", "Colaborador", "Fecha de publicación", "THEMA", "BISAC", "Dewey", "Palabras claves",
    "Texto de contenido", "Editor", "Editores", "Formato", "Idioma", "Colección", "País de publicación", "Ciudad de publicación", "DOI"]


def template(t) -> DataFrame:
    return wide.clean_template(_export(derive(t, "part", TEMPLATE), {
        "Titulo": "titulo", "anio_publicacion": "anio", "Autor": "autor", "Compilador": "compilador", "ISBN IMPRESO": "impreso",
        "ISBN EPUB": "epub", "DOI": "doi", "editorial_principal_nombre": "editorial", "coedicion_si_no": "coedicion",
        "institucion_coeditora_nombre": "coeditora", "pais_publicacion": "pais"}, TEMPLATE_HEADINGS))


def serial(t) -> DataFrame:
    return wide.clean_serial_export(_export(_quoted(derive(t, "orders", SERIAL), "creators", "shops"), {
        "eisbn": "eisbn", "isbn": "isbn", "title": "title", "publication_date": "published", "creators": "creators",
        "publisher": "publisher", "doi_number": "doi", "shopping_info": "shops"}, SERIAL_HEADINGS))


def records(t) -> DataFrame:
    return wide.clean_record_export(_export(derive(t, "events", RECORDS), {
        "RecordReference": "record", "ISBN13": "isbn", "Título": "title", "Subtítulo": "subtitle", "Colaborador": "people",
        "Fecha de publicación": "published", "THEMA": "thema", "Formato": "edition_format", "Editor": "publisher",
        "Editores": "others"}, RECORD_HEADINGS))


def model(t) -> wide.WideModel:
    return wide.WideModel({"plantilla_propia": template(t), "scielo": serial(t)})


TEMPLATE_SQL = f"""t0 AS (SELECT * FROM ({TEMPLATE}) WHERE anio = '2022' AND autor IS NOT NULL),
t1 AS (SELECT *, concat(split_part(trim(split_part(autor, ';', 1)), ', ', 2), ' ', split_part(autor, ', ', 1)) AS a1,
  CASE WHEN coedicion = 'Si' THEN coeditora END AS partner FROM t0),
template AS (SELECT 1 AS source_rank, row, trim(epub) AS isbn13, titulo AS title, '2022' AS year, concat_ws(';', a1, 'Clerk', compilador) AS contributors,
    'ebook' AS edition_format, pais AS country, doi, CAST(NULL AS VARCHAR) AS doi_scielo, editorial AS main_publisher, partner AS copublisher, lower(coedicion) AS shared,
    a1, compilador FROM t1 WHERE trim(epub) <> '' UNION ALL
  SELECT 1, row, replace(impreso, '.0', ''), titulo, '2022', concat_ws(';', a1, 'Clerk', compilador), 'impreso', pais,
    CASE WHEN trim(epub) = '' THEN doi END, NULL, editorial, partner, lower(coedicion), a1, compilador FROM t1)"""
SERIAL_SQL = f"""s0 AS (SELECT *, CAST(substr(published, 1, 4) AS INT) AS year FROM ({SERIAL}) WHERE coalesce(eisbn, isbn) IS NOT NULL),
serial AS (SELECT 2 AS source_rank, row, coalesce(eisbn, isbn) AS isbn13, title, CAST(year AS VARCHAR) AS year, concat('Ana ', publisher, ';Luz') AS contributors,
  CASE WHEN eisbn IS NOT NULL THEN 'ebook' END AS edition_format, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS doi, replace(doi, 'http://dx.doi.org/', '') AS doi_scielo,
  publisher AS main_publisher, CAST(NULL AS VARCHAR) AS copublisher, CAST(NULL AS VARCHAR) AS shared, NULL AS a1, NULL AS compilador FROM s0 WHERE year BETWEEN 2020 AND 2024)"""
MODEL_SQL = f"""WITH {TEMPLATE_SQL}, {SERIAL_SQL},
stacked AS (SELECT *, source_rank * 1000000000000000 + row AS at_row FROM (SELECT * FROM template UNION ALL SELECT * FROM serial)),
accepted AS (SELECT * FROM stacked WHERE substr(isbn13, 1, 3) IN ('978', '979')),
people AS (SELECT isbn13, at_row, 0 AS place, 'autor' AS role, a1 AS name FROM accepted WHERE source_rank = 1 UNION ALL
  SELECT isbn13, at_row, 1, 'autor', 'Clerk' FROM accepted WHERE source_rank = 1 UNION ALL
  SELECT isbn13, at_row, 2, 'compilador', compilador FROM accepted WHERE source_rank = 1 AND compilador IS NOT NULL UNION ALL
  SELECT isbn13, at_row, 0, 'compilador', concat('Ana ', main_publisher) FROM accepted WHERE source_rank = 2 UNION ALL
  SELECT isbn13, at_row, 1, NULL, 'Luz' FROM accepted WHERE source_rank = 2),
authors AS (SELECT row_number() OVER (ORDER BY first, name) AS author_id, name FROM (SELECT name, min((at_row, place)) AS first FROM people GROUP BY 1)),
works AS (SELECT row_number() OVER (ORDER BY first, title, contributors) AS work_id, title, contributors FROM
  (SELECT title, contributors, min(at_row) AS first FROM accepted GROUP BY 1, 2)),
identifiers AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isbn13 ORDER BY source_rank, row) AS n FROM accepted) WHERE n = 1)"""


@query("wide_record_rows", rf"""SELECT row, concat('978', lpad(CAST(row AS VARCHAR), 10, '0')) AS isbn13,
  concat_ws(': ', coalesce(title, '<falta_titulo_libro>'), subtitle) AS title, '2024' AS year, concat(regexp_extract(people, '^(User \d+)', 1), ';Ana') AS contributors,
  upper(substr(thema, 2, 1)) AS thema, trim(edition_format) AS edition_format, CASE WHEN others IS NOT NULL THEN trim(split_part(others, '|', 2)) END AS copublisher,
  CASE WHEN others IS NULL THEN 'no' ELSE 'si' END AS shared FROM ({RECORDS})""")
def wide_record_rows(t):
    return records(t).select("row", "isbn13", "title", "year", "contributors", "thema", "edition_format", "copublisher", "shared")


@query("wide_identifiers", MODEL_SQL + f""" SELECT isbn13, title, year, contributors, edition_format, {rules_sql('country', fixed.COUNTRY_RULES)} AS country,
  nullif(replace(doi, 'https://doi.org/', ''), '') AS doi, doi_scielo, main_publisher, copublisher, shared FROM identifiers""")
def wide_identifiers(t):
    return model(t).identifiers.select("isbn13", "title", "year", "contributors", "edition_format", "country", "doi", "doi_scielo",
                                       "main_publisher", "copublisher", "shared")


@query("wide_rejected", MODEL_SQL + " SELECT isbn13, title, row FROM stacked WHERE substr(isbn13, 1, 3) NOT IN ('978', '979')")
def wide_rejected(t):
    return model(t).rejected.select("isbn13", "title", "row")


@query("wide_authors", MODEL_SQL + " SELECT author_id, name FROM authors")
def wide_authors(t):
    return model(t).authors.select("author_id", "name")


@query("wide_author_roles", MODEL_SQL + " SELECT DISTINCT isbn13, author_id, role FROM people JOIN authors USING (name)")
def wide_author_roles(t):
    return model(t).identifier_authors


@query("wide_works", MODEL_SQL + " SELECT work_id, title, contributors FROM works")
def wide_works(t):
    return model(t).works.drop("uses")


@query("wide_work_links", MODEL_SQL + " SELECT DISTINCT isbn13, work_id FROM accepted JOIN works USING (title, contributors)")
def wide_work_links(t):
    return model(t).identifier_works


@query("wide_store_sales", MODEL_SQL + """, s AS (SELECT DISTINCT isbn13, unnest(['Amazon', main_publisher]) AS store FROM accepted WHERE source_rank = 2)
SELECT isbn13, CASE store WHEN 'Amazon' THEN 'AMAZON.COM' ELSE store END AS store, CAST(NULL AS VARCHAR) AS edition FROM s""")
def wide_store_sales(t):
    return model(t).store_sales


BROKEN = """
SELECT o_orderkey AS row, CASE o_orderstatus WHEN 'P' THEN concat('[[[~role~, ', CAST(o_custkey AS STRING)) WHEN 'F' THEN NULL
    ELSE '[[[~role~, ~autor~], [~full_name~, True]]]' END AS creators,
  CASE WHEN o_custkey % 3 = 0 THEN concat('set of ', CAST(o_custkey AS STRING)) WHEN o_custkey % 3 = 1 THEN '  '
    ELSE '[[~title~, None]]' END AS collection FROM orders
"""


@query("unreadable_cells", f"""WITH c AS ({BROKEN}),
cells AS (SELECT row, 'creators' AS field, replace(creators, '~', chr(39)) AS cell FROM c WHERE creators NOT LIKE '%]]]' UNION ALL
  SELECT row, 'collection', collection FROM c WHERE collection LIKE 'set%')
SELECT 'export' AS origin_file, row, field, cell, 'not a readable list of pairs' AS reason FROM cells""")
def unreadable_cells(t):
    rows = _quoted(derive(t, "orders", BROKEN), "creators", "collection")
    given = {"creators": "creators", "collection": "collection"}
    return wide.unreadable_cells(_export(rows, given, SERIAL_HEADINGS))
