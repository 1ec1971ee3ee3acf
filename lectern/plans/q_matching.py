"""Queries: token-set scores, name matching, best-match joins.

Orders play the books: their title is the name of one part, their authors a brand and a
supplier. Their line items play the search hits: the part of the line gives the title,
its brand and its supplier the authors, the line number the rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.similarity import matched_name_share, title_band, token_set_ratio
from lectern.operators import candidates, matching
from lectern.operators.skew import attach
from lectern.plans.inputs import normalize_sql
from lectern.plans.registry import query
from lectern.session import settle

BOOKS_SQL = """books AS (SELECT o_orderkey, concat(p_name, CASE o_orderstatus WHEN 'F' THEN ': notes' WHEN 'O' THEN '. Vol 2' ELSE '' END) AS title,
  p_name AS main_title, p_brand AS brand, concat('Supplier#00000000', substr(CAST(o_orderkey AS VARCHAR), -1)) AS person
  FROM orders JOIN part ON p_partkey = o_custkey)"""
HITS_SQL = """hits AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS cand_rank,
  concat('https://works.example.org/W', l_partkey, '-', l_suppkey, '-', l_linenumber) AS id,
  CASE WHEN l_linestatus = 'F' THEN concat('https://doi.org/10.5/', l_partkey) END AS doi,
  CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN NULL WHEN l_returnflag = 'A' THEN concat(' ', upper(p_name))
    WHEN l_returnflag = 'N' THEN concat(p_name, ' ', p_type) ELSE p_name END AS title,
  CAST(l_quantity AS BIGINT) AS cited_by_count, p_brand AS cand_brand, s_name AS cand_person,
  CASE WHEN l_linenumber % 4 = 3 THEN 'article' ELSE 'book' END AS type
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)"""


def books(t) -> DataFrame:
    ending = F.when(F.col("o_orderstatus") == "F", ": notes").when(F.col("o_orderstatus") == "O", ". Vol 2").otherwise("")
    person = F.concat(F.lit("Supplier#00000000"), F.substring(F.col("o_orderkey").cast("string"), -1, 1))
    names = t("part").select("p_partkey", "p_name", "p_brand")
    return t("orders").join(names, F.col("p_partkey") == F.col("o_custkey")).select(
        "o_orderkey", F.concat("p_name", ending).alias("title"), F.concat_ws("; ", "p_brand", person).alias("authors"))


def hits(t) -> DataFrame:
    part = t("part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = t("supplier").select("s_suppkey", "s_name")
    lines = t("lineitem").join(part, F.col("p_partkey") == F.col("l_partkey")).join(
        supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    flag = F.col("l_returnflag")
    title = (F.when((flag == "R") & (F.col("l_discount") == 0), F.lit(None))
             .when(flag == "A", F.concat(F.lit(" "), F.upper("p_name")))
             .when(flag == "N", F.concat_ws(" ", "p_name", "p_type")).otherwise(F.col("p_name")))
    authors = F.array(*[F.struct(F.struct(F.col(name).alias("display_name")).alias("author"))
                        for name in ("p_brand", "s_name")])
    dash = F.lit("-")
    return lines.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("cand_rank"),
        F.concat(F.lit("https://works.example.org/W"), "l_partkey", dash, "l_suppkey", dash, "l_linenumber").alias("id"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("https://doi.org/10.5/"), "l_partkey")).alias("doi"),
        F.lit(None).cast("string").alias("display_name"), title.alias("title"), authors.alias("authorships"),
        F.col("l_quantity").cast("long").alias("cited_by_count"), F.when(F.col("l_linenumber") % 4 == 3, "article").otherwise("book").alias("type"))


def words_sql(text: str) -> str:
    return rf"list_distinct(list_filter(string_split_regex({text}, '\s+'), lambda w: w <> ''))"


def ratio_sql(a: str, b: str) -> str:
    """Token-set ratio of two DuckDB lists of words."""
    shared = f"length(array_to_string(list_filter({a}, lambda w: list_contains({b}, w)), ' '))"
    only_a = f"length(array_to_string(list_filter({a}, lambda w: NOT list_contains({b}, w)), ' '))"
    only_b = f"length(array_to_string(list_filter({b}, lambda w: NOT list_contains({a}, w)), ' '))"
    return (f"(SELECT CASE WHEN i + f = 0 THEN 100.0 ELSE CAST(200.0 AS DOUBLE) * i / (i + f) END FROM (SELECT i, i + o + CASE WHEN i > 0 AND o > 0 "
            f"THEN 1 ELSE 0 END AS f FROM (SELECT {shared} AS i, least({only_a}, {only_b}) AS o)))")


def band_sql(left: str, right: str, ratio: str) -> str:
    return f"CASE WHEN {left} <> '' AND {left} = {right} THEN 1.0 WHEN {ratio} >= 90 THEN 0.8 WHEN {ratio} >= 80 THEN 0.6 ELSE 0.0 END"


@query("token_set_scores", f"""WITH d AS (SELECT doc_id, lower(text) AS text, lower(lang) AS lang, words, {words_sql("concat(source, ' ', lang, ' the of')")} AS probe FROM
  (SELECT *, {words_sql('lower(text)')} AS words FROM documents))
SELECT doc_id, round({ratio_sql('words', 'probe')}, 9) AS ratio FROM d""")
def token_set_scores(t):
    probe = F.concat_ws(" ", "source", "lang", F.lit("the of"))
    return t("documents").select("doc_id", F.round(token_set_ratio(F.lower("text"), probe), 9).alias("ratio"))


PAIRS_SQL = """pairs AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
texts AS (SELECT l_partkey, l_suppkey, concat(a.p_name, ' ', a.p_type) AS left_title, concat(b.p_name, ' ', b.p_type, ' old') AS right_title,
  concat(a.p_brand, ' ', a.p_type) AS w1, a.p_brand AS w2, concat(b.p_type, ' ', b.p_brand) AS o1, b.p_type AS o2
  FROM pairs JOIN part a ON a.p_partkey = l_partkey JOIN part b ON b.p_partkey = l_suppkey)"""


def _pairs(t) -> DataFrame:
    part = t("part").select("p_partkey", "p_name", "p_brand", "p_type")
    left = part.select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_name", "p_type").alias("left_title"),
                       F.concat_ws(";", F.concat_ws(" ", "p_brand", "p_type"), "p_brand").alias("wanted"))
    right = part.select(F.col("p_partkey").alias("l_suppkey"), F.concat_ws(" ", "p_name", "p_type", F.lit("old")).alias("right_title"),
                        F.concat_ws(";", F.concat_ws(" ", "p_type", "p_brand"), "p_type").alias("offered"))
    return t("lineitem").select("l_partkey", "l_suppkey").distinct().join(left, "l_partkey").join(right, "l_suppkey")


@query("title_bands", f"""WITH {PAIRS_SQL}, w AS (SELECT *, {words_sql('left_title')} AS lw, {words_sql('right_title')} AS rw FROM texts),
r AS (SELECT *, {ratio_sql('lw', 'rw')} AS ratio FROM w)
SELECT l_partkey, l_suppkey, round(ratio, 9) AS ratio, CAST({band_sql('left_title', 'right_title', 'ratio')} AS DOUBLE) AS band FROM r""")
def title_bands(t):
    return _pairs(t).select(
        "l_partkey", "l_suppkey", F.round(token_set_ratio("left_title", "right_title"), 9).alias("ratio"),
        title_band("left_title", "right_title").alias("band"))


@query("name_shares", f"""WITH {PAIRS_SQL}, w AS (SELECT l_partkey, l_suppkey, {words_sql('w1')} AS a1, {words_sql('w2')} AS a2, {words_sql('o1')} AS b1, {words_sql('o2')} AS b2 FROM texts),
r AS (SELECT *, {ratio_sql('a1', 'b1')} AS r11, {ratio_sql('a1', 'b2')} AS r12, {ratio_sql('a2', 'b1')} AS r21, {ratio_sql('a2', 'b2')} AS r22 FROM w),
g AS (SELECT *, greatest(r11, r12) >= 90 AS hit1, r11 >= r12 AS took_first FROM r)
SELECT l_partkey, l_suppkey, (CASE WHEN hit1 THEN 1 ELSE 0 END + CASE WHEN (CASE WHEN NOT hit1 THEN greatest(r21, r22)
  WHEN took_first THEN r22 ELSE r21 END) >= 90 THEN 1 ELSE 0 END) / CAST(2.0 AS DOUBLE) AS share FROM g""")
def name_shares(t):
    pairs = settle(_pairs(t).select("l_partkey", "l_suppkey", "wanted", "offered"))
    # copies of one pair of cells do not multiply the scoring
    cells = pairs.groupBy("wanted", "offered").agg(F.count("*").alias("rows"))
    shares = settle(cells.withColumn("share", matched_name_share("wanted", "offered")))
    return attach(pairs, shares, ["wanted", "offered"], "rows", F.struct("l_partkey", "l_suppkey"), how="inner").select(
        "l_partkey", "l_suppkey", "share")


SCORED_SQL = f"""WITH {BOOKS_SQL}, {HITS_SQL},
p AS (SELECT b.o_orderkey, lower(main_title) AS q, lower(trim(h.title)) AS cand_title, brand = cand_brand AS b_hit, person = cand_person AS p_hit,
  h.id AS cand_id, nullif(regexp_extract(doi, '.org/(.*)', 1), '') AS cand_doi, cited_by_count, cand_brand, cand_person
  FROM hits h JOIN books b USING (o_orderkey) WHERE h.title IS NOT NULL AND h.type = 'book'),
u AS (SELECT q, cand_title, {ratio_sql('qw', 'cw')} AS ratio FROM (SELECT DISTINCT q, cand_title, {words_sql('q')} AS qw, {words_sql('cand_title')} AS cw FROM p)),
s AS (SELECT o_orderkey, cand_title, lower(concat(cand_brand, ';', cand_person)) AS cand_names, CAST({band_sql('p.q', 'p.cand_title', 'ratio')} AS DOUBLE) AS title_score,
  (CASE WHEN b_hit THEN 1 ELSE 0 END + CASE WHEN p_hit THEN 1 ELSE 0 END) / CAST(2.0 AS DOUBLE) AS author_score, cand_id, cand_doi, cited_by_count
  FROM p JOIN u USING (q, cand_title)),
scored AS (SELECT o_orderkey, cand_title, cand_names, title_score, author_score,
  round(CASE WHEN author_score = 0 THEN 0.0 ELSE CAST(0.8 AS DOUBLE) * title_score + CAST(0.2 AS DOUBLE) * author_score END, 4) AS final_score, cand_id, cand_doi, cited_by_count FROM s),
placed AS (SELECT *, row_number() OVER w AS place, lead(final_score) OVER w AS runner_up FROM scored
  WINDOW w AS (PARTITION BY o_orderkey ORDER BY final_score DESC, title_score DESC, author_score DESC, cand_id DESC, cand_doi DESC NULLS LAST, cited_by_count DESC)),
best AS (SELECT *, round(final_score - coalesce(runner_up, 0), 4) AS margin FROM placed WHERE place = 1)"""


@query("fuzzy_scores", SCORED_SQL + """ SELECT o_orderkey, cand_title, cand_names, title_score, author_score, final_score, cand_id, cand_doi, cited_by_count FROM scored""")
def fuzzy_scores(t):
    return matching.score_fuzzy(books(t), hits(t), "o_orderkey")


@query("fuzzy_best", SCORED_SQL + """ SELECT o_orderkey, final_score, title_score, author_score, cand_id, cand_doi, cited_by_count, margin FROM best""")
def fuzzy_best(t):
    return matching.best_fuzzy(matching.score_fuzzy(books(t), hits(t), "o_orderkey"), "o_orderkey")


@query("fuzzy_match", SCORED_SQL + """, any_hit AS (SELECT o_orderkey, count(*) AS n FROM hits WHERE type = 'book' GROUP BY 1)
SELECT o_orderkey, CASE WHEN n IS NULL THEN 'not found' WHEN final_score IS NULL THEN 'except (title)' WHEN final_score >= 0.8 THEN 'found'
  ELSE 'except (score < 0.8)' END AS consulted, cand_id, final_score, title_score, author_score, margin,
  CASE WHEN final_score >= 0.8 THEN cand_doi END AS doi, CASE WHEN final_score >= 0.8 THEN cited_by_count END AS citations
FROM books LEFT JOIN any_hit USING (o_orderkey) LEFT JOIN best USING (o_orderkey)""")
def fuzzy_match(t):
    return matching.match_fuzzy(books(t), hits(t), "o_orderkey")


@query("first_page", f"""WITH {HITS_SQL}, p AS (SELECT o_orderkey, id, cand_rank FROM hits WHERE cand_rank <= 3) SELECT * FROM p""")
def first_page(t):
    return matching.first_page(hits(t), per_page=3).select("o_orderkey", "id", "cand_rank")


@query("sequence_match")
def sequence_match(t):
    return matching.match_books(books(t), hits(t), "o_orderkey")


# hits whose ratio has a closed form: the asked text itself (1), the asked text and more (2a / (a + b)),
# nothing in common (0), no title at all (0); names likewise
CLOSED_HITS = """
SELECT l_partkey AS p_partkey, l_orderkey * 10 + l_linenumber AS cand_rank, concat('W', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
  CASE l_linenumber % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN concat(p_name, ' ', p_type) WHEN 2 THEN '777' END AS display_name,
  CASE l_orderkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN concat(p_brand, ' Co') END AS person,
  CASE WHEN l_returnflag = 'A' THEN 'article' ELSE 'book' END AS type, CAST(l_quantity AS BIGINT) AS cited_by_count
FROM lineitem JOIN part ON p_partkey = l_partkey
"""


@query("sequence_match_closed", f"""WITH hits AS ({CLOSED_HITS}),
n AS (SELECT p_partkey, p_name, p_brand, {normalize_sql('p_name')} AS asked, {normalize_sql('p_brand')} AS who, {normalize_sql('p_type')} AS kind FROM part),
r AS (SELECT h.*, CASE l % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 * length(asked) / (2 * length(asked) + 1 + length(kind)) ELSE 0.0 END AS t,
    CASE WHEN person IS NULL THEN 0.0 WHEN person = p_brand THEN 1.0 ELSE 2.0 * length(who) / (2 * length(who) + 3) END AS a
  FROM (SELECT *, CAST(cand_rank % 10 AS INT) AS l FROM hits WHERE type = 'book') h JOIN n USING (p_partkey)),
s AS (SELECT *, round(CAST(t AS DOUBLE), 4) AS title_score, round(CAST(a AS DOUBLE), 4) AS author_score,
  round(CAST(0.8 AS DOUBLE) * CAST(t AS DOUBLE) + CAST(0.2 AS DOUBLE) * CAST(a AS DOUBLE), 4) AS match_score FROM r),
best AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY match_score DESC, cand_rank) AS place FROM s)
SELECT n.p_partkey, n.p_name AS query_title, CASE WHEN b.id IS NULL THEN '{fixed.NO_RESULTS}'
    WHEN match_score >= {fixed.MINIMUM_MATCH} THEN '{fixed.MATCHED}' ELSE '{fixed.LOW_CONFIDENCE}' END AS match_status,
  b.id AS openalex_id, b.display_name AS matched_title, title_score, author_score, match_score, b.cited_by_count
FROM n LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (p_partkey)""")
def sequence_match_closed(t):
    part, lines = t("part"), t("lineitem")
    given = part.sparkSession.sql(
        CLOSED_HITS.replace("FROM lineitem JOIN part", "FROM {lines} JOIN {part}"), lines=lines, part=part)
    person = F.array(F.struct(F.struct(F.col("person").alias("display_name")).alias("author")))
    found = given.select("*", F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("doi"), person.alias("authorships"))
    asked = part.select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("authors"))
    return matching.match_books(asked, found, "p_partkey").select(
        "p_partkey", "query_title", "match_status", "openalex_id", "matched_title", "title_score", "author_score", "match_score", "cited_by_count")


# page titles play the works; with letters of their middle replaced or lost they play the books
PAGE_TITLE = "regexp_extract(html, '<title>([^<]*)', 1)"
ASKED_TITLE = ("CASE page_id % 3 WHEN 0 THEN concat(substr(title, 1, 9), 'x', substr(title, 12)) "
               "WHEN 1 THEN concat(substr(title, 5), ' ', substr(title, 1, 6)) ELSE lower(title) END")


def candidates_sql(probes: int | None, top_n: int) -> str:
    def of(name, norm):
        return f"""{name} AS (SELECT norm, list_distinct(list_transform(range(1, length(norm) + 2), lambda i: substr(concat('  ', norm, ' '), i, 3))) AS grams
  FROM (SELECT DISTINCT {norm} AS norm FROM rows) WHERE norm <> '')"""

    chosen = "SELECT norm, gram FROM (SELECT norm, unnest(grams) AS gram FROM asked)" if probes is None else f"""SELECT norm, gram FROM (
    SELECT norm, gram, row_number() OVER (PARTITION BY norm ORDER BY df, gram) AS place
    FROM (SELECT norm, unnest(grams) AS gram FROM asked) JOIN (SELECT gram, count(*) AS df FROM held GROUP BY gram) USING (gram)) WHERE place <= {probes}"""
    return f"""WITH titled AS (SELECT page_id, {PAGE_TITLE} AS title FROM pages),
rows AS (SELECT page_id, {normalize_sql(ASKED_TITLE)} AS book_norm, {normalize_sql('title')} AS work_norm FROM titled),
{of('asked', 'book_norm')}, {of('stored', 'work_norm')},
held AS (SELECT norm, unnest(grams) AS gram FROM stored),
pairs AS (SELECT DISTINCT p.norm AS a, h.norm AS b FROM ({chosen}) p JOIN held h USING (gram)),
scored AS (SELECT a, b, 2000 * len(list_intersect(l.grams, r.grams)) // (len(l.grams) + len(r.grams)) AS overlap
  FROM pairs JOIN asked l ON a = l.norm JOIN stored r ON b = r.norm),
best AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY overlap DESC, b) AS place FROM scored)
SELECT x.page_id AS book_id, y.page_id AS work_id, CAST(place AS INT) AS cand_rank, CAST(overlap AS INT) AS overlap
FROM best JOIN rows x ON x.book_norm = a JOIN rows y ON y.work_norm = b WHERE place <= {top_n}"""


def _found_titles(t, probes: int | None) -> DataFrame:
    # written once: each mention of the title would search the page again
    rows = settle(t("pages").selectExpr("page_id", f"{PAGE_TITLE} AS title"))
    asked = rows.selectExpr("page_id AS book_id", f"{ASKED_TITLE} AS title")
    works = rows.selectExpr("page_id AS work_id", "title")
    return candidates.title_candidates(asked, works, "book_id", work_id="work_id", top_n=5, probes=probes)


@query("title_candidates", candidates_sql(None, 5))
def title_candidates(t):
    return _found_titles(t, None)


@query("title_candidates_all", candidates_sql(None, 5))
def title_candidates_all(t):
    return _found_titles(t, None)
