"""Candidates by trigrams against all pairs, and the best match over them."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import candidates, matching
from lectern.plans.queries import QUERIES

WORDS = "casa luna mar sol libro historia breve arte poder tierra agua fuego noche tiempo ciudad puente camino verde".split()


def grams(text):
    padded = f"  {text} "
    return {padded[k:k + 3] for k in range(len(padded) - 2)} if text else set()


def brute(books, works, top_n):
    found = {}
    for key, title in books:
        left, scored = grams(title), set()
        for _, other in works:
            right = grams(other)
            if left & right:
                scored.add((-(2000 * len(left & right) // (len(left) + len(right))), other))
        for rank, (overlap, other) in enumerate(sorted(scored)[:top_n], 1):
            for work, name in works:
                if name == other:
                    found.setdefault(key, set()).add((work, rank, -overlap))
    return found


@pytest.fixture(scope="module")
def titles():
    rng = random.Random(2)
    works = [(f"W{k}", " ".join(rng.choices(WORDS, k=rng.randint(1, 6)))) for k in range(300)]
    works += [(f"C{k}", works[5][1]) for k in range(20)] + [("E", ""), ("X", "zzz")]
    books = []
    for k in range(80):
        title = list(works[rng.randrange(300)][1])
        for _ in range(rng.randint(0, 2)):
            title[rng.randrange(len(title))] = rng.choice("abcdefghij")
        books.append((k, " ".join("".join(title).split())))
    return books + [(900, ""), (901, "qqq"), (902, books[0][1])], works


def frames(spark, titles):
    books, works = titles
    return (spark.createDataFrame(books, "book int, title string").unionByName(spark.createDataFrame([(903, None)], "book int, title string")),
            spark.createDataFrame(works, "id string, title string"))


def listed(rows):
    found = {}
    for row in rows.collect():
        found.setdefault(row.book, set()).add((row.id, row.cand_rank, row.overlap))
    return found


def test_all_trigrams_are_exact(spark, titles):
    books, works = frames(spark, titles)
    assert listed(candidates.title_candidates(books, works, "book", top_n=5, probes=None)) == brute(*titles, 5)


def test_rarest_trigrams_find_nearly_all(spark, titles):
    books, works = frames(spark, titles)
    exact = candidates.title_candidates(books, works, "book", top_n=10, probes=None)
    few = candidates.title_candidates(books, works, "book", top_n=10)
    assert candidates.recall(few, exact, "book", "id", 1).first().recall >= 0.97
    assert candidates.recall(few, exact, "book", "id", 5).first().recall >= 0.9
    assert candidates.recall(exact, exact, "book", "id", 10).first().recall == 1.0
    true = brute(*titles, 10**6)
    assert all({(work, overlap) for work, _, overlap in rows} <= {(work, overlap) for work, _, overlap in true[book]}
               for book, rows in listed(few).items())
    with pytest.raises(ValueError):
        candidates.title_candidates(books, works, "book", top_n=0)


@pytest.mark.parametrize("probes", [None, 4])
def test_blocks_and_parts_change_nothing(spark, titles, probes):
    """Pairs of titles are counted inside blocks and are never rows; however the titles are dealt, the best are the same."""
    books, works = frames(spark, titles)
    asked, stored = candidates.distinct_titles(books, "title"), candidates.distinct_titles(works, "title")
    looked_up = candidates.probed(asked, stored, probes)
    norms = {side: {row.id: row.norm for row in table.collect()} for side, table in (("asked", asked), ("held", stored))}

    def best(**sizes):
        found = {}
        for row in candidates.nearest(looked_up, stored, 3, **sizes).collect():
            found.setdefault(norms["asked"][row.asked], []).append((-row.overlap, norms["held"][row.held]))
        return {name: sorted(rows)[:3] for name, rows in found.items()}

    assert best(block=7, part_rows=40) == best(block=7, part_rows=10**9) == best(block=10**6, part_rows=10**9)


def test_matching_over_generated_candidates(spark, titles):
    books, works = frames(spark, titles)
    found = candidates.title_candidates(books, works, "book", top_n=3)
    hits = found.join(works, "id").selectExpr(
        "book", "cand_rank", "id", "cast(null as string) as display_name", "title",
        "cast(array() as array<struct<author:struct<display_name:string>>>) as authorships", "cast(null as string) as doi",
        "1L as cited_by_count", "'book' as type")
    rows = {row.book: row for row in matching.match_books(books.selectExpr("book", "title", "cast(null as string) as authors"), hits, "book").collect()}
    assert rows[901].match_status == rows[900].match_status == "no_results"
    unchanged = [key for key, title in titles[0] if title and title in {name for _, name in titles[1]}]
    assert unchanged and all(rows[key].title_score == 1.0 for key in unchanged)


def test_one_cell_is_one_task(spark, titles):
    """Dealt by a hash, some tasks counted several cells and others none."""
    books, works = frames(spark, titles)
    asked, stored = candidates.distinct_titles(books, "title"), candidates.distinct_titles(works, "title")
    found = candidates.nearest(candidates.probed(asked, stored, None), stored, 3, block=20, part_rows=10**9)
    assert found.select(F.spark_partition_id()).distinct().count() == -(-asked.count() // 20)


def test_copies_are_dealt_in_squares(spark, monkeypatch):
    """Every copy with every copy, and no task makes them all."""
    monkeypatch.setattr(candidates, "SIDE", 8)
    books = spark.range(90).selectExpr("id as rows", "if(id < 70, 'casa de la luna', concat('libro ', id)) as title")
    works = spark.range(120).selectExpr("id as held", "if(id < 100, 'Casa de la Luna', concat('libro ', id)) as title")
    result = candidates.title_candidates(books, works, "rows", work_id="held", top_n=1, probes=None)
    made = [row["count"] for row in result.groupBy(F.spark_partition_id()).count().collect()]
    found = {(row.rows, row.held): (row.cand_rank, row.overlap) for row in result.collect()}
    assert {pair for pair in found if pair[0] < 70} == {(book, work) for book in range(70) for work in range(100)}
    assert all(found[book, work] == (1, 1000) for book, work in found if book < 70)
    assert len(made) > 2 and max(made) < 3500 and sum(made) == result.count() == len(found)


def test_query_finds_titles_that_share_only_frequent_trigrams(spark, tmp_path):
    """The 16 rarest trigrams of a title were looked up, and what shares others only was no candidate."""
    common, rare = "historia breve de la ciudad", "qwx zyk vjh pfg wbm kqd"
    held = [f"{common} {rare}", *[f"{common} {word}" for word in WORDS], *[f"{piece} {word}" for piece in rare.split() for word in WORDS[:3]]]
    pages = [(3 * k + 2, f"<title>{title}</title>") for k, title in enumerate(held)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {}
    for row in QUERIES["title_candidates"](spark, str(tmp_path)).collect():
        found.setdefault(row.book_id, set()).add((row.work_id, row.cand_rank, row.overlap))
    titles = [(page, title) for (page, _), title in zip(pages, held)]
    assert found == brute(titles, titles, 5)


def test_probes_are_asked_for(spark, titles):
    """Without them every trigram is looked up; 16 of them still find nearly all."""
    books, works = frames(spark, titles)
    whole = candidates.title_candidates(books, works, "book", top_n=5)
    assert listed(whole) == brute(*titles, 5)
    few = candidates.title_candidates(books, works, "book", top_n=10, probes=16)
    exact = candidates.title_candidates(books, works, "book", top_n=10)
    assert 0.9 <= candidates.recall(few, exact, "book", "id", 5).first().recall
