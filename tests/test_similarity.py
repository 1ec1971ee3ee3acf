import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lectern.functions import similarity
from lectern.operators import matching
from lectern.plans.registry import QUERIES
from lectern.plans import q_matching  # noqa: F401

WORDS = ["a", "ana", "luz", "de", "la", "casa", "cas", "mar", "marina", "río", "ro"]


def plain_ratio(a, b):
    left, right = set(a.split()), set(b.split())
    both = " ".join(sorted(left & right))
    sides = [(both + " " + " ".join(sorted(rest))).strip() for rest in (left - right, right - left)]
    return 100 * max(SequenceMatcher(None, both, side).ratio() for side in sides)


def plain_share(names, offered):
    wanted = [n for n in names.split(";") if n]
    pool = [n for n in offered.split(";") if n]
    if not wanted or not pool:
        return 0.0
    free, hits = list(range(len(pool))), 0
    for name in wanted:
        if free:
            best = max(free, key=lambda i: (plain_ratio(name, pool[i]), -i))
            if plain_ratio(name, pool[best]) >= 90:
                free.remove(best)
                hits += 1
    return hits / len(wanted)


def phrase(rng, most=4):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, most)))


def test_token_set_ratio_against_brute_force(spark):
    rng = random.Random(3)
    pairs = [(phrase(rng), phrase(rng)) for _ in range(3000)] + [("", ""), ("", "a"), ("a", "a a")]
    pairs += [(" ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(90)),
               " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(90))) for _ in range(30)]
    rows = spark.createDataFrame([(a, b, float(plain_ratio(a, b))) for a, b in pairs], "a string, b string, r double")
    wrong = rows.where(F.abs(similarity.token_set_ratio("a", "b") - F.col("r")) > 1e-9)
    assert wrong.count() == 0


def test_name_share_against_brute_force(spark):
    rng = random.Random(5)
    pairs = [(";".join(phrase(rng, 3) for _ in range(rng.randint(0, 4))),
              ";".join(phrase(rng, 3) for _ in range(rng.randint(0, 4)))) for _ in range(2000)]
    rows = spark.createDataFrame([(a, b, float(plain_share(a, b))) for a, b in pairs], "a string, b string, s double")
    assert rows.where(F.abs(similarity.matched_name_share("a", "b") - F.col("s")) > 1e-9).count() == 0


def test_bands(spark):
    rows = spark.createDataFrame(
        [("uno dos", "uno dos", 1.0), ("uno dos", "dos uno tres", 0.8), ("", "", 0.8), ("uno", "dos", 0.0)],
        "a string, b string, s double")
    assert rows.where(similarity.title_band("a", "b") != F.col("s")).count() == 0


HIT = "isbn13 string, cand_rank int, id string, doi string, display_name string, title string, cited_by_count long, " \
      "type string, authorships array<struct<author:struct<display_name:string>>>"


def people(*names):
    return [((name,),) for name in names]


def test_match_books(spark):
    books = spark.createDataFrame(
        [("1", "Cien años de soledad", "Gabriel García Márquez"), ("2", "El túnel", "Ernesto Sábato; Otra"),
         ("3", "Nada", None)], "isbn13 string, title string, authors string")
    hits = spark.createDataFrame([
        ("1", 1, "W0", None, "Cien años", None, 1, "book", people("X")),
        ("1", 2, "W1", "d1", "Cien años de soledad", None, 42, "book", people("Gabriel García Márquez")),
        ("1", 3, "W2", "d2", "Cien anos de soledad", None, 7, "book", people("Gabriel Garcia Marquez")),
        ("1", 4, "W3", "d3", "Cien años de soledad", None, 9, "article", people("Gabriel García Márquez")),
        ("2", 1, "W4", None, "", "Zzz qq", 5, "book", people(None, "Kk")),
        ("2", 200, "W5", None, "El túnel", None, 5, "book", people("Ernesto Sábato")),
    ], HIT)
    found = {row.isbn13: row for row in matching.match_books(books, hits, "isbn13").collect()}
    assert (found["1"].match_status, found["1"].openalex_id, found["1"].match_score) == ("matched", "W1", 1.0)
    assert (found["2"].match_status, found["2"].openalex_id) == ("matched", "W5")
    assert (found["3"].match_status, found["3"].match_score) == ("no_results", None)
    assert found["2"].matched_title == "El túnel"


def test_match_books_against_brute_force(spark):
    rng = random.Random(11)
    books = [(str(i), phrase(rng, 6), "; ".join(phrase(rng, 2) for _ in range(2))) for i in range(40)]
    hits = [(str(rng.randint(0, 39)), n, f"W{n}", None, phrase(rng, 6), None, n, "book", people(phrase(rng, 2), phrase(rng, 2)))
            for n in range(1, 101)]

    def norm(value):
        return value.replace("í", "i")

    def sim(a, b):
        return SequenceMatcher(None, norm(a), norm(b)).ratio()

    expected = {}
    for key, title, authors in books:
        names = [a.strip() for a in authors.split(";") if a.strip()]
        scored = []
        for hit in hits:
            if hit[0] != key:
                continue
            others = [a[0][0] for a in hit[8] if a[0][0]]
            author = sum(max(sim(n, o) for o in others) for n in names) / len(names) if names and others else 0.0
            scored.append((round(0.8 * sim(title, hit[4]) + 0.2 * author, 4), -hit[1], hit[2]))
        expected[key] = (max(scored)[2], max(scored)[0]) if scored else (None, None)
    rows = matching.match_books(spark.createDataFrame(books, "isbn13 string, title string, authors string"),
                                spark.createDataFrame(hits, HIT), "isbn13").collect()
    assert {row.isbn13: (row.openalex_id, row.match_score) for row in rows} == expected


def test_bounds_are_never_below_the_score(spark):
    rng = random.Random(8)
    letters = ["a", "b", "c", " ", "é", "😀", "𝒳", "0"]

    def text(most):
        return "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))

    rows = [(text(12), text(12), [text(5) for _ in range(rng.randint(0, 3))], [text(5) for _ in range(rng.randint(0, 3))])
            for _ in range(1500)] + [("", "", [], []), ("", "a", [""], [""]), ("ab" * 150, "ba" * 150, ["x"], ["x"])]
    frame = spark.createDataFrame(rows, "a string, b string, n array<string>, m array<string>").withColumn(
        "bound", similarity.score_bound(*[F.col(name) for name in "abnm"])).withColumn("length", similarity.length_bound(F.col("a"), F.col("b")))
    tight = 0
    for row in frame.collect():
        title = SequenceMatcher(None, row.a, row.b).ratio()
        names = sum(max(SequenceMatcher(None, x, y).ratio() for y in row.m) for x in row.n) / len(row.n) if row.n and row.m else 0.0
        assert 0.8 * title + 0.2 * names <= row.bound + 1e-12 and title <= row.length + 1e-12
        tight += row.bound < 0.8 * row.length + 0.2
    assert tight > 1000


def test_pairs_that_cannot_win_are_not_scored(spark):
    books = spark.createDataFrame([("1", "la casa del mar", "Ana"), ("2", "otra cosa", None)], "isbn13 string, title string, authors string")
    near = [("1", n, f"W{n}", None, title, None, 1, "book", people("Ana"))
            for n, title in enumerate(["la casa del mar", "la casa del mar", "zzzz", "casa mar", "uvwxyz 123", "la casa del mar "], 1)]
    tie = [("2", n, f"V{n}", None, title, None, 1, "book", people("Ana")) for n, title in enumerate(["otra cosax", "xotra cosa", "q"], 1)]
    pairs = matching.candidate_pairs(books, matching.book_hits(spark.createDataFrame(near + tie, HIT), "isbn13"), "isbn13")
    done = matching.score_promising(pairs, "isbn13")
    work = done.work.first()
    # the two equal titles are one pair, the one with a space another; both hits of the tie are scored
    assert (work.pairs, work.scored, work.skipped) == (8, 4, 4)
    found = {row.isbn13: row.openalex_id for row in matching.match_books(books, spark.createDataFrame(near + tie, HIT), "isbn13").collect()}
    assert found == {"1": "W1", "2": "V1"}


def test_first_page(spark):
    hits = spark.createDataFrame([("1", n) for n in range(1, 61)], "isbn13 string, cand_rank int")
    assert [matching.first_page(hits, per_page=n).count() for n in (1, 25, 100)] == [1, 25, 60]
    for bad in (0, 101):
        with pytest.raises(ValueError):
            matching.first_page(hits, per_page=bad)


def test_every_given_hit_is_scored(spark):
    books = spark.createDataFrame([("1", "El túnel", "Ernesto Sábato")], "isbn13 string, title string, authors string")
    hits = [("1", n, f"W{n}", None, "Zzz qq" if n < 30 else "El túnel", None, 5, "book", people("Ernesto Sábato")) for n in range(1, 31)]
    row = matching.match_books(books, spark.createDataFrame(hits, HIT), "isbn13").first()
    assert (row.match_status, row.openalex_id) == ("matched", "W30")


def test_fuzzy_statuses(spark):
    books = spark.createDataFrame([("1", "La casa: notas", "Ana Luz"), ("2", "Mar", "Otro"), ("3", "Río", "Ana"), ("4", "X", "Y")],
                                  "isbn13 string, title string, authors string")
    hits = spark.createDataFrame([
        ("1", 1, "https://w.org/W1", "https://doi.org/10.1/a", None, "la casa", 3, "book", people("Luz Ána")),
        ("1", 2, "https://w.org/W2", None, None, "La Casa", 9, "book", people("Nadie")),
        ("2", 1, "https://w.org/W3", None, None, "Mar", 3, "book", people("Distinto")),
        ("3", 1, "https://w.org/W4", None, None, None, 3, "book", people("Ana")),
        ("2", 2, "https://w.org/W5", None, None, "Mar", 3, "article", people("Otro")),
        ("4", 1, "https://w.org/W6", None, None, "X", 3, "article", people("Y")),
    ], HIT)
    found = {row.isbn13: row for row in matching.match_fuzzy(books, hits, "isbn13").collect()}
    assert (found["1"].consulted, found["1"].doi, found["1"].citations, found["1"].margin) == ("found", "10.1/a", 3, 1.0)
    assert found["2"].consulted == "except (score < 0.8)"
    assert found["3"].consulted == "except (title)"
    assert found["4"].consulted == "not found"


def test_pairs_are_named_by_sixteen_bytes(spark):
    """Equal texts share a name, others do not: nulls, empty texts and moved borders included."""
    rows = [("a", "b", "c", ["d"]), ("a", "b", "c", ["d"]), ("ab", "", "c", ["d"]), ("a", "b", "c", []), ("a", "b", None, ["d"])]
    frame = spark.createDataFrame(rows, "asked_title string, asked_names string, hit_title string, hit_names array<string>")
    found = [bytes(row.pair) for row in frame.select(matching.text_digest(matching.COMPARED).alias("pair")).collect()]
    assert {len(name) for name in found} == {16} and found[0] == found[1] and len(set(found)) == 4


def test_name_shares_are_scored_once_per_pair_of_cells(spark):
    """The rows get their share by a join; no row is scored itself."""
    found = QUERIES["name_shares"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "array_except" not in plan and "array_intersect" not in plan


def test_ratios_of_a_batch_are_those_of_difflib(monkeypatch):
    """One pair at a time was too slow for large tables."""
    rng = random.Random(4)
    alphabets = ["ab", "abc ", "é東京ab x", "abcdefghijklmnopqrstuvwxyz ", "".join(chr(0x4E00 + k) for k in range(400))]

    def text(alphabet):
        return "".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 5, 20, 60, 150, 198, 199, 200, 201, 260])))

    pairs = [(text(alphabet), text(alphabet)) for alphabet in alphabets for _ in range(120)]
    pairs += [(left, left) for left, _ in pairs[::9]] + [(left, left[::-1]) for left, _ in pairs[::9]]
    expected = [SequenceMatcher(None, *pair).ratio() for pair in pairs]
    assert similarity.sequence_ratios(pairs) == expected
    monkeypatch.setattr(similarity, "CELLS", 50)
    assert similarity.sequence_ratios(pairs) == expected
    assert similarity.sequence_ratios([]) == [] and similarity.sequence_ratios([("", "")]) == [1.0]
    monkeypatch.setattr(similarity, "HELD_NAMES", 100)
    names = list(dict.fromkeys(pairs))[:300]
    for first in range(0, 300, 40):
        some = set(names[first:first + 60])
        found = similarity.name_ratios(some)
        assert all(found[pair] == SequenceMatcher(None, *pair).ratio() for pair in some)


def test_match_scores_all_pairs_in_one_pass(spark, monkeypatch):
    """Bounds and the best so far took three more joins over all hits."""
    books = spark.createDataFrame([("1", "la casa", "Ana; Luz"), ("2", "mar", None), ("3", "sol", "")], "isbn13 string, title string, authors string")
    hits = spark.createDataFrame([(str(2 - k % 2), k, f"W{k}", None, title, None, 1, "book", people("Ana", "Eva"))
                                  for k, title in enumerate(["casa la", "mar", "zzz", "mar", "la cosa", None], 1)], HIT)
    written, settle = [], matching.settle
    monkeypatch.setattr(matching, "settle", lambda frame: written.append(frame.columns) or settle(frame))
    found = {row.isbn13: (row.openalex_id, row.title_score) for row in matching.match_books(books, hits, "isbn13").collect()}
    assert found == {"1": ("W5", 0.8571), "2": ("W2", 1.0), "3": (None, None)}
    assert len(written) == 2
