import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lectern.llm import jaccard
from lectern.llm.graph import components
from tests.llm.helpers import docs_of, prose


def brute(rows):
    """(set size, smallest id of the component) per row, from all pairs."""
    sets = []
    for _, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for at, (doc, _) in enumerate(rows):
        ids[root(at)].append(doc)
    smallest = {r: min((i for i in held if i is not None), default=None) for r, held in ids.items()}
    return [(doc, len(sets[at]), smallest[root(at)]) for at, (doc, _) in enumerate(rows)]


def near(text, seed, changes):
    draw = random.Random(seed)
    words = text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    made = [(i, prose(i, 20 + 13 * i)) for i in range(12)]
    base, other = prose(100, 160), prose(101, 40)
    made += [(100 + i, near(base, i, i % 9)) for i in range(40)]
    made += [(200 + i, near(other, i, i % 4)) for i in range(15)]
    # a shared passage that is not enough for a link, and copies in other letters and white space
    made += [(300 + i, prose(500, 60) + " " + prose(600 + i, 60)) for i in range(10)]
    made += [(400, base.upper()), (401, base.replace(" ", "\t\n")), (402, "a b c"), (403, "A B  c"), (404, "c b a"),
             (405, ""), (406, None), (407, " \n"), (408, "a b c d e"), (409, "a b c d e f"), (None, base), (None, "zz"),
             (410, "one"), (5, made[5][1]), (411, "q " * 500), (412, "q " * 9)]
    return made


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, rows, small, monkeypatch):
    if small:  # many blocks per tile, and texts joined instead of sent
        monkeypatch.setattr(jaccard, "TILE_ROWS", 3)
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    docs = docs_of(spark, rows).selectExpr("*", "1 as class", "2 as n")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)


def test_without_first_links(spark, rows, monkeypatch):
    """The candidate search alone is complete."""
    plain = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda links, calls=[]: plain(
        links.limit(0) if not calls and not calls.append(1) else links))
    monkeypatch.setattr(jaccard, "TILE_ROWS", 5)
    found = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.join(docs_of(spark, rows[:70])).collect()}
    plain_links = {(doc, n): c for doc, n, c in brute(rows[:70])}
    assert set(found) == set(plain_links)


def test_keep_one(spark, rows):
    docs = docs_of(spark, rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None)
    expected = {doc for doc, n, component in brute(rows) if doc is not None and (n == 0 or doc == component)}
    assert [doc for doc, _ in found] == sorted(expected)


def test_empty_table(spark):
    assert jaccard.join(docs_of(spark, [(1, "x")]).limit(0)).count() == 0


def test_bitmap_bound_is_no_lower_than_the_overlap():
    draw = np.random.default_rng(0)
    for _ in range(300):
        pool = draw.integers(0, 2 ** 63, 400, dtype=np.uint64)
        a = np.unique(draw.choice(pool, draw.integers(1, 300)))
        b = np.unique(draw.choice(pool, draw.integers(1, 300)))
        bound = jaccard.overlap_bound(jaccard.bitmap(a), jaccard.bitmap(b), len(a), len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)]
    edges += [(5000, k) for k in range(5001, 5100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert found == {x: root(x) for x in linked}


def test_texts_that_are_nearly_near_enough_make_no_rows_per_pair(spark, monkeypatch):
    """Variants of one text, most pairs just under the threshold: members leave their tile, not pairs."""
    base = prose(900, 150)
    rows = [(i, near(base, i, 4 + i % 3)) for i in range(150)] + [(500 + i, prose(i, 60)) for i in range(20)]
    made, given = {}, jaccard.tile_pairs

    def counted(tiles):
        found = given(tiles).cache()
        made.update(members=found.where("b is null").count(), pairs=found.where("b is not null").count())
        return found

    monkeypatch.setattr(jaccard, "tile_pairs", counted)
    found = {row.doc_id: (row.n_shingles, row.component_id) for row in jaccard.join(docs_of(spark, rows)).collect()}
    assert found == {doc: (n, component) for doc, n, component in brute(rows)}
    assert made["members"] > 0 and made["pairs"] <= len(rows)


def test_parts_of_a_crowded_tile_hold_every_pair(monkeypatch):
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 25)
    n = np.array([7, 9, 3, 30, 4, 8, 12, 1, 5])
    for high, of_block in ((0, np.zeros(9, dtype=np.int64)), (1, np.array([0, 1, 0, 0, 1, 1, 0, 1, 0]))):
        met = set()
        for first, second, members, side in jaccard._parts(np.zeros(9), np.full(9, high), of_block, n):
            met |= {(a, b) for x, a in enumerate(members.tolist()) for y, b in enumerate(members.tolist())
                    if a < b and (first == second or side[x] != side[y])}
        assert met == {(a, b) for b in range(9) for a in range(b) if not high or of_block[a] != of_block[b]}


def test_sets_of_a_tile_give_the_overlap_itself():
    sets = jaccard.shingle_sets([near(prose(7, 90), i, i % 5).encode() for i in range(30)])
    n = np.array([len(s) for s in sets])
    a, b = (side.ravel() for side in np.meshgrid(range(30), range(30)))
    common = np.array([len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)])
    found = jaccard._Sets(sets).room(a, b, n)
    link = jaccard.linked(common, n[a], n[b])
    assert (jaccard.linked(found, n[a], n[b]) == link).all() and (found[link] == common[link]).all()
    assert 0 < link.sum() < len(link)


def test_joined_groups_take_the_smallest_name():
    root = np.array([5, 3, 9, 5, 7, 8])
    assert jaccard._joined(root, np.array([5, 9]), np.array([7, 3])).tolist() == [5, 3, 3, 5, 5, 8]
