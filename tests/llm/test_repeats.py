import random
from collections import Counter

import pytest

from lectern.llm import repeats
from lectern.llm.common import key_filter, sha, with_filter
from tests.llm.helpers import docs_of, prose


def brute(texts, least=200):
    data = [(text or "").encode() for text in texts]
    seen = Counter(d[k:k + least] for d in data for k in range(len(d) - least + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for k in range(len(d) - least + 1):
            if seen[d[k:k + least]] > 1:
                covered[k:k + least] = b"\1" * least
        spans = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        out.append((len(d), sum(covered), spans, sha(bytes(b for b, c in zip(d, covered) if not c))))
    return out


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(11)
    passages = [prose(k, 60) for k in range(4)]
    made = [prose(100 + k, 120) for k in range(6)]
    # passages at many places, cut at both sides, edited here and there
    for k in range(60):
        p = passages[k % 4]
        a, b = draw.randrange(0, 60), draw.randrange(len(p) - 80, len(p) + 1)
        part = list(p[a:b])
        if k % 3 == 0:
            part[draw.randrange(len(part))] = "#"
        made.append(prose(300 + k, draw.randrange(30)) + "".join(part) + prose(500 + k, draw.randrange(30)))
    made += [made[0], made[0], made[1] + "tail", passages[0], "ab" * 400, "a" * 700, "a" * 199, "a" * 200, "short", "short",
             "", None, "é" * 300, "xé" * 99 + "é" * 150, passages[1] * 3, made[2][:210], made[2][50:260]]
    return made


@pytest.mark.parametrize("group, broadcast, window", [(20_000, 200_000, 500_000), (2, 0, 10)])
def test_against_all_strings(spark, texts, group, broadcast, window, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "WINDOW", window)
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", broadcast)
    ids = [None if k == 3 else 7 if k in (4, 5) else k for k in range(len(texts))]
    docs = docs_of(spark, list(zip(ids, texts))).selectExpr("*", "1 as place", "2 as context")
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.dedup(docs).collect())
    assert found == Counter((doc, *row) for doc, row in zip(ids, brute(texts)))


def test_sections(monkeypatch):
    text = (prose(1, 400) + "é" * 40 + "a" * 500).encode()
    whole = repeats.anchors(text)
    monkeypatch.setattr(repeats, "SECTION", 333)
    parts = repeats.anchors(text)
    assert set(zip(*(p.tolist() for p in whole))) == set(zip(*(p.tolist() for p in parts)))


def test_sections_give_each_place_once(monkeypatch):
    text = (prose(1, 400) + "é" * 40 + "a" * 500).encode()
    whole = repeats.anchors(text)
    monkeypatch.setattr(repeats, "SECTION", 333)
    assert [p.tolist() for p in repeats.anchors(text)] == [p.tolist() for p in whole]


def test_text_of_two_sections(spark):
    """Only what another text holds goes at the border of two sections."""
    draw = random.Random(5)
    size, border = repeats.SECTION + 2000, repeats.SECTION
    text = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=size))
    part = text[border - 150:border + 150]
    docs = docs_of(spark, [(1, text), (2, "#" + part + "#"), (3, text[::-1])])
    found = {r.doc_id: (r.n_removed, r.n_spans, r.removed, r.kept_sha256) for r in repeats.dedup(docs).collect()}
    assert found == {
        1: (300, 1, f"{border - 150}:{border + 150}", sha((text[:border - 150] + text[border + 150:]).encode())),
        2: (300, 1, "1:301", sha(b"##")), 3: (0, 0, "", sha(text[::-1].encode()))}


def test_maximal_repeats_are_maximal():
    """Against all pairs: every group is a set of contexts that share exactly its string."""
    draw = random.Random(3)
    for _ in range(60):
        lefts = [bytes(draw.choice(b"ab") for _ in range(6)) for _ in range(7)]
        rights = [b"#" * repeats.GRAM + bytes(draw.choice(b"ab") for _ in range(5)) for _ in range(7)]
        best = [(0, 0)] * 7
        for a in range(7):
            for b in range(7):
                left, right = repeats.common(lefts[a], lefts[b]), repeats.common(rights[a], rights[b])
                if a != b and left + right >= repeats.GRAM + 5:
                    best[a] = (max(best[a][0], left), max(best[a][1], right))
        assert repeats.covers(lefts, rights, repeats.GRAM + 5) == best


def test_empty_table(spark):
    assert repeats.dedup(docs_of(spark, [(1, "x")]).limit(0)).count() == 0


def test_key_filter_lets_every_key_through(spark):
    keys = spark.range(0, 6000, 3).selectExpr("cast(id as string) as k").union(spark.sql("select cast(null as string)"))
    rows = spark.range(0, 6000).selectExpr("cast(id as string) as k").union(spark.sql("select cast(null as string)"))
    marked = with_filter(rows, key_filter(keys, "k"), "k", "may").collect()
    assert len(marked) == 6001
    assert all(row.may for row in marked if row.k is None or int(row.k) % 3 == 0)
    assert sum(row.may for row in marked) <= 2001 + 20
    assert not with_filter(rows, key_filter(keys.limit(0), "k"), "k", "may").where("may").count()
