"""Top-k search, mixing, language identification, personal data, fingerprints, the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from statistics import mean

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import langid, mixing, pii, syncmers, topk
from tests.llm.helpers import docs_of, prose

# top-k ---------------------------------------------------------------------------------


def brute_top(rows, k, is_query):
    valid = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, a in valid:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q)
            found += [(q, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("per_group, part_rows", [(1024, 16_384), (3, 20)])
def test_top_k(spark, monkeypatch, per_group, part_rows):
    monkeypatch.setattr(topk, "QUERIES_PER_GROUP", per_group)
    monkeypatch.setattr(topk, "PART_ROWS", part_rows)
    draw = np.random.default_rng(1)
    rows = [(k, draw.normal(k % 5, 0.4, 6).tolist()) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(60)]  # one vector many times
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, [1.0, 2.0]),
             (405, []), (None, [1.0] * 6), (406, [-3.5] * 6), (407, [1e6] * 6)]
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as cell", "2 as rank")
    found = topk.top_k(data, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, 10, lambda q: q % 10 == 0)


def test_top_k_of_an_id_with_many_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(0, 1, 8).tolist()) for k in range(1, 2001)]
    rows += [(100, (np.ones(8) * 3 + draw.normal(0, 1e-3, 8)).tolist()) for _ in range(40)]
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(map(tuple, topk.top_k(data, F.col("vec_id") == 100).collect()))
    valid = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i != 100]
    asked = {tuple(math.floor(1024 * x) for x in v) for i, v in rows if i == 100}
    best = sorted((-sum(x * y for x, y in zip(a, b)), i) for a in asked for i, b in valid)[:10]
    assert [(row[2], row[3]) for row in found] == [(i, -score) for score, i in best]


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = [(k, prose(k, 30), f"l{k % 8 if k < 300 else k % 3}", "s", 0) for k in range(600)]
    sample = langid.training_sample(docs_of(spark, rows), "doc_id", "text", "lang")
    assert {row.lang for row in sample.collect()} == {"l0", "l1", "l2"}


def test_top_k_with_few_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (2, [2.0])]
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(data, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 2048 * 1024), (0, 2, 2, 2048 * 1024)]
    assert topk.top_k(data.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(data.where("vec_id = 0"), F.lit(True)).count() == 0


def test_huge_scores_do_not_crash():
    big = np.full((1, 2), 2 ** 62, dtype=np.int64)
    assert topk._products(big, big)[0, 0] == 2 ** 63 - 1

# mixing --------------------------------------------------------------------------------


def targets_of(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        if not rest:
            return {s: most * sizes[s] for s in order}
        level = (total - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def mix_rows():
    draw = random.Random(2)
    names = ["b", "a", "é", "z", None, "Z", "tiny", "hot"]
    rows = [(k, prose(k, draw.randrange(1, 120)), "en", "hot" if k % 3 == 0 else names[k % 8], 0) for k in range(600)]
    return rows + [(1000, "", "en", "a", 0), (1001, None, "en", "a", 0), (1002, "w", "en", "lone", 0), (1003, "", "en", "void", 0),
                   (5, rows[5][1], "en", rows[5][3], 0), (None, "two words", "en", "a", 0)]


def test_mix(spark):
    rows = mix_rows()
    docs = docs_of(spark, rows).selectExpr("*", "1 as size", "2 as weight")
    found = mixing.mix(docs).collect()
    assert sorted(found, key=repr) == sorted(mixing.mix(docs.repartition(5)).collect(), key=repr)  # reruns agree
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    wanted = targets_of(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(found) == len(rows)
    for row in found:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(wanted[row.source])
        assert row.taken <= 3 * row.size and (row.size == 0) == (row.copies == 0 and row.size == 0)
        taken[row.source] += row.taken
        largest[row.source] = max(largest[row.source], row.size)
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= largest[source] / 2 + 1e-6


def brute_taken(rows, wanted):
    """Words taken by one ranking a source, row by row, from the copies that each weight expects."""
    taken = defaultdict(int)
    for source in {row[3] for row in rows}:
        sizes = [(row[0], len((row[1] or "").split())) for row in rows if row[3] == source]
        sizes = [(i, n) for i, n in sizes if n]
        low, high = 0.0, 3.0
        for _ in range(200):  # the factor, by halving
            factor = (low + high) / 2
            words = sum(n * min(3.0, factor * n.bit_length()) for _, n in sizes)
            low, high = (factor, high) if words < wanted[source] else (low, factor)
        drawn, certain = [], 0
        for i, n in sizes:
            expected = min(3.0, high * n.bit_length())
            certain += int(expected + 1e-9) * n
            p = expected - int(expected + 1e-9)
            if p > 1e-6:
                digits = hashlib.md5(("mix" + ("" if i is None else str(i))).encode()).hexdigest()[:13]
                u = (int(digits, 16) + 0.5) / (1 << 52)
                drawn.append(((u / (1 - u)) / (p / (1 - p)), i is not None, i or 0, n))
        at = certain
        for *_, n in sorted(drawn):
            if at + n / 2 < wanted[source]:
                taken[source] += n
            at += n
        taken[source] += certain
    return taken


@pytest.mark.parametrize("small", [mixing.SMALL, 0])
def test_mix_of_rows_that_are_alike(spark, monkeypatch, small):
    """A third of all rows without id in one source: the cut falls among them and the target is met."""
    monkeypatch.setattr(mixing, "SMALL", small)
    rows = [(None, "one two three", "en", "a", 0)] * 300 + [(7, "four five", "en", "b", 0)] * 40
    rows += [(k, prose(k, 1 + k % 9), "en", "ab"[k % 2], 0) for k in range(100, 500)] + [(900, "x y", "en", None, 0)]
    docs = docs_of(spark, rows).repartition(6)
    found, sizes, taken = mixing.mix(docs).collect(), defaultdict(int), defaultdict(int)
    for row in found:
        sizes[row.source] += row.size
        taken[row.source] += row.taken
    wanted = targets_of(sizes)
    assert len(found) == len(rows) and dict(taken) == dict(brute_taken(rows, wanted))
    assert all(abs(taken[source] - wanted[source]) <= 5 for source in sizes)
    assert len({row.copies for row in found if row.doc_id is None}) == 2  # not all or nothing
    assert mixing.mixed(docs).count() == sum(row.copies for row in found)


def test_mixed_repeats_rows(spark):
    docs = docs_of(spark, mix_rows())
    found, counts = mixing.mix(docs).collect(), defaultdict(int)
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns
    for row in whole.collect():
        counts[(row.doc_id, row.source)] += 1
    expected = defaultdict(int)
    for row in found:
        expected[(row.doc_id, row.source)] += row.copies
    assert counts == {k: n for k, n in expected.items() if n}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_inclusion_follows_the_probabilities(spark):
    """Over many salts, a document is taken about as often as its expected copies say."""
    rows = [(k, "w " * (1 + 40 * (k % 4)), "en", "s" if k % 2 else "t", 0) for k in range(60)]
    docs = docs_of(spark, rows)
    totals, plain = defaultdict(list), mixing.uniform
    try:
        for salt in range(12):
            mixing.uniform = lambda id_col, salt=salt: plain(id_col, f"salt{salt}")
            for row in mixing.mix(docs).collect():
                totals[(row.source, row.size)].append(row.copies)
    finally:
        mixing.uniform = plain
    by_size = {key: mean(copies) for key, copies in totals.items()}
    for source in "st":
        line = [by_size[key] for key in sorted(by_size) if key[0] == source]
        assert line == sorted(line)  # a longer document has the larger weight

# language ------------------------------------------------------------------------------


def spoken_rows(n):
    draw = random.Random(4)
    syllables = {"xx": ["ka", "to", "mi", "ra"], "yy": ["schl", "ung", "ver", "ei"], "zz": ["ção", "lh", "em", "õe"]}
    rows = []
    for k in range(n):
        lang = ("xx", "yy", "zz")[k % 3]
        words = ["".join(draw.choice(syllables[lang]) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(3, 150))]
        rows.append((k, " ".join(words), lang, "s", 0))
    return rows


@pytest.fixture(scope="module")
def spoken():
    return spoken_rows(240)


def test_language(spark, spoken):
    extra = [(900, None, "xx", "s", 0), (901, "12 34 !?", "xx", "s", 0), (902, "", None, "s", 0), (None, "ka to mi ra", None, "s", 0),
             (903, spoken[0][1] * 3000, None, "s", 0), (904, spoken[1][1], None, "s", 0), (904, spoken[1][1], None, "s", 0)]
    docs = docs_of(spark, spoken + extra).selectExpr("*", "1 as score", "2 as held_out")
    network = langid.fit(docs)
    assert network.languages == ["xx", "yy", "zz"]
    found = langid.identify(docs, network).collect()
    by_id = {row.doc_id: row for row in found}
    assert len(found) == len(spoken) + len(extra)
    for row in found:
        out = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2
        assert row.held_out == out and 0 <= row.score <= 1
    tested = [(by_id[k].lang_pred, lang) for k, _, lang, _, _ in spoken if by_id[k].held_out]
    assert tested and mean(a == b for a, b in tested) > 0.95
    assert [(by_id[k].lang_pred, by_id[k].score) for k in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by_id[903].lang_pred == spoken[0][2] and by_id[None].lang_pred == "xx"
    kept = langid.keep_known(docs, network, 0.3)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} >= {k for k, *_ in spoken}
    assert not {900, 901, 902} & {row.doc_id for row in kept.collect()}


def test_background(spark):
    """Unlearned scripts and random letters go; every document of a learned language stays."""
    spoken = spoken_rows(2400)
    draw = random.Random(8)
    noise = [" ".join("".join(draw.choice(letters) for _ in range(draw.randrange(3, 9))) for _ in range(60)) for letters in (
        "bcdfghjklmnpqrstvwxz", "абвгдежзиклмнопрстуфхцчшщ", "αβγδεζηθικλμνξοπρστυφχψω", "אבגדהוזחטיכלמנסעפצקרשת",
        "".join(map(chr, range(0x4E00, 0x6000))), "".join(map(chr, range(0x3041, 0x3097))))]
    docs = docs_of(spark, spoken + [(1000 + k, text, None, "s", 0) for k, text in enumerate(noise)])
    network = langid.fit(docs, with_background=True)
    assert network.languages == [langid.BACKGROUND, "xx", "yy", "zz"]
    kept = {row.doc_id for row in langid.keep_known(docs, network, 0.3).collect()}
    assert kept == {k for k, *_ in spoken}
    found = {row.lang_pred for row in langid.identify(docs, network).collect()}
    assert found == {"und", "xx", "yy", "zz"}
    empty = docs_of(spark, [(1, "words here", None, "s", 0)])
    assert langid.keep_known(empty, langid.fit(empty, with_background=True), 0.3).count() == 0
    assert langid.background([("a", ["", "12"])]) and langid.background([]) == []


def test_held_out_rows_teach_nothing(spark, spoken):
    out = [k for k, *_ in spoken if zlib.crc32(str(k).encode()) % 4 == 2]
    changed = [(k, "qqq " * 50, "ww", "s", 0) if k in out else (k, text, lang, "other", 0) for k, text, lang, *_ in spoken]
    first, second = langid.fit(docs_of(spark, spoken)), langid.fit(docs_of(spark, changed))
    assert first.languages == second.languages and np.array_equal(first.dense, second.dense)


def test_nothing_learned(spark):
    docs = docs_of(spark, [(1, "words here", None, "s", 0)])
    row = langid.identify(docs, langid.fit(docs)).collect()[0]
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert langid.identify(docs.limit(0), langid.fit(docs)).count() == 0


def test_windows_cover_everything():
    texts = [b"", b"abc", bytes(range(256)) * 3 + b"end", b"x" * langid.WINDOW]
    cut, owners, weights = langid.windows_of(texts)
    for number, text in enumerate(texts):
        assert weights[owners == number].sum() == len(text)
    assert bytes(cut[owners == 2][-1]) == texts[2][-langid.WINDOW:]

# personal data -------------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
            if (kind == 0 or kind == 1 and all(int(part) <= 255 for part in m.group().split("."))
                    or kind == 2 and 12 <= len(digits) <= 19 and luhn or kind == 3 and 9 <= len(digits) <= 15):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=500, deadline=None)
@given(st.one_of(*[st.text(alphabet=a, max_size=50) for a in
                   ("ab@.-_ ", "0123.  ", "01.", "12- 3", "+1 (2).-3 a", "a@b.c1.2.3.4+ -()", "4 -0")]))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_runs_of_any_length_are_scanned_once():
    for text in ("1" * 200_000, "a" * 200_000, "a." * 100_000 + "@", "+1" * 100_000, "1." * 100_000, "1 " * 100_000):
        pii.near_terms(text, pii.base_spans(text))


def test_disclosing_terms(spark):
    card = "4539 1488 0343 6467"
    rows = [(k, f"report by Zorblatt on {card} and the weather in town {k}") for k in range(4)]
    rows += [(100 + k, f"the weather and the town on report {k} by someone in it") for k in range(300)]
    rows += [(500, None), (501, ""), (502, "mail a@b.co"), (None, f"Zorblatt {card}"), (503, "x" * 4000), (0, rows[0][1])]
    docs = docs_of(spark, rows).selectExpr("*", "1 as entity", "2 as term")
    found = pii.find(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        text = next((text for doc, text in rows if doc == row.doc_id), "") or ""
        base = ",".join(f"{pii.KINDS[kind]}:{a}:{b}" for a, kind, b in brute_spans(text))
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        terms = [item for item in row.spans.split(",") if item.startswith("term")]
        assert [item for item in row.spans.split(",") if item and item not in terms] == [s for s in base.split(",") if s]
        place = text.find("Zorblatt")
        if row.doc_id is not None and place >= 0:
            assert f"term:{place}:{place + 8}" in terms
            assert all(text[int(a):int(b)] not in ("the", "by", "on", "and") for _, a, b in (t.split(":") for t in terms))
        else:
            assert not terms
    counts = {row.doc_id: (row.n_email, row.n_ip, row.n_card, row.n_phone) for row in found}
    assert counts[502] == (1, 0, 0, 0) and counts[1] == (0, 0, 1, 0) and counts[500] == (0, 0, 0, 0)
    assert pii.find(docs.limit(0)).count() == 0


def test_threshold_by_hand(spark):
    """PMI and IC from counts over all documents."""
    rows = [(k, f"alpha beta a{k % 2}@x.org") for k in range(6)] + [(10 + k, "beta gamma") for k in range(6)]
    docs = docs_of(spark, rows).select("doc_id", "text")
    found = {(r.entity, r.term) for r in pii.disclosing(docs, pii.mentions(docs), alpha=1.25, support=2).collect()}
    n = {"alpha": 6, "beta": 12}
    for entity in ("email:a0@x.org", "email:a1@x.org"):
        for term in n:
            pmi, ic = math.log2(12 * 3 / (3 * n[term])), math.log2(12 / 3)
            assert ((entity, term) in found) == (pmi >= ic / 1.25)


def test_pairs_of_one_document_are_judged(spark):
    """An entity of one document: its own words disclose it in a large corpus, common ones never."""
    rows = [(0, "Quibblesnark of the town\nwrote a long letter about the weather to zed@x.org")]
    rows += [(k, "a long letter about the weather of the town to someone wrote") for k in range(1, 4000)]
    docs = docs_of(spark, rows).select("doc_id", "text")
    found = {(r.entity, r.term) for r in pii.disclosing(docs, pii.mentions(docs)).collect()}
    assert found == {("email:zed@x.org", "quibblesnark")}
    # by hand: of one document the Wilson bound leaves 1 / (1 + Z * Z)
    assert math.log2(4000 / (1 + pii.Z ** 2)) >= math.log2(4000) / pii.ALPHA


def test_terms_are_marked_everywhere(spark):
    """Six words and a line away, a second time in the text, and in texts without the entity."""
    far = "Zorblatt one of the town people\nsaid to us in a very long letter x@y.org\nand so (zorblatt) left"
    rows = [(k, far) for k in range(8)] + [(8, "here is Zorblatt alone"), (9, None)]
    rows += [(100 + k, "one of the town people said to us in a very long letter alone here is and so left") for k in range(400)]
    docs = docs_of(spark, rows)
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    mail, second = far.index("x@y.org"), far.index("(zorblatt)")
    assert found[0] == f"term:0:8,email:{mail}:{mail + 7},term:{second}:{second + 10}"
    assert found[8] == "term:8:16" and found[9] == "" and found[100] == ""
    clean = pii.sanitised(docs)
    assert clean.schema == docs.schema and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[0] == far.replace("(zorblatt)", "[term]").replace("Zorblatt", "[term]").replace("x@y.org", "[email]")
    assert texts[8] == "here is [term] alone" and texts[9] is None and texts[100] == rows[10][1]

# fingerprints --------------------------------------------------------------------------


def test_edits(spark):
    rows = [(k, prose(k, 30 + 11 * k)) for k in range(14)]
    rows += [(100, rows[3][1]), (101, ""), (102, None), (103, "a b"), (104, "é" * 70), (None, prose(77, 50)), (105, "x" * 5000),
             (7, rows[7][1]), (7, "another text with this id, of some words more than five")]
    docs = docs_of(spark, rows).selectExpr("*", "1 as key", "2 as place")
    found = syncmers.edited(docs).collect()
    assert len(found) == len(rows)
    key = {text: spark.sql("select xxhash64(:t) as k", {"t": text}).first().k for text in {t or "" for _, t in rows}}
    order = sorted({(doc, text or "") for doc, text in rows}, key=lambda r: (r[0] is None, -(r[0] or 0), -key[r[1]]))
    after = {row: order[(k + 1) % len(order)] for k, row in enumerate(order)}
    expected = []
    for doc, text in rows:
        text = text or ""
        half = len(text) // 2
        edit = text[:len(text) - half] + after[(doc, text)][1][:half]
        expected.append((doc, len(text), hashlib.sha256(edit.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    prints = defaultdict(set)
    for r in found:
        prints[r.doc_id].add(r.fingerprint)
    assert prints[100] == prints[3] and prints[101] == prints[102] == {""} and len(prints[7]) == 2
    long_ones = [r for r in found if r.n_chars > 300 and r.doc_id != 105]
    assert mean(r.near_edited for r in long_ones) > 0.2 > max(r.near_next for r in long_ones)
    assert syncmers.edited(docs.limit(0)).count() == 0
    assert syncmers.edited(docs.where("doc_id = 3")).count() == 1


def test_syncmers_by_definition(spark):
    """The chosen places are those whose smallest inner hash is first or last, from Spark's own hashes."""
    text = prose(9, 80, vocabulary=12)
    row = syncmers.fingerprints(docs_of(spark, [(1, text)])).first()
    words = text.split()
    unit = {w: spark.sql("select xxhash64(:w) as h", {"w": w}).first().h for w in set(words)}
    pairs = [(unit[a], unit[b]) for a, b in zip(words, words[1:])]
    inner = {p: spark.sql("select xxhash64(:a, :b) as h", {"a": p[0], "b": p[1]}).first().h for p in set(pairs)}
    hashes = [inner[p] for p in pairs]
    width = syncmers.K - syncmers.S + 1
    chosen = [k for k in range(len(words) - syncmers.K + 1)
              if min(hashes[k:k + width]) in (hashes[k], hashes[k + width - 1])]
    assert [a.place for a in row.anchors] == chosen
    assert row.fingerprint == "".join(f"{a.hash:08x}" for a in row.anchors)


def test_positional_matches(spark):
    base = prose(20, 120)
    left = syncmers.fingerprints(docs_of(spark, [(1, base)]))
    right = syncmers.fingerprints(docs_of(spark, [(2, "five more words come first " + base)]))
    best = syncmers.matches(left, right).orderBy(F.desc("n")).first()
    assert best.shift == 5 and best.n > 30
