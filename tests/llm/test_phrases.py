"""Phrases against brute force, tries against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import phrases
from tests.llm.helpers import docs_of


def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    by_lang = {}
    for key, a in counts.items():
        lang, *words = key
        if len(words) < 2 or a < 10:
            continue
        if any(len(other) == 4 and f >= 10 and other[0] == lang and 100 * f >= 50 * a and (list(other[1:3]) == words or list(other[2:]) == words)
               for other, f in counts.items()) and len(words) == 2:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    found = []
    for lang, listed in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def awkward(count=120):
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "東京", "x"]
    rows = []
    for k in range(count):
        words = draw.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=draw.randrange(1, 80))
        gaps = draw.choices([" ", "\t", "  ", ", ", ".", "!\n", "\r", " ?"], [20, 2, 1, 1, 1, 1, 1, 1], k=len(words))
        rows.append((k, "".join(w + g for w, g in zip(words, gaps)), draw.choice(["en", "de", "de", None, "und"]), "s", 0))
    rows += [(None, None, "en", None, None), (900, "", None, None, 0), (901, "., ;\n", "xx", None, 0), (902, "No break IS a word. IS A", "en", "s", 0)] * 12
    rows += [(903, "THE end of it " * 30, "en", "s", 0), (904, "a a a a a a a a a a a a a", "aa", "s", 0)]
    return rows


@pytest.mark.parametrize("entries, bundle", [(1 << 19, 1 << 24), (1024, 500)])
def test_collocations(spark, monkeypatch, entries, bundle):
    monkeypatch.setattr(phrases, "TRIE_ENTRIES", entries)
    monkeypatch.setattr(phrases, "TASKS_AT_ONCE", 64 if entries > 2048 else 2)
    monkeypatch.setattr(phrases, "TRIES_AT_ONCE", 1)
    monkeypatch.setattr(phrases, "BUNDLE_BYTES", bundle)
    rows = awkward(120 if entries > 2048 else 40)
    docs = docs_of(spark, rows).selectExpr("*", "1 as n", "2 as code", "3 as rank", "'q' as word")
    found = phrases.collocations(docs)
    assert dict(found.dtypes) == {"lang": "string", "phrase": "string", **dict.fromkeys(["rank", "a", "l", "r", "n", "score"], "bigint")}
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_words_in_sections():
    texts = [b"a bb. CCC\tdd", b"", "é ".encode() * 50, b"x" * 300 + b" y"]
    salts = np.arange(4, dtype=np.uint64)
    whole = phrases.words_of(texts, salts, 0)
    phrases.SECTION_BYTES, before = 16, phrases.SECTION_BYTES
    try:
        parts = phrases.words_of(texts, salts, 0)
    finally:
        phrases.SECTION_BYTES = before
    assert (whole.codes == parts.codes).all() and (whole.follows == parts.follows).all()
    shown = [whole.data[s:e].decode() for s, e in zip(whole.starts, whole.ends)]
    assert shown[:4] == ["a", "bb", "ccc", "dd"] and shown[-2:] == ["x" * 300, "y"]
    assert whole.follows[:5].tolist() == [False, True, False, True, False]
    assert len(set(zip(whole.texts.tolist(), shown))) == len(set(whole.codes.tolist()))


@pytest.mark.parametrize("words, entries", [(5, 60), (3000, 20_000), (200, 5000)])
def test_trie(words, entries):
    draw = np.random.default_rng(words)
    alphabet = draw.integers(-2 ** 63, 2 ** 63, words)
    weights = 1 / np.arange(1, words + 1)
    rows = np.unique(alphabet[draw.choice(words, (entries, 3), p=weights / weights.sum())], axis=0)
    is_pair = draw.random(len(rows)) < 0.5
    rows[is_pair, 2] = 0
    keep = np.unique(rows, axis=0, return_index=True)[1]
    rows, is_pair = rows[keep], is_pair[keep]
    trie = phrases.build(rows, is_pair, 0)
    codes = np.append(alphabet, 17)[draw.integers(0, words + 1, 5000) if words > 9 else draw.integers(0, words, 5000)]
    codes[:3000] = rows[draw.integers(0, len(rows), 1000)].ravel()
    follows = draw.random(5000) < 0.9
    expected = Counter()
    for i in range(5000):
        for k in (2, 3):
            if i + k <= 5000 and follows[i + 1:i + k].all():
                expected[tuple(codes[i:i + k].tolist())] += 1
    named = [tuple(r[:2].tolist()) if pair else tuple(r.tolist()) for r, pair in zip(rows, is_pair)]
    assert trie.count(codes, follows).tolist() == [expected[name] for name in named]


def test_scores_beyond_64_bits(spark):
    rows = [(3_000_000_000_000, 3_000_000_000_007, 3_000_000_000_001), (10, 10, 10), (999_999_999_999_999, 10 ** 15, 10 ** 15)]
    frame = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select("a", "l", "r", phrases.cut_score("a", "l", "r").alias("s"))
    assert [row.s for row in frame.orderBy("a").collect()] == [10 ** 6 * a * a // (l * r) for a, l, r in sorted(rows)]


def test_shared_codes_are_drawn_again(spark, monkeypatch):
    seeds = []

    def vocabulary(texts, seed):
        seeds.append(seed)
        return texts.sparkSession.createDataFrame([("en", "a", 5, 1), ("en", "b", 5 + seed, 1)], "lang string, word string, code bigint, f bigint")

    monkeypatch.setattr(phrases, "vocabulary", vocabulary)
    assert phrases.coded_vocabulary(docs_of(spark, [(1, "a b")]))[1] == 1 and seeds == [0, 1]


def test_words_of_one_code_are_rows_of_their_own(spark, monkeypatch):
    texts = docs_of(spark, [(1, "a b a c"), (2, "b")]).select("text", "lang")
    batch = pa.RecordBatch.from_arrays([pa.array(["a b a c", "b"]), pa.array(["en", "en"])], ["text", "lang"])
    run = {}
    monkeypatch.setattr(type(texts), "mapInArrow", lambda frame, function, schema: run.setdefault("it", function) and frame)
    with pytest.raises(Exception):
        phrases.vocabulary(texts, 0)
    monkeypatch.setattr(phrases, "mix", lambda values: values & np.uint64(0))  # all words share a code
    found = [row for part in run["it"](iter([batch])) for row in part.to_pylist()]
    assert {row["word"] for row in found} == {"a", "b", "c"} and sum(row["n"] for row in found) == 5


def test_empty(spark):
    assert phrases.collocations(docs_of(spark, [])).collect() == []
    assert phrases.collocations(docs_of(spark, [(1, None), (2, "a b c")])).collect() == []


def test_occurrences_are_dealt_to_one_trie_each(spark):
    """Every text was walked through every trie, so that the work grew with the texts times the candidates."""
    rows = awkward(40)
    texts = docs_of(spark, rows).selectExpr("coalesce(text, '') as text", "coalesce(lang, 'und') as lang").repartition(3)
    full = np.full(1 << (phrases.PAIR_BITS - 6), -1, dtype=np.int64).view(np.uint64)
    expected = Counter()
    for _, text, lang, *_ in rows:
        for words in pieces(text):
            expected.update((k, lang or "und", *words[i:i + k]) for k in (2, 3) for i in range(len(words) - k + 1))

    def listed(tries):
        places, times = {}, Counter()
        for row in phrases.dealt(texts, 0, full, tries).collect():
            *codes, n = np.frombuffer(row.list, dtype=np.int64).reshape(row.words + 1, -1)
            for phrase, k in zip(zip(*codes), n.tolist()):
                places.setdefault(phrase, set()).add(row.trie)
                times[phrase] += k
        assert all(len(found) == 1 for found in places.values())
        return len(set.union(*places.values())), sorted(times.values())

    assert listed(1) == (1, sorted(expected.values()))
    assert listed(20) == (20, sorted(expected.values()))


def test_many_small_tries(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TRIE_LEAST", 8)
    monkeypatch.setattr(phrases, "LISTED_ROWS", 50)
    monkeypatch.setattr(phrases, "LIST_ROWS", 7)
    monkeypatch.setattr(phrases, "TASKS_AT_ONCE", 3)
    monkeypatch.setattr(phrases, "BUNDLE_BYTES", 300)
    rows = awkward(30)
    assert sorted(map(tuple, phrases.collocations(docs_of(spark, rows)).collect())) == brute(rows)


def test_rows_that_share_a_key_are_counted_whole(monkeypatch):
    """Candidates reach ten by these counts, so no row may be parted."""
    monkeypatch.setattr(phrases, "pair_key", lambda left, right: left & 0)
    draw = np.random.default_rng(3)
    columns, times = [draw.integers(0, 4, 500) for _ in range(3)], draw.integers(1, 9, 500)
    expected, weighed = Counter(zip(*(column.tolist() for column in columns))), Counter()
    for row, n in zip(zip(*(column.tolist() for column in columns)), times.tolist()):
        weighed[row] += n
    for given, wanted in ((None, expected), (times, weighed)):
        rows, n = phrases.distinct_rows(columns, given)
        assert len(n) == len(wanted) and dict(zip(zip(*(row.tolist() for row in rows)), n.tolist())) == wanted


def test_candidates_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_WORDS", 40)
    monkeypatch.setattr(phrases, "LISTED_ROWS", 30)
    monkeypatch.setattr(phrases, "BUNDLE_BYTES", 300)
    rows = awkward(30)
    texts = docs_of(spark, rows).selectExpr("coalesce(text, '') as text", "coalesce(lang, 'und') as lang").repartition(3)
    counts, total = Counter(), 0
    for _, text, lang, *_ in rows:
        for words in pieces(text):
            total += len(words)
            counts.update((lang or "und", *words[i:i + 2]) for i in range(len(words) - 1))
    full = np.full(1 << (phrases.WORD_BITS - 6), -1, dtype=np.int64).view(np.uint64)
    found = phrases.candidates(texts, 0, 2, full, phrases.WORD_BITS, total).collect()
    assert len(found) == len(set(found)) == sum(n >= 10 for n in counts.values())
