"""Periodic runs against every period tried at every place."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import periodic
from tests.llm.helpers import docs_of, prose


def smallest_period(x):
    return next(q for q in range(1, len(x) + 1) if x[q:] == x[:len(x) - q])


def brute(x):
    found, n = set(), len(x)
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            if x[at] != x[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and x[end] == x[end + q]:
                end += 1
            if end + q - at >= max(6, 4 * q) and smallest_period(x[at:end + q]) == q:
                found.add((at, end + q - at, q))
            at = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_row(doc, text):
    words = [] if text is None else text.encode().split()
    n = len(words)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    shown = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    stays = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(found), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(stays).hexdigest())


def test_transform_is_a_convolution():
    draw = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks, windows = draw.integers(0, 2 ** 20, (3, size)), draw.integers(0, 2 ** 20, (3, 2 * size - 1))
        found = periodic.squared_differences(blocks, windows)
        for row in range(3):
            for place in range(size):
                exact = sum((int(a) - int(b)) ** 2 for a, b in zip(blocks[row], windows[row, place:place + size]))
                assert found[row, place] == exact % periodic.PRIME
    rows = draw.integers(0, periodic.PRIME, (2, 256))
    assert (periodic.backward(periodic.forward(rows)) == rows).all()


def of(x):
    return periodic.runs(periodic.numbers(list(x)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_random_words(x):
    assert of(x) == brute(x)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
def test_repeated_pieces(parts):
    x = list("".join(piece * times for piece, times in parts))
    assert of(x) == brute(x)


def test_long_texts():
    draw = random.Random(3)
    for p in (1, 2, 3, 31, 32, 33, 100):
        x = [draw.randrange(50) for _ in range(37)] + ([draw.randrange(9) for _ in range(p)] * 700)[:700] + list(range(100, 110))
        assert of(x) == brute(x)
    x = list("abababc" * 5 + "abababd" * 4 + "aaaaaaaaab" * 6)
    assert of(x) == brute(x)
    block = [draw.randrange(10 ** 6) for _ in range(5000)]  # a period far beyond the arrays' size
    assert of([-1] + block * 5 + [-2]) == [(1, 25_000, 5000)]
    assert of(["w"] * 100_000) == [(0, 100_000, 1)]
    assert of(block) == []


def test_documents(spark):
    rows = [(k, prose(k, 1 + 7 * k, 3 + k % 9)) for k in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "x " * 50), (None, "é é é é é é z z z z z z"), (None, None), (203, "x " * 50),
             (204, "a b a b a b"), (205, "A a " * 9)]
    docs = docs_of(spark, rows).selectExpr("*", "1 as start", "2 as n_runs")
    found = sorted(map(tuple, periodic.of_rewritten(docs).collect()), key=repr)
    assert found == sorted((brute_row(*row) for row in rows), key=repr)
    assert any(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(150))
    listed = sorted(map(tuple, periodic.spans(docs).collect()), key=repr)
    assert listed == sorted(((doc, *run) for doc, text in rows for run in brute((text or "").encode().split())), key=repr)
    stays = {row.doc_id: row.text for row in periodic.collapsed(docs).collect()}
    assert stays[203] == "x" and stays[205] == "A a" and stays[200] == ""
    assert periodic.of_rewritten(docs.limit(0)).collect() == [] and periodic.spans(docs.limit(0)).collect() == []
