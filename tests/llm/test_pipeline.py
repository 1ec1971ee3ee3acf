"""The pipeline's stages against brute force, each on its own input, and the whole run."""

import hashlib
import os
from collections import Counter

import pytest

import corpus_pipeline
from lectern.llm import bpe, lineedit, mixing
from lectern.llm.common import settle
from tests.llm.helpers import docs_of, prose
from tests.llm.test_jaccard import brute as near_brute
from tests.llm.test_lines import brute_edit

FOLDER = "/root/testdata/sf0.001"


def dropped_lines(text, spans):
    at, kept = 0, []
    for line in text.split("\n"):
        if (at, at + len(line)) not in spans:
            kept.append(line)
        at += len(line) + 1
    return "\n".join(kept)


@pytest.fixture(scope="module")
def documents(spark):
    if os.path.isdir(FOLDER):
        rows = [tuple(row) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    else:
        rows = [(k, prose(k % 80, 20 + k), "xx" if k % 2 else "yy", f"s{k % 5}", 0) for k in range(120)]
    extra = [(10_000, None, None, None, None), (10_001, "", "en", "src0", 0), (10_002, "12 +-", "en", None, 5)]
    return docs_of(spark, rows + extra)


def test_stages(spark, documents, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_copies", "mix_sources", "encode"]
    held, columns = documents, documents.columns
    rows = {0: [(r.doc_id, r.text) for r in held.collect()]}
    sources = {}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        held = settle(stage(spark, held, FOLDER))
        if number < 5:
            assert held.columns == columns
            rows[number] = [(r.doc_id, r.text) for r in held.collect()]
            sources[number] = held
    # language: only texts that say nothing go
    assert {doc for doc, _ in rows[0]} - {doc for doc, _ in rows[1]} == {10_000, 10_001, 10_002}
    assert set(rows[1]) <= set(rows[0])
    # line dedup
    gone = brute_edit(rows[1], 1, lineedit.EDITS)
    assert Counter(rows[2]) == Counter((doc, dropped_lines(text, gone[(doc, text)])) for doc, text in rows[1])
    # near copies
    kept = {doc for doc, n, component in near_brute(rows[2]) if n == 0 or doc == component}
    assert Counter(rows[3]) == Counter((doc, text) for doc, text in rows[2] if doc in kept)
    # the mix
    copies = {r.doc_id: r.copies for r in mixing.mix(sources[3]).collect()}
    assert Counter(rows[4]) == Counter({(doc, text): copies[doc] for doc, text in rows[3] if copies[doc]})
    # tokens
    coder = bpe.load(corpus_pipeline.RANKS)
    found = held.collect()
    assert Counter(r.doc_id for r in found) == Counter(doc for doc, _ in rows[4])
    texts = dict(rows[4])
    for row in found:
        assert row.ids == coder.encode(texts[row.doc_id]) and row.n_tokens == len(row.ids)
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_every_query_is_registered():
    import __spark_entry__ as entry_points

    names = set(entry_points.queries())
    assert "pipeline" in names
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
