import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import bpe
from tests.llm.helpers import docs_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


AWKWARD = ["", " ", "\n\n", "don't 'll've ''s 's's", "a  b\t\tc \n d", "  \nabc", "x　y\x85z\x1c ", "12 345a6",
           "日本語テキスト é ñ", "\U000105c0\U00010d40 \U00011de0", "<|endoftext|>", "!!!'s ?'re", "aaaa" * 50, "\x00\x01"]


@pytest.mark.parametrize("text", AWKWARD)
def test_same_ids_as_the_rank_library(reference, text):
    coder = bpe.load(RANKS)
    assert coder.encode(text) == reference.encode_ordinary(text)
    assert coder.decode_bytes(coder.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab'srtelvmd \n\t1!é", max_size=60)))
def test_any_text(reference, text):
    text = text.encode("utf-8", "ignore").decode()
    assert bpe.load(RANKS).encode(text) == reference.encode_ordinary(text)


def test_long_text_in_sections(reference, monkeypatch):
    monkeypatch.setattr(bpe, "SECTION", 50)
    draw = random.Random(1)
    text = "".join(draw.choice("ab '\n\t1!é ") for _ in range(3000)) + "z" * 500 + " end"
    assert bpe.load(RANKS).encode(text) == reference.encode_ordinary(text)


def test_offsets_of_split_characters():
    coder = bpe.load(RANKS)
    text = "a\U0001f9ff é"
    ids = coder.encode(text)
    starts, ends = coder.offsets(text, ids)
    assert starts[0] == 0 and ends[-1] == len(text)
    assert all(a < b for a, b in zip(starts, ends))
    pieces = [coder.token_bytes[i] for i in ids]
    assert sum(starts.count(1) for _ in "x") >= 2 or len(pieces[1]) == 4  # one character, several tokens


def test_tables(spark, reference):
    rows = [(1, "Hello  world's"), (1, "Hello  world's"), (None, None), (3, ""), (4, "x" * 5000)]
    docs = docs_of(spark, rows).selectExpr("*", "1 as ids", "2 as n_tokens")
    found = bpe.token_digests(docs, RANKS, with_ids=True).collect()
    assert len(found) == len(rows)
    by_text = {row.doc_id: row for row in found}
    for doc, text in rows:
        ids = reference.encode_ordinary(text or "")
        assert by_text[doc].n_tokens == len(ids) and by_text[doc].ids == ids
        assert by_text[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert by_text[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode(docs, RANKS)
    assert sorted(row.text for row in bpe.decode(encoded, RANKS).collect()) == sorted(text or "" for _, text in rows)
    assert bpe.token_digests(docs.limit(0), RANKS).count() == 0


def test_decode_of_half_a_character(spark):
    coder = bpe.load(RANKS)
    half = [i for i in coder.encode("\U0001f9ff")][:1]
    frame = spark.createDataFrame([(1, half), (2, None)], "doc_id bigint, ids array<int>")
    found = {row.doc_id: row for row in bpe.decode(frame, RANKS).collect()}
    assert found[2].text == "" and bytes(found[1].data) == coder.token_bytes[half[0]]
