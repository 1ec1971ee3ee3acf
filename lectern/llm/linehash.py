"""Substring dedup by hashed lines.

A text is parted at line feeds. Each unit is normalised (A-Z in lower case, runs of space,
tab to carriage return as one space, none at the ends) and hashed; equal digests are
grouped over the corpus and the earliest unit of each group stays: the smallest id, then
the smallest text digest, then the first in the text. Units of fewer than ``least_words`` words are never removed.
A removed unit goes with the line feed after it (the last one with the one before it);
offsets refer to the text as it came.

Defined results: a null text is empty and has one empty unit. Null ids rank last. Rows
that agree in id and text count as one unit list, and each of them is returned with the
same result. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import WORD, by_batch, free_names, prepare, settle, strings

LEAST_WORDS = 1              # every unit that is not blank; a floor only where a caller names one
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
_WORDS = re.compile(WORD)
UNIT_SCHEMA = "doc_id bigint, key binary, unit int, start int, stop int, words int, digest binary"


def units_of(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normal form) of every line; ends exclude the line feed."""
    found, at = [], 0
    for line in text.split("\n"):
        words = _WORDS.findall(line.translate(_LOWER))
        found.append((at, at + len(line), len(words), " ".join(words)))
        at += len(line) + 1
    return found


def digest(data: str) -> bytes:
    return hashlib.sha256(data.encode("utf-8")).digest()[:16]


def units(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit of at least ``least_words`` words: ``key`` stands for the text of the row."""

    def work(batch):
        columns: list[list] = [[] for _ in range(7)]
        for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
            key = digest(text or "")
            for number, (start, stop, words, normal) in enumerate(units_of(text or "")):
                if words >= least_words:
                    for column, value in zip(columns, (doc, key, number, start, stop, words, digest(normal))):
                        column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.record_batch(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)],
            names=["doc_id", "key", "unit", "start", "stop", "words", "digest"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(chosen, UNIT_SCHEMA, work)


def rank(doc: str = "doc_id", key: str = "key", unit: str = "unit") -> Column:
    """Order of units: id (null last), text, place."""
    return F.struct(F.col(doc).isNull().alias("no_id"), F.col(doc).alias("doc_id"), F.col(key).alias("key"),
                    F.col(unit).alias("unit"))


def repeated(found: DataFrame) -> DataFrame:
    """The units to remove: those whose digest has an earlier unit.

    The earliest unit of a digest is one aggregate with partial sums before the shuffle.
    Digests without a second unit are dropped there. The rest is written, so that its join
    with the units stands on two plain exchanges, and Spark splits the hot digests.
    """
    keepers = found.groupBy("digest").agg(F.min(rank()).alias("first"), F.max(rank()).alias("last"))
    keepers = settle(keepers.where(F.col("first") < F.col("last")).select("digest", "first"))
    return found.join(keepers, "digest").where(F.col("first") < rank()).drop("first")


def drop_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given lines, each with the line feed after it."""
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at:start])
        at = min(stop + 1, len(text))
    kept.append(text[at:])
    joined = "".join(kept)
    gone_last = bool(spans) and spans[-1][1] == len(text)
    return joined[:-1] if gone_last and joined.endswith("\n") else joined


def removed_spans(removed: DataFrame) -> DataFrame:
    """Spans per text as one sorted array: no longer than the text itself."""
    return removed.select("doc_id", "key", "start", "stop").distinct().groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans to remove (null: none) as a last column, joined by id and text."""
    own, doc, of, held = free_names(docs, "key", "doc", "of", "spans")

    def work(batch):
        key = pa.array([digest(text or "") for text in strings(batch.column(text_at))], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, key], names=[*batch.schema.names, own])

    text_at = docs.columns.index(text_col)
    keyed = by_batch(docs, docs.select("*", F.lit(b"").alias(own)).schema, work)
    named = spans.select(F.col("doc_id").alias(doc), F.col("key").alias(of), F.col("spans").alias(held))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(of))
    return keyed.join(named, same, "left").drop(doc, of, own)


def strip(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with the same columns, their texts without the removed lines."""
    joined = with_spans(docs, spans, id_col, text_col)
    text_at = docs.columns.index(text_col)

    def work(batch):
        held = batch.column(batch.num_columns - 1).to_pylist()
        texts = [
            text if not found else drop_spans(text, [(s["start"], s["stop"]) for s in found])
            for text, found in zip(strings(batch.column(text_at)), held)
        ]
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(texts, columns[text_at].type)
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    return by_batch(joined, docs.schema, work)


def report(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``n_removed``, ``n_units``, ``removed`` (start:stop list), ``kept_sha256``."""
    small = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    joined = with_spans(small, spans)

    def work(batch):
        rows = []
        for text, found in zip(strings(batch.column(1)), batch.column(2).to_pylist()):
            text, held = text or "", [(s["start"], s["stop"]) for s in found or []]
            kept = drop_spans(text, held)
            rows.append((text.count("\n") + 1, len(held), ",".join(f"{a}:{b}" for a, b in held),
                         hashlib.sha256(kept.encode("utf-8")).hexdigest()))
        counts, gone, listed, kept = zip(*rows)
        yield pa.record_batch(
            [batch.column(0), pa.array(np.asarray(gone, dtype=np.int64)), pa.array(np.asarray(counts, dtype=np.int64)),
             pa.array(listed, pa.string()), pa.array(kept, pa.string())],
            names=["doc_id", "n_removed", "n_units", "removed", "kept_sha256"])

    return by_batch(joined, "doc_id bigint, n_removed bigint, n_units bigint, removed string, kept_sha256 string", work)


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The report of every row after removing repeated lines."""
    prepare(docs.sparkSession)
    found = settle(units(docs, least_words, id_col, text_col))
    return report(docs, removed_spans(repeated(found)), id_col, text_col)
