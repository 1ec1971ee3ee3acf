"""Line dedup by a segment-partition edit join.

A unit is a line of a text without the white space at its ends, of at least ``least``
characters; the registered query takes every line that is not blank. A unit goes when an earlier unit of the corpus equals it, or is within the edits that the
shorter of the two allows (insertion, deletion, substitution of a character): EDITS from
FULL_CHARS characters on, in proportion below, so that lines of a few characters go for
equal ones only. Earlier means: smaller id, then smaller text digest, then first in the
text, a line ranking by its first occurrence. So the first line of a neighbourhood stays,
and equal later ones go.

Finding pairs: a line of length l is cut into EDITS + 1 segments. A line within EDITS
edits of it holds one of the segments unchanged, at a place that the two lengths and the
number of the segment bound; these few places are probed for each length. Keys are hashes
of (length, segment number, characters), computed for a whole batch from one prefix sum.
Keys that only one line has are dropped in a sorted stream; the rest meet in tiles, cut
into pairs of blocks where a key has many lines. Counts of hashed characters (eight
bytes) rule out most chance meetings before any text is fetched, and a banded
bit-parallel edit distance decides.

Defined results: a null text is empty; shorter and blank lines are no units and always
stay. Null ids rank last. Rows that agree in id and text are one text with one result for each of
them. Line keys have 64 bits.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import by_batch, mix, prepare, settle, strings
from lectern.llm.linehash import digest, rank, removed_spans, report, strip

EDITS = 2
LEAST_CHARS = 40             # the floor unless named; 1: every line with a character is a unit
FULL_CHARS = 40              # length from which all EDITS are allowed
BLANK = " \t\n\x0b\x0c\r"
TILE_ROWS = 2048
BROADCAST_ROWS = 1_000_000   # most ids that are sent to every executor
SEEN = 300_000               # line keys a task remembers to skip repeats; speed alone

UNIT_SCHEMA = "doc_id bigint, key binary, unit int, start int, stop int, line bigint"
_BASE = 0x9E3779B97F4A7C15
MIXED = 1 << 16              # code points whose hashes are looked up, the others are computed
LANE = 65_535                # most characters of a line that are counted four buckets at a time


def line_key(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8"), digest_size=8).digest(), "little", signed=True)


def allowed(length: int, edits: int = EDITS) -> int:
    """Edits that a line may be away: in proportion to its length up to FULL_CHARS."""
    return min(edits, length * edits // FULL_CHARS)


def join_least(least: int, edits: int) -> int:
    """Length of the shortest lines that may have a neighbour but for equal ones."""
    return max(least, edits + 1, -(-FULL_CHARS // edits)) if edits else max(least, 1)


def lines_of(text: str, least: int = LEAST_CHARS) -> list[tuple[int, int, int, str]]:
    """(number, start, end, line) of the units; start and end are those of the whole line."""
    found, at = [], 0
    for number, whole in enumerate(text.split("\n")):
        line = whole.strip(BLANK)
        if len(line) >= least:
            found.append((number, at, at + len(whole), line))
        at += len(whole) + 1
    return found


def units(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    def work(batch):
        columns: list[list] = [[] for _ in range(6)]
        for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
            found = lines_of(text or "", least)
            if found:
                key = digest(text)
                for number, start, stop, line in found:
                    for column, value in zip(columns, (doc, key, number, start, stop, line_key(line))):
                        column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                              names=["doc_id", "key", "unit", "start", "stop", "line"])

    return by_batch(docs, UNIT_SCHEMA, work)


def segment(length, number: int, edits: int):
    """Start (from 0) and length of a segment: the first ones are a character shorter."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    first_long = parts - longer
    start = number * short + np.maximum(number - first_long, 0)
    return start, short + (number >= first_long)


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment number, shift) that a line looks up in shorter or equal lines.

    With ``gap`` more characters, segment i of the shorter line is met unchanged with at most
    i edits before it and edits - i after it: its place moves by -i .. i, and counted from
    the end by -(edits - i) .. edits - i.
    """
    found = []
    for gap in range(edits + 1):
        for number in range(edits + 1):
            low = max(-number, gap - (edits - number))
            high = min(number, gap + (edits - number))
            found += [(gap, number, shift) for shift in range(low, high + 1)]
    return found


@lru_cache(maxsize=1)
def _mixed() -> np.ndarray:
    return mix(np.arange(MIXED, dtype=np.uint64))


def mixed(values: np.ndarray) -> np.ndarray:
    """``mix`` of code points."""
    table = _mixed()
    found, large = table[np.minimum(values, MIXED - 1)], np.flatnonzero(values >= MIXED)
    found[large] = mix(values[large].astype(np.uint64))
    return found


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of the base and of its inverse modulo 2^64."""
    power, inverse = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    return np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


def code_points(lines: list[str]) -> np.ndarray:
    return np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)


def char_counts(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Eight counts of hashed characters, modulo 256, in one number per line."""
    which = (mixed(codes) & np.uint64(7)).astype(np.uint8)
    ones = np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))
    made = np.zeros(len(starts), dtype=np.uint64)
    if len(lengths) and lengths.max() > LANE:
        for bucket in range(8):
            run = np.zeros(len(codes) + 1, dtype=np.int64)
            np.cumsum(which == bucket, out=run[1:])
            made += ((run[starts + lengths] - run[starts]) & 255).astype(np.uint64) * ones[bucket]
        return made
    # four counts of 16 bits in one running sum; no count of a line passes its 16 bits
    run = np.zeros(len(codes) + 1, dtype=np.uint64)
    for half in range(2):
        lanes = np.zeros(8, dtype=np.uint64)
        lanes[4 * half:4 * half + 4] = np.uint64(1) << (np.arange(4, dtype=np.uint64) * np.uint64(16))
        np.cumsum(lanes[which], out=run[1:])
        sums = run[starts + lengths] - run[starts]
        for lane in range(4):
            made += ((sums >> np.uint64(16 * lane)) & np.uint64(255)) * ones[4 * half + lane]
    return made


def keys_of(lines: list[str], edits: int = EDITS, codes: np.ndarray | None = None):
    """(key, line number, whether it is a segment of the line itself) of all lines of a batch."""
    codes = code_points(lines) if codes is None else codes
    lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    starts = np.cumsum(lengths) - lengths
    size = len(codes) + 1
    power, inverse = _powers(max(1 << 20, 1 << size.bit_length()))
    total = np.zeros(size, dtype=np.uint64)
    np.cumsum(mixed(codes + np.uint32(1)) * power[:size - 1], out=total[1:])

    def hashed(at, width, length, number):
        inside = (total[at + width] - total[at]) * inverse[at]
        return mix(mix(inside + np.uint64(number + 1)) + length.astype(np.uint64))

    every = np.arange(len(lines))
    for number in range(edits + 1):
        start, width = segment(lengths, number, edits)
        yield hashed(starts + start, width, lengths, number), every, True
    for gap, number, shift in probes(edits):
        if gap == 0 and shift == 0:
            continue  # the segment itself, already there
        other = lengths - gap
        start, width = segment(other, number, edits)
        begin = start + shift
        fits = (other > edits) & (begin >= 0) & (begin + width <= lengths)
        yield hashed((starts + begin)[fits], width[fits], other[fits], number), every[fits], False


def keyed(docs: DataFrame, least: int = LEAST_CHARS, edits: int = EDITS) -> DataFrame:
    """``token``, ``line``, ``counts``, ``form`` (length, doubled, plus 1 for a segment of the line itself)."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            lines, names = [], []
            for text in strings(batch.column(0)):
                for *_, line in lines_of(text or "", least):
                    name = line_key(line)
                    if name not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(name)
                        lines.append(line)
                        names.append(name)
            if not lines:
                continue
            codes = code_points(lines)
            lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
            counts = char_counts(codes, np.cumsum(lengths) - lengths, lengths)
            key_of = np.asarray(names, dtype=np.int64)
            for token, which, own in keys_of(lines, edits, codes):
                yield pa.record_batch(
                    [pa.array(token.view(np.int64)), pa.array(key_of[which]), pa.array(counts[which].view(np.int64)),
                     pa.array(lengths[which] * 2 + own)], names=["token", "line", "counts", "form"])

    return docs.select("text").mapInArrow(run, "token bigint, line bigint, counts bigint, form bigint")


def shared_only(tokens: DataFrame) -> DataFrame:
    """Rows of the tokens that two or more lines have; rows come sorted by token and line."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(at).to_numpy() for at in range(4)]
            if held is not None:
                columns = [np.concatenate([old, new]) for old, new in zip(held[0], columns)]
            fresh = np.ones(len(columns[0]), dtype=bool)
            fresh[1:] = (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0) | (np.diff(columns[3]) != 0)
            given = held is not None and held[1]
            columns = [column[fresh] for column in columns]
            token, line = columns[0], columns[1]
            # a run of one token has several lines when its first and last line differ
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            last = np.append(first[1:], len(token)) - 1
            several = np.repeat(line[first] != line[last], last - first + 1)
            if given:
                several[:last[0] + 1] = True
            # the last run may go on in the next batch: its rows wait there unless they are given
            tail = first[-1]
            give = several.copy()
            if given:
                give[0] = False
            if several[-1]:
                held = ([column[-1:] for column in columns], True)
            elif len(token) - tail <= 64:
                give[tail:] = False
                held = ([column[tail:] for column in columns], False)
            else:  # one line many times: its distinct forms are few, so this is not reached
                held = ([column[tail:] for column in columns], False)
                give[tail:] = False
            yield pa.record_batch([pa.array(column[give]) for column in columns], names=["token", "line", "counts", "form"])

    return tokens.repartition("token").sortWithinPartitions("token", "line", "form").mapInArrow(
        run, "token bigint, line bigint, counts bigint, form bigint")


def candidates(rows: DataFrame, edits: int = EDITS) -> DataFrame:
    """``a``, ``b``: lines that share a token, fit in length and in counted characters."""
    per_token = rows.groupBy("token").agg(F.count("*").alias("rows"), F.max(F.col("form") % 2).alias("own"))
    blocks = per_token.where("own = 1").select("token", F.ceil(F.col("rows") / TILE_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(block, other).alias("low"), F.greatest(block, other).alias("high")))
    dealt = rows.join(blocks, "token").withColumn("cell", F.explode(cells)).select(
        "token", F.col("cell.low").alias("low"), F.col("cell.high").alias("high"), "line", "counts", "form")
    dealt = dealt.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")

    def pairs_of(line, counts, form):
        own, length = form % 2 == 1, form // 2
        parts = np.ascontiguousarray(counts).view(np.uint8).reshape(-1, 8)
        for at in range(0, len(line), 256):
            some = slice(at, at + 256)
            fits = (line[some, None] != line[None, :]) & (own[some, None] | own[None, :])
            fits &= np.abs(length[some, None] - length[None, :]) <= edits
            left, right = np.nonzero(fits)
            gap = parts[left + at] - parts[right]
            near = np.minimum(gap, -gap).astype(np.int64).sum(axis=1) <= 2 * edits
            left, right = line[left[near] + at], line[right[near]]
            if len(left):
                yield np.minimum(left, right), np.maximum(left, right)

    def give(columns):
        keys = np.rec.fromarrays(columns[:3])
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        found = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            if b - a > 1:
                found.extend(pairs_of(*(column[a:b] for column in columns[3:])))
        if found:
            pairs = np.unique(np.column_stack([np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])]), axis=0)
            yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    def run(batches):
        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(at).to_numpy() for at in range(6)]
            if held:
                columns = [np.concatenate([old, new]) for old, new in zip(held, columns)]
            keys = np.rec.fromarrays(columns[:3])
            cut = int(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[-1])
            if cut:
                yield from give([column[:cut] for column in columns])
            held = [column[cut:] for column in columns]
        if held:
            yield from give(held)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: a band of 2 * edits + 1 cells per column, as bits.

    Common ends are taken off. ``up`` and ``down`` are the steps +1 and -1 between cells of
    a column, ``same`` the cells that equal their diagonal neighbour; the band moves down
    one row per column. The diagonal that ends in the corner never falls, so its count ends
    the loop early.
    """
    if len(a) < len(b):
        a, b = b, a
    gap = len(a) - len(b)
    if gap > edits:
        return False
    head, size = 0, len(b)
    while head < size and a[head] == b[head]:
        head += 1
    a, b = a[head:], b[head:]
    tail, size = 0, len(b)
    while tail < size and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    full, line = (1 << (2 * edits + 1)) - 1, 1 << (edits + gap)
    places: dict[str, int] = {}
    for at, character in enumerate(a):
        places[character] = places.get(character, 0) | 1 << (at + edits)
    up, down, far = full >> edits << edits, 0, gap
    for at, character in enumerate(b):
        equal = places.get(character, 0) >> at & full
        same = ((((equal & up) + up) ^ up) | equal | down) & full
        right, left = down | (full & ~(same | up)), same & up
        if not same & line:
            far += 1
            if far > edits:
                return False
        same >>= 1
        up, down = left | (full & ~(same | right)), same & right
    return True


def near_pairs(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, least: int, edits: int) -> DataFrame:
    """The pairs within the distance, by their characters; only lines that have a pair are fetched."""
    needed = settle(
        pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct()
        .join(firsts.select("line", F.col("first.doc_id").alias("_id")), "line")
        .groupBy("_id").agg(F.collect_list("line").alias("_lines")))
    keys = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    held = docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_id"))).select("_lines", "text")

    def fetch(batch):
        names, lines = [], []
        for wanted, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
            wanted = set(wanted)
            for *_, line in lines_of(text or "", least):
                name = line_key(line)
                if name in wanted:
                    names.append(name)
                    lines.append(line)
        yield pa.record_batch([pa.array(names, pa.int64()), pa.array(lines, pa.string())], names=["line", "shown"])

    texts = settle(by_batch(held, "line bigint, shown string", fetch).dropDuplicates(["line"]))

    def check(batch):
        kept = [within(a, b, allowed(min(len(a), len(b)), edits)) for a, b in zip(strings(batch.column(2)), strings(batch.column(3)))]
        yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = pairs.join(texts.select(F.col("line").alias("a"), F.col("shown").alias("shown_a")), "a").join(
        texts.select(F.col("line").alias("b"), F.col("shown").alias("shown_b")), "b")
    return by_batch(joined.select("a", "b", "shown_a", "shown_b"), "a bigint, b bigint", check)


def removed(docs: DataFrame, least: int = LEAST_CHARS, edits: int = EDITS) -> DataFrame:
    """Spans to remove per (``doc_id``, ``key``) of docs (``doc_id``, ``text``)."""
    found = settle(units(docs, least))
    firsts = settle(found.groupBy("line").agg(F.min(rank()).alias("first"), F.max(rank()).alias("last")))
    shared = settle(shared_only(keyed(docs, join_least(least, edits), edits)))
    pairs = settle(candidates(shared, edits))
    near = near_pairs(pairs, docs, firsts, least, edits)
    place = firsts.select("line", "first")
    later = (
        near.join(place.withColumnsRenamed({"line": "a", "first": "first_a"}), "a")
        .join(place.withColumnsRenamed({"line": "b", "first": "first_b"}), "b")
        .select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("line"))
        .distinct().withColumn("near", F.lit(True)))
    # lines that occur once and have no neighbour need no join with their units; the others are
    # written, so that Spark splits the hot ones among them in the join
    marked = settle(firsts.join(later, "line", "left").where(
        F.col("near") | (F.col("first") < F.col("last"))).select("line", "first", "near"))
    gone = found.join(marked, "line").where(
        F.coalesce("near", F.lit(False)) | (F.col("first") < rank()))
    return removed_spans(gone)


def dedup(docs: DataFrame, least: int = LEAST_CHARS, edits: int = EDITS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: ``n_units`` (lines), ``n_removed``, ``removed`` (start:end list), ``kept_sha256``."""
    prepare(docs.sparkSession)
    small = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return report(docs, removed(small, least, edits), id_col, text_col)


def clean(docs: DataFrame, least: int = LEAST_CHARS, edits: int = EDITS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The rows with all their columns, their texts without the removed lines."""
    prepare(docs.sparkSession)
    small = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return strip(docs, removed(small, least, edits), id_col, text_col)
