"""Exact substring dedup over a sparse enhanced suffix array.

Every byte covered by a LEAST-byte string that also starts at another place of the corpus
is found, whichever document the other place is in. Matches stay inside documents.

Anchors. Of each LEAST-byte string the GRAM-byte substring with the smallest hash (the
leftmost of equals) is its anchor. Equal strings have their anchor at the same offset, so
occurrences of a repeated string meet at the suffixes that begin at equal anchors, about
one in 85 bytes; all other suffixes need not be sorted. The context of an anchor, REACH
bytes before it and LEAST bytes from it (less at the ends of a text), holds every string
that it can be the anchor of.

Equal contexts are counted by their hash, with partial sums before the shuffle: where one
occurs twice, all its bytes are repeated. Only different contexts of one anchor need
their bytes. They are sorted as suffixes, and a stack scan over the common-prefix lengths
gives the interval tree. Inside an interval the reversed left contexts are scanned in the
same way: an interval there is a maximal repeat, diverse to the right and to the left,
with all its occurrences. Repeats of LEAST bytes and more cover their bytes.

An anchor with more than GROUP contexts is not gathered: the strings of LEAST bytes around
it are hashed and counted instead, again with partial sums; that finds the same bytes.

Defined results: a null text is empty; texts shorter than LEAST bytes keep all bytes. All
copies of a text of LEAST bytes and more go, equal rows included. Ids play no part; null
ids are allowed. Hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import by_batch, key_filter, mix, prepare, settle, sha, strings, with_filter
from lectern.operators.skew import attach

LEAST = 200
GRAM = 32
REACH = LEAST - GRAM
GROUP = 20_000            # contexts of one anchor that are sorted together
SECTION = 1 << 22         # string starts that are looked at together
WINDOW = 500_000          # anchors of a task that are looked at together
BROADCAST_ROWS = 200_000  # most contexts whose places are sent to every executor
_BASE = 0x9E3779B97F4A7C15


def text_key(text: str) -> Column:
    """Rows whose texts are equal share this number; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


_byte_values = np.random.default_rng(4).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, 1 << 17)
        for at, factor in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            line = np.full(size, factor, dtype=np.uint64)
            line[0] = 1
            _powers[at] = np.cumprod(line, dtype=np.uint64)
    return _powers[0], _powers[1]


class Hashes:
    """Hashes of any substring of some bytes from one prefix sum."""

    def __init__(self, data: bytes):
        flat = np.frombuffer(data, dtype=np.uint8)
        power, self.inverse = _power(len(flat) + 1)
        self.total = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum(_byte_values[flat] * power[:len(flat)], out=self.total[1:])

    def of(self, starts, stops) -> np.ndarray:
        return mix((self.total[stops] - self.total[starts]) * self.inverse[starts])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, context hash, place) of every anchor of a text, each place once."""
    found, latest = ([], [], []), -1
    for first in range(0, len(data) - LEAST + 1, SECTION):
        # the strings that start here, with what their contexts reach
        low = max(0, first - REACH)
        high = min(len(data), first + SECTION - 1 + LEAST + LEAST)
        hashes = Hashes(data[low:high])
        begin = np.arange(first - low, min(len(data), first + SECTION - 1 + LEAST) - low - GRAM + 1)
        grams = hashes.of(begin, begin + GRAM)
        # the smallest hash with the leftmost place in the low bits, over REACH + 1 neighbours
        least = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = REACH + 1 - width
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        chosen = np.unique((least & np.uint64((1 << 24) - 1)).astype(np.int64))
        # places never fall; the first may be the anchor of the last string of the section before
        chosen = chosen[chosen + first > latest]
        place = chosen + first
        left, right = np.minimum(place, REACH), np.minimum(len(data) - place, LEAST)
        inside = hashes.of(place - left - low, place + right - low)
        edges = (left * 1024 + right).astype(np.uint64)
        found[0].append(grams[chosen])
        found[1].append(mix(inside + edges))
        found[2].append(place)
        latest = place[-1] if len(place) else latest
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(part) if part else empty for part, empty in zip(found, none))


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(order: list[int], prefixes: list[int], least: int):
    """The common-prefix interval tree, bottom up: (length, members) of every interval.

    ``prefixes[i]`` is the common prefix of ``order[i]`` and ``order[i + 1]``. The stack
    holds the open intervals as (length, first place).
    """
    stack: list[tuple[int, int]] = []
    for place, length in enumerate([*prefixes, -1]):
        first = place
        while stack and stack[-1][0] > length:
            held, first = stack.pop()
            if held >= least:
                yield held, order[first:place + 1]
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int = LEAST):
    """(bytes before the anchor, bytes from it, members) of each maximal repeat of contexts.

    ``lefts`` are read backwards from the anchor. Members of a right interval differ in
    their next byte; those of a left interval inside it in the byte before.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    prefixes = [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    for length, members in intervals(order, prefixes, GRAM):
        members = sorted(members, key=lefts.__getitem__)
        before = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for left, group in intervals(members, before, max(0, least - length)):
            yield left, length, group


def covers(lefts: list[bytes], rights: list[bytes], least: int = LEAST) -> list[tuple[int, int]]:
    """Bytes before and from the anchor of each context that lie in a repeat; (0, 0) without one."""
    best = [(0, 0)] * len(lefts)
    for left, right, group in maximal_repeats(lefts, rights, least):
        for member in group:
            a, b = best[member]
            best[member] = (max(a, left), max(b, right))
    return best


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(text or "").encode("utf-8") for text in texts]


ANCHORS = "anchor bigint, context bigint, text bigint, place bigint, known boolean"


def all_anchors(docs: DataFrame) -> DataFrame:
    """``anchor``, ``context``, ``text``, ``place``, ``known`` of all texts; copies in one task count once.

    An anchor that a task sees twice is known to be shared. Its rows need not meet those of
    other tasks; one more row, the witness (place -1), stands for them there. So a hot
    anchor sends no more than a row per window and the few single ones.
    """

    def run(batches):
        seen: set[int] = set()
        parts: list[list[np.ndarray]] = [[], [], [], []]
        waiting = 0

        def give():
            anchor, context, text, place = (np.concatenate(part) for part in parts)
            order = np.argsort(anchor, kind="stable")
            anchor, context, text, place = anchor[order], context[order], text[order], place[order]
            same = anchor[1:] == anchor[:-1]
            known = np.zeros(len(anchor), dtype=bool)
            known[1:] |= same
            known[:-1] |= same
            first = known & np.concatenate([[True], ~same])
            columns = [np.concatenate([anchor, anchor[first]]), np.concatenate([context, np.zeros(first.sum(), np.int64)]),
                       np.concatenate([text, np.zeros(first.sum(), np.int64)]), np.concatenate([place, np.full(first.sum(), -1)]),
                       np.concatenate([known, np.zeros(first.sum(), bool)])]
            yield pa.record_batch([pa.array(column) for column in columns],
                                  names=["anchor", "context", "text", "place", "known"])

        for batch in batches:
            for data, key in zip(_bytes(strings(batch.column(0))), batch.column(1).to_pylist()):
                if len(data) < LEAST or key in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                gram, context, place = anchors(data)
                for part, values in zip(parts, (gram.view(np.int64), context.view(np.int64),
                                                np.full(len(place), key, np.int64), place)):
                    part.append(values)
                waiting += len(place)
                if waiting >= WINDOW:
                    yield from give()
                    parts, waiting = [[], [], [], []], 0
        if waiting:
            yield from give()

    return docs.select("text", text_key("text")).mapInArrow(run, ANCHORS)


def shared_only(found: DataFrame) -> DataFrame:
    """The rows whose anchor has another row, witnesses left out; a sorted stream that remembers one row."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [column.to_numpy() for column in batch.columns]
            if held is not None:
                columns = [np.concatenate([old, new]) for old, new in zip(held[0], columns)]
            same = columns[0][1:] == columns[0][:-1]
            several = np.zeros(len(columns[0]), dtype=bool)
            several[1:] |= same
            several[:-1] |= same
            give = several & (columns[3] >= 0)
            if held is not None and held[1]:
                several[0], give[0] = True, False
            held = ([column[-1:] for column in columns], bool(several[-1]))
            yield pa.record_batch([pa.array(column[give]) for column in columns], names=batch.schema.names)

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        run, "anchor bigint, context bigint, text bigint, place bigint")


def shared_anchors(docs: DataFrame) -> DataFrame:
    """``anchor``, ``context``, ``text``, ``place`` of every anchor that occurs twice or more."""
    found = settle(all_anchors(docs))
    return found.where("known").drop("known").union(settle(shared_only(found.where("not known").drop("known"))))


def fetched(open_: DataFrame, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``anchor``, ``context``, ``before`` (read backwards), ``after`` for one place of each open context.

    Rows that share id and text with another one give their contexts more than once.
    """
    wanted = settle(
        open_.join(firsts, "text").groupBy("doc_id", "text").agg(
            F.collect_list(F.struct("anchor", "context", "place")).alias("wanted"))
        .select(F.col("doc_id").alias("_id"), "text", "wanted"))
    few = (wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0) <= BROADCAST_ROWS
    shown = docs.select("doc_id", F.col("text").alias("shown"))
    if few:
        wanted = F.broadcast(wanted)
    else:  # texts of which nothing is wanted are not shuffled
        shown = with_filter(shown, key_filter(wanted, "_id"), "doc_id", "_asked").where("_asked").drop("_asked")
    held = shown.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).where(
        text_key("shown") == F.col("text")).select("shown", "wanted")

    def work(batch):
        rows = []
        for data, places in zip(_bytes(strings(batch.column(0))), batch.column(1).to_pylist()):
            for item in places:
                at = item["place"]
                rows.append((item["anchor"], item["context"], data[max(0, at - REACH):at][::-1], data[at:at + LEAST]))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                              names=["anchor", "context", "before", "after"])

    return by_batch(held, "anchor bigint, context bigint, before binary, after binary", work)


COVER = "anchor bigint, context bigint, reach_left int, reach_right int"


def sorted_groups(contexts: DataFrame) -> DataFrame:
    """Covers of the contexts of each anchor by the interval tree; groups come one after another, a repeated row counts once."""

    def give(group):
        for reach, key in zip(covers([row[2] for row in group], [row[3] for row in group]), group):
            if reach[0] + reach[1] >= LEAST:
                yield key[0], key[1], *reach

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            rows = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[-1][0] != row[0]:
                    rows.extend(give(held))
                    held = []
                if not held or held[-1][1] != row[1]:
                    held.append(row)
            yield _cover_batch(rows)
        yield _cover_batch(list(give(held)) if held else [])

    return contexts.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(run, COVER)


def counted_groups(contexts: DataFrame) -> DataFrame:
    """The same covers for anchors of any number of contexts: counts of hashed strings."""

    def strings_of(batch):
        parts = [[], [], [], []]
        for anchor, context, before, after in zip(*(column.to_pylist() for column in batch.columns)):
            data = before[::-1] + after
            count = len(data) - LEAST + 1
            if count <= 0:
                continue
            starts = np.arange(count)
            # only strings that hold the whole anchor
            starts = starts[(starts <= len(before)) & (starts + LEAST >= len(before) + GRAM)]
            hashed = Hashes(data).of(starts, starts + LEAST)
            shift = len(before) - starts
            for part, values in zip(parts, (np.full(len(starts), anchor), np.full(len(starts), context), shift,
                                            mix(hashed + shift.astype(np.uint64)).view(np.int64))):
                part.append(values)
        if parts[0]:
            yield pa.record_batch([pa.array(np.concatenate(part).astype(np.int64)) for part in parts],
                                  names=["anchor", "context", "shift", "string"])

    once = contexts.dropDuplicates(["anchor", "context"])
    every = settle(by_batch(once, "anchor bigint, context bigint, shift bigint, string bigint", strings_of))
    repeated = every.groupBy("anchor", "string").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "string")
    return every.join(repeated, ["anchor", "string"]).groupBy("anchor", "context").agg(
        F.max("shift").cast("int").alias("reach_left"), (LEAST - F.min("shift")).cast("int").alias("reach_right"))


def _cover_batch(rows):
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                           names=["anchor", "context", "reach_left", "reach_right"])


def repeated_spans(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``text``, ``spans``: places and reaches of repeats per text (sorted, may overlap)."""
    shared = shared_anchors(docs)
    contexts = settle(shared.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("text", "place")).alias("one")))
    per_anchor = contexts.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    open_ = settle(contexts.join(per_anchor, "anchor").select(
        "anchor", "context", F.col("one.text").alias("text"), F.col("one.place").alias("place"), "contexts"))
    partly = sorted_groups(fetched(open_.where(F.col("contexts") <= GROUP).drop("contexts"), docs, firsts))
    large = open_.where(F.col("contexts") > GROUP).drop("contexts")
    if not large.isEmpty():
        partly = partly.union(counted_groups(fetched(large, docs, firsts)))
    whole = contexts.where("n > 1").select(
        "anchor", "context", F.lit(REACH).alias("reach_left"), F.lit(LEAST).alias("reach_right"), "n")
    reach = settle(partly.withColumn("n", F.lit(1)).union(whole).groupBy("anchor", "context").agg(
        F.max("reach_left").alias("reach_left"), F.max("reach_right").alias("reach_right"), F.max("n").alias("n")))
    return attach(shared, reach, ["anchor", "context"], "n", F.col("place"), how="inner").select(
        "text", F.greatest(F.col("place") - F.col("reach_left"), F.lit(0)).alias("start"),
        (F.col("place") + F.col("reach_right")).alias("stop")).distinct().groupBy("text").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def merged(spans, size: int) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    runs: list[list[int]] = []
    for start, stop in spans:
        stop = min(stop, size)
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return [(a, b) for a, b in runs]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``n_bytes``, ``n_removed``, ``n_spans``, ``removed`` (start:end list), ``kept_sha256``."""
    prepare(docs.sparkSession)
    small = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(small.dtypes)["doc_id"]

    texts = settle(small.select(
        text_key("text").alias("text"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"))
        .groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.any_value("size").alias("size")))
    spans = repeated_spans(small, texts.select("text", "doc_id"))
    copied = texts.where((F.col("copies") > 1) & (F.col("size") >= LEAST)).select(
        "text", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("size").alias("stop"))).alias("whole"))
    marked = settle(spans.join(copied, "text", "full").select(
        F.col("text").alias("_text"), F.coalesce("whole", "spans").alias("_spans")))

    # only texts that may lose something are shuffled
    keyed = with_filter(small.withColumn("_key", text_key("text")), key_filter(marked, "_text"), "_key", "_touched")
    joined = keyed.where("_touched").join(marked, F.col("_key") == F.col("_text"), "left").select(
        "doc_id", "text", "_spans").union(keyed.where("not _touched").select(
            "doc_id", "text", F.lit(None).cast(marked.schema["_spans"].dataType).alias("_spans")))

    def report(batch):
        rows = []
        for data, found in zip(_bytes(strings(batch.column(1))), batch.column(2).to_pylist()):
            runs = merged([(s["start"], s["stop"]) for s in found or []], len(data))
            edges = [0, *[edge for run in runs for edge in run], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2]))
            rows.append((len(data), len(data) - len(kept), len(runs), ",".join(f"{a}:{b}" for a, b in runs), sha(kept)))
        size, gone, count, listed, kept = zip(*rows)
        yield pa.record_batch(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()),
             pa.array(listed, pa.string()), pa.array(kept, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "removed", "kept_sha256"])

    return by_batch(joined, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, removed string, "
                    "kept_sha256 string", report)
