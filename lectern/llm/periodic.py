"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q, at least max(LEAST, 4 q)
words long, that no neighbouring word extends keeping period q. At scale B (1, 2, 4, ...)
the text is cut into blocks of B words. A run of a period q from B to 2 B - 1 holds a whole
block within its first B words, and the same block again q words later. So for each block
the distances d from B to 2 B - 1 at which it occurs again are looked for:

    sum (block[i] - text[start + d + i])^2  =  sum block^2 + sum text^2 - 2 sum block * text

is nought there. The products of all distances come from one number-theoretic transform
per block, exact modulo a prime, many blocks in one array. A nought is a seed: from it the
text is compared with itself d words on, in both directions, to the largest stretch. That
comparison is exact, so a sum that is a multiple of the prime without being nought costs
time only. Blocks that hold a word which does not come again within 2 B words cannot occur
again and are not transformed. A seed inside a known run whose period divides d is that
run again; everything else that reaches 4 d words is a run of its own, since a shorter
period would have to divide d.

Words become numbers per text. A text is one row and one call; its work is
n log^2 n at most, in arrays of bounded size.

Defined results: a null text has no words. A document without an id is not rewritten by
``rewritten``. Equal rows give equal results, one for each. Texts of fewer than LEAST
words have no run.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import by_batch, prepare, sha

LEAST, TIMES = 6, 4
#: 15 * 2^27 + 1, prime; 31 is a primitive root of it
PRIME, ROOT = 2013265921, 31
CHUNK = 1 << 19          # numbers in one array of transforms, about


# --- the transform ------------------------------------------------------------------------


_stages: dict[int, list[np.ndarray]] = {}


def _twiddles(size: int, inverse: bool) -> list[np.ndarray]:
    """Powers of the roots of unity of each level, from the whole size down to 2."""
    if (size, inverse) not in _stages:
        levels, length = [], size
        while length > 1:
            root = pow(ROOT, (PRIME - 1) // length, PRIME)
            if inverse:
                root = pow(root, PRIME - 2, PRIME)
            powers = np.ones(length // 2, dtype=np.int64)
            filled = 1
            while filled < length // 2:
                more = min(filled, length // 2 - filled)
                powers[filled:filled + more] = powers[:more] * pow(root, filled, PRIME) % PRIME
                filled += more
            levels.append(powers)
            length //= 2
        _stages[size, inverse] = levels
    return _stages[size, inverse]


def forward(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, its places in bit-reversed order."""
    count, size = rows.shape
    values = rows.reshape(count, 1, size)
    for powers in _twiddles(size, False):
        half = len(powers)
        pairs = values.reshape(count, -1, 2, half)
        left, right = pairs[:, :, 0, :], pairs[:, :, 1, :]
        total = left + right
        total -= PRIME * (total >= PRIME)
        values = np.stack([total, (left - right + PRIME) * powers % PRIME], axis=2)
    return values.reshape(count, size)


def backward(rows: np.ndarray) -> np.ndarray:
    """The inverse of ``forward``."""
    count, size = rows.shape
    values = rows
    for powers in reversed(_twiddles(size, True)):
        half = len(powers)
        pairs = values.reshape(count, -1, 2, half)
        left, right = pairs[:, :, 0, :], pairs[:, :, 1, :] * powers % PRIME
        total, rest = left + right, left - right
        total -= PRIME * (total >= PRIME)
        rest += PRIME * (rest < 0)
        values = np.stack([total, rest], axis=2)
    return values.reshape(count, size) * pow(size, PRIME - 2, PRIME) % PRIME


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For rows of B words and of 2 B - 1 following ones: the sum of squared differences, modulo
    the prime, at each of the B places of the window."""
    count, size = blocks.shape
    left = np.zeros((count, 2 * size), dtype=np.int64)
    right = np.zeros((count, 2 * size), dtype=np.int64)
    left[:, :size] = blocks[:, ::-1]
    right[:, :2 * size - 1] = windows
    products = backward(forward(left) * forward(right) % PRIME)[:, size - 1:2 * size - 1]
    squares = np.zeros((count, 2 * size), dtype=np.int64)
    np.cumsum(windows * windows % PRIME, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % PRIME).sum(axis=1, keepdims=True)
    return (own + squares[:, size:] - squares[:, :size] - 2 * products) % PRIME


# --- runs ---------------------------------------------------------------------------------


def numbers(words: list) -> np.ndarray:
    """Equal words get equal numbers from 1 on."""
    return pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) + 1


def next_place(values: np.ndarray) -> np.ndarray:
    """How many words later each word comes again; the text's length where it does not."""
    order = np.argsort(values, kind="stable")
    gap = np.full(len(values), len(values), dtype=np.int64)
    again = values[order[1:]] == values[order[:-1]]
    gap[order[:-1][again]] = np.diff(order)[again]
    return gap


def seeds_at(values: np.ndarray, gap: np.ndarray, size: int) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """(starts, distances) of blocks of ``size`` words that occur again ``size`` to 2 ``size`` - 1 words later."""
    whole = len(values) // size
    alive = np.flatnonzero(gap[:whole * size].reshape(whole, size).max(axis=1) < 2 * size) * size
    # past the end stands a number that no word has
    padded = np.concatenate([values, np.zeros(2 * size, dtype=np.int64)]) if len(alive) else values
    step = max(1, CHUNK // (2 * size))
    for at in range(0, len(alive), step):
        starts = alive[at:at + step]
        blocks = padded[starts[:, None] + np.arange(size)]
        windows = padded[np.minimum(starts[:, None] + size + np.arange(2 * size - 1), len(padded) - 1)]
        row, place = np.nonzero(squared_differences(blocks, windows) == 0)
        if len(row):
            yield starts[row], place + size


def _same_from(values: np.ndarray, start: int, distance: int) -> int:
    """The first place from ``start`` on where the text differs from itself ``distance`` later, or its last such place."""
    end, step = len(values) - distance, 64
    while start < end:
        stop = min(end, start + step)
        differs = values[start:stop] != values[start + distance:stop + distance]
        at = int(differs.argmax())
        if differs[at]:
            return start + at
        start, step = stop, step * 4
    return max(start, end)


def _same_until(values: np.ndarray, start: int, distance: int) -> int:
    """The smallest place from which on the text equals itself ``distance`` later up to ``start``."""
    step = 64
    while start > 0:
        low = max(0, start - step)
        differs = (values[low:start] != values[low + distance:start + distance])[::-1]
        at = int(differs.argmax())
        if differs[at]:
            return start - at
        start, step = low, step * 4
    return start


class _Known:
    """The runs found so far by period, and which words each period's runs cover."""

    def __init__(self):
        self.runs: list[tuple[int, int, int]] = []
        self.by_period: dict[int, list[tuple[int, int]]] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.runs.append((start, end - start, period))
        self.by_period.setdefault(period, []).append((start, end))

    def covers(self, starts: np.ndarray, ends: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether [start, end) lies in a run of a period that divides the given one."""
        found = np.zeros(len(starts), dtype=bool)
        for own, spans in self.by_period.items():
            spans = np.array(sorted(spans))
            at = np.searchsorted(spans[:, 0], starts, side="right") - 1
            inside = (at >= 0) & (ends <= spans[np.maximum(at, 0), 1])
            found |= inside & (period % own == 0)
        return found


def runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    known, size = _Known(), 1
    if len(values) < LEAST:
        return []
    gap = next_place(values)
    while TIMES * size <= len(values):
        found: dict[int, list[int]] = {}  # distance -> [end of the last stretch seen at it]
        for starts, distances in seeds_at(values, gap, size):
            fresh = ~known.covers(starts, starts + distances + size, distances)
            for start, distance in zip(starts[fresh].tolist(), distances[fresh].tolist()):
                if found.get(distance, -1) > start:
                    continue  # inside a stretch that was looked at
                low, high = _same_until(values, start, distance), _same_from(values, start, distance)
                found[distance] = high
                length = high - low + distance
                if high - start >= size and length >= max(LEAST, TIMES * distance):
                    place = np.array([low]), np.array([low + length]), np.array([distance])
                    if not known.covers(*place)[0]:
                        known.add(low, low + length, distance)
        size *= 2
    return sorted(known.runs, key=lambda run: (run[0], run[2]))


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """False for words that stand in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge)[:n] == 0


def rewritten(words: list, doc_id) -> list:
    """The words of a document after the rewriting by its id: one in ten becomes periodic from some word on."""
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n == 0 or h is None or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


RESULT = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string")
SPANS = "doc_id bigint, start bigint, length bigint, period bigint"


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: ``doc_id``, ``start`` (word number), ``length`` and ``period`` in words."""

    def work(batch: pa.RecordBatch):
        rows = [(doc, *run) for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                for run in runs(numbers(_words(text)))]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "period"])

    return by_batch(_documents(docs, id_col, text_col), SPANS, work)


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text``: the words that stay when each run keeps its first period, joined by spaces."""

    def work(batch: pa.RecordBatch):
        texts = []
        for text in batch["text"].to_pylist():
            words = _words(text)
            stays = kept(len(words), runs(numbers(words)))
            texts.append(b" ".join(w for w, s in zip(words, stays) if s).decode())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return by_batch(_documents(docs, id_col, text_col), "doc_id bigint, text string", work)


def described(words: list, found: list[tuple[int, int, int]]) -> tuple:
    """(number of runs, longest run's start, length, period and exponent, digest of the runs, digest of the kept words)."""
    best = min(found, key=lambda run: (-run[1], run[0], run[2]), default=None)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    if found:
        words = [word for word, stays in zip(words, kept(len(words), found)) if stays]
    return (len(found), *shown, sha("".join("%d,%d,%d\n" % run for run in found).encode()), sha(b" ".join(words)))


def of_rewritten(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the runs of its rewritten text: how many, the longest, and digests of all and of what stays."""
    names = [part.split()[0] for part in RESULT.split(", ")]

    def work(batch: pa.RecordBatch):
        rows = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            words = rewritten(_words(text), doc)
            rows.append((doc, *described(words, runs(numbers(words)))))
        types = [pa.int64()] * 6 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return by_batch(_documents(docs, id_col, text_col), RESULT, work)
