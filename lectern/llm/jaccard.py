"""N-gram Jaccard join: all pairs of documents whose shingle sets overlap enough.

A document is its set of distinct five-word shingles, as 64-bit hashes in order. Rows with
equal sets form one class; everything below is about classes.

1. Every class gets a few minimum hashes. Classes that share one are checked against the
   smallest class of their group, exactly; the links found join classes into groups. This
   costs a row per class and hash, also in a huge group of near copies.
2. The exact candidate search. Shingles are ordered by how often they recur (hashed counts
   over the corpus in a table of fixed size), rarest first. Two sets that reach the
   threshold share a shingle among the first  n - ceil(0.75 n) + 1  of each, and the first
   one they share leaves enough of both sets behind it. A tile holds the classes with one
   such shingle and one size band (sizes within 3:4 of each other meet in a band); a tile
   with many rows is cut into pairs of blocks. Pairs inside a tile that step 1 already
   joined need no more work, nor do those that share one of the two shared shingles before
   this one: they are seen in an earlier tile.
3. Each class has a bitmap of hashed shingles. A shingle whose bit is not set in the other
   bitmap is not in the other set, so bit counts bound the overlap from above. A folded
   bitmap goes into the tiles, so that only pairs leave them that may still reach the
   threshold; the full ones are asked next, and what remains is decided by intersecting
   the sorted arrays. A tile with more such pairs than members (texts that are all nearly
   near enough) sends its members instead: a second tile takes their texts, intersects the
   sets itself, and gives only which groups it joined. So the rows of this step grow with
   the members of the tiles, not with their pairs.
4. Components of all links.

No link between different sets is lost: step 1 only adds exact links, step 2 is complete
for pairs in different groups. Shingle hashes and class keys have 64 bits.

Defined results: null and empty texts, and texts of white space, have no shingles and are
linked with nothing; their component is their own id. Fewer than five words are one
shingle. Components carry the smallest id; a null id is larger than any id, and a
component of null ids only has a null one. Repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import BLANKS, by_batch, concatenated, free_names, mix, prepare, settle, strings
from lectern.llm.graph import components

WORDS = 5
# the threshold as a fraction of integers: NUMERATOR / DENOMINATOR
NUMERATOR, DENOMINATOR = 3, 4
MIN_HASHES = 8
BUCKETS, CHUNKS = 1 << 20, 64     # the table of hashed counts, and the parts it is merged in
WINDOW = 1 << 22                  # shingles that are counted together
TILE_ROWS = 2048                  # rows of a block of a tile
PART_SHINGLES = 1 << 20           # shingles that one side of a tile of texts holds at once
BROADCAST_ROWS = 1_000_000        # most keys (8 bytes each) that are sent to every executor
SEEN = 200_000                    # class keys a task remembers to skip copies; speed alone

_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _constants():
    draw = np.random.default_rng(20240229)
    bytes_ = draw.integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
    places = draw.integers(1, 2 ** 63, WORDS, dtype=np.uint64) | np.uint64(1)
    seeds = draw.integers(1, 2 ** 63, MIN_HASHES, dtype=np.uint64)
    return bytes_, places, seeds


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < count:
        size = max(count, 1 << 16)
        for at, factor in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            line = np.full(size, factor, dtype=np.uint64)
            line[0] = 1
            _powers[at] = np.cumprod(line, dtype=np.uint64)
    return _powers[0], _powers[1]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    if not texts:
        return []
    if sum(map(len, texts)) > 1 << 23 and len(texts) > 1:  # bounded work arrays
        half = len(texts) // 2
        return shingle_sets(texts[:half]) + shingle_sets(texts[half:])
    flat, offsets = concatenated([text + b" " for text in texts])
    byte_values, places, _ = _constants()
    blank = _BLANK[flat]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = _power(len(flat))
    total = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum(byte_values[_SMALL[flat]] * power[:len(flat)], out=total[1:])
    words = mix((total[ends] - total[starts]) * inverse[starts])
    bounds = np.searchsorted(starts, offsets)
    count = len(words) - WORDS + 1
    if count > 0:
        joined = words[:count] * places[0]
        for at in range(1, WORDS):
            joined = joined + words[at:at + count] * places[at]
        joined = mix(joined)
    sets = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= WORDS:
            sets.append(np.unique(joined[first:last - WORDS + 1]))
        elif last > first:
            short = (words[first:last] * places[:last - first]).sum(dtype=np.uint64) + np.uint64(last - first)
            sets.append(mix(np.array([short], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def class_of(shingles: np.ndarray) -> int:
    """Key of the set: a signed 64-bit digest."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray) -> bytes:
    """A power of two of bits, at least twice the size of the set, one bit set per shingle."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    line = np.zeros(bits, dtype=np.uint8)
    line[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(line, bitorder="little").tobytes()


def _folded(data: np.ndarray, size: int) -> np.ndarray:
    return data if len(data) == size else np.bitwise_or.reduce(data.reshape(-1, size), axis=0)


def overlap_bound(left: bytes, right: bytes, n_left: int, n_right: int) -> int:
    """No two sets with these bitmaps have more in common."""
    a, b = np.frombuffer(left, dtype=np.uint8), np.frombuffer(right, dtype=np.uint8)
    size = min(len(a), len(b))
    a_own, b_own = _folded(a, size), _folded(b, size)
    only_left = int(np.bitwise_count(a_own & ~b_own).sum())
    only_right = int(np.bitwise_count(b_own & ~a_own).sum())
    return min(n_left - only_left, n_right - only_right)


def linked(common: int, n_left: int, n_right: int) -> bool:
    """Also for arrays: whether the overlap reaches the threshold."""
    return (DENOMINATOR + NUMERATOR) * common >= NUMERATOR * (n_left + n_right)


SUMMARY = ("doc_id bigint, class bigint, n bigint, marks array<bigint>, bits binary, chunk int, counts binary")


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(text or "").encode("utf-8") for text in texts]


def summaries(docs: DataFrame) -> DataFrame:
    """One pass over the texts: a row per document, and each task's hashed counts in rows with a ``chunk``."""

    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.uint32)
        seeds = _constants()[2]
        window, waiting = [], 0

        def count_window():
            # shingles of a single document in the window say nothing and would hide the others
            values, times = np.unique(np.concatenate(window), return_counts=True)
            again = times > 1
            np.add.at(counts, (values[again] >> np.uint64(44)).astype(np.int64), times[again].astype(np.uint32))

        for batch in batches:
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), shingle_sets(_bytes(strings(batch.column(1))))):
                if not len(found):
                    rows.append((doc, None, 0, None, None))
                    continue
                window.append(found)
                waiting += len(found)
                if waiting >= WINDOW:
                    count_window()
                    window, waiting = [], 0
                marks = [int(mix(found ^ seed).min().view(np.int64)) for seed in seeds]
                rows.append((doc, class_of(found), len(found), marks, bitmap(found)))
            doc, key, n, marks, bits = zip(*rows) if rows else ([],) * 5
            none = pa.nulls(len(rows), pa.int32())
            yield pa.record_batch(
                [pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(marks, pa.list_(pa.int64())), pa.array(bits, pa.binary()), none, pa.nulls(len(rows), pa.binary())],
                names=["doc_id", "class", "n", "marks", "bits", "chunk", "counts"])
        if window:
            count_window()
        parts = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(CHUNKS, -1)]
        empty = [pa.nulls(CHUNKS, kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())]
        yield pa.record_batch(
            [*empty, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())],
            names=["doc_id", "class", "n", "marks", "bits", "chunk", "counts"])

    return docs.mapInArrow(run, SUMMARY)


def frequency_levels(summed: DataFrame) -> np.ndarray:
    """Rough logarithm of the hashed counts: BUCKETS bytes, whatever the corpus."""

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(data), dtype=np.uint32).astype(np.uint64)
                held[chunk] = held[chunk] + part if chunk in held else part
        for chunk, part in held.items():
            level = np.floor(4 * np.log2(part.astype(np.float64) + 1)).astype(np.uint8)
            yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                  names=["chunk", "level"])

    parts = summed.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    levels = np.zeros((CHUNKS, BUCKETS // CHUNKS), dtype=np.uint8)
    for row in parts.mapInArrow(merge, "chunk int, level binary").collect():
        levels[row.chunk] = np.frombuffer(row.level, dtype=np.uint8)
    return levels.reshape(-1)


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def prefixes(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """``token``, ``class``, ``form``: the rarest shingles of every set, as many as the threshold asks.

    ``form`` is the size of the set, shifted by 31 bits, plus the place of the shingle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        level, seen = shared.value, set()
        for batch in batches:
            tokens, keys, sizes = [], [], []
            for found in shingle_sets(_bytes(strings(batch.column(0)))):
                if not len(found):
                    continue
                key = class_of(found)
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                order = np.lexsort((found, level[(found >> np.uint64(44)).astype(np.int64)]))
                chosen = found[order[:prefix_length(len(found))]]
                tokens.append(chosen)
                keys.append(np.full(len(chosen), key, dtype=np.int64))
                sizes.append((len(found) << 31) + np.arange(len(chosen), dtype=np.int64))
            if tokens:
                yield pa.record_batch(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(keys)),
                     pa.array(np.concatenate(sizes))], names=["token", "class", "form"])

    return docs.select("text").mapInArrow(run, "token bigint, class bigint, form bigint")


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.append(starts[1:], len(keys))


def shared_only(tokens: DataFrame) -> DataFrame:
    """The rows whose token occurs in two classes or more, each class once.

    Rows come sorted by token and class; a task remembers only the last row and whether
    it was given, so a hot token takes no memory.
    """

    def run(batches):
        held = None  # (token, class, n, given) of the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            token, key, n = (batch.column(at).to_numpy() for at in range(3))
            if held is not None:
                token, key, n = (np.concatenate([[old], new]) for old, new in zip(held[:3], (token, key, n)))
            fresh = np.ones(len(token), dtype=bool)
            fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            first_given = held is not None and held[3]
            token, key, n = token[fresh], key[fresh], n[fresh]
            same = token[1:] == token[:-1]
            shared = np.zeros(len(token), dtype=bool)
            shared[1:] |= same
            shared[:-1] |= same
            if first_given:
                shared[0] = True
            give = shared.copy()
            if first_given:
                give[0] = False
            last = len(token) - 1
            held = (token[last], key[last], n[last], bool(shared[last]))
            yield pa.record_batch([pa.array(token[give]), pa.array(key[give]), pa.array(n[give])],
                                  names=["token", "class", "form"])

    return tokens.repartition("token").sortWithinPartitions("token", "class").mapInArrow(
        run, "token bigint, class bigint, form bigint")


class _Bitmaps:
    """The bitmaps of a tile as rows of 64-bit words, folded to each length that pairs ask for."""

    def __init__(self, data: list[bytes]):
        self.data, self.sizes, self.levels = data, np.fromiter(map(len, data), dtype=np.int64, count=len(data)), {}

    def level(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Row of every member (those of this length and of twice it), and the words."""
        if size not in self.levels:
            members = np.flatnonzero((self.sizes == size) | (self.sizes == 2 * size))
            row = np.full(len(self.data), -1, dtype=np.int64)
            row[members] = np.arange(len(members))
            words = np.stack([_folded(np.frombuffer(self.data[at], dtype=np.uint8), size) for at in members.tolist()])
            self.levels[size] = row, np.ascontiguousarray(words).view(np.uint64)
        return self.levels[size]

    def room(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Upper bound of the overlap of each pair; fitting sizes have lengths at most a factor of two apart."""
        found, size = np.zeros(len(a), dtype=np.int64), np.minimum(self.sizes[a], self.sizes[b])
        for level in np.unique(size).tolist():
            some = np.flatnonzero(size == level)
            row, words = self.level(level)
            for part in range(0, len(some), max(1, (1 << 22) // level)):
                at = some[part:part + max(1, (1 << 22) // level)]
                left, right = words[row[a[at]]], words[row[b[at]]]
                both = left & right
                only_a = np.bitwise_count(left ^ both).sum(axis=1, dtype=np.int64)
                only_b = np.bitwise_count(right ^ both).sum(axis=1, dtype=np.int64)
                found[at] = np.minimum(n[a[at]] - only_a, n[b[at]] - only_b)
        return found


class _Sets:
    """The sets of a tile; ``room`` is the overlap itself where the bitmaps leave enough, else their bound."""

    def __init__(self, sets: list[np.ndarray]):
        self.maps = _Bitmaps([bitmap(found) for found in sets])
        vocabulary, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.offsets = np.cumsum([0, *map(len, sets)])
        self.present = np.zeros(len(vocabulary), dtype=bool)

    def _own(self, at: int) -> np.ndarray:
        return self.place[self.offsets[at]:self.offsets[at + 1]]

    def room(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        found = self.maps.room(a, b, n)
        some = np.flatnonzero(linked(found, n[a], n[b]))
        some = some[np.argsort(a[some], kind="stable")]
        for first, last in zip(*_runs(a[some])) if len(some) else ():
            at = some[first:last]
            mine, others = self._own(a[at[0]]), b[at]
            self.present[mine] = True
            inside = self.present[np.concatenate([self._own(other) for other in others.tolist()])]
            found[at] = np.add.reduceat(inside, np.cumsum(n[others]) - n[others], dtype=np.int64)
            self.present[mine] = False
        return found


def _tile(columns: list[np.ndarray], maps: _Bitmaps | _Sets):
    """Pairs of one tile, as places: columns low, high, block, upper, class, n, root, place, before, further.

    The caller may join groups in ``root`` between the pairs it gets.
    """
    low, high, of_block, upper, key, n, root, place, before, further = columns
    left_over = n - place
    for at in range(0, len(key), 512):
        some = slice(at, at + 512)
        fits = (root[some, None] != root[None, :]) & (key[some, None] < key[None, :])
        fits &= upper[some, None] | upper[None, :]
        # the first shared shingle must leave room, and so must the sizes
        fits &= linked(np.minimum(left_over[some, None], left_over[None, :]), n[some, None], n[None, :])
        if low[0] != high[0]:
            fits &= of_block[some, None] != of_block[None, :]
        # an earlier shared shingle has a tile of its own, where this pair is seen
        for mine in (before, further):
            for other in (before, further):
                fits &= (mine[some, None] != other[None, :]) | (mine[some, None] == 0)
        rows, others = np.nonzero(fits)
        a, b = rows + at, others
        near = linked(maps.room(a, b, n), n[a], n[b]) if len(a) else np.zeros(0, bool)
        if near.any():
            yield a[near], b[near]


def _parts(low: np.ndarray, high: np.ndarray, of_block: np.ndarray, n: np.ndarray):
    """(low, high, members, their blocks): cells of at most PART_SHINGLES a side that hold every pair of a tile."""
    part = np.zeros(len(n), dtype=np.int64)
    sides = [of_block == block for block in np.unique(of_block)]
    for side in sides:
        part[side] = np.cumsum(n[side]) // PART_SHINGLES
    if low[0] == high[0]:
        for first in range(part.max() + 1):
            for second in range(first, part.max() + 1):
                members = np.flatnonzero((part == first) | (part == second))
                yield first, second, members, part[members]
    elif len(sides) == 2:  # the members of one block meet in a tile of their own
        for first in range(part[sides[0]].max() + 1):
            for second in range(part[sides[1]].max() + 1):
                members = np.flatnonzero(np.where(sides[0], part == first, part == second))
                yield 2 * first, 2 * second + 1, members, sides[1][members].astype(np.int64)


MEMBER = ["token", "band", "low", "high", "cell", "other", "block", "upper", "a", "n", "root", "place", "before", "further"]
FOUND = pa.schema([(name, pa.int64()) for name in [*MEMBER, "b"]])


def _tiles(batches, columns: int, keys: int, group: int):
    """The rows of each run of equal ``keys`` first columns that holds several groups: arrays, and a list of the last column."""
    def joined(parts):
        return [*(np.concatenate(p) for p in list(zip(*parts))[:-1]), [item for part in parts for item in part[-1]]]

    def give(held):
        starts, ends = _runs(np.rec.fromarrays(held[:keys]))
        root = held[group]
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a > 1 and (root[a:b] != root[a]).any():
                yield [column[a:b] for column in held]

    held: list[list] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        read = [*(batch.column(at).to_numpy() for at in range(columns - 1)), batch.column(columns - 1).to_pylist()]
        cut = int(_runs(np.rec.fromarrays(read[:keys]))[0][-1])
        if cut == 0 and held and all(h[0] == c[0] for h, c in zip(held[-1][:keys], read[:keys])):
            held.append(read)
            continue
        head = [column[:cut] for column in read]
        if held or cut:
            yield from give(joined([*held, head]) if held else head)
        held = [[column[cut:] for column in read]]
    if held:
        yield from give(joined(held))


def tile_pairs(rows: DataFrame) -> DataFrame:
    """``a``, ``b``: pairs of classes in one tile that may reach the threshold, of different groups.

    ``rows``: token, class, n, place, root, before and further (the two shared shingles of the
    class before this one, 0 for none), bits, blocks. The rows of a token with several
    blocks go to every pair of blocks with their own. A size band spans a factor of eight;
    rows so near its upper end that larger sets of the next band can fit also go there.
    A tile with more pairs than members gives its members (``a``, and no ``b``) for ``crowded``.
    """
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(block, other).alias("low"), F.greatest(block, other).alias("high")))
    own = F.floor((F.length(F.bin("n")) - 1) / 3).cast("int")
    edge = F.pow(F.lit(8.0), F.col("own_band") + 1)
    reaches = F.col("n") * DENOMINATOR >= edge * NUMERATOR
    bands = F.when(reaches, F.array(F.col("own_band"), F.col("own_band") + 1)).otherwise(F.array("own_band"))
    dealt = (
        rows.withColumn("own_band", own).withColumn("block", block)
        .withColumn("cell", F.explode(cells)).withColumn("band", F.explode(bands))
        .select("token", "band", F.col("cell.low").alias("low"), F.col("cell.high").alias("high"), "block", "own_band",
                "class", "n", "root", "place", "before", "further", "bits"))
    dealt = dealt.repartition("token", "band", "low", "high").sortWithinPartitions("token", "band", "low", "high")

    def members(columns):
        token, band, low, high, of_block, own_band, *rest = columns
        for first, second, some, side in _parts(low, high, of_block, rest[1]):
            given = [token, band, low, high, np.full(len(token), first), np.full(len(token), second)]
            given = [column[some] for column in given] + [side, (own_band == band)[some], *(column[some] for column in rest)]
            arrays = [pa.array(column.astype(np.int64)) for column in given]
            yield pa.record_batch([*arrays, pa.nulls(len(some), pa.int64())], schema=FOUND)

    def run(batches):
        found, waiting = [], 0
        for *numbers, bits in _tiles(batches, 13, 4, 8):
            token, band, low, high, of_block, own_band, key, n, root, *rest = numbers
            mine, count = [], 0
            for a, b in _tile([low, high, of_block, own_band == band, key, n, root, *rest], _Bitmaps(bits)):
                mine.append((key[a], key[b]))
                count += len(a)
                if count > len(key):
                    yield from members(numbers)
                    break
            else:
                found, waiting = found + mine, waiting + count
            if waiting > 100_000:
                yield _pair_batch(found)
                found, waiting = [], 0
        if found:
            yield _pair_batch(found)

    return dealt.mapInArrow(run, ", ".join(f"{name} bigint" for name in FOUND.names))


def crowded(members: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``u``, ``v``: joined groups, by the sets of the members of tiles with many pairs."""
    texts = class_texts(members.select(F.col("a").alias("class")), docs, classes)
    cell = MEMBER[:6]
    dealt = members.drop("b").join(texts.withColumnRenamed("class", "a"), "a").select(*MEMBER, "text")
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell)

    def run(batches):
        for columns in _tiles(batches, len(MEMBER) + 1, len(cell), MEMBER.index("root")):
            first, second, of_block, upper, key, n, root, *rest = columns[4:-1]
            sets, root = _Sets(shingle_sets(_bytes(columns[-1]))), root.copy()
            before = root.copy()
            for a, b in _tile([first, second, of_block, upper == 1, key, n, root, *rest], sets):
                root[:] = _joined(root, root[a], root[b])
            edges = np.unique(np.column_stack([before, root])[before != root], axis=0)
            yield pa.record_batch([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], names=["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def _joined(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``root`` after joining the groups ``left`` and ``right``, named by the smallest."""
    over: dict[int, int] = {}

    def top(name):
        while name in over:
            name = over[name]
        return name

    for a, b in np.unique(np.column_stack([left, right]), axis=0).tolist():
        a, b = top(a), top(b)
        if a != b:
            over[max(a, b)] = min(a, b)
    names, place = np.unique(root, return_inverse=True)
    return np.array([top(name) for name in names.tolist()], dtype=np.int64)[place]


@F.pandas_udf(T.BinaryType())
def folded(bits: pd.Series) -> pd.Series:
    """Bitmaps of half the length, at least 64 bits, for the tiles."""
    return bits.map(lambda data: _folded(np.frombuffer(data, dtype=np.uint8), max(8, len(data) // 2)).tobytes())


def _pair_batch(found):
    pairs = np.unique(np.column_stack([np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])]), axis=0)
    held = {"a": pa.array(pairs[:, 0].copy()), "b": pa.array(pairs[:, 1].copy())}
    return pa.record_batch([held.get(name, pa.nulls(len(pairs), pa.int64())) for name in FOUND.names], schema=FOUND)


def bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes and bitmaps leave room for the threshold."""
    def side(name):
        return classes.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    def work(batch):
        columns = [column.to_pylist() for column in batch.columns]
        kept = [linked(overlap_bound(ba, bb, na, nb), na, nb) for na, ba, nb, bb in zip(*columns[2:])]
        yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(
        (F.lit(DENOMINATOR) * F.least("n_a", "n_b") >= F.lit(NUMERATOR) * F.greatest("n_a", "n_b")))
    return by_batch(joined.select("a", "b", "n_a", "bits_a", "n_b", "bits_b"), "a bigint, b bigint", work)


def class_texts(wanted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``class`` and ``text``: one text of every wanted class.

    Only these texts travel. Their ids are sent to the scan while there are at most
    BROADCAST_ROWS of them; beyond that the texts are joined by id.
    """
    needed = settle(wanted.distinct().join(classes.select("class", "first_id"), "class"))
    keys = needed.select(F.col("first_id").alias("_id"), F.col("class").alias("_class"))
    if needed.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    found = docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_id"))).select("_class", "text")

    def same_class(batch):
        sets = shingle_sets(_bytes(strings(batch.column(1))))
        kept = [len(s) > 0 and class_of(s) == key for s, key in zip(sets, batch.column(0).to_pylist())]
        yield pa.record_batch(batch.columns, names=["class", "text"]).filter(pa.array(kept, pa.bool_()))

    return settle(by_batch(found, "class bigint, text string", same_class).dropDuplicates(["class"]))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``u``, ``v``, ``common``: the pairs whose sets reach the threshold, by the sets themselves."""
    texts = class_texts(pairs.select(F.col("a").alias("class")).union(pairs.select("b")), docs, classes)

    def side(name):
        return texts.select(F.col("class").alias(name), F.col("text").alias(f"text_{name}"))

    def check(batch):
        left, right = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        known: dict[int, str] = {}
        for keys_, column in ((left, batch.column(2)), (right, batch.column(3))):
            for at, key in enumerate(keys_):
                if key not in known:
                    known[key] = column[at].as_py()
        sets = dict(zip(known, shingle_sets(_bytes(list(known.values())))))
        rows = []
        for a, b in zip(left, right):
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if linked(common, len(sets[a]), len(sets[b])):
                rows.append((a, b, common))
        u, v, common = zip(*rows) if rows else ([], [], [])
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(common, pa.int64())],
                              names=["u", "v", "common"])

    return by_batch(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b"),
                    "u bigint, v bigint, common bigint", check)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``class`` of every row."""
    spark: SparkSession = prepare(docs.sparkSession)
    small = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    summed = settle(summaries(small))
    rows = summed.where("chunk is null").select("doc_id", "class", "n")
    classes = settle(
        summed.where("class is not null").groupBy("class").agg(
            F.min("doc_id").alias("first_id"), F.any_value("n").alias("n"), F.any_value("marks").alias("marks"),
            F.any_value("bits").alias("bits")))

    # 1: links to the smallest class with the same minimum hash
    marked = classes.select("class", F.posexplode("marks").alias("which", "mark"))
    hubs = marked.groupBy("which", "mark").agg(F.min("class").alias("hub"), F.max("class").alias("last"))
    hubs = hubs.where("hub < last").select("which", "mark", "hub")
    stars = settle(bounded(
        marked.join(hubs, ["which", "mark"]).where("class <> hub")
        .select(F.col("hub").alias("a"), F.col("class").alias("b")).distinct(), classes))
    links = settle(verified(stars, small, classes).select("u", "v"))
    groups = settle(components(links))

    # 2 and 3: every other pair that can reach the threshold
    tokens = settle(shared_only(prefixes(small, frequency_levels(summed))))
    placed = tokens.join(groups.withColumnRenamed("node", "class"), "class", "left").select(
        "token", "class", F.shiftright("form", 31).alias("n"), F.col("form").bitwiseAND(F.lit((1 << 31) - 1)).alias("place"),
        F.coalesce("root", "class").alias("root"))
    in_set = Window.partitionBy("class").orderBy("place")
    placed = placed.select("*", F.lag("token", 1, 0).over(in_set).alias("before"), F.lag("token", 2, 0).over(in_set).alias("further"))
    open_ = placed.groupBy("token").agg(
        F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    blocks = F.ceil(F.col("rows") / TILE_ROWS).cast("int")
    tiles = placed.join(open_.select("token", blocks.alias("blocks")), "token").join(
        classes.select("class", folded("bits").alias("bits")), "class")
    found = settle(tile_pairs(tiles))
    more = settle(bounded(found.where("b is not null").select("a", "b").distinct(), classes))
    links = links.union(verified(more, small, classes).select("u", "v"))
    members = found.where("b is null")
    if not members.isEmpty():
        links = links.union(crowded(members, small, classes))

    # 4: components, named by the smallest id
    roots = settle(components(links)).withColumnRenamed("node", "class")
    named = classes.select("class", "first_id").join(roots, "class")
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = classes.select("class", "first_id").join(roots, "class", "left").join(names, "root", "left").select(
        "class", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    known = rows.where("class is not null").join(of_class, "class").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "class")
    alone = rows.where("class is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "class")
    return known.union(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, without the near copies: of each component the row with the smallest id.

    Equal smallest ids go to the smallest class key; rows that agree in id and set are one.
    Rows without shingles stay.
    """
    found = settle(join(docs, id_col, text_col))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("class").alias("class"))
    # null components hold null ids only; those are told apart by class
    group = F.when(F.col("component_id").isNull(), F.col("class"))
    first = found.where("class is not null").groupBy("component_id", group.alias("of")).agg(F.min(order).alias("first"))
    own, doc, keep = free_names(docs, "class", "id", "keep")
    keepers = first.select(F.col("first.id").alias(doc), F.col("first.class").alias(keep))
    text_at = docs.columns.index(text_col)

    def with_class(batch):
        sets = shingle_sets(_bytes(strings(batch.column(text_at))))
        key = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, key], names=[*batch.schema.names, own])

    keyed = by_batch(docs, T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())]), with_class)
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(keep))
    kept = keyed.where(F.col(own).isNotNull()).join(keepers, same, "left_semi").dropDuplicates([id_col, own])
    return kept.union(keyed.where(F.col(own).isNull())).drop(own)
