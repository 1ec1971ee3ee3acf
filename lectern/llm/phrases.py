"""Word phrases that stand out: frequent phrases of 2 to 3 words, counted by tries, scored by their weakest cut.

Texts are lower-cased (A to Z), split into pieces at `[.,;:!?\\x0A-\\x0D]` and those into
words `[^\\x20\\x09]+`; everything is counted per language. Words are known by 64-bit codes of
(language, word); the vocabulary shows whether two words share a code, in which case other
codes are drawn.

Level by level, phrases that can reach LEAST occurrences are found first (their parts all
do): each task lists the distinct phrases of its texts whose parts are frequent, with their
number up to LEAST, dealt by a hash to groups of bounded size, and those that reach LEAST over all tasks are candidates. Which parts are frequent is sent as a
bitmap of fixed size (2^26 bits of words, 2^27 of pairs); where codes share a bit it only
lets more phrases pass. The candidates are dealt by a hash to double-array tries of about
TRIE_ENTRIES phrases, each built by the task that uses it. The texts are read once more: every
occurrence that a bitmap of all candidates lets pass is dealt to the one trie that may hold it,
equal ones of a task together with their number. There numpy advances the states of many
phrases together, one digit of a word's number after the other, drops those that leave the
trie, and adds the numbers of the accepting ones: the sums are the exact counts. So the work
grows with the texts and not with the texts times the tries, and no trie is broadcast or
passes through the driver.

Counts go back to phrases by ``skew.attach``, so that a word or pair which begins very many
phrases is no single task. The score of a cut, floor(SCALE a^2 / (l r)), is taken in
decimals of 38 digits.

Defined results: a null text is empty, a null language is `und`, extra columns are left
aside, repeated rows count each, an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import mix, prepare, settle
from lectern.operators.skew import attach, shuffle_width

LEAST = 10                   # occurrences of a candidate
COVERED = 50                 # percent of a phrase's occurrences inside a longer one that drop it
TOP = 2000                   # phrases of a language in the report
SCALE = 1_000_000
BUNDLE_BYTES = 1 << 23       # text that is counted together in a task
SECTION_BYTES = 1 << 20      # text whose words are coded in one go
WORD_BITS, PAIR_BITS = 26, 27
CHECK_SEED = -1              # of the hash that tells words of one code apart
TRIE_ENTRIES, TRIE_LEAST = 1 << 17, 4096     # phrases of a trie, and the fewest that are worth one where tasks are free
TRIES_AT_ONCE = 32           # tries that a task has at most, one after another
GROUP_WORDS = 1 << 21        # words of all texts for each group that candidates are found in
LISTED_ROWS = 1 << 20        # phrases that a task lists before equal ones are put together
LIST_ROWS, TASKS_AT_ONCE = 4096, 64          # phrases of a list dealt to a trie, and lists (of any tasks) that are walked together
DIGIT = 11                   # bits of a word's number that one step of a trie reads; two steps a word
SYMBOLS = 1 << DIGIT

_WORD, _BLANK, _BREAK = 0, 1, 2
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(b" \t")] = _BLANK
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# --- words ----------------------------------------------------------------------------------


@dataclass
class Words:
    """The words of a bundle: codes, whether each follows the one before in its piece, where they stand."""

    codes: np.ndarray
    follows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: bytes
    texts: np.ndarray


def salt(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{lang}".encode(), digest_size=8).digest(), "little")


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base & (2 ** 64 - 1), dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_held: dict = {}


def _tables(seed: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if seed not in _held or len(_held[seed][0]) < count:
        base = salt("base", seed) | 1
        _held[seed] = _powers(base, count), _powers(pow(base, -1, 2 ** 64), count)
    return _held[seed]


def words_of(texts: list[bytes], salts: np.ndarray, seed: int) -> Words:
    lowered = [text.translate(_LOWER) for text in texts]
    data = b"\n".join([*lowered, b""])
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = _CLASS[raw]
    inside = kind == _WORD
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(raw) and inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    bounds = np.cumsum([len(text) + 1 for text in lowered])
    of_text = np.searchsorted(bounds, starts, side="right").astype(np.int32)
    breaks = np.flatnonzero(kind == _BREAK)
    piece = np.searchsorted(breaks, starts)
    del kind, inside, breaks
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = piece[1:] == piece[:-1]
    codes = mix(mix(word_hash(raw, starts, ends, seed)) ^ salts[of_text]).view(np.int64)
    return Words(codes, follows, starts, ends, data, of_text)


def word_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A polynomial of each word's bytes modulo 2^64, from running sums over sections of the text."""
    made = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        until = max(at + 1, int(np.searchsorted(starts, starts[at] + SECTION_BYTES)))
        low, high = starts[at], ends[until - 1]
        powers, inverse = _tables(seed, int(max(high - low, SECTION_BYTES)) + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * powers[:high - low], out=sums[1:])
        first, last = starts[at:until] - low, ends[at:until] - low
        made[at:until] = (sums[last] - sums[first]) * inverse[first]
        at = until
    return made


def bundles(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of about BUNDLE_BYTES of text at a time, and the language of each of their texts."""
    known: dict[str, int] = {}

    def bundle(texts, langs):
        for lang in set(langs) - set(known):
            known[lang] = salt(lang, seed)
        return words_of(texts, np.array([known[lang] for lang in langs], dtype=np.uint64), seed), langs

    texts, langs, size = [], [], 0
    for batch in batches:
        for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
            texts.append(text.encode())
            langs.append(lang)
            size += len(texts[-1]) + 1
            if size >= BUNDLE_BYTES:
                yield bundle(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield bundle(texts, langs)


def _batches(schema: pa.Schema, columns: list, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(column[at:at + rows], field.type) for column, field in zip(columns, schema)], schema=schema)


def vocabulary(texts: DataFrame, seed: int) -> DataFrame:
    """``lang``, ``word``, ``code`` and number ``f`` of every word."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("code", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for words, langs in bundles(batches, seed):
            check = word_hash(np.frombuffer(words.data, dtype=np.uint8), words.starts, words.ends, CHECK_SEED)
            order = np.argsort(words.codes, kind="stable")
            codes, check = words.codes[order], check[order]
            first = np.ones(len(order), dtype=bool)
            first[1:] = (codes[1:] != codes[:-1]) | (check[1:] != check[:-1])
            at = np.flatnonzero(first)
            n, codes, at = np.diff(np.append(at, len(order))), codes[at], order[at]
            shown = [words.data[s:e].decode() for s, e in zip(words.starts[at].tolist(), words.ends[at].tolist())]
            of = [langs[text] for text in words.texts[at].tolist()]
            yield from _batches(schema, [of, shown, codes, n])

    parts = texts.mapInArrow(run, "lang string, word string, code bigint, n bigint")
    return parts.groupBy("lang", "word", "code").agg(F.sum("n").alias("f"))


def coded_vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """The vocabulary, and the seed of codes that tell all its words apart.

    Words of one code are told apart by a second hash inside a task and by their letters
    between tasks, so each of them is a row of its own.
    """
    seed = 0
    while True:
        words = settle(vocabulary(texts, seed))
        shared = words.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        if not shared:
            return words, seed
        seed += 1


# --- candidates -----------------------------------------------------------------------------


def pair_key(left, right):
    """One 64-bit number of two codes; the order counts. Works on arrays and on columns."""
    if isinstance(left, Column):
        turned = F.shiftleft(right, 21).bitwiseOR(F.shiftrightunsigned(right, 43))
        return left.bitwiseXOR(turned)
    unsigned = right.view(np.uint64)
    return left ^ ((unsigned << np.uint64(21)) | (unsigned >> np.uint64(43))).view(np.int64)


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each key's last ``bits`` bits; never more than 2^bits of them, whatever the data."""
    place = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    cells = keys.select(F.shiftright(place, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(key & 63 as int))").alias("bit"))
    table = cells.groupBy("cell").agg(F.bit_or("bit").alias("held")).toArrow()
    made = np.zeros(1 << (bits - 6), dtype=np.int64)
    made[table["cell"].to_numpy()] = table["held"].to_numpy()
    return made.view(np.uint64)


def has(made: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    place = keys.view(np.uint64) & np.uint64((1 << bits) - 1)
    return (made[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def phrase_key(first, second, third):
    """The key of a phrase of three words, or of two with a zero after them (that of the pair)."""
    return pair_key(first, pair_key(second, third))


def distinct_rows(columns: list[np.ndarray], times: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of codes and how often each occurs (once a row, or ``times``)."""
    key = columns[-1]
    for column in columns[-2::-1]:
        key = pair_key(column, key)
    order = np.argsort(key, kind="stable")
    while True:
        held = [column[order] for column in columns]
        first = np.ones(len(order), dtype=bool)
        first[1:] = np.logical_or.reduce([column[1:] != column[:-1] for column in held])
        if key is None or not (first[1:] & (key[order[1:]] == key[order[:-1]])).any():
            break
        # rows that share a key could lie mixed
        key, order = None, np.lexsort(columns)
    at = np.flatnonzero(first)
    rows = [column[at] for column in held]
    if times is None or not len(at):
        return rows, np.diff(np.append(at, len(order)))
    return rows, np.add.reduceat(times[order], at)


def together(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Lists of phrases (columns of codes, and how often each occurs) as one, with equal ones once."""
    columns = [np.concatenate(column) for column in zip(*held)]
    rows, times = distinct_rows(columns[:-1], columns[-1])
    return [*rows, times]


def lists(texts: DataFrame, seed: int, find, groups: int, most: int | None = None) -> DataFrame:
    """``part``, ``words`` and ``list``: the phrases that ``find`` gives of the words of a bundle, dealt to ``groups`` parts.

    ``find`` gives columns of codes by the number of words. A list holds the codes of the first
    words of at most LIST_ROWS phrases, those of the second (and third), and how often each
    occurs (``most`` at most, if named). Equal phrases have one part.
    """
    schema = pa.schema([("part", pa.int64()), ("words", pa.int8()), ("list", pa.binary())])

    def cut(columns):
        *codes, times = columns
        third = codes[2] if len(codes) == 3 else np.zeros_like(codes[0])
        part = phrase_key(codes[0], codes[1], third) % groups
        order = np.lexsort((codes[0], part))       # equal first words together: shuffled lists are compressed
        part, columns = part[order], [column[order] for column in (*codes, times if most is None else np.minimum(times, most))]
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        cuts = [(at, min(at + LIST_ROWS, until)) for begin, until in zip(edges, edges[1:]) for at in range(begin, until, LIST_ROWS)]
        for first in range(0, len(cuts), TASKS_AT_ONCE):
            some = cuts[first:first + TASKS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([
                pa.array([part[begin] for begin, _ in some], pa.int64()), pa.array([len(codes)] * len(some), pa.int8()),
                pa.array([b"".join(column[begin:until].tobytes() for column in columns) for begin, until in some], pa.binary())],
                schema=schema)

    def run(batches):
        held: dict[int, list] = {}
        for words, _ in bundles(batches, seed):
            for length, codes in find(words).items():
                some = held.setdefault(length, [])
                some.append(together([[*codes, np.ones(len(codes[0]), dtype=np.int64)]]))
                if sum(len(one[0]) for one in some) > LISTED_ROWS:
                    one = together(some)
                    held[length] = [one]
                    if 2 * len(one[0]) > LISTED_ROWS:
                        yield from cut(one)
                        held[length] = []
        for some in held.values():
            if some:
                yield from cut(together(some))

    return texts.mapInArrow(run, "part bigint, words tinyint, list binary")


def read_list(one: bytes, words: int) -> np.ndarray:
    return np.frombuffer(one, dtype=np.int64).reshape(words + 1, -1)


def candidates(texts: DataFrame, seed: int, length: int, parts: np.ndarray, bits: int, total: int) -> DataFrame:
    """``c1`` to ``c3`` (``c3`` null for pairs) of the phrases of ``length`` words that reach LEAST; ``parts`` is the
    bitmap of the frequent phrases one word shorter, ``total`` the number of words.

    A group has the phrases of GROUP_WORDS words or so, so a task's memory does not grow with the texts.
    """
    sent = texts.sparkSession.sparkContext.broadcast(parts)
    groups = max(shuffle_width(texts), ceil(total / GROUP_WORDS))
    columns = [f"c{k + 1}" for k in range(length)]
    schema = pa.schema([(name, pa.int64()) for name in columns])

    def find(words):
        codes, follows = words.codes, words.follows
        if length == 2:
            good = has(sent.value, bits, codes)
            at = np.flatnonzero(follows[1:] & good[:-1] & good[1:])
        else:
            good = np.zeros(len(codes), dtype=bool)
            good[:-1] = follows[1:] & has(sent.value, bits, pair_key(codes[:-1], codes[1:]))
            at = np.flatnonzero(good[:-1] & good[1:])
        return {length: [codes[at + k] for k in range(length)]}

    def reached(batches):
        done, fresh, size = [], [], 0
        for batch in batches:
            for one in batch["list"].to_pylist():
                fresh.append(read_list(one, length))
                size += fresh[-1].shape[1]
                if size > max(LISTED_ROWS, len(done[0][0]) if done else 0):
                    done, fresh, size = [together([*done, *fresh])], [], 0
        if done or fresh:
            *codes, times = together([*done, *fresh])
            enough = times >= LEAST
            yield from _batches(schema, [code[enough] for code in codes])

    dealt_out = lists(texts, seed, find, groups, LEAST).repartitionById(groups, F.col("part").cast("int"))
    found = dealt_out.select("list").mapInArrow(reached, ", ".join(f"{name} bigint" for name in columns))
    return found.select(*columns, *([] if length == 3 else [F.lit(None).cast("bigint").alias("c3")]))


# --- tries ----------------------------------------------------------------------------------


@dataclass
class Trie:
    """A double array: from state s digit d leads to base[s] + d where check[] of that place is s."""

    alphabet: np.ndarray
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    first: int
    entries: int

    def number(self, codes: np.ndarray) -> np.ndarray:
        """Each word's number in the trie's alphabet, -1 for others."""
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at, -1)

    def count(self, codes: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """How often each entry occurs."""
        numbers = self.number(codes)
        counts = np.zeros(self.entries, dtype=np.int64)
        at = np.flatnonzero(numbers >= 0)
        state = np.zeros(len(at), dtype=np.int64)
        for depth in range(3):
            if depth:
                stays = at + depth < len(codes)
                at, state = at[stays], state[stays]
                stays = follows[at + depth] & (numbers[at + depth] >= 0)
                at, state = at[stays], state[stays]
            stays, state = self.advance(state, numbers[at + depth])
            at = at[stays]
            accepted = self.accept[state]
            counts += np.bincount(accepted[accepted >= 0], minlength=self.entries)
        return counts

    def advance(self, state: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states the word with that number leads on, and where to."""
        stays = np.arange(len(state))
        for shift in (DIGIT, 0):
            moved = self.base[state] + ((numbers[stays] >> shift) & (SYMBOLS - 1))
            good = self.check[moved] == state
            stays, state = stays[good], moved[good].astype(np.int64)
        return stays, state

    def tally(self, columns: list[np.ndarray], times: np.ndarray) -> np.ndarray:
        """How often each entry occurs among phrases, given by the codes of their first, second, ... words and their number."""
        state, at = np.zeros(len(times), dtype=np.int64), np.arange(len(times))
        for column in columns:
            numbers = self.number(column[at])
            known = numbers >= 0
            at, state, numbers = at[known], state[known], numbers[known]
            stays, state = self.advance(state, numbers)
            at = at[stays]
        counts, accepted = np.zeros(self.entries, dtype=np.int64), self.accept[state]
        np.add.at(counts, accepted[accepted >= 0], times[at[accepted >= 0]])
        return counts


def build(rows: np.ndarray, is_pair: np.ndarray, first: int) -> Trie:
    """The trie of phrases given as rows of three codes (the third unused for pairs), numbered from ``first``."""
    alphabet = np.unique(np.concatenate([rows[:, :2].ravel(), rows[~is_pair, 2]]))
    numbers = np.minimum(np.searchsorted(alphabet, rows), len(alphabet) - 1)
    node, made = np.zeros(len(rows), dtype=np.int64), 1
    parents, symbols = [], []
    final = np.zeros(len(rows), dtype=np.int64)
    for step in range(6):
        alive = np.arange(len(rows)) if step < 4 else np.flatnonzero(~is_pair)
        digit = (numbers[alive, step // 2] >> (DIGIT if step % 2 == 0 else 0)) & (SYMBOLS - 1)
        edges, child = np.unique(node[alive] * SYMBOLS + digit, return_inverse=True)
        parents.append(edges // SYMBOLS)
        symbols.append(edges % SYMBOLS)
        node[alive] = made + child
        made += len(edges)
        final[alive] = node[alive]
    parents, symbols = np.concatenate(parents), np.concatenate(symbols)
    base, size = _placed(parents, symbols, made)
    slot = np.zeros(made, dtype=np.int64)
    slot[1:] = base[parents] + symbols          # nodes are numbered in the order of their edges
    trie = Trie(alphabet, np.zeros(size + SYMBOLS, dtype=np.int32), np.full(size + SYMBOLS, -1, dtype=np.int32),
                np.full(size + SYMBOLS, -1, dtype=np.int32), first, len(rows))
    trie.base[slot] = base
    trie.check[slot[1:]] = slot[parents]
    trie.accept[slot[final]] = np.arange(len(rows))
    return trie


def _placed(parents: np.ndarray, symbols: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
    """A base for each node such that no two nodes use one place, and the number of places.

    Places below SYMBOLS stay empty, so nodes without children may have base 0. Nodes with
    many children come first, alone; nodes with few are tried together at random places, each
    place going to the first that asks; nodes with one child take what is free.
    """
    draw = np.random.default_rng(7)
    degree = np.bincount(parents, minlength=nodes)
    order = np.argsort(parents, kind="stable")
    begin = np.zeros(nodes + 1, dtype=np.int64)
    np.cumsum(degree, out=begin[1:])
    children = symbols[order]
    base = np.zeros(nodes, dtype=np.int64)
    free = np.ones(2 * SYMBOLS + 2 * len(parents), dtype=bool)
    free[:SYMBOLS] = False

    def grown(free, more):
        return np.concatenate([free, np.ones(more, dtype=bool)])

    many = np.flatnonzero(degree > 8)
    for node in many[np.argsort(-degree[many], kind="stable")].tolist():
        own = children[begin[node]:begin[node + 1]]
        while True:
            tried = draw.integers(SYMBOLS, len(free) - SYMBOLS, 64)
            fits = free[tried[:, None] + own].all(axis=1)
            if fits.any():
                break
            free = grown(free, SYMBOLS)
            tried, fits = np.array([len(free) - 2 * SYMBOLS]), np.array([True])
            if free[tried[0] + own].all():
                break
        base[node] = tried[fits.argmax()]
        free[base[node] + own] = False
    few = np.flatnonzero((degree > 1) & (degree <= 8))
    while len(few):
        tried = draw.integers(SYMBOLS, len(free) - SYMBOLS, len(few))
        owner = np.repeat(np.arange(len(few)), degree[few])
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(degree[few]) - degree[few], degree[few])
        places = tried[owner] + children[begin[few][owner] + inner]
        asked = np.full(len(free), len(few), dtype=np.int64)
        np.minimum.at(asked, places, owner)
        lost = ~free[places] | (asked[places] != owner)
        fits = np.bincount(owner, weights=lost, minlength=len(few)) == 0
        free[places[fits[owner]]] = False
        base[few[fits]] = tried[fits]
        if 8 * fits.sum() < len(few):
            free = grown(free, len(free) // 4)
        few = few[~fits]
    ones = np.flatnonzero(degree == 1)
    if free.sum() < len(ones):
        free = grown(free, len(ones))
    base[ones] = np.flatnonzero(free)[:len(ones)] - children[begin[ones]]
    return base, len(free)


def counted(texts: DataFrame, seed: int, found: DataFrame) -> DataFrame:
    """``c1``, ``c2``, ``c3``, ``a``: the exact counts of the candidates, by tries that all texts' occurrences are dealt to."""
    key = phrase_key(F.col("c1"), F.col("c2"), F.coalesce("c3", F.lit(0)))
    keyed = settle(found.withColumn("key", key))
    total, width = keyed.count(), shuffle_width(texts)
    tries = max(1, ceil(total / TRIE_ENTRIES), min(width, total // TRIE_LEAST))
    tasks = max(min(tries, width), ceil(tries / TRIES_AT_ONCE))
    entries = keyed.select(F.pmod("key", F.lit(tries)).alias("trie"), F.lit(0).cast("tinyint").alias("words"), "c1", "c2", "c3",
                           F.lit(None).cast("binary").alias("list"))
    occurrences = dealt(texts, seed, bitmap(keyed, PAIR_BITS), tries)
    nothing = [F.lit(None).cast("bigint").alias(name) for name in ("c1", "c2", "c3")]
    rows = entries.union(occurrences.select("trie", "words", *nothing, "list"))
    # the candidates of a trie come before what is looked up in it
    rows = rows.repartitionById(tasks, F.pmod("trie", F.lit(tasks)).cast("int")).sortWithinPartitions("trie", "words")
    counts = rows.mapInArrow(_walked, "c1 bigint, c2 bigint, c3 bigint, pair boolean, a bigint")
    return counts.where(F.col("a") >= LEAST).select("c1", "c2", F.when(~F.col("pair"), F.col("c3")).alias("c3"), "a")


def dealt(texts: DataFrame, seed: int, marks: np.ndarray, tries: int) -> DataFrame:
    """``trie``, ``words`` (2 or 3) and ``list``: all occurrences of phrases that the bitmap has, by the trie they belong to."""
    sent = texts.sparkSession.sparkContext.broadcast(marks)

    def find(words):
        codes, follows = words.codes, words.follows
        at = np.flatnonzero(follows[1:] & has(sent.value, PAIR_BITS, pair_key(codes[:-1], codes[1:])))
        # a frequent phrase begins with a frequent pair
        longer = at[at + 2 < len(codes)]
        longer = longer[follows[longer + 2]]
        longer = longer[has(sent.value, PAIR_BITS, phrase_key(codes[longer], codes[longer + 1], codes[longer + 2]))]
        return {2: [codes[at], codes[at + 1]], 3: [codes[longer + k] for k in range(3)]}

    return lists(texts, seed, find, tries).withColumnRenamed("part", "trie")


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates of each trie with their counts, from rows in the order of trie and ``words`` (0: a candidate)."""
    schema = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("c3", pa.int64()), ("pair", pa.bool_()), ("a", pa.int64())])
    number, entries, trie, counts, waiting = None, [], None, None, {2: [], 3: []}

    def begun():
        rows = np.stack([np.concatenate(column) for column in zip(*[one[:3] for one in entries])], axis=1)
        return build(rows, np.concatenate([one[3] for one in entries]), 0)

    def walk(length):
        *columns, times = np.concatenate([read_list(one, length) for one in waiting[length]], axis=1)
        waiting[length].clear()
        return trie.tally(columns, times)

    def ended():
        if trie is not None:
            for length, some in waiting.items():
                if some:
                    counts[:] += walk(length)
            *codes, pair = [np.concatenate(column) for column in zip(*entries)]
            yield from _batches(schema, [*codes, pair, counts])
        for some in waiting.values():
            some.clear()

    for batch in batches:
        of, words = batch["trie"].to_numpy(), batch["words"].to_numpy()
        edges = (np.flatnonzero((of[1:] != of[:-1]) | (words[1:] != words[:-1])) + 1).tolist()
        for first, last in zip([0, *edges], [*edges, len(of)] if len(of) else []):
            if of[first] != number:
                yield from ended()
                number, entries, trie, counts = of[first], [], None, None
            part, length = batch.slice(first, last - first), int(words[first])
            if length == 0:
                codes = [part[name].fill_null(0).to_numpy() for name in ("c1", "c2", "c3")]
                entries.append([*codes, part["c3"].is_null().to_numpy(zero_copy_only=False)])
            elif entries:        # no candidate: what came here only shares bits with others
                if trie is None:
                    trie = begun()
                    counts = np.zeros(trie.entries, dtype=np.int64)
                for one in part["list"].to_pylist():
                    waiting[length].append(one)
                    if len(waiting[length]) >= TASKS_AT_ONCE:
                        counts += walk(length)
    yield from ended()


# --- scores ---------------------------------------------------------------------------------


def _looked_up(rows: DataFrame, keys: list[str], table: DataFrame, spread: str) -> DataFrame:
    """``rows`` with the columns of their key's one row in ``table``; keys of very many rows are salted."""
    uses = rows.groupBy(*keys).agg(F.count("*").alias("uses"))
    return attach(rows, table.join(uses, keys), keys, "uses", F.col(spread), how="inner").drop("uses")


def cut_score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly."""
    def big(name):
        return f"cast({name} as decimal(16,0))"

    return F.expr(f"({big(a)} * {big(a)} * {SCALE}) div ({big(left)} * {big(right)})")


def scored(counts: DataFrame, words: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score`` of the phrases that no longer one covers."""
    pairs = counts.where("c3 is null").select("c1", "c2", "a")
    first = words.select(F.col("code").alias("c1"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    second = words.select(F.col("code").alias("c2"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    pairs = settle(_looked_up(_looked_up(pairs, ["c1"], first, "c2"), ["c2"], second, "c1"))
    triples = settle(counts.where("c3 is not null"))
    covered = triples.select("c1", "c2", "a").union(triples.select("c2", "c3", "a")).groupBy("c1", "c2").agg(
        F.max("a").alias("longer"))
    stays = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * COVERED)
    short = pairs.join(covered, ["c1", "c2"], "left").where(stays).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        cut_score("a", "f1", "f2").alias("score"))
    head = pairs.select("c1", "c2", "lang", "w1", "w2", F.col("a").alias("a12"), "f1")
    tail = pairs.select(F.col("c1").alias("c2"), F.col("c2").alias("c3"), F.col("w2").alias("w3"),
                        F.col("a").alias("a23"), F.col("f2").alias("f3"))
    joined = _looked_up(_looked_up(triples, ["c1", "c2"], head, "c3"), ["c2", "c3"], tail, "c1")
    cuts = joined.withColumns({"s1": cut_score("a", "f1", "a23"), "s2": cut_score("a", "a12", "f3")})
    early = F.col("s1") <= F.col("s2")
    long = cuts.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"),
        F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    return short.union(long)


def best(phrases: DataFrame, totals: DataFrame, k: int = TOP) -> DataFrame:
    """The first ``k`` of each language, ranked inside hashed parts of it first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_width(phrases)))
    inside = Window.partitionBy("lang", "part").orderBy(*order)
    few = phrases.withColumn("part", part).withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= k).drop("part", "rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= k)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mined(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All scored phrases, and the number ``n`` of words of each language."""
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    words, seed = coded_vocabulary(texts)
    frequent = settle(words.where(F.col("f") >= LEAST))
    marks = bitmap(frequent.select(F.col("code").alias("key")), WORD_BITS)
    total = words.agg(F.sum("f")).first()[0] or 0
    pairs = settle(candidates(texts, seed, 2, marks, WORD_BITS, total))
    marks = bitmap(pairs.select(pair_key(F.col("c1"), F.col("c2")).alias("key")), PAIR_BITS)
    triples = candidates(texts, seed, 3, marks, PAIR_BITS, total)
    counts = settle(counted(texts, seed, pairs.union(triples)))
    return scored(counts, frequent), words.groupBy("lang").agg(F.sum("f").alias("n"))


def collocations(docs: DataFrame, k: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``k`` phrases of each language."""
    phrases, totals = mined(docs, text_col, lang_col)
    return best(phrases, totals, k)
