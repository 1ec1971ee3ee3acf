"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file gives every token's bytes and rank. The vocabulary and the merges are
rewritten in the byte alphabet of the library (one printable character per byte value),
a text is cut into the matches of the split pattern, and every different piece goes
through the library once per worker; the ids of a text are those of its pieces. Decoding
reverses the byte table and joins bytes, so a token that holds only part of a character
costs nothing: characters are put together after all bytes are.

Defined results: a null text is empty (no ids); no special tokens exist, their strings
are ordinary text; rows are independent, so ties, repeated rows, null ids and extra
columns need no rule; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import by_batch, prepare, strings

# pieces kept per worker before the memory is emptied; affects speed alone
REMEMBERED = 1_000_000
# longest piece that is remembered, and characters that are cut at once
SHORT_PIECE, SECTION = 64, 1 << 20

LETTER, NUMBER, OTHER, SPACE = 1, 2, 0, 3


def byte_alphabet() -> list[str]:
    """The character that stands for each byte value: itself where it prints, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(value) if value in shown else chr(next(hidden)) for value in range(256)]


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point in the Unicode version of the rank file's own library.

    Its regular expressions know other characters than Python's, so the letters,
    numbers and white space are asked from it: one call per class over all code points.
    """
    import tiktoken

    table = np.zeros(0x110000, dtype=np.uint8)
    ranks = {bytes([value]): value for value in range(256)}
    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        asked = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        members = asked.decode_bytes(asked.encode_ordinary(everything)).decode("utf-8")
        table[np.frombuffer(members.encode("utf-32-le"), dtype=np.uint32)] = kind
    return table


def cut(text: str) -> list[str]:
    """The matches of the split pattern, in order; together they are the whole text.

    A piece is a run of one class; the last space of a white-space run joins the run
    after it and any other last white space stands alone; an apostrophe that begins a
    piece takes one of the endings s, t, m, d, re, ve, ll.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    if not len(codes):
        return []
    kinds = character_classes()[codes]
    begins = np.ones(len(codes), dtype=bool)
    begins[1:] = kinds[1:] != kinds[:-1]
    blank = kinds == SPACE
    last_blank = np.flatnonzero(blank[:-1] & ~blank[1:])
    begins[last_blank] = True
    begins[last_blank[codes[last_blank] == 0x20] + 1] = False
    for place in np.flatnonzero((codes == 0x27) & begins).tolist():
        after = text[place + 1:place + 3]
        taken = 2 if after[:1] in ("s", "t", "m", "d") else 3 if after in ("re", "ve", "ll") else 0
        if taken:
            begins[place + 1:place + taken] = False
            if place + taken < len(codes):
                begins[place + taken] = True
    edges = np.flatnonzero(begins).tolist()
    return [text[a:b] for a, b in zip(edges, [*edges[1:], len(codes)])]


_SECTION_END = regex.compile(r"(?<=[^\s\x1c-\x1f\x85]) ")


def sections(text: str) -> Iterator[str]:
    """Parts of a long text that can be cut separately: a space after a non-blank begins a piece."""
    start = 0
    while len(text) - start > SECTION:
        found = _SECTION_END.search(text, start + SECTION)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


class Ragged:
    """Rows of different lengths in one array; ``take`` joins chosen rows."""

    def __init__(self, kind):
        self.flat, self.used = np.zeros(1024, dtype=kind), 0
        self.starts, self.lengths, self.rows = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64), 0

    @classmethod
    def of(cls, items: list[bytes], kind) -> Ragged:
        made = cls(kind)
        made.add(items)
        return made

    def add(self, items: list) -> None:
        if not items:
            return
        lengths = np.fromiter(map(len, items), dtype=np.int64, count=len(items))
        joined = np.fromiter(chain.from_iterable(items), dtype=self.flat.dtype, count=int(lengths.sum()))
        self.flat = self._room(self.flat, self.used, len(joined))
        self.starts = self._room(self.starts, self.rows, len(items))
        self.lengths = self._room(self.lengths, self.rows, len(items))
        self.flat[self.used:self.used + len(joined)] = joined
        self.lengths[self.rows:self.rows + len(items)] = lengths
        self.starts[self.rows:self.rows + len(items)] = self.used + np.cumsum(lengths) - lengths
        self.used += len(joined)
        self.rows += len(items)

    @staticmethod
    def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
        if used + more <= len(array):
            return array
        grown = np.zeros(max(2 * len(array), used + more), dtype=array.dtype)
        grown[:used] = array[:used]
        return grown

    def take(self, chosen: np.ndarray) -> np.ndarray:
        lengths = self.lengths[chosen]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[chosen] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))]


class Numbers(dict):
    """Numbers pieces in order of their first sight; ``new`` holds those not yet encoded."""

    def __init__(self):
        self.new: list[str] = []
        self.next = 0

    def __missing__(self, piece: str) -> int:
        number = self[piece] = self.next
        self.next += 1
        self.new.append(piece)
        return number


class ByteBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        alphabet = byte_alphabet()
        spelled = {token: "".join(alphabet[value] for value in token) for token in ranks}
        merges = [
            (spelled[token[:at]], spelled[token[at:]])
            for token in sorted(ranks, key=ranks.get) for at in range(1, len(token))
            if token[:at] in ranks and token[at:] in ranks
        ]
        self.tokenizer = Tokenizer(models.BPE(
            vocab={spelled[token]: rank for token, rank in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        value_of = {character: value for value, character in enumerate(alphabet)}
        # decoding: the library's own vocabulary, spelled back into bytes
        self.token_bytes = {
            rank: bytes(value_of[character] for character in token)
            for token, rank in self.tokenizer.get_vocab().items()
        }
        size = max(self.token_bytes, default=-1) + 1
        self.byte_table = Ragged.of([self.token_bytes.get(rank, b"") for rank in range(size)], np.uint8)
        self.digit_table = Ragged.of([b",%d" % rank for rank in range(size)], np.uint8)
        self.numbers = Numbers()
        self.piece_ids = Ragged(np.int32)

    def _numbered(self, pieces: list[str]) -> np.ndarray:
        """Row of every piece in ``piece_ids``; new pieces are encoded first."""
        if len(self.numbers) > REMEMBERED:
            self.numbers = Numbers()
            self.piece_ids = Ragged(np.int32)
        rows = np.fromiter(map(self.numbers.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        if self.numbers.new:
            found = self.tokenizer.encode_batch_fast(self.numbers.new, add_special_tokens=False)
            self.piece_ids.add([item.ids for item in found])
            self.numbers.new = []
        return rows

    def runs(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text, section by section."""
        for section in sections(text):
            pieces = cut(section)
            if pieces:
                yield self.piece_ids.take(self._numbered(pieces))
            if len(section) > SECTION:
                for piece in pieces:
                    if len(piece) > SHORT_PIECE:
                        self.numbers.pop(piece, None)

    def encode(self, text: str | None) -> list[int]:
        return [value for run in self.runs(text or "") for value in run.tolist()]

    def decode_bytes(self, ids) -> bytes:
        return self.byte_table.take(np.asarray(ids, dtype=np.int64)).tobytes()

    def offsets(self, text: str | None, ids: list[int]) -> tuple[list[int], list[int]]:
        """First character and end of each token; a character split over tokens is in each of them."""
        data = (text or "").encode("utf-8")
        if not ids:
            return [], []
        # the character that every byte belongs to: continuation bytes do not begin one
        character = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80) - 1
        ends = np.cumsum([len(self.token_bytes[value]) for value in ids])
        starts = np.concatenate([[0], ends[:-1]])
        return character[starts].tolist(), (character[ends - 1] + 1).tolist()

    def digests(self, text: str | None, held: list[np.ndarray] | None = None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of their list, SHA-256 of the bytes they decode to; ``held`` receives the ids."""
        count, listed, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.runs(text or ""):
            digits = self.digit_table.take(ids)
            listed.update(digits if count else digits[1:])
            decoded.update(self.decode_bytes(ids))
            count += len(ids)
            if held is not None:
                held.append(ids)
        return count, listed.hexdigest(), decoded.hexdigest()


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` array<int>, ``starts`` and ``ends`` (characters of the text per token)."""
    prepare(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]

    def work(batch):
        coder = load(path)
        texts = strings(batch.column(1))
        ids = [coder.encode(text) for text in texts]
        spans = [coder.offsets(text, found) for text, found in zip(texts, ids)]
        yield pa.record_batch([
            batch.column(0), pa.array(ids, pa.list_(pa.int32())),
            pa.array([a for a, _ in spans], pa.list_(pa.int32())), pa.array([b for _, b in spans], pa.list_(pa.int32())),
        ], names=["doc_id", "ids", "starts", "ends"])

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(chosen, f"doc_id {id_type}, ids array<int>, starts array<int>, ends array<int>", work)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``data`` binary and ``text`` (bytes that are no UTF-8 become U+FFFD); null ids are none."""
    prepare(encoded.sparkSession)
    id_type = dict(encoded.dtypes)[id_col]

    def work(batch):
        coder = load(path)
        data = [coder.decode_bytes(ids or ()) for ids in batch.column(1).to_pylist()]
        yield pa.record_batch([
            batch.column(0), pa.array(data, pa.binary()),
            pa.array([part.decode("utf-8", "replace") for part in data], pa.string()),
        ], names=["doc_id", "data", "text"])

    chosen = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return by_batch(chosen, f"doc_id {id_type}, data binary, text string", work)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass and return the digests, and the ids themselves if wanted."""
    prepare(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]

    def work(batch):
        coder = load(path)
        held: list[np.ndarray] | None = [] if with_ids else None
        found = [coder.digests(text, held) for text in strings(batch.column(1))]
        counts, listed, decoded = zip(*found)
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(listed), pa.array(decoded)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            flat = np.concatenate(held) if held else np.zeros(0, np.int32)
            ends = np.concatenate([[0], np.cumsum(counts)])
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
            names.append("ids")
        yield pa.record_batch(columns, names=names)

    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(chosen, schema + (", ids array<int>" if with_ids else ""), work)
