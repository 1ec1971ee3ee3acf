"""Personal data: base patterns, and terms that give protected entities away.

Base finds: e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers, per
kind leftmost and without overlap. Every scan is linear in the text: a match can only
begin at the start of a run, or at the '@' or '+' that it needs.

The method on top is information-theoretic sanitisation. A protected entity is the
normal form of a base find. A term is a word of a text that touches no base find; it
co-occurs with an entity in every document that has both, wherever they stand. From
document counts over the whole corpus, with N documents,

    IC(c) = log2(N / n(c)),     PMI(c; t) = log2(N * p(c | t) / n(c)),

where p(c | t) is n(c, t) / n(t) put down to its lower confidence bound (Wilson, one-sided,
Z), so that few documents of a term are weak evidence. A term discloses an entity when
PMI(c; t) >= IC(c) / ALPHA: seeing the term tells at least that share of what the entity
itself would tell. Every pair is judged, also those that meet in one document; these pass
only in a corpus so large that the entity says more than the bound takes away. A disclosing
term is marked wherever it stands, in texts without the entity too, as a span of kind
``term``. ``sanitised`` gives the texts with all spans replaced by their kind.

Defined results: a null text is empty. Documents are counted by row, so a repeated row
counts again; null ids are ids of no document: their rows get base spans only. Spans of
terms never overlap base spans. An empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import WORD, by_batch, prepare, settle, sha, strings
from lectern.llm.linehash import digest, with_spans

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SUPPORT = 1      # least documents in which entity and term meet: every pair
Z = 1.645        # one-sided 95 % bound
ALPHA = 1.25     # share of the entity's information that discloses it: 1 / ALPHA
FLUSH = 400_000  # word counts a task holds before it passes them on
COMMON = 50_000  # most words too common for any entity that a task is told to skip; speed alone
BITS = 1 << 26   # size of the bitmap of disclosing terms

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORDS = re.compile(WORD)
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at and (host := _DOMAIN.match(text, at + 1)):
            found.append((start, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    # numbers longer than three digits may still be at most 255 with zeros in front
    return [m.span() for m in _IP.finditer(text) if all(int(part[-4:]) <= 255 and not part[:-4].strip("0")
                                                        for part in m.groups())]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        total += value if place % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text)
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), kinds numbered as listed, by start and kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        found += [(a, 1, b) for a, b in addresses(text)]
    found += [(a, 2, b) for a, b in cards(text)]
    if "+" in text:
        found += [(a, 3, b) for a, b in phones(text)]
    return sorted(found)


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def term_of(word: str) -> str:
    """A word as a term: lower case, without signs at its ends; empty for numbers and the like."""
    term = _EDGE.sub("", word.lower())
    return term if any(map(str.isalpha, term)) else ""


def entity_of(kind: int, found: str) -> str:
    form = found.lower() if kind < 2 else re.sub(r"[^0-9]", "", found)
    return f"{KINDS[kind]}:{form}"


def text_terms(text: str, spans: list[tuple[int, int, int]], wanted: set[str] | None = None) -> list[tuple[str, int, int]]:
    """(term, start, end) of the words of a text (the ``wanted`` ones), those that touch a base find left out."""
    span_starts = [a for a, _, _ in spans]
    furthest = list(accumulate((end for _, _, end in spans), max))
    found = []
    for word in _WORDS.finditer(text):
        if wanted is not None and word.group() not in wanted:
            continue
        a, b = word.span()
        before = bisect_left(span_starts, b)
        if before and furthest[before - 1] > a:  # touches a base find
            continue
        term = term_of(word.group())
        if term:
            found.append((term, a, b))
    return found


near_terms = text_terms  # the name from when only words near a find were terms


def mentions(docs: DataFrame) -> DataFrame:
    """``entities`` and ``terms``, each once, of every row with a base find."""

    def work(batch):
        entities, terms = [], []
        for text in strings(batch.column(0)):
            spans = base_spans(text or "")
            if spans:
                entities.append(sorted({entity_of(kind, text[a:b]) for a, kind, b in spans}))
                terms.append(sorted({term for term, _, _ in text_terms(text, spans)}))
        kind = pa.list_(pa.string())
        yield pa.record_batch([pa.array(entities, kind), pa.array(terms, kind)], names=["entities", "terms"])

    return by_batch(docs.select("text"), "entities array<string>, terms array<string>", work)


def joint_counts(met: DataFrame, common: frozenset[str] = frozenset()) -> DataFrame:
    """``entity``, ``term``, ``n_both``: in how many rows both occur, without the ``common`` terms."""

    def run(batches):
        counts: Counter = Counter()

        def give():
            pairs = list(counts)
            for at in range(0, len(pairs), 50_000):
                part = pairs[at:at + 50_000]
                yield pa.record_batch(
                    [pa.array([p[0] for p in part], pa.string()), pa.array([p[1] for p in part], pa.string()),
                     pa.array([counts[p] for p in part], pa.int64())], names=["entity", "term", "n"])
            counts.clear()

        for batch in batches:
            for entities, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = [term for term in terms if term not in common]
                for entity in entities:
                    counts.update((entity, term) for term in terms)
                    if len(counts) > FLUSH:
                        yield from give()
        yield from give()

    return met.select("entities", "terms").mapInArrow(run, "entity string, term string, n bigint").groupBy(
        "entity", "term").agg(F.sum("n").alias("n_both"))


def document_counts(docs: DataFrame) -> DataFrame:
    """``term``, ``n``: in how many documents each word of the corpus occurs, from all whole texts."""

    def run(batches):
        counts: Counter = Counter()

        def give():
            # the counts of the words before signs and capitals are taken away
            terms: Counter = Counter()
            for word, n in counts.items():
                terms[word] += n
            counts.clear()
            names = list(terms)
            for at in range(0, len(names), 50_000):
                part = names[at:at + 50_000]
                yield pa.record_batch([pa.array(part, pa.string()), pa.array([terms[w] for w in part], pa.int64())],
                                      names=["term", "n"])

        known: dict[str, str] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                words = set(_WORDS.findall(text))
                found = set()
                for word in words:
                    term = known.get(word)
                    if term is None:
                        term = known[word] = term_of(word)
                    found.add(term)
                found.discard("")
                counts.update(found)
                if len(known) > FLUSH:
                    known.clear()
                if len(counts) > FLUSH:
                    yield from give()
        yield from give()

    return docs.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing(docs: DataFrame, met: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``entity``, ``term`` pairs whose mutual information reaches the threshold."""
    entities = settle(met.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity")))
    terms = settle(document_counts(docs))
    everything = float(docs.count())
    # p(c | t) is at most n(c) / n(t): a term of more documents than this reaches the threshold for no entity
    most = entities.agg(F.max("n_entity")).first()[0] or 0
    bound = most ** (1 / alpha) * max(everything, 1.0) ** (1 - 1 / alpha) * (1 + 1e-9)
    rare = terms.where(F.col("n") <= bound)
    common = frozenset(r.term for r in terms.where(F.col("n") > bound).orderBy(F.desc("n")).limit(COMMON).collect())
    joint = joint_counts(met, common).where(F.col("n_both") >= support)
    scored = joint.join(rare, "term").join(entities, "entity")
    n, share = F.col("n"), F.col("n_both") / F.col("n")
    low = (share + Z * Z / (2 * n) - Z * F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
    information = F.log2(everything / F.col("n_entity"))
    mutual = F.log2(everything * low / F.col("n_entity"))
    return scored.where((information > 0) & (mutual >= information / alpha)).select("entity", "term")


def marks(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``doc_id``, ``key``, ``spans``: every place of every disclosing term, per text.

    A bitmap of the terms, of fixed size, goes to all tasks; the words that it lets through
    are joined with the terms themselves.
    """
    given = settle(disclosing(docs, settle(mentions(docs)), alpha, support).select("term").distinct())
    place = F.crc32(F.col("term").cast("binary")) % BITS
    words = given.select((place / 64).cast("long").alias("at"), (place % 64).cast("int").alias("bit")).groupBy("at").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toPandas()
    bitmap = np.zeros(BITS // 64, dtype=np.int64)
    bitmap[words["at"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.astype("<i8").tobytes())

    def run(batches):
        bits, known = shared.value, {}
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                if doc is None or not text:
                    continue
                maybe = set()
                for word in set(_WORDS.findall(text)):
                    term = known.get(word)
                    if term is None:
                        term = term_of(word)
                        at = zlib.crc32(term.encode("utf-8")) % BITS
                        term = known[word] = term if term and bits[at >> 3] >> (at & 7) & 1 else ""
                    if term:
                        maybe.add(word)
                if maybe:
                    key = digest(text)
                    for term, start, stop in text_terms(text, base_spans(text), maybe):
                        for column, value in zip(columns, (doc, key, term, start, stop)):
                            column.append(value)
                if len(known) > FLUSH:
                    known.clear()
            kinds = [pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                  names=["doc_id", "key", "term", "start", "stop"])

    placed = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, key binary, term string, start int, stop int")
    # a hot term is split by the join itself
    return placed.join(given, "term").select("doc_id", "key", "start", "stop").distinct().groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def replaced(text: str, terms: list[tuple[int, int]], shown: str = "[{}]") -> str:
    """The text with base finds and terms put as ``shown``; finds that overlap become one."""
    pieces: list[list] = []
    for start, kind, end in sorted(base_spans(text) + [(a, len(KINDS), b) for a, b in terms]):
        if pieces and start < pieces[-1][2]:
            pieces[-1][2] = max(pieces[-1][2], end)
        else:
            pieces.append([start, kind, end])
    out, at = [], 0
    for start, kind, end in pieces:
        out += [text[at:start], shown.format((*KINDS, TERM)[kind])]
        at = end
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
              support: int = SUPPORT, shown: str = "[{}]") -> DataFrame:
    """The rows with the same columns, base finds and disclosing terms generalised to their kind (``shown=""``: removed)."""
    prepare(docs.sparkSession)
    small = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    joined = with_spans(docs, marks(small, alpha, support), id_col, text_col)
    text_at = docs.columns.index(text_col)

    def work(batch):
        held = batch.column(batch.num_columns - 1).to_pylist()
        texts = [text and replaced(text, [(s["start"], s["stop"]) for s in found or []], shown)
                 for text, found in zip(strings(batch.column(text_at)), held)]
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(texts, columns[text_at].type)
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    return by_batch(joined, docs.schema, work)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
         support: int = SUPPORT) -> DataFrame:
    """Per row: counts per kind, ``base_sha256`` and ``spans``, the base spans and the terms."""
    prepare(docs.sparkSession)
    small = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    by_text = marks(small, alpha, support).withColumnRenamed("spans", "terms")

    def scan(batch):
        rows = []
        for text in strings(batch.column(1)):
            spans = base_spans(text or "")
            kinds = Counter(kind for _, kind, _ in spans)
            base = listed([(a, KINDS[kind], b) for a, kind, b in spans])
            key = digest(text or "")
            rows.append((*(kinds[n] for n in range(4)), sha(base.encode()), base, key))
        *counts, digests, bases, keys = zip(*rows)
        yield pa.record_batch(
            [batch.column(0), *[pa.array(np.asarray(c, dtype=np.int64)) for c in counts],
             pa.array(digests, pa.string()), pa.array(bases, pa.string()), pa.array(keys, pa.binary())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "key"])

    scanned = by_batch(small, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                       "base_sha256 string, base string, key binary", scan)
    joined = scanned.join(by_text.withColumnsRenamed({"doc_id": "_doc", "key": "_key"}),
                          (F.col("doc_id") == F.col("_doc")) & (F.col("key") == F.col("_key")), "left")
    # base and term spans in one order: by start, then kind as listed
    order = {kind: n for n, kind in enumerate((*KINDS, TERM))}
    number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    pieces = F.filter(F.split("base", ","), lambda item: item != "")
    base = F.transform(pieces, lambda item: F.struct(
        F.split_part(item, F.lit(":"), F.lit(2)).cast("int").alias("start"),
        F.element_at(number, F.split_part(item, F.lit(":"), F.lit(1))).alias("kind"), item.alias("shown")))
    terms = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,stop:int>>")), lambda item: F.struct(
        item["start"].alias("start"), F.lit(len(KINDS)).alias("kind"),
        F.concat_ws(":", F.lit(TERM), item["start"].cast("string"), item["stop"].cast("string")).alias("shown")))
    merged = F.array_sort(F.concat(base, terms))
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(
        F.array_join(F.transform(merged, lambda item: item["shown"]), ","))
    return joined.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))
