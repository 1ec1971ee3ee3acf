"""Candidates of a title search by shared character trigrams.

For callers without a candidates table. Titles are normalised and each distinct one is
taken once, so copies multiply nothing. A title looks up all its trigrams: every pair that
shares any is compared in full, by the trigrams that both have, and the ``top_n`` best stay.
A caller who names a number of ``probes`` has only so many looked up, those that the fewest
held titles have (ties in the order of the trigrams), and loses the titles found by others.

The pairs of titles grow with the square of the titles, so no pair is ever a row. The asked
titles are dealt to blocks of at most ``BLOCK``; every block meets the held titles as a
sorted stream, counts what they share from its own inverted index and keeps the ``top_n``
of each of its titles. Memory is that of a block; what is shuffled is the held titles once
per block. Nothing is cut but by ``top_n``, and by ``probes`` where a caller names them.

The result lists every copy of a book with every copy of its works, so it grows with the
square of the copies. It is dealt in squares of about ``SIDE`` rows a side: a title with many
copies is made by many tasks, and what is shuffled for it is the result divided by ``SIDE``.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import bind, normalize_text
from lectern.operators.skew import attach, shuffle_width
from lectern.session import settle

TOP_N = 25
BLOCK = 8192        # asked titles that one index holds
PART_ROWS = 2048    # fewest held titles worth an index of their own
SIDE = 1024         # rows of books, and of works, that one square of the result pairs
STEP = 256          # held titles that are counted before the best are chosen again
DENSE = 4096        # trigrams of a block, its most frequent, that are counted by rows of a matrix


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters of a text with two blanks before it and one behind; none of an empty text."""
    padded = F.concat(F.lit("  "), text, F.lit(" "))
    places = F.sequence(F.lit(1), F.length(text) + 1)
    runs = bind(padded, lambda whole: F.transform(places, lambda at: F.substring(whole, at, 3)))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


def numbered(norms: DataFrame) -> DataFrame:
    """``id``, ``norm`` and ``rows`` (how many have it), once for every normalised title that has any trigram."""
    counted = norms.where("norm <> ''").groupBy("norm").agg(F.count("*").alias("rows"))
    return settle(counted.select(F.monotonically_increasing_id().alias("id"), "norm", "rows"))


def distinct_titles(rows: DataFrame, title: str) -> DataFrame:
    return numbered(rows.select(normalize_text(title).alias("norm")))


def postings(titles: DataFrame) -> DataFrame:
    return titles.select("id", F.explode(trigrams(F.col("norm"))).alias("gram"))


def probed(asked: DataFrame, stored: DataFrame, probes: int | None) -> DataFrame:
    """``id``, ``norm`` and ``probes``: the trigrams of each title that are looked up, in one text; null for all of them."""
    if probes is None:
        return asked.withColumn("probes", F.lit(None).cast("string"))
    spread = postings(asked)
    known = postings(stored).groupBy("gram").agg(F.count("*").alias("df"))
    uses = spread.groupBy("gram").agg(F.count("*").alias("uses"))
    counted = attach(spread, settle(known.join(uses, "gram")), ["gram"], "uses", F.col("id"), how="inner")
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("df", "gram"))), 1, probes)
    chosen = counted.groupBy("id").agg(F.array_join(rarest["gram"], "").alias("probes"))
    return asked.join(chosen, "id")


def codes_of(texts: list[str]) -> np.ndarray:
    """The code points of texts, one after another."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)


def packed(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return first << 42 | second << 21 | third


def title_grams(norms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, place in it of each trigram, offsets of the titles): the distinct trigrams of each title."""
    points = codes_of([f"  {norm} " for norm in norms])
    lengths = np.fromiter(map(len, norms), dtype=np.int64, count=len(norms)) + 3
    owner = np.repeat(np.arange(len(norms)), lengths)
    inside = owner[:-2] == owner[2:]
    vocabulary, place = np.unique(packed(points[:-2], points[1:-1], points[2:])[inside], return_inverse=True)
    owned = np.unique(owner[:-2][inside] * len(vocabulary) + place)
    offsets = np.searchsorted(owned, np.arange(len(norms) + 1) * len(vocabulary))
    return vocabulary, owned % len(vocabulary), offsets


class Block:
    """The best held titles of some asked ones; held titles are given in ascending order of their text."""

    def __init__(self, ids: list[int], norms: list[str], probes: list[str | None], top_n: int):
        self.ids, self.count = np.array(ids, dtype=np.int64), len(ids)
        self.vocabulary, place, offsets = title_grams(norms)
        self.sizes = np.diff(offsets)
        self.counter = np.uint8 if self.sizes.max() < 255 else np.int32
        owner = np.repeat(np.arange(self.count), self.sizes)
        order = np.argsort(place, kind="stable")
        self.owners = owner[order]
        times = np.bincount(place, minlength=len(self.vocabulary))
        self.starts = np.concatenate([[0], np.cumsum(times)])
        # frequent trigrams are rows of a matrix, the others lists
        frequent = np.sort(np.argsort(-times, kind="stable")[:DENSE])
        self.row = np.full(len(self.vocabulary), -1, dtype=np.int64)
        self.row[frequent] = np.arange(len(frequent))
        self.matrix = np.zeros((len(frequent), self.count), dtype=self.counter)
        shown = self.row[place] >= 0
        self.matrix[self.row[place[shown]], owner[shown]] = 1
        self.lines = self.matrix[:0]
        self.probes = None if probes[0] is None else self._probes(probes)
        # overlap -1: free
        self.overlaps = np.full((self.count, top_n), -1, dtype=np.int64)
        self.found = np.zeros((self.count, top_n), dtype=np.int64)
        self.fed = 0

    def _probes(self, probes: list[str]) -> np.ndarray:
        """Places in the vocabulary of the probes of each title; one that no trigram has fills the rows up."""
        points = codes_of(probes)
        place = np.searchsorted(self.vocabulary, packed(points[0::3], points[1::3], points[2::3]))
        widths = np.fromiter(map(len, probes), dtype=np.int64, count=len(probes)) // 3
        table = np.full((len(probes), widths.max()), len(self.vocabulary), dtype=np.int64)
        table[np.arange(widths.max()) < widths[:, None]] = place
        return table

    def feed(self, ids: np.ndarray, norms: list[str]) -> None:
        vocabulary, place, offsets = title_grams(norms)
        own = np.minimum(np.searchsorted(self.vocabulary, vocabulary), len(self.vocabulary) - 1)
        own[self.vocabulary[own] != vocabulary] = -1
        place = own[place]
        first = 0
        while first < len(norms):
            # few at first: a step takes whatever beats the best of the steps before
            last = min(first + min(max(self.fed, 8), STEP), len(norms))
            self._step(ids[first:last], place, offsets[first:last + 1])
            self.fed, first = self.fed + last - first, last

    def _step(self, ids: np.ndarray, place: np.ndarray, offsets: np.ndarray) -> None:
        present = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        least, entries = {}, []
        for one, first, last in zip(ids.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            size, grams = last - first, place[first:last]
            grams = grams[grams >= 0]
            rows = self.row[grams]
            # a count is no larger than the asked title
            rows = rows[rows >= 0]
            if len(self.lines) < len(rows):
                self.lines = np.empty((len(rows), self.count), dtype=self.counter)
            lines = np.take(self.matrix, rows, axis=0, out=self.lines[:len(rows)], mode="clip")
            shared = np.add.reduce(lines, axis=0, dtype=self.counter)
            for gram in grams[self.row[grams] < 0].tolist():
                shared[self.owners[self.starts[gram]:self.starts[gram + 1]]] += 1
            if size not in least:
                least[size] = self._least(size)
            asked = np.flatnonzero(shared >= least[size])
            if self.probes is not None and len(asked):
                present[grams] = True
                asked = asked[present[self.probes[asked]].any(axis=1)]
                present[grams] = False
            if len(asked):
                entries.append((asked, 2000 * shared[asked].astype(np.int64) // (self.sizes[asked] + size), np.full(len(asked), one)))
        if entries:
            self._enter(*map(np.concatenate, zip(*entries)))

    def _least(self, size: int) -> np.ndarray:
        """The fewest trigrams that a held title of ``size`` must share with each asked one to beat its last place."""
        more = self.overlaps[:, -1] + 1
        return np.clip(-(-more * (self.sizes + size) // 2000), 1, self.sizes + 1).astype(self.counter)

    def _enter(self, asked: np.ndarray, overlap: np.ndarray, held: np.ndarray) -> None:
        """The best of the old and the new; equal ones stay in the order in which they came, that of their texts."""
        touched, top_n = np.unique(asked), self.overlaps.shape[1]
        owner = np.concatenate([np.repeat(touched, top_n), asked])
        overlap = np.concatenate([self.overlaps[touched].ravel(), overlap])
        held = np.concatenate([self.found[touched].ravel(), held])
        order = np.lexsort((-overlap, owner))
        chosen = order[np.searchsorted(owner[order], touched)[:, None] + np.arange(top_n)]
        self.overlaps[touched], self.found[touched] = overlap[chosen], held[chosen]

    def best(self) -> pa.RecordBatch:
        rows, columns = np.nonzero(self.overlaps >= 0)
        return pa.record_batch(
            [pa.array(self.ids[rows]), pa.array(self.found[rows, columns]), pa.array(self.overlaps[rows, columns].astype(np.int32))],
            names=["asked", "held", "overlap"])


def nearest(asked: DataFrame, stored: DataFrame, top_n: int, block: int = BLOCK, part_rows: int = PART_ROWS) -> DataFrame:
    """``asked``, ``held`` (ids) and ``overlap``: the best held titles of each asked one, at least the ``top_n`` best.

    ``asked``: id, norm, probes. Where there are fewer blocks than tasks, the held titles are
    parted too, and each part gives its best.
    """
    blocks = max(1, ceil(asked.count() / block))
    parts = max(1, min(ceil(shuffle_width(asked) / blocks), stored.count() // part_rows))

    def cells(rows: DataFrame, kind: int, own: Column, others: Column, probes: Column) -> DataFrame:
        return rows.withColumn("other", F.explode(others)).select(
            own.alias("cell"), F.lit(kind).alias("kind"), "id", "norm", probes.alias("probes"))

    def dealt(ways: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(ways)).cast("int")

    def every(ways: int) -> Column:
        return F.sequence(F.lit(0), F.lit(ways - 1))

    rows = cells(asked, 0, dealt(blocks) * parts + F.col("other"), every(parts), F.col("probes")).union(
        cells(stored, 1, F.col("other") * parts + dealt(parts), every(blocks), F.lit(None).cast("string")))
    # a cell is a task: hashed, some tasks would get several and others none
    rows = rows.repartitionById(blocks * parts, F.col("cell")).sortWithinPartitions("cell", "kind", "norm")

    def run(batches):
        cell, index, waiting = None, None, ([], [], [])
        for batch in batches:
            if not batch.num_rows:
                continue
            of, kind, ids = (batch.column(at).to_numpy() for at in range(3))
            edges = np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1
            for first, last in zip([0, *edges.tolist()], [*edges.tolist(), len(of)]):
                if of[first] != cell:
                    if index is not None:
                        yield index.best()
                    cell, index, waiting = of[first], None, ([], [], [])
                norms = batch.column(3).slice(first, last - first).to_pylist()
                if kind[first] == 0:
                    for held, some in zip(waiting, (ids[first:last].tolist(), norms, batch.column(4).slice(first, last - first).to_pylist())):
                        held.extend(some)
                elif waiting[0]:
                    index = index or Block(*waiting, top_n)
                    index.feed(ids[first:last], norms)
        if index is not None:
            yield index.best()

    return rows.mapInArrow(run, "asked bigint, held bigint, overlap int")


def title_candidates(books: DataFrame, works: DataFrame, key: str, book_title: str = "title", work_id: str = "id",
                     work_title: str = "title", top_n: int = TOP_N, probes: int | None = None) -> DataFrame:
    """``key``, ``work_id``, ``cand_rank``, ``overlap``: the works whose titles share most trigrams with a book's.

    ``overlap`` is twice the shared trigrams over those of both titles, in thousandths
    rounded down. Ranks count the titles of a book by overlap, then in the order of the
    normalised titles; works with one normalised title have one rank and come together.
    """
    if top_n < 1 or (probes is not None and probes < 1):
        raise ValueError("top_n and probes must be at least 1")
    # what a title is made from may be long (a page): it is read once
    of_books = settle(books.select(F.col(key).alias("book"), normalize_text(book_title).alias("norm")))
    of_works = settle(works.select(F.col(work_id).alias("work"), normalize_text(work_title).alias("norm")))
    asked, stored = numbered(of_books.select("norm")), numbered(of_works.select("norm"))
    found = settle(nearest(settle(probed(asked, stored, probes)), stored, top_n))
    named = found.join(stored.select(F.col("id").alias("held"), F.col("norm").alias("work_norm")), "held")
    place = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("overlap"), "work_norm"))
    best = settle(named.withColumn("cand_rank", place).where(F.col("cand_rank") <= top_n).drop("work_norm"))
    return expanded(of_books.where("norm <> ''"), of_works.where("norm <> ''"), asked, stored, best, SIDE).select(
        F.col("book").alias(key), F.col("work").alias(work_id), "cand_rank", "overlap")


def expanded(of_books: DataFrame, of_works: DataFrame, asked: DataFrame, stored: DataFrame, best: DataFrame, side: int) -> DataFrame:
    """``book``, ``work``, ``cand_rank``, ``overlap``: every book with every work that has one of its best titles.

    The rows of a held title times the books that found it are one rectangle of the result;
    it is cut into squares, each a key of its own in the last join. The number of tasks
    follows the size of the result, which the size of what is joined does not tell.
    """
    def pieces(rows: str) -> Column:
        return F.ceil(F.col(rows) / side).cast("int").alias(f"{rows}_pieces")

    def dealt(row: str, ways: str) -> Column:
        return F.pmod(F.xxhash64(row), F.col(ways)).cast("int")

    def every(ways: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(ways) - 1))

    finders = best.join(asked.select(F.col("id").alias("asked"), F.col("rows").alias("books")), "asked").groupBy("held").agg(
        F.sum("books").alias("books"))
    sized = settle(stored.select(F.col("id").alias("held"), "norm", F.col("rows").alias("works")).join(finders, "held").select(
        "held", "norm", "works", "books", pieces("works"), pieces("books")))
    size = sized.agg(F.sum(F.col("works") * F.col("books")).alias("size")).first()["size"] or 0
    tasks = max(shuffle_width(best), ceil(size / (4 * side * side)))
    links = best.join(sized.select("held", "works_pieces", "books_pieces"), "held").groupBy("asked").agg(
        F.collect_list(F.struct("held", "cand_rank", "overlap", "works_pieces", "books_pieces")).alias("links"))
    linked = settle(asked.select(F.col("id").alias("asked"), "norm", "rows").join(links, "asked").drop("asked"))
    left = attach(of_books, linked, ["norm"], "rows", F.col("book"), how="inner").select(
        "book", F.explode("links").alias("link")).select("book", "link.*").select(
        "book", "held", "cand_rank", "overlap", dealt("book", "books_pieces").alias("book_piece"), every("works_pieces").alias("work_piece"))
    right = attach(of_works, sized.drop("books"), ["norm"], "works", F.col("work"), how="inner").select(
        "work", "held", every("books_pieces").alias("book_piece"), dealt("work", "works_pieces").alias("work_piece"))
    square = ["held", "book_piece", "work_piece"]
    return left.repartition(tasks, *square).join(right.repartition(tasks, *square), square)


def recall(found: DataFrame, exact: DataFrame, key: str, work_id: str, top_n: int) -> DataFrame:
    """``wanted`` and ``found`` numbers of the exact candidates up to rank ``top_n``, and their ``recall``."""
    wanted = exact.where(F.col("cand_rank") <= top_n).select(key, work_id).distinct()
    hit = found.select(key, work_id, F.lit(1).alias("hit")).distinct()
    return wanted.join(hit, [key, work_id], "left").agg(
        F.count("*").alias("wanted"), F.count("hit").alias("found")).withColumn("recall", F.col("found") / F.col("wanted"))
