"""Language identification by a byte convolutional network.

Each byte has a small vector; filters of several widths slide over a window of fixed
length, the maximum of every filter over the window feeds a softmax over the languages.
The network is trained in numpy on a bounded sample of labelled text and applied to all
windows of every whole text, many windows at a time. The probabilities of a text are the
mean log probabilities of its windows, weighted by their bytes and normalised again.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is
every text when nothing could be learned. Of more than LANGUAGES labels those with most rows
are learned, the first in their order among equals. Rows without id, text or label teach nothing.
A network that was fitted with a background class also says ``und``, with that class's
probability, of text that looks like none of its languages: letters in no order, and scripts
that the sample does not have. An unlearned language in a learned script may still pass.
Rows are independent, so ties and repeated rows get equal results. ``lang``, ``source``
and the id are no inputs of a prediction.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import by_batch, prepare, strings

WINDOW = 256          # bytes of a window
WIDTHS = (2, 3, 4, 5)  # filter widths
FILTERS = 8           # filters of each width
DEPTH = 6             # length of a byte's vector
AT_ONCE = 512         # windows in one block of the network
# bounds of the training sample
ROWS_PER_LANGUAGE, PIECES_PER_ROW, LANGUAGES = 600, 2, 256
PIECE_CHARS = 400
SPREAD = 128
ROUNDS, STEP, SEED = 6, 3e-3, 7

UNKNOWN = "und"
# label of the background class: no text that Spark reads as a label of a document sorts before it
BACKGROUND = "\0"
# a text goes to the background only with this probability; below, its best language counts
SURE = 0.95
# code points in one block of a script
SCRIPT_BLOCK = 128


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept away from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Pieces of at most ROWS_PER_LANGUAGE rows of each language, chosen by a hash of the id.

    Ranks are taken over (language, hash) in two rounds, first inside SPREAD parts of a
    language. Spark keeps the first rows of each part per task before the shuffle, so a hot
    language sends no more than any other and no task gets more with more input files.
    """
    usable = F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & F.col(id_col).isNotNull()
    taught = docs.where(usable & ~held_out(id_col))
    # the LANGUAGES labels with most rows, then in their order: as many as there are, so they fit a broadcast
    label = F.col(lang_col).cast("string").alias("label")
    frequent = taught.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(LANGUAGES)
    # where in the text a piece is taken: hash of id, so every part of a text can teach
    length = F.length(text_col)
    pieces = F.array(*[
        F.substring(
            F.col(text_col),
            (F.pmod(F.xxhash64(F.col(id_col), F.lit(n)), F.greatest(length - F.lit(PIECE_CHARS), F.lit(1))) + 1).cast("int"),
            F.lit(PIECE_CHARS))
        for n in range(PIECES_PER_ROW)
    ])
    small = taught.select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col).alias("draw"), F.col(id_col).alias("id"),
        pieces.alias("pieces"))
    small = small.join(F.broadcast(frequent.select(F.col("label").alias("lang"))), "lang", "left_semi")
    part = F.pmod(F.col("draw"), F.lit(SPREAD)).alias("part")
    for by in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*by).orderBy("draw", "id", "pieces")
        small = small.select("*", part) if "part" in by else small
        small = small.withColumn("place", F.row_number().over(first)).where(F.col("place") <= ROWS_PER_LANGUAGE).drop("place")
    return small


@dataclass
class Network:
    languages: list[str]
    vectors: np.ndarray    # 256 x DEPTH
    filters: np.ndarray    # (max width * DEPTH) x all filters; shorter filters are zero at the end
    bias: np.ndarray
    dense: np.ndarray      # all filters x languages
    dense_bias: np.ndarray

    def features(self, windows: np.ndarray, with_places: bool = False):
        """Maximum over the window of every filter, cut off at 0; ``windows`` is n x bytes."""
        n, length = windows.shape
        wide, reach = max(WIDTHS), self.filters.shape[0]
        padded = np.zeros((n, length + wide - 1), dtype=np.uint8)
        padded[:, :length] = windows
        looked = self.vectors[padded].reshape(n, -1)
        step = looked.strides[1]
        patches = np.lib.stride_tricks.as_strided(
            looked, (n, length, reach), (looked.strides[0], DEPTH * step, step))
        values = patches.reshape(n * length, reach) @ self.filters
        values = values.reshape(n, length, -1)
        peaks = values.max(axis=1) + self.bias
        best = np.maximum(peaks, 0)
        if not with_places:
            return best
        return best, values.argmax(axis=1), patches, peaks > 0, padded

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for at in range(0, len(windows), AT_ONCE):
            scores = self.features(windows[at:at + AT_ONCE]) @ self.dense + self.dense_bias
            scores -= scores.max(axis=1, keepdims=True)
            parts.append(scores - np.log(np.exp(scores).sum(axis=1, keepdims=True)))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, the text each belongs to, and its number of bytes.

    Windows follow one another without gaps. The last one of a longer text reaches back
    over its neighbour to be full; a shorter text is padded with zero bytes.
    """
    owners, starts, weights = [], [], []
    joined = b"".join(texts) + bytes(WINDOW)
    at = 0
    for number, data in enumerate(texts):
        count = -(-len(data) // WINDOW)
        for k in range(count):
            weights.append(min(WINDOW, len(data) - k * WINDOW))
            starts.append(at + max(0, min(k * WINDOW, len(data) - WINDOW)))
            owners.append(number)
        at += len(data)
    flat = np.frombuffer(joined, dtype=np.uint8)
    starts, owners = np.asarray(starts, dtype=np.int64), np.asarray(owners, dtype=np.int64)
    cut = np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[starts] if len(starts) else np.zeros((0, WINDOW), np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    short = np.flatnonzero(lengths[owners] < WINDOW)
    if len(short):
        cut[short] = cut[short] * (np.arange(WINDOW) < lengths[owners[short]][:, None])
    return cut, owners, np.asarray(weights, dtype=np.float32)


def predict(network: Network, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of whole texts."""
    spoken = [i for i, text in enumerate(texts) if text and any(map(str.isalpha, text))]
    languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not network.languages:
        return languages, scores
    total = np.zeros((len(spoken), len(network.languages)), dtype=np.float64)
    weight = np.zeros(len(spoken))
    held, size = [], 0

    def settle_block(block):
        cut, owners, weights = windows_of([data for _, data in block])
        found = network.log_probabilities(cut)
        rows = np.asarray([place for place, _ in block])[owners]
        np.add.at(total, rows, found * weights[:, None])
        np.add.at(weight, rows, weights)

    reach = WINDOW * AT_ONCE * 8
    for place, i in enumerate(spoken):
        data = texts[i].encode("utf-8")
        for at in range(0, len(data), reach):  # a very long text goes through in parts
            part = data[at:at + reach]
            held.append((place, part))
            size += len(part)
            if size >= reach:
                settle_block(held)
                held, size = [], 0
    if held:
        settle_block(held)
    mean = total / np.maximum(weight, 1)[:, None]
    chance = np.exp(mean - mean.max(axis=1, keepdims=True)) if len(spoken) else mean
    chance /= chance.sum(axis=1, keepdims=True) if len(spoken) else 1
    for place, i in enumerate(spoken):
        best = int(chance[place].argmax())
        if network.languages[best] == BACKGROUND and len(network.languages) > 1 and chance[place][best] < SURE:
            chance[place] /= 1 - chance[place][best]
            chance[place][best] = 0
            best = int(chance[place].argmax())
        found = network.languages[best]
        languages[i], scores[i] = UNKNOWN if found == BACKGROUND else found, float(chance[place][best])
    return languages, scores


def background(sample: list[tuple[str, list[str]]]) -> list[str]:
    """Pieces that are in no language, about as many as the largest language of the sample has.

    In turn: the letters of a piece of the sample in no order; random letters of its
    alphabet; letters of a block of code points that the sample does not have.
    """
    draw = np.random.default_rng(SEED + 1)
    by_label: dict[str, list[str]] = {}
    for lang, pieces in sorted(sample):
        by_label.setdefault(lang, []).extend(piece for piece in pieces if piece)
    wanted = max(map(len, by_label.values()), default=0)
    texts = [piece for pieces in by_label.values() for piece in pieces]
    seen = {ord(c) // SCRIPT_BLOCK for text in texts for c in text}
    scripts = []
    for block in range(0x10000 // SCRIPT_BLOCK):
        letters = [chr(c) for c in range(block * SCRIPT_BLOCK, (block + 1) * SCRIPT_BLOCK) if chr(c).isalpha()]
        if block not in seen and len(letters) >= SCRIPT_BLOCK // 4:
            scripts.append(letters)
    found = []
    for number in range(wanted if texts else 0):
        piece = list(texts[int(draw.integers(len(texts)))])
        places = [k for k, c in enumerate(piece) if c.isalpha()]
        letters = [piece[k] for k in places]
        kind = number % 3
        if kind == 0:
            letters = [letters[k] for k in draw.permutation(len(letters))]
        else:
            # one block has few signs of a large script, so that of these several blocks are mixed
            alphabet = sorted(set(letters)) if kind == 1 or not scripts else [
                c for k in draw.integers(len(scripts), size=1 + number % 2) for c in scripts[k]]
            letters = [alphabet[k] for k in draw.integers(max(1, len(alphabet)), size=len(letters))] if alphabet else []
        for k, c in zip(places, letters):
            piece[k] = c
        found.append("".join(piece) if number % 6 < 3 else "".join(c for c in piece if c != " "))
    return found


def train(sample: list[tuple[str, list[str]]]) -> Network:
    """Fit the network to (language, pieces of text); the same sample gives the same network."""
    languages = sorted({lang for lang, _ in sample})
    draw = np.random.default_rng(SEED)
    wide, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide * DEPTH, total), dtype=np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width * DEPTH, k * FILTERS:(k + 1) * FILTERS] = 1
    network = Network(
        languages,
        draw.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        (draw.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(total, np.float32),
        draw.normal(0, 0.3, (total, max(1, len(languages)))).astype(np.float32),
        np.zeros(max(1, len(languages)), np.float32))
    if not languages:
        return network
    texts, labels = [], []
    for lang, pieces in sorted(sample):
        for piece in pieces:
            if piece:
                texts.append(piece.encode("utf-8"))
                labels.append(languages.index(lang))
    cut, owners, _ = windows_of(texts)
    target = np.asarray(labels)[owners]
    parameters = [network.vectors, network.filters, network.bias, network.dense, network.dense_bias]
    slow, fast, time = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
    for _ in range(ROUNDS):
        order = draw.permutation(len(cut))
        for at in range(0, len(order), 64):
            chosen = order[at:at + 64]
            time += 1
            for p, gradient, m, v in zip(parameters, _gradients(network, cut[chosen], target[chosen], mask), slow, fast):
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient * gradient - v)
                p -= STEP * (m / (1 - 0.9 ** time)) / (np.sqrt(v / (1 - 0.999 ** time)) + 1e-8)
    return network


def _gradients(network: Network, windows: np.ndarray, target: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
    n = len(windows)
    best, places, patches, open_, padded = network.features(windows, with_places=True)
    scores = best @ network.dense + network.dense_bias
    scores -= scores.max(axis=1, keepdims=True)
    error = np.exp(scores)
    error /= error.sum(axis=1, keepdims=True)
    error[np.arange(n), target] -= 1
    error /= n
    upward = (error @ network.dense.T) * open_
    rows = np.arange(n)[:, None]
    at_peak = patches[rows, places]                       # n x filters x reach
    of_filters = np.einsum("nf,nfr->rf", upward, at_peak) * mask
    of_patches = upward[:, :, None] * network.filters.T   # n x filters x reach
    of_vectors = np.zeros_like(network.vectors)
    wide = max(WIDTHS)
    seen = padded[rows[:, :, None], places[:, :, None] + np.arange(wide)]
    np.add.at(of_vectors, seen.ravel(), of_patches.reshape(-1, DEPTH))
    return [of_vectors, of_filters, upward.sum(axis=0), best.T @ error, error.sum(axis=0)]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        with_background: bool = False) -> Network:
    """Train on the bounded sample: ROWS_PER_LANGUAGE rows of each language, PIECES_PER_ROW pieces each."""
    prepare(docs.sparkSession)
    sample = training_sample(docs, id_col, text_col, lang_col).select("lang", "pieces").collect()
    taught = [(row.lang, list(row.pieces)) for row in sample]
    if with_background and taught:
        taught.append((BACKGROUND, background(taught)))
    return train(taught)


def identify(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(pickle.dumps(network))
    id_type = dict(docs.dtypes)[id_col]

    def work(batch):
        languages, scores = predict(pickle.loads(shared.value), strings(batch.column(2)))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"])

    chosen = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return by_batch(chosen, f"doc_id {id_type}, held_out boolean, lang_pred string, score double", work)


def keep_known(docs: DataFrame, network: Network, least: float, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text is in a learned language with at least ``least``."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(pickle.dumps(network))
    place = docs.columns.index(text_col)

    def work(batch):
        languages, scores = predict(pickle.loads(shared.value), strings(batch.column(place)))
        kept = [lang != UNKNOWN and score >= least for lang, score in zip(languages, scores)]
        yield batch.filter(pa.array(kept, pa.bool_()))

    return by_batch(docs, docs.schema, work)
