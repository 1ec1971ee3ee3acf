"""Similarity scores.

Token-set scores are closed-form column expressions. The Ratcliff-Obershelp ratio
has no native counterpart: it runs as an Arrow function over pairs that were joined,
normalised and made distinct by Spark beforehand. All pairs of a batch are matched
together in numpy, with the same result as ``difflib``.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import fixed_values as fixed
from lectern.functions.text import SPACE, as_column, bind, split_plain


def tokens(value) -> Column:
    """Distinct whitespace-separated words."""
    words = F.split(F.coalesce(as_column(value), F.lit("")), SPACE + "+")
    return F.array_distinct(F.filter(words, lambda word: word != ""))


def _joined_length(words: Column) -> Column:
    return F.length(F.array_join(words, " "))


def token_set_ratio_of(left: Column, right: Column) -> Column:
    """0..100 for two token sets (plain columns or bound values).

    The shared words are a prefix of both compared strings, so the ratio is
    2i / (i + t) with i the shared length and t the shorter full string.
    """
    lengths = F.struct(
        _joined_length(F.array_intersect(left, right)).alias("shared"),
        F.least(_joined_length(F.array_except(left, right)), _joined_length(F.array_except(right, left))).alias("rest"),
    )

    def ratio(part: Column) -> Column:
        shared, rest = part["shared"], part["rest"]
        full = shared + rest + F.when((shared > 0) & (rest > 0), 1).otherwise(0)
        return F.when(shared + rest == 0, F.lit(100.0)).otherwise(F.lit(200.0) * shared / (shared + full))

    return bind(lengths, ratio)


def token_set_ratio(left, right) -> Column:
    return bind(tokens(left), lambda one: bind(tokens(right), lambda other: token_set_ratio_of(one, other)))


def title_band(left, right) -> Column:
    """1.0 for equal titles, then fixed steps on the token-set ratio."""
    left, right = as_column(left), as_column(right)

    def band(ratio: Column) -> Column:
        score = F.when((left != "") & (left == right), F.lit(1.0))
        for floor, value in fixed.TITLE_BANDS:
            score = score.when(ratio >= floor, F.lit(value))
        return score.otherwise(F.lit(0.0))

    return bind(token_set_ratio(left, right), band)


def matched_name_share(names, candidates, threshold: float = fixed.NAME_THRESHOLD) -> Column:
    """Share of ``names`` that find a partner, one to one, taken in order, best first.

    Both sides are ``;`` lists already folded for comparison.
    """
    return bind(F.transform(split_plain(names), tokens), lambda wanted: bind(
        F.transform(split_plain(candidates), tokens), lambda offered: _greedy_share(wanted, offered, threshold)))


def _greedy_share(wanted: Column, offered: Column, threshold: float) -> Column:
    start = F.struct(
        F.transform(offered, lambda _: F.lit(False)).alias("used"), F.lit(0).alias("hits")
    )

    def take(state: Column, name: Column) -> Column:
        scored = F.transform(
            offered,
            lambda other, place: F.when(
                ~F.get(state["used"], place),
                F.struct(token_set_ratio_of(name, other).alias("ratio"), (-place).alias("early")),
            ),
        )

        def settle(best: Column) -> Column:
            good = F.coalesce(best["ratio"] >= threshold, F.lit(False))
            used = F.transform(
                state["used"],
                lambda flag, place: flag | F.coalesce(good & (place == -best["early"]), F.lit(False)),
            )
            return F.struct(used.alias("used"), (state["hits"] + good.cast("int")).alias("hits"))

        return bind(F.array_max(scored), settle)

    share = F.aggregate(wanted, start, take, lambda state: state["hits"] / F.size(wanted))
    return F.when((F.size(wanted) == 0) | (F.size(offered) == 0), F.lit(0.0)).otherwise(share)


# --- bounds: no ratio is larger, and they stay in the JVM ------------------------------------------


def _share(common: Column, left: Column, right: Column) -> Column:
    total = F.length(left) + F.length(right)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * common / total)


def length_bound(left: Column, right: Column) -> Column:
    """Of two texts at most the shorter one can match."""
    return _share(F.least(F.length(left), F.length(right)), left, right)


def letters_bound(left: Column, right: Column) -> Column:
    """At most the characters that both texts have, each as often as both have it, can match."""
    def times(text: Column, letter: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, letter, F.lit("")))

    letters = F.array_distinct(F.regexp_extract_all(left, F.lit("(?s)."), F.lit(0)))
    common = F.aggregate(letters, F.lit(0), lambda sum_, letter: sum_ + F.least(times(left, letter), times(right, letter)))
    return _share(common, left, right)


def score_bound(title: Column, candidate_title: Column, names: Column, candidate_names: Column) -> Column:
    """No smaller than the combined score that ``sequence_scores`` gives the same texts, before rounding."""
    best = F.transform(names, lambda name: F.array_max(F.transform(candidate_names, lambda other: letters_bound(name, other))))
    total = F.aggregate(best, F.lit(0.0), lambda sum_, one: sum_ + one)
    people = F.when((F.size(names) == 0) | (F.size(candidate_names) == 0), F.lit(0.0)).otherwise(total / F.size(names))
    return fixed.TITLE_WEIGHT * letters_bound(title, candidate_title) + fixed.AUTHOR_WEIGHT * people


# difflib sets frequent characters aside in texts of 200 characters and more: those are left to it
SHORT = 200
CELLS = 1 << 15      # cells of a table of runs that are worked on together
HELD_NAMES = 1 << 17 # pairs of names whose ratio a worker keeps


def _ratio(left: str, right: str) -> float:
    return SequenceMatcher(None, left, right).ratio()


def _longest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of the longest common run of each column's two texts, and its place in both: the first in the left text, then in the right one."""
    # a cell holds 256 times the length of the run that ends there, and 255 less the place where it begins on the right
    begun = (255 - np.arange(len(right), dtype=np.uint16))[:, None]
    runs = np.zeros((len(right) + 1, right.shape[1]), dtype=np.uint16)
    longer, equal = np.empty(right.shape, dtype=np.uint16), np.empty(right.shape, dtype=bool)
    best, end = np.zeros(right.shape[1], dtype=np.uint16), np.zeros(right.shape[1], dtype=np.int64)
    for row, letters in enumerate(left):
        np.maximum(runs[:-1], begun, out=longer)
        longer += 256
        np.equal(right, letters, out=equal)
        np.multiply(longer, equal, out=runs[1:])
        top = runs[1:].max(axis=0)
        better = top >> 8 > best >> 8
        best[better] = top[better]
        end[better] = row
    size = (best >> 8).astype(np.int64)
    return size, end + 1 - size, 255 - (best & 255).astype(np.int64)


def matched_letters(left: list[str], right: list[str]) -> np.ndarray:
    """Characters that SequenceMatcher matches in each pair of texts below ``SHORT``, all pairs together: the longest common
    run, and the same again on both its sides."""
    points = np.frombuffer("".join([*left, *right]).encode("utf-32-le"), dtype=np.uint32)
    known, codes = np.unique(points, return_inverse=True)
    codes = codes.astype(np.uint8 if len(known) < 254 else np.uint32)
    lengths = np.fromiter(map(len, [*left, *right]), dtype=np.int64, count=2 * len(left))
    starts = np.cumsum(lengths) - lengths
    pair, n = np.arange(len(left)), len(left)
    at, size_at, to, size_to = starts[:n], lengths[:n], starts[n:], lengths[n:]
    matched = np.zeros(n, dtype=np.int64)

    def columns(start, size, other):
        place = np.arange(size.max())[:, None]
        letters = codes[np.minimum(start + place, len(codes) - 1)]
        letters[place >= size] = len(known) + other
        return letters

    while True:
        open_ = np.flatnonzero((size_at > 0) & (size_to > 0))
        open_ = open_[np.lexsort((-size_at[open_], -size_to[open_]))]
        if not len(open_):
            return matched
        pair, at, size_at, to, size_to = (held[open_] for held in (pair, at, size_at, to, size_to))
        found, first = [], 0
        while first < len(pair):
            some = slice(first, first + max(16, CELLS // int(size_to[first])))
            found.append(_longest(columns(at[some], size_at[some], 0), columns(to[some], size_to[some], 1)))
            first = some.stop
        size, on_left, on_right = map(np.concatenate, zip(*found))
        np.add.at(matched, pair, size)
        some = np.flatnonzero(size)
        pair, at, size_at, to, size_to, size, on_left, on_right = (
            held[some] for held in (pair, at, size_at, to, size_to, size, on_left, on_right))
        pair, at, to, size_at, size_to = (np.concatenate(sides) for sides in (
            (pair, pair), (at, at + on_left + size), (to, to + on_right + size),
            (on_left, size_at - on_left - size), (on_right, size_to - on_right - size)))


def sequence_ratios(pairs: list[tuple[str, str]]) -> list[float]:
    """The Ratcliff-Obershelp ratio of each pair, as ``SequenceMatcher`` gives it."""
    short = [place for place, (left, right) in enumerate(pairs) if len(left) < SHORT and len(right) < SHORT]
    ratios = dict.fromkeys(range(len(pairs)), 1.0)
    matched = matched_letters([pairs[place][0] for place in short], [pairs[place][1] for place in short])
    for place, letters in zip(short, matched.tolist()):
        total = len(pairs[place][0]) + len(pairs[place][1])
        if total:
            ratios[place] = 2.0 * letters / total
    for place in ratios.keys() - set(short):
        ratios[place] = _ratio(*pairs[place])
    return list(ratios.values())


_held: dict[tuple[str, str], float] = {}


def name_ratios(pairs: set[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """The ratios of pairs of names, which repeat over many batches."""
    new = [pair for pair in pairs if pair not in _held]
    found = dict(zip(new, sequence_ratios(new)))
    if len(_held) + len(found) > HELD_NAMES:
        found |= {pair: _held[pair] for pair in pairs if pair in _held}
        _held.clear()
        return found
    _held.update(found)
    return _held


SCORES = T.StructType([
    T.StructField(name, T.DoubleType()) for name in ("title_score", "author_score", "match_score")
])


@F.pandas_udf(SCORES)
def sequence_scores(
    title: pd.Series, candidate_title: pd.Series, names: pd.Series, candidate_names: pd.Series
) -> pd.DataFrame:
    """Scores of normalised pairs, combined unrounded and rounded to four places."""
    titles = list(zip(title, candidate_title))
    compared = list(dict.fromkeys(titles))
    of_titles = dict(zip(compared, sequence_ratios(compared)))
    people = [(list(wanted), list(offered)) for wanted, offered in zip(names, candidate_names)]
    of_names = name_ratios({(name, other) for wanted, offered in people for name in wanted for other in offered})
    rows = []
    for both, (wanted, offered) in zip(titles, people):
        title_score = of_titles[both]
        author_score = 0.0
        if wanted and offered:
            author_score = sum(max(of_names[name, other] for other in offered) for name in wanted) / len(wanted)
        combined = fixed.TITLE_WEIGHT * title_score + fixed.AUTHOR_WEIGHT * author_score
        rows.append((round(title_score, 4), round(author_score, 4), round(combined, 4)))
    return pd.DataFrame(rows, columns=["title_score", "author_score", "match_score"])
