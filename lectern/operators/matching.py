"""Best-match joins between a catalogue and a table of candidates.

The candidates table holds the search hits of each book (``key`` plus hit columns) and
is given by the caller. Scores are computed once per distinct pair of compared texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.codes import doi_from_url
from lectern.functions.similarity import matched_name_share, score_bound, sequence_scores, title_band
from lectern.functions.text import fold_marks, normalize_text, search_title, split_list, strip
from lectern.operators.skew import attach, shuffle_width
from lectern.session import settle


def first_page(candidates: DataFrame, rank: str = "cand_rank", per_page: int = fixed.DEFAULT_PER_PAGE) -> DataFrame:
    """The hits a lookup of this page size would have returned; ``rank`` counts from 1."""
    if not 1 <= per_page <= fixed.MAX_PER_PAGE:
        raise ValueError(f"a page holds 1 to {fixed.MAX_PER_PAGE} hits")
    return candidates.where(F.col(rank) <= per_page)


def books_only(candidates: DataFrame) -> DataFrame:
    """The hits of type book."""
    return candidates.where(F.col("type") == "book")


def candidate_title() -> Column:
    """Display name, else title, else empty; an empty text counts as missing."""
    return F.coalesce(F.nullif("display_name", F.lit("")), F.nullif("title", F.lit("")), F.lit(""))


def candidate_names(authorships: str = "authorships") -> Column:
    """Author names of a hit; entries without a name are skipped."""
    names = F.transform(F.col(authorships), lambda entry: entry["author"]["display_name"])
    present = F.filter(names, lambda name: name.isNotNull() & (name != ""))
    return F.coalesce(present, F.array().cast("array<string>"))


COMPARED = ["asked_title", "asked_names", "hit_title", "hit_names"]


def text_digest(names: list[str]) -> Column:
    """128 bits of SHA-256 over some columns: 16 bytes, which every hit carries through a file and two shuffles."""
    return F.unhex(F.left(F.sha2(F.to_json(F.struct(*names)), 256), F.lit(32)))


def candidate_pairs(books: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """Each hit beside the texts of its book, as they were given, with a digest of the compared texts in ``pair``."""
    asked = books.select(
        key, F.coalesce("title", F.lit("")).alias("asked_title"), F.coalesce("authors", F.lit("")).alias("asked_names"))
    return settle(hits.join(asked, key).withColumn("pair", text_digest(COMPARED)))


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Every compared combination once, over as many tasks as shuffles use.

    Copies of one work do not multiply the scoring, and the shuffle goes by a digest, not by
    four texts. Scoring is heavy for few bytes, so the partitions must not be merged by their
    size; normalising the texts comes after this, for the same reason.
    """
    distinct = pairs.groupBy("pair").agg(F.count("*").alias("pair_rows"), *[F.any_value(name).alias(name) for name in COMPARED])
    return distinct.repartition(shuffle_width(pairs), "pair")


def scores_to_hits(pairs: DataFrame, scores: DataFrame, key: str, hit: str) -> DataFrame:
    return attach(pairs, scores, ["pair"], "pair_rows", F.struct(key, hit), how="inner").drop("pair_rows", "pair")


COMPARED_TEXTS = ["title", "hit_title", "names", "hit_names"]


def normalised_pairs(pairs: DataFrame) -> DataFrame:
    return distinct_pairs(pairs).select(
        "pair", "pair_rows", normalize_text("asked_title").alias("title"), normalize_text("hit_title").alias("hit_title"),
        F.transform(split_list("asked_names"), normalize_text).alias("names"),
        F.transform("hit_names", normalize_text).alias("hit_names"))


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Scores (``pair``, ``pair_rows``, title_score, author_score, match_score) of every distinct pair.

    Ratios of a whole batch cost less than a bound of each pair, and far less than the joins
    over all hits that tell which pairs can be a book's best.
    """
    return settle(normalised_pairs(pairs).withColumn("_scores", sequence_scores(*COMPARED_TEXTS)).select("pair", "pair_rows", "_scores.*"))


# a score is rounded to four places, so one this far below the best cannot be rounded up to it
ROUNDED = 0.00006


@dataclass(frozen=True)
class Scored:
    """Scores of the pairs that can be a book's best, and how much work that was."""

    scores: DataFrame
    work: DataFrame


def score_promising(pairs: DataFrame, key: str) -> Scored:
    """Scores (``pair``, ``pair_rows``, title_score, author_score, match_score) of every pair that can be the best of a book.

    Each distinct pair gets an upper bound of its score in the JVM. The pair with the highest
    bound of each book is scored first; of the others only those whose bound reaches their
    book's score so far, equal scores included. ``work``: ``pairs``, ``scored`` and ``skipped``.
    That takes joins over all hits, so it is for few hits with long texts; ``score_pairs`` scores all.
    """
    bounded = settle(normalised_pairs(pairs).withColumn("bound", score_bound(*[F.col(name) for name in COMPARED_TEXTS])))

    def scored(chosen: DataFrame) -> DataFrame:
        rows = bounded.join(chosen.select("pair"), "pair", "left_semi").repartition(shuffle_width(pairs), "pair")
        return settle(rows.withColumn("_scores", sequence_scores(*COMPARED_TEXTS)).select("pair", "pair_rows", "_scores.*"))

    linked = settle(attach(pairs.select(key, "pair"), bounded.select("pair", "pair_rows", "bound"), ["pair"], "pair_rows",
                           F.col(key), how="inner").select(key, "pair", "bound"))
    first = settle(linked.groupBy(key).agg(F.max_by("pair", F.struct("bound", "pair")).alias("pair"), F.count("*").alias("hits")))
    asked = first.groupBy("pair").agg(F.count("*").alias("uses"))
    found = scored(asked)
    reached = attach(first, found.join(asked, "pair").select("pair", "uses", "match_score"), ["pair"], "uses", F.col(key),
                     how="inner").select(key, "hits", "match_score")
    open_ = attach(linked, reached, [key], "hits", F.col("pair"), how="inner").where(
        F.col("bound") >= F.col("match_score") - ROUNDED)
    rest = scored(open_.select("pair").distinct().join(asked, "pair", "left_anti"))
    scores = found.union(rest)
    n_scored = scores.agg(F.count("*").alias("scored")).scalar()
    work = bounded.agg(F.count("*").alias("pairs")).select("pairs", n_scored.alias("scored")).withColumn(
        "skipped", F.col("pairs") - F.col("scored"))
    return Scored(scores, work)


def book_hits(candidates: DataFrame, key: str) -> DataFrame:
    return books_only(candidates).select(
        key, "cand_rank", F.col("id").alias("openalex_id"), "doi", "cited_by_count",
        candidate_title().alias("hit_title"), candidate_names().alias("hit_names"),
    )


def match_books(books: DataFrame, candidates: DataFrame, key: str, minimum: float = fixed.MINIMUM_MATCH) -> DataFrame:
    """Best candidate of each book by 0.8 title + 0.2 author similarity, over all given hits of type book.

    ``books``: key, title, authors (``;`` cell). ``candidates``: key, cand_rank,
    display_name, title, authorships, id, doi, cited_by_count, type. The first of equal
    scores wins; books without hits get ``no_results``. Every distinct pair of texts is
    scored once.
    """
    pairs = candidate_pairs(books, book_hits(candidates, key), key)
    scores = score_pairs(pairs)
    shown = ["openalex_id", "matched_title", "doi", "cited_by_count", "title_score", "author_score", "match_score"]
    named = scores_to_hits(pairs, scores, key, "cand_rank").withColumn("matched_title", F.nullif("hit_title", F.lit("")))
    best = named.groupBy(key).agg(
        F.max_by(F.struct(*shown), F.struct(F.col("match_score"), -F.col("cand_rank"), "openalex_id")).alias("_best")
    ).select(key, "_best.*")
    joined = books.select(key, F.col("title").alias("query_title")).join(best, key, "left")
    status = (
        F.when(F.col("match_score").isNull(), fixed.NO_RESULTS)
        .when(F.col("match_score") >= minimum, fixed.MATCHED)
        .otherwise(fixed.LOW_CONFIDENCE)
    )
    return joined.select(key, "query_title", status.alias("match_status"),
                         F.lit(fixed.FROM_LIVE).alias("data_source"), *shown,
                         F.lit(None).cast("string").alias("error"))


def score_fuzzy(books: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Banded title score and greedy author share for each usable hit; no author match means zero.

    Titles are compared lower-cased with accents, names without. Hits without a title
    and hits of other types than book are not scored.
    """
    hits = books_only(candidates).where(F.col("title").isNotNull()).select(
        key, F.col("title").alias("hit_title"), candidate_names().alias("hit_names"),
        F.col("id").alias("cand_id"), doi_from_url("doi").alias("cand_doi"), "cited_by_count",
    )
    pairs = candidate_pairs(books, hits, key)
    compared = distinct_pairs(pairs).select(
        "pair", "pair_rows", F.lower(search_title("asked_title")).alias("_title"),
        fold_marks("asked_names").alias("_names"), F.lower(strip("hit_title")).alias("cand_title"),
        F.array_join(F.transform("hit_names", fold_marks), ";").alias("cand_names"),
    )
    scores = settle(compared.select(
        "pair", "pair_rows", "cand_title", "cand_names", title_band("_title", "cand_title").alias("title_raw"),
        matched_name_share("_names", "cand_names").alias("author_raw"),
    ))
    final = F.when(F.col("author_raw") == 0, F.lit(0.0)).otherwise(
        fixed.TITLE_WEIGHT * F.col("title_raw") + fixed.AUTHOR_WEIGHT * F.col("author_raw"))
    return scores_to_hits(pairs, scores, key, "cand_id").select(
        key, "cand_title", "cand_names", F.round("title_raw", 4).alias("title_score"),
        F.round("author_raw", 4).alias("author_score"), F.round(final, 4).alias("final_score"),
        "cand_id", "cand_doi", "cited_by_count",
    )


RANKING = ["final_score", "title_score", "author_score", "cand_id", "cand_doi"]


def best_fuzzy(scored: DataFrame, key: str) -> DataFrame:
    """Top hit by five descending criteria, and its lead over the second score.

    Scores take few values, so a book's hits are first reduced to one row per score.
    """
    by_score = scored.groupBy(key, "final_score").agg(
        F.max(F.struct(*RANKING, "cited_by_count")).alias("_top"), F.count("*").alias("_n")
    )
    best = by_score.groupBy(key).agg(
        F.max("_top").alias("_top"),
        F.max_by("_n", "final_score").alias("_n"),
        F.sort_array(F.collect_set("final_score"), asc=False).alias("_scores"),
    )
    top = F.col("_top.final_score")
    second = F.when(F.col("_n") > 1, top).otherwise(F.coalesce(F.get("_scores", 1), F.lit(0.0)))
    return best.select(key, "_top.*", F.round(top - second, 4).alias("margin"))


def match_fuzzy(books: DataFrame, candidates: DataFrame, key: str,
                minimum: float = fixed.MINIMUM_FINAL) -> DataFrame:
    """One row per book: status of the lookup and, when found, DOI and citations."""
    best = best_fuzzy(score_fuzzy(books, candidates, key), key)
    seen = books_only(candidates).groupBy(key).agg(F.count("*").alias("_hits"))
    joined = books.select(key).join(seen, key, "left").join(best, key, "left")
    has_id = F.contains(F.col("cand_id"), F.lit(".org/"))
    found = F.coalesce((F.col("final_score") >= minimum) & has_id, F.lit(False))
    status = (
        F.when(F.col("_hits").isNull(), fixed.CONSULTED_NOT_FOUND)
        .when(F.col("final_score").isNull(), fixed.CONSULTED_BAD_TITLE)
        .when(found, fixed.CONSULTED_FOUND)
        .otherwise(fixed.CONSULTED_LOW_SCORE)
    )
    return joined.select(
        key, status.alias("consulted"), "cand_id", "final_score", "title_score", "author_score", "margin",
        F.when(found, F.col("cand_doi")).alias("doi"), F.when(found, F.col("cited_by_count")).alias("citations"),
    )
