"""Joining facts, metrics and matches to the catalogue, with explicit fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.operators.conform import reindex

MONEY = "decimal(38,10)"


def money_total(column: str) -> Column:
    """Sum of all rows, exact in any order, rounded once to cents."""
    return F.round(F.sum(F.col(column).cast(MONEY)), 2).cast("double")


def known_only(facts: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Facts whose key is in the catalogue; the plan picks broadcast or shuffle from measured sizes."""
    return facts.join(catalogue.select(key), key, "left_semi")


def orphans(facts: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    return facts.join(catalogue.select(key), key, "left_anti")


def sales_rollup(sales: DataFrame, key: str, units: str, revenue: str) -> DataFrame:
    """Units and revenue per key."""
    return sales.groupBy(key).agg(
        F.sum(units).alias("units_sold"),
        money_total(revenue).alias("revenue_eur"),
    )


def author_rollup(book_authors: DataFrame, authors: DataFrame, separator: str = "; ") -> DataFrame:
    """Names of each book in alphabetical order."""
    named = book_authors.join(authors.select("author_id", "name"), "author_id")
    return named.groupBy("book_id").agg(
        F.array_join(F.array_sort(F.collect_list("name")), separator).alias("authors")
    )


def book_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """The star view: every side is reduced to one row per key before it is joined."""
    rollup = author_rollup(tables["book_authors"], tables["authors"])
    sold = sales_rollup(tables["sales"], "isbn13", "units", "revenue_eur")
    matches = tables["openalex_enrichment"].select(
        "isbn13", "openalex_id", F.col("doi").alias("openalex_doi"), F.col("cited_by_count").alias("openalex_citations"),
        F.col("match_status").alias("openalex_match_status"), F.col("data_source").alias("openalex_data_source"),
    )
    books = tables["books"].select("book_id", "title", "country")
    publishers = tables["publishers"].select("publisher_id", F.col("name").alias("publisher"))
    wide = (
        tables["editions"]
        .join(books, "book_id")
        .join(rollup, "book_id", "left")
        .join(publishers, "publisher_id", "left")
        .join(sold, "isbn13", "left")
        .join(tables["altmetrics"].select("isbn13", "mentions", "readers", "demo_score"), "isbn13", "left")
        .join(matches, "isbn13", "left")
    )
    return wide.select(
        "isbn13", "title", "authors", "publisher", "publication_year", "country", "pages", "source_count",
        "source_names",
        *[F.coalesce(F.col(name), F.lit(0)).alias(name)
          for name in ["units_sold", "revenue_eur", "mentions", "readers", "demo_score"]],
        "openalex_id", "openalex_doi", "openalex_citations", "openalex_match_status", "openalex_data_source",
    )


def last_write(updates: DataFrame, key: str, values: list[str], row: str) -> DataFrame:
    """Per key the values of its last row; rows without a key are skipped."""
    grouped = updates.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(*values), row).alias("_last")
    )
    return grouped.select(key, "_last.*")


def update_from(base: DataFrame, updates: DataFrame, key: str, values: list[str], row: str) -> DataFrame:
    """Overwrite ``values`` of the keys that have an update; a NULL update overwrites too."""
    new = last_write(updates, key, values, row).select(
        key, F.lit(True).alias("_hit"), *[F.col(name).alias(f"_new_{name}") for name in values]
    )
    joined = base.join(new, key, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name) if name in values
        else F.col(name)
        for name in base.columns
    ])


def not_yet_done(work: DataFrame, state: DataFrame, keys: list[str], mark: str) -> DataFrame:
    """Rows without any mark in the state table."""
    done = state.where(F.col(mark).isNotNull()).select(*keys)
    return work.join(done, keys, "left_anti")


def fixture_matches(catalogue: DataFrame, fixture: DataFrame) -> DataFrame:
    """Fixture records as match rows; the title is looked up, empty when unknown."""
    titles = catalogue.select("isbn13", F.col("title").alias("_title"))
    latest = fixture.groupBy("isbn13").agg(
        F.max_by(F.struct("match_status", "cited_by_count_demo"), "record_no").alias("_last")
    )
    return latest.join(titles, "isbn13", "left").select(
        "isbn13",
        F.coalesce("_title", F.lit("")).alias("query_title"),
        F.coalesce("_last.match_status", F.lit(fixed.OFFLINE_DEMO)).alias("match_status"),
        F.lit(fixed.FROM_FIXTURE).alias("data_source"),
        F.col("_last.cited_by_count_demo").cast("long").alias("cited_by_count"),
    )


MATCH_TYPES = {name: "double" if name.endswith("_score") else "long" if name == "cited_by_count" else "string"
               for name in fixed.MATCH_COLUMNS}


def enrich_offline(catalogue: DataFrame, fixture: DataFrame) -> DataFrame:
    """Fixture row, else ``not_in_fixture``."""
    found = fixture_matches(catalogue, fixture).select(
        "isbn13", F.lit(True).alias("_found"), F.col("match_status").alias("_status"),
        F.col("cited_by_count").alias("_cited"),
    )
    joined = catalogue.select("isbn13", F.col("title").alias("query_title")).join(found, "isbn13", "left")
    rows = joined.select(
        "isbn13", "query_title",
        F.when(F.col("_found"), F.col("_status")).otherwise(fixed.NOT_IN_FIXTURE).alias("match_status"),
        F.lit(fixed.FROM_FIXTURE).alias("data_source"),
        F.col("_cited").alias("cited_by_count"),
    )
    return reindex(rows, MATCH_TYPES)


def enrich_live(catalogue: DataFrame, results: DataFrame, failures: DataFrame | None, fixture: DataFrame) -> DataFrame:
    """One row per catalogue row: its live result, else its fixture row, else an error row.

    ``results`` holds match rows, ``failures`` (isbn13, error) the keys whose request failed.
    A key with neither was not answered and is treated as failed, without an error text.
    """
    base = catalogue.select("isbn13", F.col("title").alias("_title"))
    if failures is None:
        failures = base.select("isbn13", F.lit(None).cast("string").alias("error")).limit(0)
    answered = reindex(results, MATCH_TYPES).join(failures.select("isbn13"), "isbn13", "left_anti")
    live = answered.join(base.select("isbn13"), "isbn13", "left_semi").select(*MATCH_TYPES)
    failed = base.join(answered.select("isbn13"), "isbn13", "left_anti").join(
        failures.select("isbn13", "error"), "isbn13", "left")
    stored = fixture_matches(catalogue, fixture).select(
        "isbn13", F.lit(True).alias("_found"), F.col("match_status").alias("_status"),
        F.col("cited_by_count").alias("_cited"),
    )
    fallback = failed.join(stored, "isbn13", "left").select(
        "isbn13", F.col("_title").alias("query_title"),
        F.when(F.col("_found"), F.col("_status")).otherwise(fixed.REQUEST_ERROR).alias("match_status"),
        F.when(F.col("_found"), fixed.FROM_FALLBACK).otherwise(fixed.FROM_ERROR).alias("data_source"),
        F.col("_cited").alias("cited_by_count"), "error",
    )
    return live.unionByName(reindex(fallback, MATCH_TYPES))


def enrich(catalogue: DataFrame, mode: str, fixture: DataFrame, results: DataFrame | None = None,
           failures: DataFrame | None = None) -> DataFrame:
    if mode not in ("offline", "live"):
        raise ValueError("mode must be 'offline' or 'live'")
    if mode == "offline":
        return enrich_offline(catalogue, fixture)
    if results is None:
        raise ValueError("mode 'live' needs results")
    return enrich_live(catalogue, results, failures, fixture)
