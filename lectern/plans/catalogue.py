"""The whole integration flow: staging -> golden catalogue -> model -> enrichment -> audit.

Tables that several later steps read (the golden catalogue, the dimensions) are written
once; everything else is lazy. Nothing is collected: metrics and the step log are
DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.codes import clean_isbn
from lectern.operators import conform, dedup, enrich, model, quality, reports, reshape
from lectern.operators.skew import attach
from lectern.session import settle
from lectern.sources import publish, readers

CATALOGUE_VALUES = ["title", "normalized_title", "authors", "publisher", "year", "country", "pages", "language",
                    "source_url"]


@dataclass(frozen=True)
class CatalogueResult:
    catalogue: DataFrame
    sales: DataFrame
    altmetrics: DataFrame
    matches: DataFrame
    source_records: DataFrame
    events: DataFrame
    metrics: DataFrame
    tables: Mapping[str, DataFrame] = field(default_factory=dict)

    @property
    def book_summary(self) -> DataFrame:
        return enrich.book_summary(self.tables)


def canonical_catalogue(records: DataFrame) -> DataFrame:
    """One row per valid identifier."""
    return dedup.golden_record(
        conform.accepted(records), "isbn13", CATALOGUE_VALUES, "source_name", "source_row", fixed.SOURCE_PRIORITY)


def has_comparable_title() -> Column:
    return F.coalesce(F.col("normalized_title"), F.lit("")) != ""


def comparable(catalogue: DataFrame) -> DataFrame:
    """The catalogue rows that can be filed under a title."""
    return catalogue.where(has_comparable_title())


def untitled(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows without a title, or with one of which normalising leaves nothing, with the reason."""
    reason = F.when(F.col("title").isNull(), "no title").otherwise("title without comparable letters")
    return catalogue.where(~has_comparable_title()).withColumn("reason", reason)


def numeric_key(column: str = "isbn13"):
    return F.col(column).cast("long")


class RelationalModel:
    """publishers, authors, books, editions, book_authors, with ids in catalogue order.

    Editions that share a normalised title share a book; the first edition names it.
    Dimensions are written once, because editions and bridges read them several times.
    """

    def __init__(self, catalogue: DataFrame):
        self.numbered = catalogue.withColumn("position", numeric_key())

    @cached_property
    def publishers(self) -> DataFrame:
        return settle(model.dimension(self.numbered, "publisher", ["position"], "publisher_id"))

    @cached_property
    def books(self) -> DataFrame:
        titles = self.numbered.groupBy("normalized_title").agg(
            F.min_by(F.struct("position", "title", "year", "country"), "position").alias("_first"),
            F.count("*").alias("uses"),
        )
        by_position = F.col("_first.position")
        numbered = model.dense_ids(titles, F.floor(by_position / model.ID_BLOCK), [by_position], "book_id")
        return settle(numbered.select(
            "book_id", "normalized_title", "_first.title", F.col("_first.year").alias("first_publication_year"),
            "_first.country", "uses"))

    @cached_property
    def with_book(self) -> DataFrame:
        ids = self.books.select("normalized_title", "book_id", "uses")
        return attach(self.numbered, ids, ["normalized_title"], "uses", F.col("isbn13"), how="inner").drop("uses")

    @cached_property
    def people(self) -> DataFrame:
        return settle(reshape.explode_list(
            self.with_book.select("book_id", F.col("position").alias("at"), "authors"), ["book_id", "at"], "authors",
            "name"))

    @cached_property
    def authors(self) -> DataFrame:
        return settle(model.dimension(self.people, "name", ["at", "position"], "author_id"))

    @cached_property
    def editions(self) -> DataFrame:
        return attach(self.with_book, self.publishers, ["publisher"], "uses", F.col("isbn13")).select(
            "isbn13", "book_id", "publisher_id", F.col("year").cast("int").alias("publication_year"),
            F.col("pages").cast("int").alias("pages"), "language", "source_count", "source_names", "source_url")

    @cached_property
    def book_authors(self) -> DataFrame:
        return model.bridge(self.people, "book_id", self.authors, "name", "author_id", F.col("book_id"))

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        """Each table is built when it is asked for, so nothing is written that is not read."""
        return OnDemand({
            "publishers": lambda: self.publishers.select("publisher_id", F.col("publisher").alias("name")),
            "authors": lambda: self.authors.select("author_id", "name"),
            "books": lambda: self.books.drop("uses"),
            "editions": lambda: self.editions,
            "book_authors": lambda: self.book_authors,
        })


class OnDemand(Mapping):
    """Tables by name, each built at its first use."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def joined_with(self, others: dict[str, DataFrame]) -> OnDemand:
        own = {name: partial(self.__getitem__, name) for name in self}
        return OnDemand(own | {name: partial(lambda frame: frame, frame) for name, frame in others.items()})


def clean_sales(sales: DataFrame, catalogue: DataFrame) -> DataFrame:
    cleaned = sales.withColumn("isbn13", clean_isbn("isbn13")).withColumn(
        "sale_date", F.date_format(F.col("sale_date").cast("date"), "yyyy-MM-dd"))
    return enrich.known_only(cleaned, catalogue, "isbn13")


def clean_metrics(metrics: DataFrame, catalogue: DataFrame) -> DataFrame:
    return enrich.known_only(metrics.withColumn("isbn13", clean_isbn("isbn13")), catalogue, "isbn13")


def step_log(records: DataFrame, catalogue: DataFrame, mode: str) -> DataFrame:
    """Six fixed steps with rows in, rows out and a text; counts come from one-row aggregates."""
    staged = records.agg(
        F.count("*").alias("n_staged"), F.count_if("valid_isbn").alias("n_valid"),
        F.count_if(~F.col("valid_isbn")).alias("n_invalid"))
    repeated = dedup.duplicate_row_count(conform.accepted(records), ["isbn13"], "n_repeated")
    golden = catalogue.agg(F.count("*").alias("n_golden"))
    n_repeated, n_golden = repeated.scalar(), golden.scalar()
    counts = staged.select("*", n_repeated.alias("n_repeated"), n_golden.alias("n_golden"))
    flows = [("n_staged", "n_staged"), ("n_staged", "n_staged"), ("n_staged", "n_valid"), ("n_valid", "n_golden"),
             ("n_golden", "n_golden"), ("n_golden", "n_golden")]
    mentioned = [None, None, "n_invalid", "n_repeated", None, None]
    steps = []
    for number, (name, text, (rows_in, rows_out), count) in enumerate(
            zip(fixed.STEP_NAMES, fixed.STEP_DETAILS, flows, mentioned), start=1):
        details = F.lit(text.replace("{mode}", mode))
        if count:
            details = F.replace(details, F.lit("{n}"), F.col(count).cast("string"))
        steps.append(F.struct(
            F.lit(number).alias("event_id"), F.lit(name).alias("step_name"), F.col(rows_in).alias("input_rows"),
            F.col(rows_out).alias("output_rows"), details.alias("details")))
    return counts.select(F.explode(F.array(*steps)).alias("_step")).select("_step.*")


def flow_metrics(records: DataFrame, catalogue: DataFrame, sales: DataFrame, matches: DataFrame) -> DataFrame:
    """The run's figures as (metric, value) rows, each out of a one-row aggregate."""

    def long(row: DataFrame) -> DataFrame:
        cells = F.explode(F.array(*[
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in row.columns
        ]))
        return row.select(cells.alias("_cell")).select("_cell.*")

    return conform.union_all([
        long(records.agg(F.count("*").alias("source_rows"), F.count_if(~F.col("valid_isbn")).alias("invalid_rows"))),
        long(catalogue.agg(F.count("*").alias("catalogue_books"))),
        long(dedup.duplicate_row_count(conform.accepted(records), ["isbn13"])),
        long(sales.agg(
            F.count("*").alias("sales_rows"), F.coalesce(F.sum("units"), F.lit(0)).alias("units_sold"),
            F.coalesce(enrich.money_total("revenue_eur"), F.lit(0.0)).alias("revenue_eur"))),
        long(matches.agg(
            F.count_if(F.col("data_source") == fixed.FROM_LIVE).alias("openalex_live_rows"),
            F.count_if(F.col("match_status") == fixed.MATCHED).alias("openalex_matched_rows"))),
    ])


def build(records: DataFrame, sales: DataFrame, metrics: DataFrame, fixture: DataFrame, mode: str = "offline",
          results: DataFrame | None = None, failures: DataFrame | None = None,
          catalogue: DataFrame | None = None) -> CatalogueResult:
    """Everything the flow delivers, from a staging table and the auxiliary inputs.

    A golden catalogue that was already written can be passed in.
    """
    catalogue = comparable(settle(canonical_catalogue(records)) if catalogue is None else catalogue)
    sold = clean_sales(sales, catalogue)
    attention = clean_metrics(metrics, catalogue)
    matches = enrich.enrich(catalogue, mode, fixture, results, failures)
    trace = conform.source_trace(records)
    log = step_log(records, catalogue, mode)
    tables = RelationalModel(catalogue).tables.joined_with({
        "sales": sold, "altmetrics": attention, "openalex_enrichment": matches,
        "source_records": trace, "pipeline_events": log,
    })
    return CatalogueResult(catalogue, sold, attention, matches, trace, log,
                           flow_metrics(records, catalogue, sold, matches), tables)


SALES_COLUMNS = ["isbn13", "sale_date", "units", "revenue_eur", "channel", "synthetic"]
METRIC_COLUMNS = ["isbn13", "mentions", "readers", "demo_score", "synthetic"]


def run(spark: SparkSession, data_folder: str, target_folder: str, mode: str = "offline",
        fixture_path: str | None = None, results: DataFrame | None = None,
        failures: DataFrame | None = None) -> CatalogueResult:
    """Read the declared exports, write the golden catalogue first, build everything on it, publish all tables as one.

    Staging, catalogue, quarantine and model tables are one publication: readers of
    ``target_folder`` (``publish.published``) see the tables of one complete run. The
    written staging and catalogue tables cut the lineage: later steps read them instead of
    repeating the survivorship.
    """
    run_ = publish.Publication(spark, target_folder)
    records = run_.write("staging", readers.read_sources(spark, data_folder))
    sales = readers.read_csv(spark, f"{data_folder}/ventas.csv", SALES_COLUMNS).select(
        "isbn13", "sale_date", F.col("units").cast("int"), F.col("revenue_eur").cast("double"), "channel",
        F.col("synthetic").cast("int"))
    metrics = readers.read_csv(spark, f"{data_folder}/altmetrics.csv", METRIC_COLUMNS).select(
        "isbn13", F.col("mentions").cast("int"), F.col("readers").cast("int"), F.col("demo_score").cast("double"),
        F.col("synthetic").cast("int"))
    fixture = readers.read_fixture(spark, fixture_path or f"{data_folder}/fixture.json")
    golden = settle(canonical_catalogue(records))
    catalogue = run_.write("catalogue", comparable(golden))
    run_.write("quarantine_titles", untitled(golden))
    quality.require(quality.integrity_report(catalogue, records))
    built = build(records, sales, metrics, fixture, mode, results, failures, catalogue)
    for name, frame in built.tables.items():
        run_.write(name, frame)
    run_.write("quarantine", conform.rejected(records))
    run_.commit()
    return built


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reports.row_counts(tables)


REFERENCES = {
    "editions.book_id": ("editions", "books", "book_id"),
    "editions.publisher_id": ("editions", "publishers", "publisher_id"),
    "book_authors.book_id": ("book_authors", "books", "book_id"),
    "book_authors.author_id": ("book_authors", "authors", "author_id"),
    "sales.isbn13": ("sales", "editions", "isbn13"),
    "altmetrics.isbn13": ("altmetrics", "editions", "isbn13"),
    "openalex_enrichment.isbn13": ("openalex_enrichment", "editions", "isbn13"),
}

UNIQUE_KEYS = {
    "publishers": ["name"], "authors": ["name"], "books": ["normalized_title"], "editions": ["isbn13"],
    "book_authors": ["book_id", "author_id"], "altmetrics": ["isbn13"], "openalex_enrichment": ["isbn13"],
}


def reference_report(tables: dict[str, DataFrame]) -> DataFrame:
    return quality.reference_report({
        name: (tables[child], tables[parent], key) for name, (child, parent, key) in REFERENCES.items()})


def uniqueness_report(tables: dict[str, DataFrame]) -> DataFrame:
    return quality.uniqueness_report({name: (tables[name], keys) for name, keys in UNIQUE_KEYS.items()})
