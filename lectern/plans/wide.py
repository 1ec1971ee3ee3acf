"""The wider model: three richer exports cleaned to one shape, loaded, standardised, matched.

Each cleaning function takes an all-text export with ``origin_file`` and an integer
``row`` and returns rows of one common shape. Identifiers that fail the prefix check are
set aside before any bridge is built, so nothing has to be deleted afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions import codes, dates, nested, text, vocab
from lectern.operators import conform, dedup, model, reports, reshape
from lectern.operators.skew import fill_forward
from lectern.session import settle

PEOPLE = "array<struct<role:string,name:string>>"
SHAPE = {
    "origin_file": "string", "row": "long", "id_original": "string", "isbn13": "string", "title": "string",
    "year": "string", "contributors": "string", "people": PEOPLE, "publishers": PEOPLE, "country": "string",
    "city": "string", "language": "string", "collection": "string", "bisac": "string", "thema": "string",
    "dewey": "string", "main_publisher": "string", "keywords": "string", "summary": "string", "shared": "string",
    "copublisher": "string", "sharing_type": "string", "edition_format": "string", "work_type": "string",
    "doi": "string", "doi_simeh": "string", "doi_scielo": "string", "edition": "string", "stores": "array<string>",
}
# load order of the exports: an identifier belongs to the first that brings it
SOURCE_RANK = {"simeh": 0, "plantilla_propia": 1, "scielo": 2}


def _rewrite(frame: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return frame.withColumns(changes)


def _shaped(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return conform.reindex(frame.select(*[value.alias(name) for name, value in columns.items()]), SHAPE)


def clean_record_export(raw: DataFrame, filter_first: bool = False) -> DataFrame:
    """Export with continuation rows, categories over several rows, and repeated identifiers.

    Continuation rows receive their record id before the years are filtered, so undated
    ones are kept; ``filter_first`` drops them.
    """
    data = [name for name in raw.columns if name not in ("origin_file", "row")]
    rows = raw.dropna(how="all", subset=data)
    dated = {"Fecha de publicación": dates.year_day_first("Fecha de publicación")}
    if filter_first:
        rows = conform.between_years(_rewrite(rows, dated), "Fecha de publicación")
    for column in ("THEMA", "Texto de contenido"):
        rows = fill_forward(rows, "RecordReference", "row", ["origin_file"], F.col(column).isNotNull())
    if not filter_first:
        rows = _rewrite(rows, dated)
        inherited = F.col("Fecha de publicación").isNull() & F.col("RecordReference").isNotNull()
        rows = rows.where(F.col("Fecha de publicación").between(fixed.YEAR_FROM, fixed.YEAR_TO) | inherited)
    rows = settle(_rewrite(rows, {"Colaborador": text.tidy_delimiters("Colaborador")}))
    # every file is cleaned by itself: equal ids in two files are two records
    file = ["origin_file"]
    rows = settle(dedup.consolidate_list_column(rows, "RecordReference", "row", "THEMA", file))
    rows = dedup.consolidate_text_column(rows, "RecordReference", "row", "Texto de contenido", file)
    rows = rows.where(F.col("Fecha de publicación").isNotNull())
    rows = settle(_rewrite(rows, {
        "Editores": text.tidy_delimiters(text.drop_parentheses("Editores")),
        "ISBN13": text.drop_decimal_zero("ISBN13"),
    }))
    merged = dedup.merge_values(rows, "ISBN13", [c for c in data if c != "ISBN13"], "row", within=file)
    listed = ["BISAC", "THEMA", "Dewey", "Palabras claves"]
    tidy = _rewrite(merged, {name: text.tidy_delimiters(text.drop_parentheses(name)) for name in listed})
    once = [*listed, "Formato", "Editor", "Colaborador", "Editores", "Fecha de publicación"]
    tidy = _rewrite(tidy, {name: text.distinct_items(name) for name in once})
    tidy = _rewrite(tidy, {"Editores": text.items_not_in("Editores", "Editor")})
    tidy = _rewrite(tidy, {name: text.blank_to_null(name) for name in data})
    col = F.col
    people = F.transform(text.split_list("Colaborador"), lambda name: F.struct(F.lit("autor").alias("role"), name.alias("name")))
    return _shaped(tidy, {
        "origin_file": col("origin_file"), "row": col("row"), "id_original": col("RecordReference"),
        "isbn13": text.or_sentinel("ISBN13", fixed.MISSING_ISBN),
        "title": text.full_title(text.or_sentinel("Título", fixed.MISSING_TITLE), "Subtítulo"),
        "year": col("Fecha de publicación"), "contributors": col("Colaborador"), "people": people,
        "publishers": reshape.publisher_roles("Editor", "Editores"), "country": col("País de publicación"),
        "city": col("Ciudad de publicación"), "language": col("Idioma"), "collection": col("Colección"),
        "bisac": codes.bisac_list("BISAC"), "thema": codes.thema_brackets("THEMA"), "dewey": codes.dewey_list("Dewey"),
        "main_publisher": col("Editor"), "keywords": col("Palabras claves"), "summary": col("Texto de contenido"),
        "shared": vocab.yes_no_from_presence("Editores"), "copublisher": col("Editores"), "edition_format": col("Formato"),
        "doi_simeh": col("DOI"),
    })


def clean_template(raw: DataFrame) -> DataFrame:
    """Own template: one row per title, an identifier column per format, a column per role."""
    rows = raw.where(F.col("anio_publicacion").try_cast("double").between(fixed.YEAR_FROM, fixed.YEAR_TO))
    listed = [name for name in (*fixed.CONTRIBUTOR_ROLES, "palabras_clave") if name in rows.columns]
    rows = _rewrite(rows, {name: text.tidy_delimiters(name) for name in listed})
    rows = _rewrite(rows, {name: text.blank_to_null(name) for name in rows.columns if name not in ("origin_file", "row")})
    long = reshape.one_row_per_edition(rows.withColumn("people", reshape.contributors()), once=["DOI"])
    long = long.where(F.size("people") > 0).withColumn("shared", vocab.yes_no("coedicion_si_no"))
    copublisher = vocab.only_if_yes("shared", "institucion_coeditora_nombre")
    col = F.col
    return _shaped(long, {
        "origin_file": col("origin_file"), "row": col("row"), "isbn13": text.drop_decimal_zero("identifier"),
        "title": col("Titulo"), "year": col("anio_publicacion").try_cast("double").cast("int"),
        "contributors": reshape.contributor_cell("people"), "people": col("people"),
        "publishers": reshape.publisher_roles("editorial_principal_nombre", copublisher),
        "country": col("pais_publicacion"), "city": col("ciudad_publicacion"), "language": col("idioma"),
        "collection": col("coleccion"), "bisac": codes.bisac_before_arrow("bisac"), "thema": codes.thema_mixed("thema"),
        "dewey": codes.dewey_leading("dewey"), "main_publisher": col("editorial_principal_nombre"),
        "keywords": col("palabras_clave"), "summary": col("resumen"), "shared": col("shared"), "copublisher": copublisher,
        "sharing_type": vocab.only_if_yes("shared", "tipo_coedicion"), "edition_format": col("edition_format"),
        "work_type": col("tipo_obra"), "doi": codes.doi_from_url("DOI"),
    })


def clean_serial_export(raw: DataFrame) -> DataFrame:
    """Export with serialised people, collection and stores, and two identifier columns."""
    rows = _rewrite(raw, {name: text.blank_to_null(name) for name in raw.columns if name not in ("origin_file", "row")})
    rows = conform.between_years(rows.withColumn("year", dates.year_iso("publication_date")), "year")
    rows = rows.withColumn("isbn13", text.drop_decimal_zero(codes.fallback_identifier("eisbn", "isbn")))
    rows = rows.where(F.col("isbn13").isNotNull()).withColumn("people", nested.creators("creators"))
    col = F.col
    return _shaped(rows, {
        "origin_file": col("origin_file"), "row": col("row"), "id_original": col("_id"), "isbn13": col("isbn13"),
        "title": col("title"), "year": col("year"), "contributors": reshape.contributor_cell("people"), "people": col("people"),
        "publishers": F.when(col("publisher").isNotNull(), F.array(F.struct(F.lit("editor").alias("role"), col("publisher").alias("name")))),
        "country": col("country"), "language": col("language"), "collection": nested.object_title("collection"),
        "bisac": codes.bisac_in_pairs("bisac_code"), "main_publisher": col("publisher"), "summary": col("synopsis"),
        "edition_format": codes.fallback_format("eisbn", "ebook"), "work_type": col("TYPE"),
        "doi_scielo": codes.doi_from_url("doi_number"), "edition": col("edition"), "stores": nested.stores("shopping_info"),
    })


# the serialised cells of the serial export, and how they are read
SERIAL_CELLS = {"creators": nested.parse_pair_lists, "collection": nested.parse_pairs, "bisac_code": nested.parse_pair_lists,
                "shopping_info": nested.parse_pair_lists}


def unreadable_cells(raw: DataFrame) -> DataFrame:
    """(origin_file, row, field, cell, reason) for serialised cells that hold something and cannot be read.

    The export's rows stay in the flow with these fields empty; this is their quarantine.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).alias("cell"), nested.unreadable(name, read(name)).alias("bad"))
        for name, read in SERIAL_CELLS.items()
    ]))
    found = raw.select("origin_file", "row", cells.alias("_cell")).where(F.col("_cell.bad"))
    return found.select("origin_file", "row", "_cell.field", "_cell.cell", F.lit("not a readable list of pairs").alias("reason"))


STANDARDS = {"country": fixed.COUNTRY_RULES, "language": fixed.LANGUAGE_RULES, "edition_format": fixed.FORMAT_RULES,
             "work_type": fixed.WORK_TYPE_RULES}


@dataclass
class WideModel:
    """Identifiers, people, publishers and works out of the cleaned exports."""

    parts: dict[str, DataFrame]

    @cached_property
    def rows(self) -> DataFrame:
        """All cleaned rows with their load position: source, then file, then row.

        Rows restart in every file, so a file begins after the last row of the files before
        it; the running sum is over one line per file.
        """
        ranked = conform.union_all([
            part.withColumn("source_rank", F.lit(SOURCE_RANK[source])).withColumn("_file", F.coalesce("origin_file", F.lit("")))
            for source, part in self.parts.items()
        ])
        ranked = settle(ranked)
        files = ranked.groupBy("source_rank", "_file").agg(F.max("row").alias("_last"))
        before = Window.partitionBy("source_rank").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        begins = files.select("source_rank", "_file", F.coalesce(F.sum(F.col("_last") + 1).over(before), F.lit(0)).alias("_begin"))
        placed = ranked.join(begins, ["source_rank", "_file"]).withColumn(
            "position", F.col("source_rank").cast("long") * F.lit(10**15) + F.col("_begin") + F.col("row"))
        return settle(placed.drop("_file", "_begin"))

    @cached_property
    def accepted(self) -> DataFrame:
        return self.rows.where(codes.has_book_prefix("isbn13"))

    @property
    def rejected(self) -> DataFrame:
        return self.rows.where(~codes.has_book_prefix("isbn13"))

    @cached_property
    def identifiers(self) -> DataFrame:
        """The whole first row of each identifier, values standardised."""
        first = dedup.keep_first(self.accepted, ["isbn13"], ["source_rank", "origin_file", "row", "edition_format"])
        return first.withColumns({name: vocab.by_rules(name, rules) for name, rules in STANDARDS.items()})

    def _named(self, column: str) -> DataFrame:
        """(isbn13, position, place, role, name): ignored rows still bring their names."""
        rows = self.accepted.where(F.col(column).isNotNull())
        return reshape.explode_people(rows.select("isbn13", F.col("position").alias("at"), column), ["isbn13", "at"], column).where(
            F.col("name").isNotNull())

    @cached_property
    def authors(self) -> DataFrame:
        return settle(model.dimension(self._named("people"), "name", ["at", "position"], "author_id"))

    @cached_property
    def publishers(self) -> DataFrame:
        return settle(model.dimension(self._named("publishers"), "name", ["at", "position"], "publisher_id"))

    @cached_property
    def identifier_authors(self) -> DataFrame:
        """Roles are standardised before the pairs are made distinct."""
        named = self._named("people").withColumn("role", vocab.by_rules("role", fixed.ROLE_RULES))
        return model.bridge(named, "isbn13", self.authors, "name", "author_id", F.col("isbn13"), ["role"])

    @cached_property
    def identifier_publishers(self) -> DataFrame:
        return model.bridge(self._named("publishers"), "isbn13", self.publishers, "name", "publisher_id", F.col("isbn13"), ["role"])

    @cached_property
    def works(self) -> DataFrame:
        return settle(model.works(self.accepted, "title", "contributors", "position"))

    @cached_property
    def identifier_works(self) -> DataFrame:
        return model.work_bridge(self.accepted, self.works, "title", "contributors", "isbn13")

    @cached_property
    def work_authors(self) -> DataFrame:
        names = reshape.explode_list(self.works, ["work_id"], "contributors", "name")
        return model.bridge(names, "work_id", self.authors, "name", "author_id", F.col("work_id"))

    @cached_property
    def store_sales(self) -> DataFrame:
        """One fact per identifier and store, without year or quantity."""
        rows = self.accepted.where(F.col("stores").isNotNull()).withColumn("named", F.filter("stores", lambda s: s.isNotNull()))
        facts = model.store_facts(rows, "isbn13", "named", "position", ["edition"])
        return facts.withColumn("store", vocab.by_rules("store", fixed.STORE_RULES))

    def with_matches(self, matches: DataFrame) -> DataFrame:
        """Identifiers with the DOI and citations found for their work, and the DOI filled by priority.

        ``matches``: work_id, consulted, doi, citations.
        """
        # the identifier's own title and contributors: ignored duplicate rows belong to other works
        own = model.work_bridge(self.identifiers, self.works, "title", "contributors", "isbn13")
        found = own.join(
            matches.select("work_id", "consulted", F.col("doi").alias("doi_openalex"), "citations"), "work_id")
        joined = self.identifiers.join(found.drop("work_id"), "isbn13", "left")
        return joined.withColumn("doi", vocab.first_present("doi", "doi_simeh", "doi_openalex", "doi_scielo"))

    def publisher_doi_counts(self, identifiers: DataFrame) -> DataFrame:
        return reports.count_per_listed_name(
            self.publishers.select("publisher_id", "name"), "name", identifiers, "main_publisher", "doi", "identifiers_with_doi")
