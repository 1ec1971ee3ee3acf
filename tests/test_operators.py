import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import conform, dedup, enrich, model, quality, reports, reshape, rules, skew
from lectern.plans import catalogue


def rows_of(frame, *columns):
    return sorted((tuple(row[c] for c in columns or frame.columns) for row in frame.collect()), key=repr)


def hot_rows(spark, n=4000):
    """A third of the rows share one key, some have none."""
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"))


def test_attach_salts_hot_and_missing_keys(spark):
    rows = hot_rows(spark)
    groups = rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
    attached = skew.attach(rows, groups, ["key"], "n", F.col("id"))
    plain = rows.join(groups, "key", "left")
    assert rows_of(attached, "id", "key", "n") == rows_of(plain, "id", "key", "n")
    inner = skew.attach(rows, groups, ["key"], "n", F.col("id"), how="inner")
    assert inner.count() == rows.where("key IS NOT NULL").count()


def test_hot_rows_spread_over_partitions(spark):
    rows = hot_rows(spark)
    groups = rows.groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        attached = skew.attach(rows, groups, ["key"], "n", F.col("id"))
        parts = attached.where("key = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count()
        sizes = [row["count"] for row in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 2 and max(sizes) < 0.6 * sum(sizes)


def test_dense_and_sequential_ids(spark):
    rng = random.Random(2)
    values = rng.sample(range(10**6), 700)
    rows = spark.createDataFrame([(v, f"t{v:07d}") for v in values], "pos long, name string").repartition(7)
    expected = [(i + 1, v) for i, v in enumerate(sorted(values))]
    dense = skew.dense_ids(rows, F.floor(F.col("pos") / 1000), ["pos"], "id")
    assert rows_of(dense, "id", "pos") == sorted(expected, key=repr)
    sequential = skew.sequential_ids(rows, ["name"], "id")
    assert rows_of(sequential, "id", "pos") == sorted(expected, key=repr)


def test_fill_forward_over_block_borders(spark):
    rng = random.Random(4)
    data, last = [], {}
    expected = []
    for n in range(500):
        file = rng.choice("ab")
        value = f"v{n}" if rng.random() < 0.05 else None
        data.append((n, file, value))
        last[file] = value or last.get(file)
        expected.append((n, last[file]))
    rows = spark.createDataFrame(data, "n long, file string, v string")
    filled = skew.fill_forward(rows, "v", "n", ["file"], block_rows=16)
    assert rows_of(filled, "n", "v") == sorted(expected, key=repr)


def test_golden_record_mixes_sources(spark):
    rows = spark.createDataFrame([
        ("1", "simeh", 2, "S", None, 10), ("1", "plantilla_propia", 9, "P", None, None), ("1", "scielo", 2, "C", "es", 30),
        ("1", "simeh", 3, "S2", "pt", 40), ("2", "scielo", 5, None, None, None)],
        "k string, source string, row long, title string, lang string, pages int")
    golden = dedup.golden_record(rows, "k", ["title", "lang", "pages"], "source", "row",
                                 {"plantilla_propia": 0, "simeh": 1, "scielo": 2})
    assert rows_of(golden) == [("1", "P", "pt", 10, 3, "plantilla_propia, scielo, simeh"), ("2", None, None, None, 1, "scielo")]


def test_merge_values_keeps_order_and_unkeyed_rows(spark):
    rows = spark.createDataFrame([
        (1, "k", " b ", None), (2, "k", "a", None), (3, "k", "b", None), (4, None, " x ", "y"), (5, None, "z", None), (6, "e", None, None)],
        "n long, k string, a string, b string")
    assert rows_of(dedup.merge_values(rows, "k", ["a", "b"], "n")) == sorted(
        [("k", 1, "b;a", None), (None, 4, " x ", "y"), (None, 5, "z", None), ("e", 6, None, None)], key=repr)


def test_duplicate_counts_rows_not_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5), ("c", 6)], "k string, n long")
    assert dedup.duplicate_row_count(rows, ["k"]).first()[0] == 5
    assert rows_of(dedup.flag_duplicates(rows, ["k"], "n").where("is_duplicate"), "n") == [(1,), (2,), (3,), (5,), (6,)]
    assert rows_of(dedup.flag_repeats(rows, ["k"], "n").where("is_repeat"), "n") == [(2,), (3,), (6,)]


def test_null_unsafe_first(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, None, "x"), (4, None, "x"), (5, "a", None)], "n long, k string, l string")
    assert rows_of(dedup.keep_first_null_unsafe(rows, ["k", "l"], ["n"]), "n") == [(1,), (3,), (4,), (5,)]
    assert rows_of(dedup.keep_first(rows, ["k", "l"], ["n"]), "n") == [(1,), (3,), (5,)]


def test_continuation_rows(spark):
    rows = spark.createDataFrame([
        (1, "R1", "JW", None), (2, "R1", "K; JW", "full"), (3, "R1", " ; ", None), (4, "R2", None, "full"), (5, None, "Z", None)],
        "n long, rec string, thema string, note string")
    kept = [(1, "R1", "JW", None), (3, "R1", " ; ", None), (4, "R2", None, "full"), (5, None, "Z", None)]
    assert rows_of(dedup.consolidate_list_column(rows, "rec", "n", "thema", drop_late_destination=True)) == sorted(kept, key=repr)
    assert rows_of(dedup.consolidate_list_column(rows, "rec", "n", "thema")) == sorted(
        [*kept, (2, "R1", "JW;K", "full")], key=repr)
    texts = spark.createDataFrame([
        (1, "R1", " uno  dos ", None), (2, "R1", "tres", "full"), (3, "R1", "uno dos", None), (4, "R1", " ", None)],
        "n long, rec string, body string, note string")
    assert rows_of(dedup.consolidate_text_column(texts, "rec", "n", "body")) == [(2, "R1", "uno dos tres", "full"), (4, "R1", " ", None)]


def test_reshape(spark):
    wide = spark.createDataFrame([(1, "t", "d", "11", None, "33"), (2, "t", "d", " ", "22", None)],
                                 "id long, title string, DOI string, `ISBN IMPRESO` string, `ISBN PDF` string, `ISBN EPUB` string")
    assert rows_of(reshape.one_row_per_edition(wide, once=["DOI"]), "id", "DOI", "identifier", "edition_format") == [
        (1, "d", "33", "ebook"), (1, None, "11", "impreso"), (2, "d", "22", "pdf")]
    roles = spark.createDataFrame([("A;B", "B; C;BB")], "p string, c string").select(reshape.publisher_roles("p", "c").alias("r"))
    assert [tuple(r) for r in roles.first().r] == [("editor", "A"), ("editor", "B"), ("coeditor", "C"), ("coeditor", "BB")]


def test_dimension_and_bridge(spark):
    rows = spark.createDataFrame([(10, "x", "Varios"), (10, "x", "Ana"), (20, "y", "Varios"), (20, "y", "Varios"), (30, "z", None)],
                                 "at long, book string, name string")
    dim = model.dimension(rows, "name", ["at"], "author_id", block=15)
    assert rows_of(dim, "author_id", "name", "uses") == [(1, "Ana", 1), (2, "Varios", 3)]
    assert rows_of(model.bridge(rows, "book", dim, "name", "author_id", F.col("book"))) == [("x", 1), ("x", 2), ("y", 2)]


def test_a_second_load_keeps_the_ids_of_the_first(spark):
    first = spark.createDataFrame([(10, "x"), (30, "z"), (20, "y"), (20, "x"), (5, None)], "at long, name string")
    nothing = spark.createDataFrame([], "id bigint, name string")
    one = model.grown_dimension(nothing, first, ["name"], ["at"], "id", block=7)
    assert rows_of(one) == [(1, "x"), (2, "y"), (3, "z")]
    second = spark.createDataFrame([(1, "new"), (2, "y"), (3, "a"), (4, "new"), (90, "late"), (1, "also")], "at long, name string")
    assert rows_of(model.grow(one, second, ["name"], ["at"], "id", block=7)) == [(4, "also", 1), (5, "new", 2), (6, "a", 1), (7, "late", 1)]
    two = model.grown_dimension(one, second, ["name"], ["at"], "id", block=7)
    assert rows_of(two)[:3] == rows_of(one) and two.count() == two.select("id").distinct().count() == 7
    assert rows_of(model.grown_dimension(two, second.union(first), ["name"], ["at"], "id")) == rows_of(two)
    works = spark.createDataFrame([(1, "t", "a"), (2, "t", "b"), (3, "t", None)], "at long, title string, people string")
    held = spark.createDataFrame([(7, "t", "b")], "id bigint, title string, people string")
    assert rows_of(model.grow(held, works, ["title", "people"], ["at"], "id")) == [(8, "t", "a", 1)]


def test_rules_count_and_keep_what_breaks_them(spark):
    sales = spark.createDataFrame([(1, "a", -1, "w"), (2, "b", 3, None), (3, "q", -2, None), (4, None, None, "w"), (5, "a", 1, "w")],
                                  "n int, key string, units int, channel string")
    books = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 3), (None, 4)], "key string, row int")
    found = rules.audit({"sales": sales, "books": books}, [
        rules.not_negative("units", "sales", "units"), rules.present("channel", "sales", "channel"),
        rules.Reference("known", "sales", "key", "books"), rules.Unique("once", "books", ("key",)),
        rules.Check("never", "books", F.col("row") > 99)], {"sales": F.col("n").cast("string"), "books": F.col("row").cast("string")})
    assert rows_of(found.report) == [("channel", "sales", 2), ("known", "sales", 1), ("never", "books", 0), ("once", "books", 2), ("units", "sales", 2)]
    assert sorted((r.rule, r.row_key) for r in found.rejected.collect()) == [
        ("channel", "2"), ("channel", "3"), ("known", "3"), ("once", "1"), ("once", "2"), ("units", "1"), ("units", "3")]
    assert '"units":-2' in found.rejected.where("rule = 'known'").first().row
    assert rows_of(found.accepted["sales"], "n") == [(4,), (5,)] and found.accepted["books"].columns == ["key", "row"]
    assert sorted(row.row for row in found.accepted["books"].collect()) == [1, 3, 4]
    with pytest.raises(ValueError):
        rules.audit({"sales": sales}, [rules.present("a", "sales", "n"), rules.present("a", "sales", "key")], {})


def test_accepted_rows_and_the_report_write_nothing(spark, monkeypatch):
    """Rejected rows are written when they are asked for, not for the other two results."""
    written = []
    monkeypatch.setattr(rules, "settle", lambda frame: written.append(frame) or frame)
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "n int, key string")
    found = rules.audit({"rows": rows}, [rules.present("key", "rows", "key"), rules.Unique("once", "rows", ("key",))],
                        {"rows": F.col("n").cast("string")})
    assert found.accepted["rows"].count() == 0
    assert rows_of(found.report) == [("key", "rows", 1), ("once", "rows", 2)] and not written
    assert sorted(row.row_key for row in found.rejected.collect()) == ["1", "2", "3"] and found.rejected is found.rejected
    assert len(written) == 1


def test_sketches_merge(spark):
    rows = spark.range(60_000).selectExpr("id % 20000 AS a", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS b", "id % 7 AS day")
    pieces = quality.column_sketches(rows, ["a", "b"], ["day"])
    found = {r.column_name: r for r in quality.merged_profile(pieces).collect()}
    assert (found["a"].rows, found["a"].nulls, found["b"].nulls, found["b"].distinct_values) == (60_000, 0, 20_000, 1)
    assert abs(found["a"].distinct_values / 20_000 - 1) < 0.05
    assert quality.merged_profile(pieces, ["day"]).count() == 14


def test_profile_and_conflicts_shuffle_digests(spark):
    frame = spark.createDataFrame([(1, "k", "x" * 50, "u"), (2, "k", "y", None), (3, "k", "y", None), (4, "j", None, "u")],
                                  "row int, key string, text string, other string")
    report = dedup.conflict_report(frame, "key", {"texts": "text", "others": "other"})
    assert rows_of(report) == [("k", 2, 1)]
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    found = {r.column_name: r for r in quality.profile_columns(frame, "row").collect()}
    assert (found["text"].sample, found["text"].nulls, found["text"].distinct_values) == ("x" * 50 + " | y", 1, 2)
    assert (found["other"].sample, found["key"].sample) == ("u", "k | j")


def test_only_asked_tables_are_built(spark):
    asked = []
    tables = catalogue.OnDemand({"a": lambda: asked.append("a") or 1, "b": lambda: asked.append("b") or 2}).joined_with({"c": 3})
    assert list(tables) == ["a", "b", "c"] and asked == []
    assert tables["a"] == 1 and tables["a"] == 1 and tables["c"] == 3 and asked == ["a"]


def test_works_need_both_parts(spark):
    rows = spark.createDataFrame([(1, "t", "a"), (2, "t", "a"), (3, None, "a"), (4, "t", None), (5, "t", "b")], "n long, title string, people string")
    work = model.works(rows, "title", "people", "n")
    assert rows_of(work, "work_id", "people") == [(1, "a"), (2, "b")]
    assert rows_of(model.work_bridge(rows, work, "title", "people", "n")) == [(1, 1), (2, 1), (5, 2)]


def test_update_from_last_write(spark):
    base = spark.createDataFrame([("1", 1, "a"), ("2", 2, "b")], "k string, v int, w string")
    updates = spark.createDataFrame([(1, "1", 5, "x"), (2, "1", None, "y"), (3, None, 9, "z"), (4, "9", 9, "q")], "n long, k string, v int, w string")
    assert rows_of(enrich.update_from(base, updates, "k", ["v"], "n")) == [("1", None, "a"), ("2", 2, "b")]


def test_enrichment_fallbacks(spark):
    catalogue = spark.createDataFrame([("1", "Uno"), ("2", "Dos"), ("3", "Tres")], "isbn13 string, title string")
    fixture = spark.createDataFrame([(0, "1", None, 5), (1, "1", "offline_demo", 7), (2, "9", "x", 1)],
                                    "record_no int, isbn13 string, match_status string, cited_by_count_demo int")
    offline = enrich.enrich(catalogue, "offline", fixture)
    assert rows_of(offline, "isbn13", "match_status", "data_source", "cited_by_count") == [
        ("1", "offline_demo", "fixture_offline", 7), ("2", "not_in_fixture", "fixture_offline", None), ("3", "not_in_fixture", "fixture_offline", None)]
    assert rows_of(enrich.fixture_matches(catalogue, fixture), "isbn13", "query_title") == [("1", "Uno"), ("9", "")]
    results = spark.createDataFrame([("3", "Tres", "matched", "openalex_live")], "isbn13 string, query_title string, match_status string, data_source string")
    failures = spark.createDataFrame([("1", "boom"), ("2", "bang")], "isbn13 string, error string")
    live = enrich.enrich(catalogue, "live", fixture, results, failures)
    assert rows_of(live, "isbn13", "match_status", "data_source", "error") == [
        ("1", "offline_demo", "fixture_fallback", "boom"), ("2", "request_error", "openalex_error", "bang"), ("3", "matched", "openalex_live", None)]
    with pytest.raises(ValueError):
        enrich.enrich(catalogue, "other", fixture)


def test_profile(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, " ", 5), (3, None, None), (4, "b", 7), (5, "a", 8), (6, "c", 9)], "n long, s string, i int")
    assert rows_of(quality.profile_columns(rows, "n")) == [
        ("i", "int", 1, 0, 4, "5 | 7 | 8"), ("s", "string", 1, 1, 4, "a |   | b")]
    assert quality.exact_duplicates(rows.union(rows.limit(2)), ["n", "s", "i"]).first()[0] == 2


def test_types_and_constraints(spark):
    rows = spark.createDataFrame([("1", "2020"), ("x", "2021"), (None, "abc")], "pages string, year string")
    good, bad = quality.split_by_types(rows, {"pages": "int", "year": "int"}, ["pages"])
    assert rows_of(good) == [(1, 2020)]
    assert rows_of(bad, "reason") == [("missing pages; unreadable year",), ("unreadable pages",)]
    strict, _ = quality.split_by_types(rows, {"pages": "int"}, strict=True)
    with pytest.raises(Exception, match="bad row"):
        strict.collect()
    report = spark.createDataFrame([("a", True), ("b", False)], "control string, result boolean")
    with pytest.raises(ValueError, match="b"):
        quality.require(report)


def test_filters(spark):
    rows = spark.createDataFrame([("2020-01-01", "3", 2019), ("x", "3", 2020), ("2020-01-01", "-1", 2024), (None, None, None)],
                                 "d string, u string, y int")
    assert conform.sane_facts(rows, "d", ["u"]).count() == 1
    assert conform.between_years(rows, "y").count() == 2
    assert conform.drop_empty_rows(rows).count() == 3
    assert conform.keep_members(rows, "y", []).count() == 4
    assert conform.keep_members(rows, "y", [2020]).count() == 1


def test_missing_column_is_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        conform.project(spark.range(1), {"isbn": "ISBN"}).collect()


def test_listed_names_take_wildcards_literally(spark):
    names = spark.createDataFrame([("A%",), ("Ab",), ("Zz",)], "name string")
    rows = spark.createDataFrame([("Ab; A%;Ab", "10.1"), ("Ab", " "), ("Abc", "x")], "cell string, doi string")
    assert rows_of(reports.count_per_listed_name(names, "name", rows, "cell", "doi", "n")) == [("A%", 1), ("Ab", 1), ("Zz", 0)]


def test_cascade_keeps_author_of_either_bridge(spark):
    def t(data, schema):
        return spark.createDataFrame(data, schema)

    out = model.cascade(
        t([(1,)], "id long"), "id",
        {"identifier_authors": t([(1, 1), (2, 2)], "id long, author_id long"),
         "identifier_publishers": t([(1, 1), (2, 2)], "id long, publisher_id long"),
         "identifier_works": t([(1, 10), (2, 20)], "id long, work_id long")},
        t([(10, 3), (20, 2)], "work_id long, author_id long"),
        {"works": t([(10,), (20,)], "work_id long"), "authors": t([(1,), (2,), (3,)], "author_id long"),
         "publishers": t([(1,), (2,)], "publisher_id long")})
    assert rows_of(out["works"]) == [(10,)] and rows_of(out["publishers"]) == [(1,)]
    assert rows_of(out["authors"]) == [(1,), (3,)]


def test_removal_by_counts_equals_the_rebuild(spark):
    draw = random.Random(8)
    ids = range(120)

    def t(pairs, schema):
        return spark.createDataFrame(sorted(set(pairs)), schema)

    bridges = {
        "identifier_authors": t([(k, draw.randrange(40)) for k in ids for _ in range(2)], "id long, author_id long"),
        "identifier_publishers": t([(k, draw.randrange(30)) for k in ids], "id long, publisher_id long"),
        "identifier_works": t([(k, draw.randrange(70)) for k in ids], "id long, work_id long"),
        "work_authors": t([(w, draw.randrange(60)) for w in range(70)], "work_id long, author_id long")}
    # works that no identifier has do not stand in the bridge
    bridges["work_authors"] = bridges["work_authors"].join(bridges["identifier_works"].select("work_id"), "work_id", "left_semi")
    counts = model.reference_counts(bridges)
    dims = {name: frame.drop("uses") for name, frame in counts.items()}
    gone = sorted(draw.sample(ids, 45))
    removed = spark.createDataFrame([(k,) for k in [*gone, gone[0], 999]], "id long")
    kept = spark.createDataFrame([(k,) for k in ids if k not in gone], "id long")
    only = {name: frame for name, frame in bridges.items() if name != "work_authors"}
    rebuilt = model.cascade(kept, "id", only, bridges["work_authors"], dims)
    changes = model.removal(removed, "id", bridges, counts)
    left = {name: model.after_removal(frame, changes[name], frame.columns) for name, frame in {**bridges, **dims}.items()}
    assert {name: rows_of(frame, *frame.columns) for name, frame in left.items()} == {
        name: rows_of(rebuilt[name], *frame.columns) for name, frame in left.items()}
    later = model.reference_counts({name: left[name] for name in bridges})
    for name, frame in counts.items():
        now = model.after_removal(frame, changes[name], frame.columns[:1])
        assert rows_of(now, *frame.columns) == rows_of(later[name], *frame.columns)
        assert changes[name].where("uses < 0").isEmpty()
    assert changes["works"].where("uses = 0").count() and changes["works"].where("uses > 0").count()


def test_money_is_rounded_once(spark):
    sales = spark.createDataFrame([("k", 1, 0.004)] * 5 + [("big", 1, 1e16)], "isbn13 string, units int, revenue_eur double")
    assert rows_of(enrich.sales_rollup(sales, "isbn13", "units", "revenue_eur")) == [("big", 1, 1e16), ("k", 5, 0.02)]


def test_live_enrichment_keeps_every_catalogue_row(spark):
    catalogue = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")], "isbn13 string, title string")
    results = spark.createDataFrame([("1", "a", "matched", "openalex_live"), ("9", "z", "matched", "openalex_live")],
                                    "isbn13 string, query_title string, match_status string, data_source string")
    failures = spark.createDataFrame([("2", "timed out")], "isbn13 string, error string")
    fixture = spark.createDataFrame([(1, "4", None, 5)], "record_no int, isbn13 string, match_status string, cited_by_count_demo int")
    for given, error in ((failures, "timed out"), (None, None)):
        rows = enrich.enrich(catalogue, "live", fixture, results, given)
        assert rows_of(rows, "isbn13", "match_status", "error") == sorted([
            ("1", "matched", None), ("2", "request_error", error), ("3", "request_error", None),
            ("4", "offline_demo", None)], key=repr)
    with pytest.raises(ValueError):
        enrich.enrich(catalogue, "live", fixture)


def test_title_and_normalised_title_come_from_one_row(spark):
    def export(source, title, row):
        frame = spark.createDataFrame([("9780307474728", title)], "isbn string, title string")
        columns = {name: name for name in ("isbn", "title")}
        return conform.conform(frame, columns, source, F.lit(row))

    rows = export("plantilla_propia", None, 2).union(export("scielo", "Cien años", 2)).union(export("simeh", "  ", 2))
    golden = dedup.golden_record(rows, "isbn13", ["title", "normalized_title"], "source_name", "source_row",
                                 {"plantilla_propia": 0, "scielo": 1, "simeh": 2}).first()
    assert (golden.title, golden.normalized_title) == ("Cien años", "cien anos")


def test_flags_of_missing_keys(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, None, "y"), (4, "a", "x")], "n long, k string, l string")
    assert rows_of(dedup.flag_duplicates(rows, ["k", "l"], "n"), "n", "is_duplicate") == [(1, True), (2, True), (3, False), (4, False)]
    assert rows_of(dedup.flag_repeats(rows, ["k", "l"], "n"), "n", "is_repeat") == [(1, False), (2, True), (3, False), (4, False)]


def test_titles_that_cannot_be_compared_are_set_aside(spark):
    rows = spark.createDataFrame([("9780307474728", "Cien años"), ("9788437604947", "Преступление"), ("9780000000002", None)],
                                 "isbn string, title string")
    staged = conform.conform(rows, {"isbn": "isbn", "title": "title"}, "simeh", F.lit(2))
    golden = dedup.golden_record(conform.accepted(staged), "isbn13", ["title", "normalized_title"], "source_name", "source_row",
                                 {"simeh": 0})
    assert rows_of(catalogue.comparable(golden), "title") == [("Cien años",)]
    assert rows_of(catalogue.untitled(golden), "title", "reason") == sorted(
        [("Преступление", "title without comparable letters"), (None, "no title")], key=repr)


def test_merging_stays_inside_a_file(spark):
    rows = spark.createDataFrame([(2, "a", "k", "Uno"), (3, "a", "k", "Dos"), (2, "b", "k", "Tres")], "n long, file string, k string, t string")
    assert rows_of(dedup.merge_values(rows, "k", ["t"], "n", within=["file"]), "file", "t") == [("a", "Uno;Dos"), ("b", "Tres")]
    texts = spark.createDataFrame([(1, "a", "R", "x", "full"), (2, "a", "R", "y", None), (1, "b", "R", "z", "full")],
                                  "n long, file string, rec string, body string, note string")
    kept = dedup.consolidate_text_column(texts, "rec", "n", "body", ["file"])
    assert rows_of(kept, "file", "body") == [("a", "x y"), ("b", "z")]


def test_only_rows_of_repeated_keys_become_cells(spark, monkeypatch):
    given, counted = dedup._cells_of, []
    monkeypatch.setattr(dedup, "_cells_of", lambda frame, *rest: counted.append(frame.count()) or given(frame, *rest))
    rows = [(1, "a", " x ", None), (2, "b", "y", ""), (3, "a", "z", None), (4, None, " q ", "r"), (5, "c", " ", "s;s")]
    frame = spark.createDataFrame(rows, "row int, id string, v string, w string")
    found = sorted((tuple(r) for r in dedup.merge_values(frame, "id", ["v", "w"], "row").select("row", "id", "v", "w").collect()))
    assert found == [(1, "a", "x;z", None), (2, "b", "y", None), (4, None, " q ", "r"), (5, "c", None, "s;s")]
    assert counted == [2]
