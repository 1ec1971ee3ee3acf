import json

import pytest
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.operators import model
from lectern.sources import documents, publish, readers, reports, sinks
from lectern.streaming import incremental
from tests.test_operators import rows_of


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_folder_rows_are_numbered_per_file(spark, tmp_path):
    lines = [f"{n},x{n}" for n in range(4000)]
    write(tmp_path / "in" / "a.csv", "id,v\n" + "\n".join(lines) + "\n")
    write(tmp_path / "in" / "b.csv", "id,v\n7,y\n8,z\n")
    write(tmp_path / "in" / "~$a.csv", "id,v\n99,open\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = readers.numbered_csv(spark, str(tmp_path / "in"), ["id", "v"])
        by_file = {row.origin_file.rsplit("/", 1)[1]: row for row in rows.groupBy("origin_file").agg(
            F.count("*").alias("n"), F.min("source_row").alias("low"), F.max("source_row").alias("high"),
            F.count_distinct("source_row").alias("d")).collect()}
        wrong = rows.where("origin_file LIKE '%/a.csv' AND CAST(id AS INT) + 2 <> source_row").count()
        splits = rows.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(by_file) == {"a.csv", "b.csv"} and splits >= 1
    assert (by_file["a.csv"].n, by_file["a.csv"].low, by_file["a.csv"].high, by_file["a.csv"].d) == (4000, 2, 4001, 4000)
    assert wrong == 0
    assert rows_of(readers.read_folder(spark, str(tmp_path / "in"), ["id", "v"]).where("origin_file LIKE '%/b.csv'"), "id", "v") == [
        ("7", "y"), ("8", "z")]


def test_files_of_one_name_are_told_apart(spark, tmp_path):
    write(tmp_path / "in" / "a" / "v.csv", "id,v\n1,x\n2,y\n3,z\n")
    write(tmp_path / "in" / "b" / "v.csv", "id,v\n4,x\n5,y\n6,z\n")
    rows = readers.numbered_csv(spark, str(tmp_path / "in" / "*"), ["id", "v"])
    assert rows_of(rows, "id", "source_row") == [("1", 2), ("2", 3), ("3", 4), ("4", 2), ("5", 3), ("6", 4)]
    assert rows.select("origin_file").distinct().count() == 2


def test_windows_encoding_and_text_keys(spark, tmp_path):
    write(tmp_path / "m.csv", "ISBN,Título\n0012,Año – niño\n", "cp1252")
    assert rows_of(readers.read_csv_windows(spark, str(tmp_path / "m.csv"), ["ISBN", "Título"])) == [("0012", "Año – niño")]


def test_parquet_rows_are_numbered(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "p"))
    assert rows_of(readers.numbered_parquet(spark, str(tmp_path / "p"))) == [(n, n + 2) for n in range(5)]


def test_large_document_is_read_by_many_tasks(spark, tmp_path):
    records = [{"isbn13": f"{k}", "match_status": ['a}{"b', "\\", 'q\\"]}', "line\n}", "é, {", ""][k % 6] * (k % 5), "cited_by_count_demo": k,
                "nested": [{"x": {"y": "}"}}, [{}]] if k % 4 == 0 else {}} for k in range(1500)]
    layouts = {
        "a": json.dumps({"about": 'x "records": [{', "records": records}, indent=1),
        "b": json.dumps({"meta": {"x": {"y": 1}, "z": {"w": {}}}, "others": [{"isbn13": "no"}, {"isbn13": "no"}], "records": records,
                         "later": [{"isbn13": "no"}], "generated_with_seed": 4}, ensure_ascii=False) + "\n",
        "c": json.dumps({"records": []}), "d": json.dumps({"about": "none"}), "e": json.dumps({"records": [records[1]]}),
    }
    for name, text in layouts.items():
        write(tmp_path / f"{name}.json", text)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        for name in layouts:
            path = str(tmp_path / f"{name}.json")
            found = rows_of(readers.read_fixture(spark, path, split_bytes=1))
            assert found == rows_of(readers.read_fixture(spark, path)), name
            assert len(found) == {"a": 1500, "b": 1500, "e": 1}.get(name, 0)
        assert documents.pieces_of(spark, str(tmp_path / "a.json")).rdd.getNumPartitions() > 4
        both = documents.read_records(spark, str(tmp_path / "[ae].json"), readers.RECORD_SCHEMA)
        assert both.count() == 1501 and both.where("record_no = 0").count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_fixture(spark, tmp_path):
    write(tmp_path / "f.json", json.dumps({"about": "x", "records": [
        {"isbn13": "1", "match_status": "offline_demo", "cited_by_count_demo": 3}, {"isbn13": "2"}]}, indent=1))
    assert rows_of(readers.read_fixture(spark, str(tmp_path / "f.json"))) == [(0, "1", "offline_demo", 3), (1, "2", None, None)]
    assert readers.read_fixture(spark, str(tmp_path / "none.json")).count() == 0


def test_candidates(spark, tmp_path):
    write(tmp_path / "c.json", json.dumps({"isbn13": "1", "results": [
        {"id": "W1", "display_name": "Uno", "authorships": [{"author": {"display_name": "Ana"}}]}, {"id": "W2"}]}) + "\n")
    assert rows_of(readers.read_candidates(spark, str(tmp_path / "c.json")), "isbn13", "cand_rank", "id") == [("1", 1, "W1"), ("1", 2, "W2")]


def report(year_text, header, rows):
    width = len(fixed.REPORT_HEADER)
    pad = "," * (width - 1)
    return "\n".join([pad, f"Informe{pad}", f"{year_text}{pad}", pad, ",".join(header), *rows]) + "\n"


def test_sales_reports(spark, tmp_path):
    full = "Desde: 1 de enero de 2024 Hasta: 31 de diciembre de 2024"
    part = "Desde: 1 de marzo de 2024 Hasta: 31 de diciembre de 2024"
    classic = "Web,T1,digital,ES,a,s,c,pdf, 9781 ,t,1,Ana,3"
    ebook = "Web,T1,ES,a,s,digital,c,pdf,9782,t,1,Ana,4"
    folder = tmp_path / "r"
    write(folder / "one.csv", report(full, fixed.REPORT_HEADER, [classic]))
    write(folder / "two.csv", report(full.replace("2024", "2023"), fixed.REPORT_HEADER_EBOOK, [ebook, ebook]))
    write(folder / "half.csv", report(part, fixed.REPORT_HEADER, [classic]))
    write(folder / "headless.csv", report(full, ["Canal"] + [""] * 12, [classic]))
    cells = reports.read_cells(spark, str(folder), len(fixed.REPORT_HEADER))
    cells = cells.withColumn("file", F.element_at(F.split("file", "/"), -1))
    status = reports.file_status(reports.file_facts(cells))
    assert rows_of(status, "file", "sale_year", "status") == [
        ("half.csv", None, "not_a_full_year"), ("headless.csv", 2024, "no_header"),
        ("one.csv", 2024, "accepted"), ("two.csv", 2023, "accepted")]
    rows = reports.report_rows(cells)
    assert rows_of(rows, "file", "sale_year", "isbn", "mode", "country", "quantity") == [
        ("one.csv", 2024, "9781", "digital", "ES", "3"), ("two.csv", 2023, "9782", "digital", "ES", "4"),
        ("two.csv", 2023, "9782", "digital", "ES", "4")]
    known = spark.createDataFrame([("9781", 1), ("9782", 2)], "isbn string, id long")
    facts = model.dedup_facts(model.load_facts(rows, known, "isbn", "id"),
                              ["id", "sale_year", "channel", "store", "mode", "country"], ["file", "row_no"])
    assert rows_of(facts, "id", "quantity") == [(1, "3"), (2, "4")]


def test_report_rows_with_too_many_cells(spark, tmp_path):
    full = "Desde: 1 de enero de 2024 Hasta: 31 de diciembre de 2024"
    classic = "Web,T1,digital,ES,a,s,c,pdf, 9781 ,t,1,Ana,3"
    write(tmp_path / "r" / "one.csv", report(full, fixed.REPORT_HEADER, [classic, classic + ",lost", classic]))
    cells = reports.read_cells(spark, str(tmp_path / "r"), len(fixed.REPORT_HEADER))
    bad = reports.overflowing_rows(cells).collect()
    assert [(row.row_no, row.overflow.endswith(",lost"), row.reason) for row in bad] == [(7, True, "more cells than declared")]
    assert reports.report_rows(cells).count() == 2


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("9780307474728", True), ("9790000000000", False), ("123", False)], "isbn13 string, valid_isbn boolean")
    sinks.write_identifier_list(rows, "isbn13", str(tmp_path / "ids"))
    assert rows_of(spark.read.text(str(tmp_path / "ids"))) == [("9780307474728",), ("9790000000000",)]
    for _ in range(2):
        sinks.write_quarantine(rows, str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    sinks.write_tables({"a": rows}, str(tmp_path / "t"))
    rows_view = spark.read.parquet(str(tmp_path / "t" / "a"))
    rows_view.createOrReplaceTempView("written")
    assert readers.read_table(spark, "written").count() == readers.read_table(spark, "SELECT * FROM written").count() == 3


def test_stream_appends_new_facts_once(spark, tmp_path):
    source, target = str(tmp_path / "src"), str(tmp_path / "facts")
    batch = spark.createDataFrame([(1, "a", "w"), (2, "a", "w"), (3, None, "w")], "n long, k string, c string")
    batch.coalesce(1).write.parquet(source)

    def drain(checkpoint="cp"):
        stream = spark.readStream.schema(batch.schema).parquet(source)
        query = incremental.append_new_facts(stream, target, ["k", "c"], ["n"], str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        query.awaitTermination()

    drain()
    assert rows_of(spark.read.parquet(target).select("n"), "n") == [(1,), (3,)]
    spark.createDataFrame([(4, "a", "w"), (5, "b", "w")], batch.schema).coalesce(1).write.mode("append").parquet(source)
    drain()
    assert rows_of(spark.read.parquet(target).select("n"), "n") == [(1,), (3,), (5,)]
    drain("other")  # another stream over the same source: known facts are found, those with a NULL equal nothing
    assert rows_of(spark.read.parquet(target).select("n"), "n") == [(1,), (3,), (3,), (5,)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    target, schema = str(tmp_path / "facts"), "n long, k string, year int"
    batches = [spark.createDataFrame(rows, schema) for rows in (
        [(1, "a", 2020), (2, None, 2020), (3, "a", None), (4, "b", 2021), (5, "a", 2020)],
        [(6, "a", 2020), (7, None, 2020), (8, None, None), (9, "a", 2021), (10, "c", 2022)])]

    def store(number):
        incremental.store_batch(batches[number], number, target, "s", ["k", "year"], ["n"], "year")
        found = incremental.fact_store(spark, target, batches[0].schema)
        return sorted((row.n, row.k, row.year, row.batch_id) for row in found.collect())

    first = store(0)
    assert [row[0] for row in first] == [1, 2, 3, 4]
    second = store(1)
    assert [row[0] for row in second] == [1, 2, 3, 4, 7, 8, 9, 10]
    assert store(1) == second and store(1) == second and store(0) == second
    with pytest.raises(ValueError):
        incremental.store_batch(batches[0], 0, target, "s", ["k"], ["n"], "year")


def test_only_the_years_of_the_batch_are_read(spark, tmp_path):
    target = str(tmp_path / "facts")
    rows = spark.range(300).selectExpr("id AS n", "cast(id AS string) AS k", "cast(2000 + id % 10 AS int) AS year")
    incremental.store_batch(rows, 0, target, "s", ["k", "year"], ["n"], "year")
    batch = rows.where("year = 2003").selectExpr("n", "k", "year")
    stored = incremental.earlier_facts(batch, target, "s", 1, "year")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2003" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert stored.count() == 30 and incremental.new_facts(batch, stored, ["k", "year"], ["n"]).count() == 0


def test_a_run_that_fails_leaves_the_old_tables(spark, tmp_path):
    folder = str(tmp_path / "set")

    def tables(n):
        return {"a": spark.range(n), "b": spark.range(10 * n).withColumnRenamed("id", "x")}

    with pytest.raises(ValueError):
        publish.published(spark, folder)
    first = publish.publish(spark, tables(1), folder)
    failing = tables(2) | {"b": spark.range(5).selectExpr("raise_error('lost') AS x")}
    with pytest.raises(Exception):
        publish.publish(spark, failing, folder)  # stops after table a
    halfway = publish.Publication(spark, folder)
    halfway.write("a", spark.range(99))
    seen = publish.published(spark, folder)
    assert {name: frame.count() for name, frame in seen.items()} == {"a": 1, "b": 10}
    second = publish.publish(spark, tables(3), folder)
    assert {name: frame.count() for name, frame in publish.published(spark, folder).items()} == {"a": 3, "b": 30}
    assert publish.published(spark, folder, first)["b"].count() == 10
    assert sorted(row.rows for row in publish.manifest(spark, folder).collect()) == [1, 3, 10, 30]
    halfway.commit()
    assert set(publish.published(spark, folder)) == {"a"} and publish.published(spark, folder)["a"].count() == 99
    assert publish.drop_expired(spark, folder, keep=2) == [first]
    assert publish.published(spark, folder, second)["a"].count() == 3
    with pytest.raises(ValueError):
        halfway.write("b", spark.range(1))
    with pytest.raises(ValueError):
        publish.published(spark, folder, "unknown")


def test_consult_new(spark):
    work = spark.createDataFrame([("t1", "a"), ("t2", "b")], "title string, people string")
    state = spark.createDataFrame([("t1", "a", "found"), ("t2", "b", None)], "title string, people string, consulted string")
    assert rows_of(incremental.consult_new(work, state, ["title", "people"], "consulted", lambda rows: rows)) == [("t2", "b")]


@pytest.mark.parametrize("mode", ["offline", "live"])
def test_whole_flow(spark, tmp_path, mode):
    """Twelve books over three exports: overlaps, hyphens, case, accents, two bad identifiers."""
    from lectern.plans import catalogue

    def isbn(n):
        stem = f"978{n:09d}"
        return stem + str(-sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(stem)) % 10)

    books = [[isbn(n), f"Título número {n}", "Ana Ruiz" if n < 2 else f"Autor {n};Coautora {n}", "Casa" if n % 2 else "Editora",
              1950 + n, "Chile", 100 + n, "es", f"https://example.org/{n}"] for n in range(12)]
    simeh = [list(b) for b in books[:8]]
    simeh[0][0] = "978-" + books[0][0][3:]
    simeh[4][1] = simeh[4][1].upper()
    simeh.append(["9780000000001", "Control"] + books[0][2:])
    own = [list(b) for b in books[4:]]
    scielo = [list(b) for b in books[1::2]]
    scielo[0][1] = "Titulo numero 1"
    scielo.append(["1234567890123", "Control"] + books[1][2:])
    data = tmp_path / "data"
    for source, rows in {"simeh": simeh, "plantilla_propia": own, "scielo": scielo}.items():
        header = ",".join(fixed.SOURCE_COLUMNS[source].values())
        write(data / f"{source}.csv", "\n".join([header, *[",".join(map(str, row)) for row in rows]]) + "\n")
    sales = [f"{b[0]},{2022 + y}-0{1 + n % 9}-15,{n + 1},{(n + 1) * 10.1:.2f},Web,1" for y in range(4) for n, b in enumerate(books)]
    write(data / "ventas.csv", "\n".join([",".join(catalogue.SALES_COLUMNS), *sales, "9799999999999,2022-01-01,1,1.0,Web,1"]) + "\n")
    metrics = [f"{b[0]},{n},{n * 2},{n / 2},1" for n, b in enumerate(books)]
    write(data / "altmetrics.csv", "\n".join([",".join(catalogue.METRIC_COLUMNS), *metrics]) + "\n")
    write(data / "fixture.json", json.dumps({"records": [
        {"isbn13": books[n][0], "match_status": "offline_demo", "cited_by_count_demo": 5 * n} for n in (0, 3, 4)]}))
    failures = spark.createDataFrame([(b[0], "no network") for b in books], "isbn13 string, error string")
    nothing = spark.createDataFrame([], "isbn13 string, query_title string")
    result = catalogue.run(spark, str(data), str(tmp_path / "out"), mode, results=nothing, failures=failures)

    figures = {row.metric: row.value for row in result.metrics.collect()}
    assert (figures["source_rows"], figures["catalogue_books"], figures["invalid_rows"], figures["duplicate_rows"]) == (24, 12, 2, 18)
    assert (figures["sales_rows"], figures["units_sold"]) == (48, 4 * 78)
    assert figures["revenue_eur"] == pytest.approx(4 * sum(round((n + 1) * 10.1, 2) for n in range(12)))
    titles = {row.isbn13: row.title for row in result.catalogue.collect()}
    assert titles[books[4][0]] == "Título número 4" and titles[books[1][0]] == "Título número 1"
    steps = result.events.orderBy("event_id").collect()
    assert [(s.input_rows, s.output_rows) for s in steps] == [(24, 24), (24, 24), (24, 22), (22, 12), (12, 12), (12, 12)]
    assert "2 filas" in steps[2].details and "18 filas" in steps[3].details and steps[4].details.endswith(f"{mode}.")
    statuses = [row.match_status for row in result.matches.collect()]
    if mode == "offline":
        assert sorted(statuses) == ["not_in_fixture"] * 9 + ["offline_demo"] * 3
    else:
        assert sorted(statuses) == ["offline_demo"] * 3 + ["request_error"] * 9
    assert all(row.violations == 0 for row in catalogue.reference_report(result.tables).collect())
    assert all(row.violations == 0 for row in catalogue.uniqueness_report(result.tables).collect())
    summary = result.book_summary
    assert len(summary.columns) == 19 and summary.count() == 12
    tables = publish.published(spark, str(tmp_path / "out"))
    assert set(tables) == {"staging", "catalogue", "quarantine", "quarantine_titles", *result.tables}
    written = tables["authors"]
    assert written.count() == 21 and written.where("author_id = 1").first().name == "Ana Ruiz"
    assert tables["quarantine"].count() == 2
