"""Ad-hoc queries: what reads may run, everything else is refused before it runs."""

import pytest
from pyspark.sql import functions as F

from lectern.operators.guard import Refused, read_only_query


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("guard")
    spark.range(300).withColumn("k", F.col("id") % 7).write.parquet(str(folder / "rows"))
    spark.read.parquet(str(folder / "rows")).createOrReplaceTempView("guard_rows")
    spark.sql("CREATE TABLE guarded_target USING parquet AS SELECT id FROM range(3)")
    spark.udf.register("guard_udf", lambda x: x, "bigint")
    shown = spark.table("guard_rows").withColumn("twice", F.udf(lambda x: 2 * x, "bigint")("id"))
    shown.createOrReplaceTempView("guard_view")
    yield folder
    spark.sql("DROP TABLE guarded_target")
    for view in ("guard_rows", "guard_view"):
        spark.catalog.dropTempView(view)


ALLOWED = [
    ("SELECT id FROM guard_rows ORDER BY id DESC ;", 200),
    ("select * from guard_rows", 200),
    ("WITH a AS (SELECT 1 AS x) SELECT * FROM a", 1),
    ("SELECT k, count(*) n, sum(id) OVER (PARTITION BY k ORDER BY id ROWS 2 PRECEDING) s FROM guard_rows GROUP BY k, id HAVING n > 0", 200),
    ("SELECT a.k FROM guard_rows a JOIN guarded_target b ON a.id = b.id LEFT JOIN (VALUES (1), (2)) v(x) ON x = a.id", 3),
    ("SELECT id FROM guard_rows WHERE id IN (SELECT id FROM guarded_target) AND EXISTS (SELECT 1 FROM guarded_target)", 3),
    ("SELECT (SELECT max(id) FROM guard_rows) AS m, upper('x') UNION ALL SELECT 1, 'y'", 2),
    ("SELECT x FROM guard_rows LATERAL VIEW explode(array(1, 2)) t AS x WHERE id = 0", 2),
    ("SELECT * FROM range(5) EXCEPT SELECT id FROM guarded_target", 2),
    ("WITH a AS (WITH b AS (SELECT 1 AS x) SELECT x FROM b) SELECT x FROM a WHERE x IN (SELECT x FROM a)", 1),
    ("SELECT twice FROM guard_view WHERE id = 4", 1),           # what a view holds is its owner's affair
    ("SELECT id FROM guarded_target -- all", 3),
    ("SELECT k, w.id FROM guard_rows w, LATERAL (SELECT w.id + 1 AS z) WHERE id < 2", 2),
    ("SELECT * FROM (SELECT k, id FROM guard_rows WHERE id < 14) PIVOT (sum(id) FOR k IN (1, 2))", 1),
]

REFUSED = [
    "DELETE FROM guard_rows", "SELECT 1; SELECT 2", "DROP VIEW guard_rows", "", "SELECT ';'", "SELECT 1) UNION ALL (SELECT 2 -- ",
    "SELECT TRANSFORM(id) USING 'echo ran' AS (o STRING) FROM range(1)",
    "SELECT * FROM (SELECT TRANSFORM(id) USING 'echo ran' AS (o STRING) FROM range(1))",
    "WITH t AS (SELECT TRANSFORM(id) USING 'echo ran' AS (o STRING) FROM range(1)) SELECT * FROM t",
    "SELECT 1 WHERE 1 IN (SELECT TRANSFORM(id) USING 'echo 1' AS (o INT) FROM range(1))",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT java_method('java.lang.System', 'getProperty', 'user.home')",
    "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT `REFLECT`('java.lang.System', 'getProperty', 'user.home')",
    "SELECT builtin.reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT id FROM guard_rows ORDER BY reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT sum(id) OVER w FROM guard_rows WINDOW w AS (ORDER BY reflect('java.lang.System', 'getProperty', 'user.home'))",
    "SELECT (SELECT max(reflect('java.lang.System', 'getProperty', 'user.home')) FROM guard_rows)",
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
    "SELECT * FROM IDENTIFIER('guard_rows')",
    "SELECT * FROM parquet.`{folder}/rows`", "SELECT * FROM text.`/etc/hostname`", "SELECT * FROM csv.`/etc/hostname`",
    "WITH parquet AS (SELECT 1) SELECT * FROM parquet.`{folder}/rows`",
    "SELECT * FROM binaryFile.`{folder}/rows`",
    "WITH x AS (SELECT 99L AS id) INSERT INTO guarded_target SELECT * FROM x",
    "WITH x AS (SELECT 99L AS id) FROM x INSERT INTO guarded_target SELECT *",
    "SELECT guard_udf(1)", "SELECT nowhere(1)", "SELECT * FROM missing_table", "SELECT * FROM a.b.c.d",
    "SELECT input_file_name() FROM guarded_target", "SELECT current_user()", "SELECT version()",
    "SELECT * FROM python_worker_logs()", "SELECT * FROM sql_keywords()",
    "SELECT * FROM read_files('/etc')",
]


@pytest.mark.parametrize("sql, rows", ALLOWED)
def test_allowed(spark, tables, sql, rows):
    assert read_only_query(spark, sql).count() == rows


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(spark, tables, sql):
    with pytest.raises(Exception) as raised:
        read_only_query(spark, sql.replace("{folder}", str(tables)))
    assert isinstance(raised.value, Refused) or "Parse" in type(raised.value).__name__
    assert spark.table("guarded_target").count() == 3


def test_order_and_cap(spark, tables):
    assert [row.id for row in read_only_query(spark, "SELECT id FROM guard_rows ORDER BY id DESC", 2).collect()] == [299, 298]
    assert read_only_query(spark, "SELECT id FROM guard_rows", 0).count() == 0
    with pytest.raises(Refused):
        read_only_query(spark, "SELECT id FROM guard_rows", -1)


def test_only_given_tables(spark, tables):
    assert read_only_query(spark, "WITH a AS (SELECT * FROM guard_rows) SELECT * FROM a", 5, tables=["Guard_Rows"]).count() == 5
    with pytest.raises(Refused):
        read_only_query(spark, "SELECT * FROM guarded_target", tables=["guard_rows"])
    with pytest.raises(Refused):
        read_only_query(spark, "SELECT 1 WHERE EXISTS (SELECT * FROM guarded_target)", tables=["guard_rows"])


def test_a_function_that_hides_a_built_in_one(spark):
    other = spark.newSession()  # with functions of its own
    other.udf.register("soundex", lambda x: "mine", "string")
    with pytest.raises(Refused):
        read_only_query(other, "SELECT soundex('x')")
    assert read_only_query(spark, "SELECT soundex('x')").count() == 1
