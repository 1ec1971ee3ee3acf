import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from lectern.functions import text


def comparison_form(value):
    kept = "".join(ch for ch in unicodedata.normalize("NFKD", value) if not unicodedata.combining(ch))
    return " ".join(re.sub("[^a-zA-Z0-9]", " ", kept).lower().split())


def without_marks(value):
    decomposed = unicodedata.normalize("NFD", value.strip().lower())
    return "".join(ch for ch in decomposed if unicodedata.category(ch) != "Mn")


def every_character(spark):
    codes = spark.range(1, 0x110000).where("id < 55296 OR id > 57343")
    ch = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    return codes.select("id", F.concat(F.lit("a"), ch, F.lit("b")).alias("text"))


def mismatches(frame, expected, actual):
    @F.pandas_udf("string")
    def wanted(values: pd.Series) -> pd.Series:
        return values.map(expected)

    return frame.select("id", "text", wanted("text").alias("wanted"), actual.alias("found")).where("wanted <> found")


def test_normalize_text_on_every_character(spark):
    assert mismatches(every_character(spark), comparison_form, text.normalize_text("text")).count() == 0


def test_fold_marks_on_every_character(spark):
    rows = mismatches(every_character(spark), without_marks, text.fold_marks("text"))
    # the two runtimes may know different case pairs of very recent scripts
    same_case = rows.where(F.lower("wanted") != F.lower("found"))
    assert same_case.count() == 0


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{name} string" for name in values))
    return row.select(column.alias("v")).first().v


def test_normalize_examples(spark):
    assert one(spark, text.normalize_text("a"), a=" Cien años de soledad ") == "cien anos de soledad"
    assert one(spark, text.normalize_text("a"), a="  Pedro   Páramo ") == "pedro paramo"
    assert one(spark, text.normalize_text("a"), a=None) == ""
    assert one(spark, text.normalize_text("a"), a="ﬁn ½ Łódź") == "fin 1 2 odz"


def test_strip_knows_unicode_spaces(spark):
    assert one(spark, text.strip("a"), a="  \x1c x y 　\n") == "x y"


def test_lists(spark):
    assert one(spark, text.split_list("a"), a=" x ; ;y z;; ") == ["x", "y z"]
    assert one(spark, text.split_list("a"), a=None) == []
    assert one(spark, text.split_list("a"), a=" ; ") == []
    assert one(spark, text.split_plain("a"), a="x;; y") == ["x", " y"]
    assert one(spark, text.tidy_delimiters("a"), a=" a | b ;c ") == "a;b;c"
    assert one(spark, text.distinct_items("a"), a="b; a;b") == "b;a"
    assert one(spark, text.distinct_items("a"), a=" ; ") is None
    assert one(spark, text.items_not_in("a", "b"), a="Casa  Uno;DOS;tres", b="casa uno; dos") == "tres"
    assert one(spark, text.items_not_in("a", "b"), a="STRASSE", b="straße") is None
    assert one(spark, text.items_not_in("a", "b"), a="x;y", b=None) == "x;y"
    assert one(spark, text.items_not_in("a", "b"), a=None, b="x") is None


def test_rewrites(spark):
    assert one(spark, text.drop_parentheses("a"), a="Ana (ed.) Ruiz (x)") == "Ana  Ruiz"
    assert one(spark, text.drop_decimal_zero("a"), a=" 9780000000002.0 ") == "9780000000002"
    assert one(spark, text.natural_name("a"), a="Ruiz,Ana") == "Ana Ruiz"
    assert one(spark, text.natural_name("a"), a="Ana Ruiz") == "Ana Ruiz"
    assert one(spark, text.natural_name("a"), a=None) is None
    assert one(spark, text.full_title("a", "b"), a="Uno", b="dos") == "Uno: dos"
    assert one(spark, text.full_title("a", "b"), a="Uno", b=None) == "Uno"
    assert one(spark, text.search_title("a"), a=" Uno. Dos: tres") == "Uno"
    assert one(spark, text.or_sentinel("a", "<x>"), a="  ") == "<x>"
    assert one(spark, text.blank_to_null("a"), a=" ") is None
    assert one(spark, text.collapse_spaces("a"), a=" a \n b ") == "a b"


def test_normal_form_of_ascii_text_needs_no_regular_expression(spark):
    """Each ASCII character at the ends, alone, doubled and between letters, also beside others."""
    texts = [value for ch in map(chr, range(0x80)) for value in (ch, f"{ch}a{ch}{ch}B{ch} {ch}9{ch}", f"<{ch}>><< x", f"é{ch}{ch}中 Z")]
    frame = spark.createDataFrame([(value,) for value in [*texts, "", "<>", "a<>b"]], "t string").select("t", text.normalize_text("t").alias("n"))
    assert [(row.t, row.n) for row in frame.collect()] == [(row.t, comparison_form(row.t)) for row in frame.collect()]
    assert "THEN regexp_replace(" in frame._jdf.queryExecution().optimizedPlan().toString()
