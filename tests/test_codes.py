import random

from pyspark.sql import functions as F

from lectern.functions import codes, dates, nested, vocab
from lectern import fixed_values as fixed
from tests.test_text import one


def test_clean_and_checksum(spark):
    assert one(spark, codes.clean_isbn("a"), a="978-0-307-47472-8") == "9780307474728"
    assert one(spark, codes.clean_isbn("a"), a="​080442957x") == "080442957X"
    assert one(spark, codes.clean_isbn("a"), a=None) == ""
    assert one(spark, codes.is_isbn13("a"), a="978-0-307-47472-8") is True
    assert one(spark, codes.is_isbn13("a"), a="978-0-307-47472-9") is False
    for bad in (None, "", "1234567890123", "9780000000001", "97803074747280", "978030747472X"):
        assert one(spark, codes.is_isbn13("a"), a=bad) is False


def test_checksum_against_plain_arithmetic(spark):
    rng = random.Random(7)
    numbers = ["".join(rng.choice("0123456789") for _ in range(13)) for _ in range(3000)]

    def good(code):
        return sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(code)) % 10 == 0

    rows = spark.createDataFrame([(n, good(n)) for n in numbers], "code string, good boolean")
    assert rows.where(codes.is_isbn13("code") != F.col("good")).count() == 0
    digits = rows.select("code", codes.check_digit(F.substring("code", 1, 12)).alias("digit")).collect()
    assert all(good(row.code[:12] + str(row.digit)) for row in digits)


def test_prefix_check(spark):
    assert one(spark, codes.has_book_prefix("a"), a="9790000000000") is True
    assert one(spark, codes.has_book_prefix("a"), a="1230000000000") is False
    assert one(spark, codes.has_book_prefix("a"), a=fixed.MISSING_ISBN) is False


def test_classification(spark):
    assert one(spark, codes.bisac_list("a"), a="[EDU000000] Educación;HIS033000 x;nada") == "EDU000000;HIS033000"
    assert one(spark, codes.bisac_list("a"), a="nada") is None
    assert one(spark, codes.bisac_unread("a"), a="[EDU000000] x; ;nada;; HIS033000 y;[[EDU000000]") == [
        "nada", "HIS033000 y", "[[EDU000000]"]
    assert one(spark, codes.bisac_unread("a"), a="") == [] and one(spark, codes.bisac_unread("a"), a=None) is None
    assert one(spark, codes.bisac_before_arrow("a"), a="EDU000000 > x") == "EDU000000"
    assert one(spark, codes.bisac_in_pairs("a"), a="[[['code', 'SOC000000']]]") == "SOC000000"
    assert one(spark, codes.thema_brackets("a"), a="[JN] a;[JN] b;[QD] c") == "JN;JN;QD"
    assert one(spark, codes.thema_mixed("a"), a="QD > Filosofía; QDTN; QDT > Temas; ds > x; QD") == "QD;QDTN;QDT"
    assert one(spark, codes.thema_mixed("a"), a="[P;PBA] Matemáticas; P; X9 > y") == "P;PBA;X9"
    assert one(spark, codes.dewey_list("a"), a="[370.7] x;sin;100 Filosofía") == "370.7;100"
    assert one(spark, codes.dewey_list("a"), a="1234;12345.6 x;12.345;[863.] y;99 100.5.1") == "123;123;345;863;100.5"
    assert one(spark, codes.dewey_leading("a"), a=" [370.7] x; 100 y") == "370.7"
    assert one(spark, codes.dewey_leading("a"), a="1234 x") == "123"
    assert one(spark, codes.dewey_leading("a"), a="x 100") is None
    assert one(spark, codes.doi_from_url("a"), a="https://doi.org/10.1/x") == "10.1/x"
    assert one(spark, codes.doi_from_url("a"), a="10.1/x") is None


def test_years(spark):
    for given, year in [("03/04/2021", 2021), ("3/4/2021", 2021), ("2022-01-05", 2022), ("c. 2019, rev", 2019),
                        ("2020", 2020), ("sin fecha", None), (None, None), (" 31/12/1999 ", 1999),
                        ("5/3/21", 2021), ("05-03-68", 2068), ("05.03.69", 1969), ("29/2/23", None), ("5/3/021", None)]:
        assert one(spark, dates.year_day_first("a"), a=given) == year, given
    assert one(spark, dates.year_iso("a"), a="2021-02-03") == 2021
    assert one(spark, dates.year_iso("a"), a="03/02/2021") is None


def test_pairs(spark):
    cell = """[[['role', 'organizer'], ['full_name', "O'Neill, Ana"], ['bio', None]], [['role', 'translator'], ['full_name', 'Luz']]]"""
    people = one(spark, nested.creators("a"), a=cell)
    assert [tuple(p) for p in people] == [("organizador", "Ana O'Neill"), ("translator", "Luz")]
    assert one(spark, nested.creators("a"), a="not a list") is None
    assert one(spark, nested.object_title("a"), a="[['title', 'Uno'], ['n', None], ['title', 'Dos']]") == "Dos"
    assert one(spark, nested.stores("a"), a="[[['store', 'Amazon']], [['url', 'x']]]") == ["Amazon", None]


def test_vocabularies(spark):
    assert one(spark, vocab.by_table("a", fixed.COUNTRY_NAMES), a=" br ") == "Brasil"
    assert one(spark, vocab.by_table("a", fixed.COUNTRY_NAMES), a="Chile") == "Chile"
    assert one(spark, vocab.by_table("a", fixed.CHANNEL_NAMES, caseless=False), a="Google Play") == "GOOGLE BOOKS"
    assert one(spark, vocab.by_rules("a", fixed.STORE_RULES), a="Google Play") == "GOOGLE PLAY"
    assert one(spark, vocab.by_rules("a", fixed.LANGUAGE_RULES), a="Español / Castellano") == "Español"
    assert one(spark, vocab.by_rules("a", fixed.LANGUAGE_RULES), a=None) is None
    assert one(spark, vocab.by_rules("a", fixed.FORMAT_RULES), a="print;pdf") == "impreso;pdf"
    for given, flag in [(None, "no"), ("No", "no"), ("Sí", "si"), ("nota", "no")]:
        assert one(spark, vocab.yes_no("a"), a=given) == flag
