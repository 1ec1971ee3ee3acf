"""Reading one large JSON document with many tasks.

A document ``{..., "records": [{...}, {...}]}`` has no line per record, so Spark would give
it whole to one task. Here its text is cut at every closing brace, which Spark can do from
any place of the file, and what a task cannot know of the text before its part is small: is
the place inside a string, and how many brackets are open. Both are sums over pieces, so
they run inside the file's splits and one row per split carries them on. Pieces between two
ends of a record are put together again and only then parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators.skew import fill_forward
from lectern.session import settle

FILE, SPLIT, PLACE = "file", "split", "place"
# brackets open between two records: the document's and the array's
OUTSIDE = 2


def _running(rows: DataFrame, value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all pieces of the file before this one."""
    sums = rows.groupBy(FILE, SPLIT).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(FILE, SPLIT, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy(FILE, SPLIT).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(offsets, [FILE, SPLIT]).withColumn(
        name, F.col("_carried") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_carried")


def _opened(text, in_string: bool):
    """Brackets opened less those closed by a piece and the brace after it, and that brace alone."""
    started = F.concat(F.lit('"'), text) if in_string else text
    outside = F.regexp_replace(started, r'"[^"]*("|$)', "")
    count = F.length(F.regexp_replace(outside, r"[^{\[]", "")) - F.length(F.regexp_replace(outside, r"[^}\]]", ""))
    quotes = F.length(F.regexp_replace(started, '[^"]', ""))
    return (count - F.when(quotes % 2 == 0, 1).otherwise(0)).cast("long")


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """The text of the documents up to each closing brace, with its file, split and place."""
    lines = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(PLACE), F.col("value").alias("piece"))
    plain = F.regexp_replace("piece", r"(?s)\\.", "")  # escaped characters, quotes among them
    return lines.withColumn("_plain", plain).select(
        *lines.columns, F.length(F.regexp_replace("_plain", '[^"]', "")).cast("long").alias("quotes"),
        _opened(F.col("_plain"), False).alias("opened"), _opened(F.col("_plain"), True).alias("opened_in_string"))


def read_records(spark: SparkSession, path: str, schema: str, key: str = "records") -> DataFrame:
    """``file``, ``record_no`` (from 0) and ``record`` of the objects in each document's array ``key``.

    Defined results: the array's elements are objects, of any depth; numbers and nulls among
    them are not counted. An empty array, or a document without the key, has no rows. A
    record that does not fit the schema has nulls. The key stands once, at the top level.
    """
    pieces = settle(pieces_of(spark, path))
    narrow = pieces.select(FILE, SPLIT, PLACE, "quotes", "opened", "opened_in_string")
    stringed = _running(narrow, "quotes", "quotes_before")
    starts_in = F.col("quotes_before") % 2 == 1
    ends_in = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    depth = _running(
        stringed.select(FILE, SPLIT, PLACE, ends_in.alias("ends_in"),
                        F.when(starts_in, F.col("opened_in_string")).otherwise(F.col("opened")).alias("change")),
        "change", "depth")
    # a brace outside strings after which only the document and the array are open
    is_end = ~F.col("ends_in") & (F.col("depth") + F.col("change") == OUTSIDE)
    ended = depth.select(FILE, SPLIT, PLACE, is_end.cast("long").alias("ends"))
    numbers = settle(_running(ended, "ends", "number"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(SPLIT, PLACE, "piece"))), lambda p: p["piece"]), "}")
    whole = pieces.join(numbers, [FILE, SPLIT, PLACE]).groupBy(FILE, "number").agg(
        text.alias("text"), F.max("ends").alias("ends")).where("ends = 1").drop("ends")
    # the first of an array says whose it is; what goes on after a comma belongs to the same array
    goes_on = F.col("text").rlike(r"^\s*,\s*(\{|[^\"{\s])")
    head = rf'(?s)(?<!\\)"{key}"\s*:\s*\[[^{{"]*(\{{.*)$'
    named = whole.withColumn("wanted", F.when(~goes_on, F.col("text").rlike(head)))
    labelled = fill_forward(named, "wanted", "number", [FILE])
    body = F.when(goes_on, F.substr("text", F.locate("{", "text"))).otherwise(F.regexp_extract("text", head, 1))
    wanted = labelled.where("wanted").select(FILE, "number", F.from_json(F.concat(body, F.lit("}")), schema).alias("record"))
    first = labelled.where("wanted").groupBy(FILE).agg(F.min("number").alias("_first"))
    return wanted.join(first, FILE).select(FILE, (F.col("number") - F.col("_first")).cast("int").alias("record_no"), "record")
