"""Document fingerprints from closed syncmers, in DataFrame functions alone.

A text is a sequence of units: words, and runs without white space cut into pieces of at
most PIECE characters. Of the k units from each position the inner substrings of s units
are hashed; the k-mer is a closed syncmer when the smallest of these hashes is at the
first or at the last place. Whether a k-mer is chosen depends on nothing around it, so
equal passages have equal anchors wherever they stand. The fingerprint lists the hashes
of the chosen k-mers in the order of the text, eight hexadecimal digits each.

The smallest of a run of hashes comes from pairwise minima of runs half as long, so the
work per unit is the same for every text length.

Defined results: a null text is empty and has the empty fingerprint; a text of fewer than
k units has one anchor, its whole sequence. Likeness is the share of common anchors among
all distinct anchors; two empty fingerprints are alike (1), an empty and another are not
(0). Documents follow one another by falling id, null ids last, equal ids by falling hash
of the text; rows that agree in id and text are one document with one result for each of
them. A single document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import prepare, settle
from lectern.operators.skew import sequential_ids

K, S = 5, 2            # units of a k-mer and of an inner substring; K - S + 1 is a power of two
PIECE = 16             # most characters of a unit
UNIT = r"[^\x20\x09-\x0D]{1,%d}" % PIECE


def _from(array: str, skip: int, length: Column) -> Column:
    return F.slice(F.col(array), F.lit(skip + 1), F.greatest(length, F.lit(0)))


def with_anchors(frame: DataFrame, text_col: str, name: str) -> DataFrame:
    """``frame`` with ``name``, array<struct<place, hash>>: the closed syncmers of the text in order."""
    w = K - S + 1
    u, s, m, n = f"_{name}_u", f"_{name}_s", f"_{name}_m", f"_{name}_n"
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(UNIT), F.lit(0))
    made = frame.withColumn(u, F.transform(pieces, lambda x: F.xxhash64(x))).withColumn(n, F.size(u))
    made = made.withColumn(s, F.zip_with(
        _from(u, 0, F.col(n) - (S - 1)), _from(u, 1, F.col(n) - (S - 1)), lambda a, b: F.xxhash64(a, b)))
    reach, held = 1, s
    while reach < w:  # minima of runs of 2, 4, ... hashes
        count = F.col(n) - (S - 1) - (2 * reach - 1)
        made = made.withColumn(f"{m}{reach}", F.zip_with(
            _from(held, 0, count), _from(held, reach, count), lambda a, b: F.least(a, b)))
        held, reach = f"{m}{reach}", 2 * reach
    last = F.col(n) - K
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    chosen = F.filter(places, lambda i: (F.get(F.col(s), i) == F.get(F.col(held), i)) | (
        F.get(F.col(s), i + (w - 1)) == F.get(F.col(held), i)))

    def anchor(i):
        whole = F.xxhash64(F.get(F.col(s), i), F.get(F.col(s), i + 2), F.get(F.col(u), i + (K - 1)))
        return F.struct(i.alias("place"), whole.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("hash"))

    short = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(u).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("hash")))
    none = F.array().cast("array<struct<place:int,hash:int>>")
    anchors = F.when(F.col(n) == 0, none).when(F.col(n) < K, short).otherwise(F.transform(chosen, anchor))
    made = made.withColumn(name, anchors)
    return made.drop(*[c for c in made.columns if c.startswith(f"_{name}_")])


def hashes(anchors: str) -> Column:
    return F.col(anchors).getField("hash")


def shown(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(left: str, right: str) -> Column:
    """Common distinct hashes among all of two hash arrays that hold each hash once."""
    common = F.size(F.array_intersect(left, right))
    every = F.size(left) + F.size(right) - common
    return F.when(every == 0, 1.0).otherwise(common / F.nullif(every, F.lit(0)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``anchors`` with their places, and ``fingerprint``."""
    prepare(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_anchors(base, "text", "anchors").select("doc_id", "anchors", shown(hashes("anchors")).alias("fingerprint"))


def matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places where two fingerprint tables share an anchor: ``doc_id``, ``other_id``, ``shift``, ``n``.

    Shared anchors of one shift lie on one alignment of the two texts.
    """
    def long(frame, doc, place):
        return frame.select(F.col("doc_id").alias(doc), F.explode("anchors").alias("a")).select(
            doc, F.col("a.place").alias(place), F.col("a.hash").alias("hash"))

    return long(left, "doc_id", "here").join(long(right, "other_id", "there"), "hash").groupBy(
        "doc_id", "other_id", (F.col("there") - F.col("here")).alias("shift")).agg(F.count("*").alias("n"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit: its second half replaced by the beginning of the next document.

    Only ids travel to find who follows whom; then a text is dealt once by its own id, and
    the beginning it gives, with its anchors, once to the document before it.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a null id takes part in joins as a flag and a number; both branches below then read the
    # same columns of the dealt texts, and Spark deals them once
    keyed = base.select("text", F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                        F.xxhash64("text").alias("key"))
    slim = keyed.select("no_id", "id", "key", F.length("text").alias("n_chars")).distinct()
    placed = settle(sequential_ids(slim, [F.asc("no_id"), F.desc("id"), F.desc("key")], "place", start=0))
    count = placed.count()
    if not count:
        count = 1
    # whom a document gives its beginning to, and how much: its predecessor lost that many characters
    before = placed.select(
        F.pmod(F.col("place") + 1, F.lit(count)).alias("place"), F.col("no_id").alias("to_no_id"), F.col("id").alias("to_id"),
        F.col("key").alias("to_key"), F.floor(F.col("n_chars") / 2).cast("int").alias("asked"))
    gives = placed.select("no_id", "id", "key", "place").join(before, "place").drop("place")
    dealt = keyed.repartition("no_id", "id", "key")
    heads = dealt.dropDuplicates(["no_id", "id", "key"]).join(gives, ["no_id", "id", "key"])
    heads = with_anchors(heads, "text", "next").select(
        F.col("to_no_id").alias("no_id"), F.col("to_id").alias("id"), F.col("to_key").alias("key"),
        F.left("text", F.col("asked")).alias("head"), F.array_distinct(hashes("next")).alias("next_set"))
    joined = dealt.join(heads, ["no_id", "id", "key"]).withColumn("n_chars", F.length("text"))
    halved = joined.withColumn("edit", F.concat(
        F.left("text", F.col("n_chars") - F.floor(F.col("n_chars") / 2).cast("int")), F.col("head"))).drop("head")
    own = with_anchors(halved, "text", "own").withColumn("own", hashes("own")).drop("text")
    both = with_anchors(own, "edit", "new").withColumn("new", hashes("new"))
    sets = both.withColumn("own_set", F.array_distinct("own")).withColumn("new_set", F.array_distinct("new"))
    return sets.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256"),
        shown(F.col("own")).alias("fingerprint"), shown(F.col("new")).alias("edited_fingerprint"),
        likeness("own_set", "new_set").alias("near_edited"), likeness("own_set", "next_set").alias("near_next"))
