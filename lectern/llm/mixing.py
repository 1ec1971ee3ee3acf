"""Mixing sources to target weights by Pareto order sampling.

Every source has a target number of words: its share by weight of all words, at most
``most`` times its own size, the excess shared again by weight. Inside a source each
document has an expected number of copies, its weight times a factor, at most ``most``,
such that the expected words meet the target. The whole part of that number is certain;
the rest is an inclusion probability p, and the documents are ranked by

    (u / (1 - u)) / (p / (1 - p)),      u a uniform number from a hash of the id,

the first ones being taken until the missing words are reached as nearly as whole
documents allow. No document exceeds ``most`` copies.

A document's weight is the number of binary digits of its size, so a near-empty page is
repeated less often than a long one. Weights are small integers: a source is summed up
by (source, weight), at most 64 lines, whatever its number of rows.

Where a source's ranking is cut: its ranks are put into 4096 bins, twice, by sums that
Spark combines before the shuffle; only the different (id, size) of the one bin that holds
the cut are sorted. No task sees a whole source, and whole rows are not shuffled by it:
what is known of the sources comes to the rows as a table of checked size, or by a join
whose hot sources are salted.

Defined results: a null or empty text has size 0, takes 0 words and is not in the mix. Null is a source of
its own, last in order. Rows that agree in id, size and source have the same rank and are
interchangeable; where the cut falls among them as many are taken as the target needs, by
a count of them. Without any words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import prepare, settle, word_count
from lectern.operators.skew import attach, sequential_ids

BINS = 4096
# lines of the table of sources that go to every task; beyond, rows are joined to it
SMALL = 100_000
WEIGHTS = (5, 2, 1)
MOST = 3


def uniform(id_col: str, salt: str = "mix") -> Column:
    """A number in (0, 1) from a hash of the id: 52 bits, never 0 or 1."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``source_weight``, ``target`` for rows of (source, size).

    Sources are numbered in code point order over range partitions and the numbers give
    the repeating weights. Sharing the excess again is one sum per round, until no
    source is above its limit.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # UTF-8 bytes sort as code points
    numbered = sequential_ids(totals, [F.col("source").asc_nulls_last()], "place", start=0)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    table = settle(numbered.select(
        "source", "source_size", F.get(cycle, (F.col("place") % len(weights)).cast("int")).cast("bigint").alias("source_weight")))
    everything = table.agg(F.sum("source_size")).first()[0] or 0
    # the level is words per unit of weight, kept as a fraction of integers
    capped, level = F.lit(False), (0, 1)
    while True:
        words, weight, n = table.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size") * most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("source_weight"))), F.lit(0)),
            F.count_if(capped)).first()
        if not weight:
            break
        level = (everything - words, weight)
        now = F.lit(level[0]).cast("double") * F.col("source_weight") / F.lit(level[1]) > F.col("source_size") * most
        if table.where(capped | now).count() == n:
            break
        capped = capped | now
    share = F.lit(level[0]).cast("double") * F.col("source_weight") / F.lit(level[1])
    limit = (F.col("source_size") * most).cast("double")
    return table.withColumn("target", F.least(share, limit))


def expected_copies(sized: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``source``, ``weight``, its number of ``rows``, ``expected`` copies of a document, ``certain`` words and the target.

    The factor of a source solves  sum of size * min(most, factor * weight) = target. With
    the weights in falling order the largest ones meet the limit first, so the factor
    follows from sums over the at most 64 lines of the source.
    """
    lines = sized.groupBy("source", "weight").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows")).join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    above = Window.partitionBy("source").orderBy(F.desc("weight")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("source").orderBy(F.desc("weight")).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("source")
    limited = F.coalesce(F.sum("words").over(above), F.lit(0)) * most
    open_ = F.sum(F.col("words") * F.col("weight")).over(below)
    factor = (F.col("target") - limited) / F.nullif(open_, F.lit(0))
    solved = lines.withColumn("factor", factor).withColumn(
        "factor", F.max(F.when(F.col("factor") * F.col("weight") <= most, F.col("factor"))).over(whole))
    # the first line that stays under the limit fixes the factor; without one all are at it
    expected = F.least(F.coalesce(F.col("factor") * F.col("weight"), F.lit(float(most))), F.lit(float(most)))
    return (
        solved.withColumn("expected", F.when(F.col("source_size") == 0, 0.0).otherwise(expected))
        .withColumn("certain", F.sum(F.floor("expected") * F.col("words")).over(whole))
        .select("source", "weight", "rows", "expected", "certain", "source_size", "target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` of every row.

    ``keep`` names further columns of ``docs`` to carry along, under the prefix ``kept_``.
    """
    prepare(docs.sparkSession)
    size = word_count(F.col(text_col))
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
        uniform(id_col).alias("u"), *[F.col(name).alias(f"kept_{name}") for name in keep or []])
    sized = base.withColumn("weight", F.length(F.bin("size")).cast("bigint"))
    # ids and sizes are written once; whole rows are only read, in the last step
    slim = settle(sized.select("doc_id", "source", "size", "weight", "u"))
    targets = source_targets(slim, weights, most)
    levels = settle(expected_copies(slim, targets, most))
    small = levels.count() <= SMALL

    def with_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
        """The line of each row's source and weight, and its rank in the source."""
        # a key that is never null, so that null is a source like any other
        key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key")
        rows, lines = rows.select("*", key), lines.select("*", key).drop("source")
        keys = ["source_key", "weight"]
        if small:
            joined = rows.join(F.broadcast(lines.drop("rows")), keys)
        else:
            joined = attach(rows, lines, keys, "rows", F.xxhash64("doc_id", "size", "u"), "inner").drop("rows")
        chance = F.col("expected") - F.floor("expected")
        rank = (F.col("u") / (1 - F.col("u"))) / (chance / (1 - chance))
        return (
            joined.withColumn("rank", F.when((chance > 0) & (F.col("size") > 0), rank))
            # ranks of any size as numbers under 1, in the same order
            .withColumn("turn", F.col("rank") / (1 + F.col("rank")) * BINS)
            .withColumn("bin", F.least(F.floor("turn"), F.lit(BINS - 1)))
            .withColumn("fine", F.least(F.floor((F.col("turn") - F.col("bin")) * BINS), F.lit(BINS - 1))))

    drawn = with_lines(slim, levels).where(F.col("rank").isNotNull())
    missing = F.col("target") - F.col("certain")

    def cut(sums: DataFrame, keys: list[str], order: str) -> DataFrame:
        """The bin in which the middle of a document first reaches the missing words, and the words before it."""
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        run = sums.withColumn("_before", F.col("base") + F.coalesce(F.sum("words").over(before), F.lit(0)))
        reach = run.where(F.col("_before") + F.col("words") >= F.col("missing"))
        return reach.groupBy(*keys).agg(F.min(order).alias(order), F.min_by("_before", order).alias("base"))

    def inside(rows: DataFrame, cuts: DataFrame, order: str) -> DataFrame:
        """The rows in the bin of their source that holds the cut, with the words before it."""
        named = cuts.select("source_key", order, F.col("base").alias("cut_base"))
        return rows.join(F.broadcast(named) if small else named, ["source_key", order])

    first = drawn.groupBy("source_key", "bin").agg(
        F.sum("size").alias("words"), F.first(missing).alias("missing")).withColumn("base", F.lit(0).cast("bigint"))
    cut_1 = settle(cut(first, ["source_key"], "bin"))
    # two bins of ranks around the cut decide: a document counts when its middle is before it
    near = inside(drawn, cut_1, "bin")
    second = near.groupBy("source_key", "bin", F.col("cut_base").alias("base"), "fine").agg(
        F.sum("size").alias("words"), F.first(missing).alias("missing"))
    cut_2 = settle(cut(second, ["source_key", "bin"], "fine"))
    # rows of one id and size are one entry, however many they are
    alike = inside(near.drop("cut_base"), cut_2, "fine").groupBy("source_key", "rank", "doc_id", "size").agg(
        F.count("*").alias("n"), F.first("cut_base").alias("base"), F.first(missing).alias("missing"))
    run = Window.partitionBy("source_key").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(run), F.lit(0))
    half = F.col("size") / 2
    sure = F.least(F.greatest(F.floor((F.col("missing") - F.col("at") - half) / F.col("size")), F.lit(0)), F.col("n"))
    one_more = (F.col("sure") < F.col("n")) & (F.col("at") + F.col("sure") * F.col("size") + half < F.col("missing"))
    entry = F.struct("rank", "doc_id", "size")
    edges = (
        alike.withColumn("at", start).withColumn("sure", sure)
        .withColumn("part", F.col("sure") + one_more.cast("bigint")).where("part > 0")
        .groupBy("source_key").agg(
            F.max(entry).alias("edge"), F.max_by("part", entry).alias("part"), F.max_by("n", entry).alias("n")))
    ends = settle(cut_2.select("source_key", F.col("bin").alias("cut_bin"), F.col("fine").alias("cut_fine")).join(
        edges, "source_key", "left"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    lines = levels.withColumn("source_key", key).join(ends, "source_key", "left").drop("source_key")
    ready = with_lines(sized if keep else slim, lines)
    in_cut = (F.col("bin") == F.col("cut_bin")) & (F.col("fine") == F.col("cut_fine"))
    earlier = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (F.col("fine") < F.col("cut_fine")))
    at_edge = F.coalesce(F.col("edge").eqNullSafe(entry) & (F.col("part") < F.col("n")), F.lit(False))
    # a source whose probabilities do not reach the missing words takes all of them
    extra = F.when(F.col("rank").isNull(), 0).when(F.col("cut_bin").isNull(), 1).when(
        earlier | (in_cut & F.coalesce(entry <= F.col("edge"), F.lit(False))), 1).otherwise(0)
    if ends.where("part < n").isEmpty():
        decided = ready.withColumn("extra", extra)
    else:
        # the cut falls among rows that are alike: they are counted, in blocks of those that a task reads
        columns = ready.columns
        placed = settle(ready.where(at_edge).select(
            "*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("place")))
        counts = placed.groupBy("source_key", "block").agg(F.count("*").alias("block_rows"))
        above = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("source_key", "block", F.coalesce(F.sum("block_rows").over(above), F.lit(0)).alias("offset"))
        in_block = Window.partitionBy("source_key", "block").orderBy("place")
        counted = placed.join(offsets, ["source_key", "block"]).withColumn(
            "number", F.col("offset") + F.row_number().over(in_block))
        decided = ready.where(~at_edge).withColumn("extra", extra).unionByName(
            counted.select(*columns, (F.col("number") <= F.col("part")).cast("int").alias("extra")))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.floor("expected") + F.col("extra")).cast("int")
    return decided.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), *[f"kept_{name}" for name in keep or []])


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of the mix with all their columns, each as often as it is taken."""
    found = mix(docs, id_col, text_col, source_col, weights, most, keep=docs.columns).where("copies > 0")
    repeated = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(f"kept_{name}").alias(name) for name in docs.columns])
