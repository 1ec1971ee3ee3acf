"""Exact top-k search by inner product as a Voronoi join.

Every vector is turned into integers, floor(scale * component). A bounded number of
pivots parts the data into cells; each cell is summarised by its size, its radius about
the pivot and the best score bounds that follow from them. Queries are grouped by the
cell of their own, in groups of bounded size. For each query the summaries give a score
that its k-th best surely reaches; a cell is sent to a query group only when the upper
bound  q.p + |q| * radius  of some query in the group reaches that query's floor. Each
(group, part of the data) is solved by itself, and the partial lists are merged.

Defined results: vectors that are null, or hold a null or non-finite component, take no
part. Vectors shorter than the longest are filled with zeros. Equal scores go to the
smaller id; equal ids and scores are ranked as equal rows, in any order. A row is no
candidate for a query with its own id; query rows that agree in id and vector ask once.
Rows without an id take no part. Scores beyond
the range of a long are cut to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import prepare, settle
from lectern.operators.skew import shuffle_width

PIVOTS = 64              # cells at most
PIVOT_SAMPLE = 2048      # rows that pivots are fitted on, the first by a hash of the id
QUERIES_PER_GROUP = 1024
PART_ROWS = 16_384       # data rows in one task, about
SCALE = 1024


def integers(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, or null when the vector takes no part."""
    def is_bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    doubles = F.col(vector).cast("array<double>")
    whole = F.transform(doubles, lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint"))
    return F.when(doubles.isNotNull() & ~F.coalesce(F.exists(doubles, is_bad), F.lit(False)), whole)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    made = np.zeros((len(column), width), dtype=np.int64)
    for at, vector in enumerate(column):
        made[at, :len(vector)] = vector
    return made


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these hold them, else in Python's integers."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < 2 ** 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _fit_pivots(sample: np.ndarray, rounds: int = 5) -> np.ndarray:
    """A few rounds of k-means on the sample."""
    count = min(PIVOTS, max(1, len(sample) // 8))
    pivots = sample[np.linspace(0, len(sample) - 1, count).astype(int)].astype(np.float64)
    for _ in range(rounds):
        nearest = _nearest(sample, pivots)[0]
        for cell in range(count):
            members = sample[nearest == cell]
            if len(members):
                pivots[cell] = members.mean(axis=0)
    return pivots


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gaps = ((rows.astype(np.float64) ** 2).sum(axis=1)[:, None] - 2 * rows.astype(np.float64) @ pivots.T
            + (pivots ** 2).sum(axis=1))
    cell = gaps.argmin(axis=1)
    distance = np.sqrt(((rows - pivots[cell]) ** 2).sum(axis=1))
    return cell, distance


def _query_groups(centre: np.ndarray, cells: pd.DataFrame) -> tuple[list[int], list[int]]:
    """Group of each cell's queries, and blocks of the group when one cell asks too much.

    Cells are taken in the order of a walk to the nearest pivot not yet seen, and share a
    group until it holds QUERIES_PER_GROUP queries: the data is sent once per group.
    """
    asked, left, at, group, size = cells["asked"].to_numpy(), set(range(len(cells))), 0, 0, 0
    groups, blocks = [0] * len(cells), [1] * len(cells)
    while left:
        left.discard(at)
        if size and size + asked[at] > QUERIES_PER_GROUP:
            group, size = group + 1, 0
        groups[at], blocks[at] = group, max(1, -(-int(asked[at]) // QUERIES_PER_GROUP))
        size += asked[at]
        if left:
            rest = np.fromiter(left, dtype=int)
            at = int(rest[((centre[rest] - centre[at]) ** 2).sum(axis=1).argmin()])
    return groups, blocks


def top_k(data: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best other rows of every query row."""
    spark = prepare(data.sparkSession)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    rows = settle(
        data.select(F.col(id_col).cast("bigint").alias("vec_id"), integers(vector_col, scale).alias("vector"),
                    F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull()))
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return spark.createDataFrame([], schema)

    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(PIVOT_SAMPLE).select("vector").toPandas()
    pivots = _fit_pivots(_matrix(sample["vector"], width))

    def assign(batches):
        for batch in batches:
            cell, distance = _nearest(_matrix(batch["vector"], width), pivots)
            yield batch.assign(cell=cell.astype(np.int32), distance=distance)

    placed = settle(rows.mapInPandas(assign, "vec_id bigint, vector array<bigint>, asks boolean, cell int, distance double"))
    # one line per cell, so at most PIVOTS lines
    cells = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("distance").alias("radius"), F.count_if("asks").alias("asked")).toPandas()
    cells = cells.sort_values("cell").reset_index(drop=True)
    centre, radius, held = pivots[cells["cell"]], cells["radius"].to_numpy(), cells["n"].to_numpy()
    groups, blocks = _query_groups(centre, cells)

    def reached(batches):
        """For every query: the cells it needs, from the summaries alone."""
        for batch in batches:
            q = _matrix(batch["vector"], width).astype(np.float64)
            middle, length = q @ centre.T, np.sqrt((q ** 2).sum(axis=1))[:, None]
            slack = 1e-6 * (1 + np.abs(middle) + length * radius)
            low, high = middle - length * radius - slack, middle + length * radius + slack
            order = np.argsort(-low, axis=1)
            # cells by falling lower bound until they surely hold k rows besides all rows of the query's id
            wanted = (k + batch["own"].to_numpy(np.int64))[:, None]
            reach = np.cumsum(held[order], axis=1) >= wanted
            floor = np.take_along_axis(low, order, axis=1)[np.arange(len(q)), reach.argmax(axis=1)]
            floor = np.where(reach[:, -1], floor, -np.inf)
            needed = high >= floor[:, None]
            yield batch[["vec_id", "vector", "group"]].assign(
                cells=[cells["cell"].to_numpy()[line].tolist() for line in needed])

    pairs = F.create_map(*[F.lit(x) for at, cell in enumerate(cells["cell"]) for x in (int(cell), groups[at])])
    widths = F.create_map(*[F.lit(x) for at, cell in enumerate(cells["cell"]) for x in (int(cell), blocks[at])])
    block = F.pmod(F.xxhash64("vec_id"), F.element_at(widths, F.col("cell")))
    group = F.element_at(pairs, F.col("cell")).cast("bigint") * F.lit(1 << 40) + block
    # no row of the query's own id is a candidate, so as many rows as it has are not counted on
    own = rows.groupBy("vec_id").agg(F.count("*").alias("own"), F.max("asks").alias("any")).where("any").drop("any")
    asking = placed.where("asks").dropDuplicates(["vec_id", "vector"]).join(own, "vec_id").withColumn("group", group)
    queries = settle(asking.mapInPandas(reached, "vec_id bigint, vector array<bigint>, group bigint, cells array<int>"))

    # the data a group needs; both sides are dealt by (group, part), and parts bound a task
    wanted = queries.select("group", F.explode("cells").alias("cell")).distinct()
    total = int(held.sum())
    parts = max(1, min(-(-total // PART_ROWS), 64 * shuffle_width(rows)))
    part = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int").alias("part")
    sent = placed.select("cell", "vec_id", "vector", part).join(wanted, "cell").select(
        (F.col("group") + 0).alias("group"), "part", "vec_id", "vector")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    spread = queries.select("group", every_part, "vec_id", "vector")

    def solve(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if not len(asked) or not len(found):
            return empty
        ids = found["vec_id"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")
        ids, right = ids[order], _matrix(found["vector"], width)[order]
        answers = [empty]
        for at in range(0, len(asked), 256):
            some = asked.iloc[at:at + 256]
            scores = _products(_matrix(some["vector"], width), right)
            for own, line in zip(some["vec_id"].to_numpy(np.int64), scores):
                own_rows = ids == own
                line = line[~own_rows] if own_rows.any() else line
                others = ids[~own_rows] if own_rows.any() else ids
                if len(line) > k:  # all that reach the k-th score, in id order, then the first k
                    least = np.partition(line, len(line) - k)[len(line) - k]
                    line, others = line[(at_least := line >= least)], others[at_least]
                best = np.argsort(-line.astype(object) if len(line) and line.min() == -2 ** 63 else -line, kind="stable")[:k]
                answers.append(pd.DataFrame({"query_id": own, "vec_id": others[best], "score": line[best]}))
        return pd.concat(answers)

    partial = (
        spread.groupBy("group", "part").cogroup(sent.groupBy("group", "part"))
        .applyInPandas(lambda asked, found: solve(asked, found), "query_id bigint, vec_id bigint, score bigint"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
