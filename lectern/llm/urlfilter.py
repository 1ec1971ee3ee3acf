"""URL filters: rules on host and path, and trust propagated over the links between hosts.

Rules decide the urls that they fit. Every other url is judged by its host. A host most of
whose pages the rules allow is a trusted seed, one most of whose pages they block is a
blocked seed. Trust goes along the links by personalised PageRank from the trusted seeds,
distrust goes against them from the blocked seeds: who links to blocked hosts is
distrusted. A host is blocked where its distrust is at least LEAST and holds more than
MOST_DISTRUST percent of both scores; hosts that neither reaches are allowed.

Both walks run together on one table of host edges. Scores are whole numbers of UNIT
parts of a seed, and each edge rounds its share down, so that a result depends on no
order of summing; s = seed + DAMPING * (shares of s over the links) is repeated ROUNDS
times or until nothing changes. What flows into a host without links ends there. A page
counts once for each host that it links to, links within a host count for nothing. Each
round is written to the shared folder. Pages and edges are reduced per host with map-side
combine; hosts with many pages or links are salted where they are joined.

Defined results: a url that is null or has no `://` has empty host and path, which is a
host like any other but no rule fits it. Of rules of equal length the one with the longer
host wins, then a blocking one. Null html has no links. Repeated rows are judged each, and
count each as a page. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import prepare, settle
from lectern.operators.skew import attach

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x20\x09-\x0D]*"
LINKED_HOST = rf"""[hH][rR][eE][fF]{GAP}={GAP}["']?{GAP}(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)"""

UNIT = 1_000_000_000      # score of a seed
DAMPING = 85              # percent of a score that the links pass on
ROUNDS = 40
MOST_DISTRUST = 50        # percent of trust and distrust together
LEAST = UNIT // 100       # less distrust than this blocks no host
WAYS = ("trust", "distrust")


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def after_scheme(url: str) -> Column:
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def path_of(rest: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rules(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) for columns ``host`` and ``path``; ``rules``: (allow or block, host/path)."""
    def order(entry):
        verdict, rule = entry
        return -len(rule), -len(rule.split("/", 1)[0]), verdict != "block", rule

    found = found_verdict = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=order, reverse=True):  # the first in order is tested first
        host, path = rule.split("/", 1)
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(
            F.col("path"), F.lit(f"/{path}"))
        found = F.when(fits, F.lit(rule)).otherwise(found)
        found_verdict = F.when(fits, F.lit(verdict)).otherwise(found_verdict)
    return found, found_verdict


def parsed(pages: DataFrame, rules: list[tuple[str, str]], id_col: str, url_col: str, html_col: str | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` (null where no rule fits), and ``html`` if asked for."""
    html = [F.col(html_col).alias("html")] if html_col else []
    named = pages.select(F.col(id_col).alias("page_id"), after_scheme(url_col).alias("rest"), *html)
    split = named.withColumns({"host": host_of(F.col("rest")), "path": path_of(F.col("rest"))}).drop("rest")
    rule, verdict = by_rules(rules)
    return split.withColumns({"rule": rule, "verdict": verdict})


def host_table(pages: DataFrame) -> DataFrame:
    """``host``, its number of ``pages``, and those that the rules ``allow`` and ``block``."""
    return pages.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("verdict") == "allow").alias("allow"),
        F.count_if(F.col("verdict") == "block").alias("block"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``weight``: how many pages of a host link to another one."""
    targets = F.transform(F.regexp_extract_all("html", F.lit(LINKED_HOST), F.lit(1)), lowered)
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(targets)).alias("dst"))
    return links.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def flows(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges as (``way``, ``src``, ``dst``, ``weight``), distrust reversed, and per (way, src) their ``total`` and ``links``."""
    both = edges.select(F.lit(WAYS[0]).alias("way"), "src", "dst", "weight").union(
        edges.select(F.lit(WAYS[1]).alias("way"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both, both.groupBy("way", "src").agg(F.sum("weight").alias("total"), F.count("*").alias("links"))


def share(score: str, weight: str, total: str) -> Column:
    return F.expr(f"(cast({score} as decimal(19,0)) * cast({weight} as decimal(13,0)) * {DAMPING}) div "
                  f"(cast({total} as decimal(19,0)) * 100)")


def seeds(hosts: DataFrame) -> DataFrame:
    """``way``, ``host``, ``score`` of the hosts that the rules decide for the larger part."""
    return reduce(DataFrame.union, [
        hosts.where(F.col(verdict) * 2 > F.col("pages")).select(
            F.lit(way).alias("way"), "host", F.lit(UNIT).cast("bigint").alias("score"))
        for way, verdict in zip(WAYS, ("allow", "block"))])


def _mark(scores: DataFrame) -> tuple:
    return tuple(scores.agg(F.count("*"), F.sum(F.col("score").cast("decimal(38,0)")),
                            F.bit_xor(F.xxhash64("way", "host", "score"))).first())


def propagate(start: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``way``, ``host``, ``score`` of every host that trust or distrust reaches from ``start``."""
    start = settle(start)
    moving, totals = (settle(frame) for frame in flows(edges))
    held, mark = start, _mark(start)
    for _ in range(rounds):
        senders = held.withColumnRenamed("host", "src").join(totals, ["way", "src"])
        passed = attach(moving, senders, ["way", "src"], "links", F.col("dst"), how="inner").select(
            "way", F.col("dst").alias("host"), share("score", "weight", "total").alias("score"))
        held = settle(start.union(passed).groupBy("way", "host").agg(F.sum("score").alias("score")).where("score > 0"))
        before, mark = mark, _mark(held)
        if mark == before:
            break
    return held


def host_scores(scores: DataFrame) -> DataFrame:
    """``host``, ``trust``, ``distrust`` and the ``blocked`` flag of every host that was reached."""
    wide = scores.groupBy("host").agg(*[
        F.coalesce(F.max(F.when(F.col("way") == way, F.col("score"))), F.lit(0)).alias(way) for way in WAYS])
    both = (F.col("trust") + F.col("distrust")) * MOST_DISTRUST
    return wide.withColumn("blocked", (F.col("distrust") >= LEAST) & (F.col("distrust") * 100 > both))


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the host's ``trust`` and ``distrust``, for every page."""
    prepare(pages.sparkSession)
    edges = settle(host_edges(parsed(pages, rules, id_col, url_col, html_col)))
    rows = parsed(pages, rules, id_col, url_col)
    hosts = settle(host_table(rows))
    judged = host_scores(propagate(seeds(hosts), edges))
    known = hosts.select("host", "pages").join(judged, "host")
    joined = attach(rows, known, ["host"], "pages", F.struct("page_id", "path"))
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust"))
