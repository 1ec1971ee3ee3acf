"""Url rules and trust over host edges, against SQL and by hand."""

import random

import duckdb
import pandas as pd
import pytest

from lectern.llm import urlfilter
from lectern.llm.q_urlfilter import RULES, SQL

SCHEMA = "page_id bigint, url string, html string"


def link(*hosts):
    return "".join(f'<a href="https://{host}/x">x</a>' for host in hosts)


def both(spark, rows):
    found = urlfilter.judge(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as host", "2 as rule", "3 as pages"), RULES)
    database = duckdb.connect()
    database.register("given", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    database.execute("CREATE VIEW pages AS SELECT CAST(page_id AS BIGINT) page_id, CAST(url AS VARCHAR) url, CAST(html AS VARCHAR) html FROM given")
    expected = database.execute(SQL).fetchall()
    plain = sorted(map(tuple, found.collect()), key=repr)
    assert plain == sorted(expected, key=repr)
    return plain


def test_rules_and_odd_urls(spark):
    rows = [(1, "http://a.example.org/es/1", ""), (2, "HTTP://EXAMPLE.org/en/12?x#y", None), (3, "http://xorg/fr/", ""),
            (4, "x://b.com/fr/1", ""), (5, "x://b.com/de/1", ""), (6, "x://b.com", ""), (7, None, None), (8, "no scheme", ""),
            (9, "http://org", ""), (10, "http://org/", ""), (11, "http://a.org?/de/", ""), (12, "a://b://c.org/", ""),
            (None, "http://notexample.org/es/", ""), (1, "http://a.example.org/es/1", ""), (13, "://É.ORG/\nq", "")]
    found = {row[0]: row[1:5] for row in both(spark, rows)}
    assert found[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert found[3] == ("xorg", "/fr/", None, "allow")
    assert found[4][2:] == ("com/fr/", "allow") and found[5][2:] == ("com/de/", "block")
    assert found[6] == ("b.com", "", None, "allow") and found[7] == ("", "", None, "allow")
    assert found[9] == ("org", "", None, "allow") and found[10][2:] == ("org/", "allow")
    assert found[11][:3] == ("a.org", "", None) and found[12][:2] == ("b:", "//c.org/")
    assert found[None][2:] == ("org/", "allow") and found[13][:2] == ("É.org", "/\nq")
    assert len(both(spark, rows[:1])) == 1


def test_links_decide_hosts_without_rules(spark):
    rows = [(1, "http://bad.com/de/1", ""), (2, "http://good.org/x", link("near.net", "far.net")),
            (3, "http://farm.net/en/1", link("bad.com", "bad.com")), (4, "http://farm2.net/", link("farm.net")),
            (5, "http://near.net/", link("bad.com")), (6, "http://alone.net/", link("ALONE.net")), (7, "http://far.net/", "<a HREF = '//BAD.com'>")]
    verdicts = {row[1]: row[4] for row in both(spark, rows)}
    assert verdicts["farm.net"] == verdicts["farm2.net"] == "block"      # they link to a blocked host
    assert verdicts["alone.net"] == "allow" and verdicts["good.org"] == "allow"
    assert verdicts["near.net"] == "allow"                               # more trust than distrust
    scores = {row[1]: row[5:] for row in both(spark, rows)}
    assert scores["near.net"][0] == urlfilter.UNIT * 85 // 200


@pytest.mark.parametrize("seed", range(1))
def test_random_graphs(spark, seed):
    draw = random.Random(seed)
    hosts = [f"h{k}.{draw.choice(['org', 'com', 'net'])}" for k in range(25)]
    rows = [(k, f"http://{host}/{draw.choice(['fr', 'de', 'en'])}/{k}", link(*draw.choices(hosts, k=draw.randrange(4))))
            for k, host in enumerate(draw.choices(hosts, k=90))]
    rows += [(100 + k, f"http://hub.net/{k}", link(*hosts)) for k in range(40)]  # one host with a third of pages and edges
    both(spark, rows)


def test_empty(spark):
    assert urlfilter.judge(spark.createDataFrame([], SCHEMA), RULES).collect() == []
