import itertools
import random
from pathlib import Path

from pyspark.sql import functions as F

from tabproof.llm.components import connected_components
from tabproof.llm.url_filter import filter_urls

SCHEMA = "page_id bigint, url string, html string"


def verdicts(spark, rows, **more):
    found = filter_urls(spark.createDataFrame(rows, SCHEMA), **more)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}


def test_rules_and_parts(spark):
    found = verdicts(spark, [
        (1, "http://A.Example.NET/en/x?y#z", ""), (2, "http://example.net", ""), (3, "//x", None),
        (4, None, None), (5, "x://example.com/de/1", ""), (6, "http://example.com/fr/1", ""),
        (7, "http://q.org/fr/1?u=://net/", ""), (8, "http://notexample.net/en/", ""), (9, "http://É.Net/#a", ""),
    ])
    assert found[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[2] == ("example.net", "", None, "allow")
    assert found[3] == found[4] == ("", "", None, "allow")
    assert found[5] == ("example.com", "/de/1", "example.com/de/", "block")
    assert found[6] == ("example.com", "/fr/1", None, "allow")
    assert found[7] == ("q.org", "/fr/1", "org/fr/", "allow")
    assert found[8] == ("notexample.net", "/en/", "net/", "block")
    assert found[9] == ("É.net", "/", "net/", "block")


def test_blocks_reach_aliases_and_an_allow_stays(spark):
    link = '<link rel="canonical" href="{}">'
    found = verdicts(spark, [
        (1, "http://a.com/1", link.format("http://b.com/2")), (2, "http://b.com/2#x", link.format("//bad.net/3")),
        (3, "http://x.org/fr/4", link.format("http://a.com/1")), (4, "http://c.com/", "<p>canonical</p>"),
        (5, "http://d.com/a/b", '<META HTTP-EQUIV=refresh content="0; URL=../up">'),
        (6, "HTTP://A.com/1", None),
    ])
    assert [found[i][3] for i in (1, 2, 3, 4, 5, 6)] == ["block", "block", "allow", "allow", "allow", "block"]


def test_all_tags_count_by_their_attributes(spark):
    """Words in addresses and other attributes make no link; the true tag may come later."""
    icon = '<link rel=icon href="https://canonical.net/x.ico"><link href=/canonical.css rel="stylesheet">'
    found = verdicts(spark, [
        (1, "http://a.com/1", icon + "<link data-rel='x' rel='alternate CANONICAL' href='http://bad.net/1'>"),
        (2, "http://b.com/2", icon + '<meta name="description" content="refresh; url=http://bad.net/2">'),
        (3, "http://c.com/3", '<meta name=refresh content="x"><meta content="5;url=http://bad.net/3" http-equiv="Refresh">'),
        (4, "http://d.com/4", '<link data-rel="canonical" href="http://bad.net/4"><link rel="not-canonical" href="http://bad.net/5">'),
        (5, "http://e.com/5", "<link rel=canonical href=http://f.com/6><link rel=canonical href=http://bad.net/7>"),
        (6, "http://f.com/6", None),
    ])
    assert [found[i][3] for i in range(1, 7)] == ["block", "allow", "block", "allow", "block", "block"]


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "http://a.net/x", None)] * 3 + [(None, None, None), (2, "http://c.com/", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("host", "path", "rule", "verdict", "node", "component", "said"):
        df = df.withColumn(name, F.lit(1))
    found = filter_urls(df)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "a.net", "/x", "net/", "block")] * 3 + [(None, "", "", None, "allow"), (2, "c.com", "/", None, "allow")], key=repr)


def test_given_redirects(spark):
    redirects = spark.createDataFrame([("http://a.com/", "http://z.net/")], "a string, b string")
    assert verdicts(spark, [(1, "http://a.com/", "")], redirects=redirects)[1][3] == "block"


def test_empty(spark):
    assert filter_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(500, None), (None, 3), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(n, find(n)) for n in parent}
    assert len(found) == len(parent) and next(itertools.chain(found)) is not None


def test_small_rounds_take_few_files(spark):
    """A round is known not to outgrow the one before, whatever the number of partitions."""
    few = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in few}
    try:
        for name, value in few.items():
            spark.conf.set(name, value)
        edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
        found = connected_components(edges, "few").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(map(tuple, found)) == [(i, 0) for i in range(41)]
    rounds = sorted(len(list(folder.glob("*.parquet"))) for folder in Path(spark.conf.get("spark.checkpoint.dir")).glob("few-*"))
    assert len(rounds) > 2
    assert all(files <= spark.sparkContext.defaultParallelism for files in rounds[:-1])
