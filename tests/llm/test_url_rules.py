import re

import pytest
from pyspark.sql import functions as F

from tidecast.llm import url_rules
from tidecast.llm.queries import RULES
from tidecast.llm.url_rules import judged_urls, link_targets, url_host, url_node, url_path


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], "page_id long, url string, html string, host string, node string, rule string")


def verdicts(spark, rows, rules=RULES):
    return {r["page_id"]: (r["rule"], r["verdict"], r["by"]) for r in judged_urls(pages(spark, rows), rules).collect()}


def test_host_path_and_node(spark):
    urls = ["HTTP://WWW.Exämple.com:80/A/b?x=1#f", "http://h", "http://h?/p", "nothing/here", "x://a://b/c", None, "", "http://h/p/?utm_source=a&k=1&ref=z"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(url_host(F.col("u")), url_path(F.col("u")), url_node(F.col("u"))).collect()]
    assert got == [
        ("www.exämple.com:80", "/A/b", "www.exämple.com:80/A/b?x=1"),
        ("h", "", "h"),
        ("h", "", "h?/p"),
        ("", "", None),
        ("a:", "//b/c", "a://b/c"),
        ("", "", None),
        ("", "", None),
        ("h", "/p/", "h/p?k=1"),
    ]


def test_longest_rule_wins(spark):
    rows = [
        (1, "http://www.example.com/en/1", None),
        (2, "http://m.example.com/en/1", None),
        (3, "http://m.example.com/fr/1", None),
        (4, "http://notexample.com/en/", None),
        (5, "http://a.net/es/x", None),
        (6, "http://a.net/en/x", None),
        (7, "http://example.com", None),
    ]
    got = verdicts(spark, rows)
    assert got == {
        1: ("www.example.com/en/", "allow", "rule"),
        2: ("example.com/en/", "block", "rule"),
        3: ("com/", "allow", "rule"),
        4: ("com/", "allow", "rule"),
        5: ("net/es/", "block", "rule"),
        6: (None, "allow", "default"),
        7: (None, "allow", "default"),
    }


def link(url):
    return f'<head><LINK href="{url}" rel="canonical"></head>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; URL={url}'>"


def test_decisions_reach_aliases_and_allow_has_precedence(spark):
    rows = [
        (1, "http://a.org/1", link("http://b.org/2")),
        (2, "https://b.org/2/#top", refresh("//bad.net/es/3")),
        (3, "http://c.org/x/y", link("/z")),
        (4, "http://c.org/z", link("http://bad.net/fr/1")),
        (5, "http://d.org/", link("http://bad.net/fr/1") + link("http://fine.com/")),
        (6, "http://e.org/e", link("http://bad.net/fr/2")),
        (7, "http://f.org/q", link("http://nobody.org/")),
        (8, None, link("http://bad.net/fr/2")),
        (9, "no url", refresh("http://bad.net/fr/2")),
        (10, "http://e.org/e?utm_medium=x", None),
        (10, "http://e.org/e?utm_medium=x", None),
        (None, "http://e.org/f/g", link("../e")),
        (12, "http://bad.net/es/3", "<p>" + "x" * 300_000),
    ]
    got = {k: v[1:] for k, v in verdicts(spark, rows).items()}
    assert got == {
        1: ("block", "alias"),
        2: ("block", "alias"),
        3: ("allow", "alias"),
        4: ("allow", "alias"),
        5: ("allow", "alias"),
        6: ("block", "alias"),
        7: ("allow", "default"),
        8: ("allow", "default"),
        9: ("allow", "default"),
        10: ("block", "alias"),
        None: ("block", "alias"),
        12: ("block", "rule"),
    }
    assert judged_urls(pages(spark, rows), RULES).count() == len(rows)
    assert judged_urls(pages(spark, rows).limit(0), RULES).collect() == []


def test_dot_segments_and_character_references(spark):
    paths = {
        "/a/b/../c": "/a/c", "/a/./b": "/a/b", "/../../a": "/a", "/a/..": "/", "/a/b/.": "/a/b/", "/a//../b": "/a/b",
        "/.../a": "/.../a", "/a/..b/.c": "/a/..b/.c", "": "", "/": "/", "/..": "/",
    }
    df = spark.createDataFrame([(p,) for p in [*paths, None]], "p string")
    assert [r[0] for r in df.select(url_rules.without_dots(F.col("p"))).collect()] == [*paths.values(), None]
    targets = {
        "../e": "http://h/e", "../../../e?x=../y#/../z": "http://h/e?x=../y#/../z", "./": "http://h/f/", "https://o/a/../b": "https://o/b", "//o/./b": "http://o/b",
    }
    df = spark.createDataFrame([(t,) for t in targets], "t string")
    assert [r[0] for r in df.select(url_rules.resolved(F.col("t"), F.lit("http://h/f/g"))).collect()] == list(targets.values())
    pairs = {"/p?a=1&amp;b=2": "/p?a=1&b=2", "/p?a=1&#38;b=2": "/p?a=1&b=2", "/p?&amp;lt;": "/p?&lt;"}
    df = spark.createDataFrame([(link(k),) for k in pairs], "h string")
    assert [r[0][0] for r in df.select(link_targets(F.col("h"))).collect()] == list(pairs.values())
    rows = [(1, "http://a.org/p?x=1&y=2", None), (2, "http://b.org/q/r/s", refresh("http://a.org/./z/../p?x=1&amp;y=2")), (3, "http://b.org/q/r/../r/s", link("http://bad.net/es/1"))]
    assert {k: v[1:] for k, v in verdicts(spark, rows).items()} == dict.fromkeys((1, 2, 3), ("block", "alias"))


def test_many_rules_by_join(spark, monkeypatch):
    rows = [(i, u, None) for i, u in enumerate(["http://www.example.com/en/1", "http://m.example.com/en/", "http://a.b.net/fr/", "http://x/", None, "http://example.com/", "http://example.com/"])]
    inline = verdicts(spark, rows)
    monkeypatch.setattr(url_rules, "INLINE_RULES", 2)
    assert verdicts(spark, rows) == inline


def test_ties_of_rules_go_to_allow_and_no_rules(spark):
    rows = [(1, "http://a.org/x", None)]
    assert verdicts(spark, rows, [("block", "org", "/x"), ("allow", "org", "/x")])[1] == ("org/x", "allow", "rule")
    assert verdicts(spark, rows, [])[1] == (None, "allow", "default")


def test_targets_only_from_links_and_refreshes(spark):
    html = '<a href="http://no/"><link rel=stylesheet href=/s.css><link rel=canonical href=/c><meta name=refresh content="url=/n"><meta http-equiv=Refresh content="5;url=/r">'
    df = spark.createDataFrame([(html,), (None,), ("",)], "h string")
    assert [r[0] for r in df.select(link_targets(F.col("h"))).collect()] == [["/c", "/r"], [], []]


@pytest.mark.parametrize("rules", [RULES])
def test_no_python_on_the_executors(spark, sf_dir, rules):
    df = judged_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
