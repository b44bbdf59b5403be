"""URL rules against a plain loop over all of them."""

import random
import re

import pytest

from tripstrata.llm import urlrules

RULES = "host string, path string, verdict string"


def judged(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for at_host, at_path, verdict in rules:
        if None in (at_host, at_path, verdict) or at_path[:1] not in ("", "/"):
            continue
        if (host == at_host or host.endswith("." + at_host)) and path.startswith(at_path):
            rule = at_host + at_path
            rank = (len(rule), at_host.count("."), rule, verdict)
            best = rank if best is None else max(best, rank)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def check(spark, urls, rules, parts=4):
    pages = spark.createDataFrame(list(enumerate(urls)), "id long, url string").repartition(parts)
    got = urlrules.filter_urls(pages, spark.createDataFrame(rules, RULES))
    got = got.select("rest.id", "rest.url", "host", "path", "rule", "verdict").collect()
    assert sorted(r.id for r in got) == list(range(len(urls)))
    for r in got:
        assert tuple(r)[2:] == judged(r.url, rules), r


@pytest.mark.parametrize("block", [1, 7, 256])
def test_nested_rules(spark, monkeypatch, block):
    monkeypatch.setattr(urlrules, "RULE_BLOCK", block)
    pick = random.Random(block)

    def host(n, letters="abc"):
        return ".".join(pick.choice(letters) for _ in range(n))

    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/b/", "/ab", "odd", None]
    rules = [(host(pick.randint(1, 4)), pick.choice(paths), pick.choice(["allow", "block"])) for _ in range(120)]
    # Rules that are given twice need one verdict for the loop.
    rules = [(h, p, max(v for *k, v in rules if k == [h, p])) for h, p, _ in rules]
    rules += [(None, "/", "block"), ("a", "/", None)]
    starts = ["http://", "x://", "", ":/"]
    ends = ["", "/", "/a", "/a/b/c", "/ab?x=://", "/b/#z", "?q", "#/a/", "/é/\n", ":80/a"]
    urls = [pick.choice(starts) + host(pick.randint(1, 5), "abcA") + pick.choice(ends) for _ in range(600)]
    check(spark, urls + [None, "", "://", "http://", "http://..a/", "http://a./"], rules)


def test_one_url_in_most_rows_and_very_long_ones(spark):
    rules = [("b.a", "/x/", "block"), ("a", "/x/y", "allow"), ("", "", "block"), ("a", "", "block")]
    urls = ["http://c.b.a/x/y"] * 300 + ["http://" + "a." * 3000 + "a/x/y" + "z" * 50_000, "http://" + "h" * 50_000 + ".a"]
    check(spark, urls, rules, parts=3)


def test_no_rules_no_rows_and_clashing_names(spark):
    pages = spark.createDataFrame(
        [("http://A.b/c", 1, "keep", 2)], "url string, key int, verdict string, row_id int"
    )
    none = spark.createDataFrame([], RULES)
    row = urlrules.filter_urls(pages, none, default="block").first()
    assert (row.host, row.path, row.rule, row.verdict) == ("a.b", "/c", None, "block")
    assert tuple(row.rest) == ("http://A.b/c", 1, "keep", 2)
    some = spark.createDataFrame([("b", "/", "allow")], RULES)
    assert urlrules.filter_urls(pages.limit(0), some).count() == 0


def test_plan_runs_no_python_and_no_cross_join(spark):
    pages = spark.createDataFrame([("http://a.b/c",)], "url string")
    rules = spark.createDataFrame([("b", "/", "block")], RULES)
    done = urlrules.filter_urls(pages, rules)
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
