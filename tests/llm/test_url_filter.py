"""URL rules against SQL and a plain judge."""

import random

from tests.oracle_check import compare, connect
from trendengine.llm import url_filter as u

SF = "/root/testdata/sf0.01"


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail.split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, x, "h", None) for i, x in enumerate(urls)], "page_id long, url string, Host string, verdict int").withColumn("_host", u.F.lit("x"))
    out = u.judge(spark, pages, spark.createDataFrame(rules, u.RULES_DDL))
    assert out.columns == ["page_id", "url", "Host", "verdict", "_host", "host_", "path", "rule", "verdict_"]
    good = [r for r in rules if r[0] is not None and r[1] is not None]
    got = {r.page_id: (r.host_, r.path, r.rule, r.verdict_) for r in out.collect()}
    assert got == {i: plain(x, good) for i, x in enumerate(urls)}


def test_query_is_the_sql(spark):
    assert compare(u.query(spark, SF), connect(SF), u.SQL) is None


def test_no_python_in_the_plan(spark):
    plan = u.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_against_plain_judge(spark):
    rng = random.Random(4)
    hosts = ["example.org", "A.Example.ORG", "org", "xorg", "badexample.org", "a.b.com", "com", "", ".", "com.", "é.com", "example.org:80", "u@a.com"]
    tails = ["", "/", "/es/", "/ES/", "/en/1", "/en/12/x", "/de/?q=/fr/", "/fr/#x", "?/es/", "#/es/", "/es", "//", "/fr/a/b?c#d", "/" + "x" * 5000]
    urls = [rng.choice(["http://", "https://", "://", "", "http:/"]) + rng.choice(hosts) + rng.choice(tails) for _ in range(400)]
    check(spark, urls + [None, "", "http://a.org/x://b.com/de/", "a\nb://c.org/\n/"] + ["http://example.org/es/"] * 50, u.RULES)


def test_precedence_ties_nulls_and_empty(spark):
    rules = [("a.com", "/x", "allow"), ("com", "/xyz..", "block"), ("com", "/x", "allow"), ("com", "/x", "block"), ("com", "/x", "block"), (None, "/", "block"), ("com", None, "block"), ("b.com", "", "block")]
    check(spark, ["http://a.com/xyz..", "http://c.com/x", "http://b.com", "http://b.com?x", "http://q"], rules)
    check(spark, ["http://a.com/x", None], [])
    check(spark, [], rules)
