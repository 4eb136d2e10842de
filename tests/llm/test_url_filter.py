import re

import pytest

from tillmark.llm import url_filter as u

PAGES = "page_id long, url string"


def brute(url, rules, default="allow"):
    """Every rule on every URL."""
    url = url or ""
    host, path = "", ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [rule for rule in rules if re.search(rule.pattern, host + path)]
    sites = [rule for rule in fits if rule.label]
    if sites:
        best = max(sites, key=lambda rule: (len(rule.label), rule.verdict == "block", rule.label))
        return host, path, best.label, best.verdict
    blocked = any(rule.verdict == "block" for rule in fits)
    return host, path, None, "block" if blocked else default


URLS = [
    "https://www.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/",
    "ftp://a.com/fr/x", "http://com/de/", "http://acom/de/", "http://x.com/DE/", "http://x.com/fr", "example.org/es/",
    "http://example.org", "http://example.org?x=/es/", "://", "", None, "http://a.net/Casino/1", "http://a.net/casinos",
    "http://a.net/x#casino", "http://a://b.org/es/", "HTTP://EXAMPLE.org:80/es/", "http://a.net/login/de/", "http://ü.org/a",
    "http://poker.example.com/de/1", "http://poker.org/1", "x\ny://b.com/de/\n1",
]


def test_equal_to_trying_every_rule(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[0]), (0, URLS[0]), (0, URLS[0])]
    pages = spark.createDataFrame(rows, PAGES)
    found = u.filter_urls(pages, u.rules_frame(spark, u.DEFAULT_RULES)).collect()
    expected = [(n, *brute(url, u.DEFAULT_RULES)) for n, url in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_a_rule_is_filed_under_its_rarest_token(spark):
    rule = u.site_rule("block", "common.org", "/rare/x")
    assert rule.tokens == ("common", "org", "rare")
    tokens = spark.createDataFrame([("common",)] * 5 + [("org",)] * 9 + [("rare",)] * 2, "token string")
    row = u.index_rules(u.rules_frame(spark, [rule]), tokens).first()
    assert row["indexed"] == "rare"


def test_the_last_token_of_a_path_is_no_literal():
    assert u.site_rule("block", "example.org", "/en/1").tokens == ("example", "org", "en")


@pytest.mark.parametrize("rules", [(), u.PATTERN_RULES])
def test_no_rules_and_no_pages(spark, rules):
    frame = u.rules_frame(spark, rules)
    assert u.filter_urls(spark.createDataFrame([], PAGES), frame).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/b", "clash", "clash")], PAGES + ", host string, rule string")
    assert tuple(u.filter_urls(pages, frame, "block").first()) == (1, "a.org", "/b", None, "block")


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/b")], PAGES)
    plan = u.filter_urls(pages, u.rules_frame(spark, u.DEFAULT_RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
