"""URL rules against a plain scan over all rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wattline.llm import queries, url_filter
from wattline.llm.url_filter import Rule, host_rule, judge_urls, literal_tokens, to_regex

SCHEMA = "page_id long, url string"
RULES = [
    *(host_rule(*rule) for rule in queries.URL_RULES), *url_filter.JUNK_RULES, Rule("*", "block", "any", 5), Rule("|a*z|", "block", None, 2),
    Rule("ad", "block", "ad", 1), Rule("^ad^", "allow", "ad-word", 1), Rule("||Ad.Example^*/x", "block", None, 1), Rule("/x(1).*.gif|", "block", "gif", 1),
]
URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/", "http://a.net/x", "http://anet/x", "http://x.example.net/en/1?q#f",
    "http://example.net/en", "https://EXAMPLE.com/de/9", "https://example.com/DE/9", "https://w.example.com/de/", "http://user@net/", "http://user@a.net:80/",
    "http://a.org/fr/://b.net/en/", "http://b.com/a.net/", "ftp://x?y://z.net/", "http://spam-farm.example.org/en/1", "http://a.com/notspam-farm.x/",
    "http://a.com/login", "http://a.com/login.html", "http://a.com/login?x", "http://a.com/?phpsessid=1", "http://a.com/#phpsessid=1", "http://az", "http://a.b/z",
    "http://a.b/ad/", "http://a.b/bad/", "http://ad.example/1/x", "http://b.ad.example/1/x", "http://b.ad.example/1/x(1).b.gif", "http://a.org/fr/\n/x", "http://é.org/fr/é",
    "HTTP://x.net/" + "y" * 100_000, "http://\u212aet.net/", "http://a.com/x.net/", "http://a.com?.net/",
]


def by_hand(url, rules, default="allow"):
    host = path = target = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = re.search(r"[/?#]|\Z", rest).start()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = re.split("[?#]", rest[cut:])[0]
        target = host + rest[cut:].split("#")[0]
    fits = [r for r in rules if re.search(to_regex(r.pattern), target)]
    best = min(fits, key=url_filter._order, default=None)
    return host, path, best and best.name, best.verdict if best else default, best and best.pattern


@pytest.mark.parametrize("most", [0, 1000])
@pytest.mark.parametrize("rules", [RULES, RULES[:20], []])
def test_equals_a_scan_of_all_rules(spark, rules, most):
    rows = [*enumerate(URLS), (3, "no scheme"), (None, "http://a.net/"), (None, None)]
    pages = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("key", "host", "path", "target", "place", "rule", "token")])
    found = judge_urls(pages, rules, most_rules=most)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((key, *by_hand(url, rules))) for key, url in rows)


def test_contract_rules():
    judged = {url: by_hand(url, RULES[:20])[2:4] for url in URLS}
    assert judged["http://net"] == (None, "allow") and judged["http://NET/"] == ("net/", "block") and judged["http://anet/x"] == (None, "allow")
    assert judged["http://x.example.net/en/1?q#f"] == ("example.net/en/", "allow") and judged["http://b.com/a.net/"] == (None, "allow")
    assert judged["http://spam-farm.example.org/en/1"] == (None, "block")


def test_literal_tokens_are_in_every_target_that_fits():
    assert literal_tokens("||example.net/en/") == ["en", "example", "net"] and literal_tokens("ad") == [] and literal_tokens("|ad*") == []
    assert literal_tokens("^ad^") == ["ad"] and literal_tokens("||a*b.C/d|") == ["c", "d"]
    draw = random.Random(5)
    for _ in range(4000):
        pattern = draw.choice(["", "|", "||"]) + "".join(draw.choices("aB1./*^-", k=draw.randint(1, 6))) + draw.choice(["", "|"])
        target = "".join(draw.choices("aB1./-", k=draw.randint(0, 9)))
        if re.search(to_regex(pattern), target):
            assert set(literal_tokens(pattern)) <= {t.lower() for t in re.findall("[A-Za-z0-9]+", target)}, (pattern, target)


def test_rules_are_filed_under_their_rarest_token(spark):
    targets = spark.createDataFrame([("a.b.com/x",), ("c.com/b",), ("com",)], "target string")
    rules = spark.createDataFrame([(0, "||b.com/", ["b", "com"]), (1, "||com/", ["com"]), (2, "x", []), (3, "|zz|com|", ["com", "zz"])], "place int, pattern string, tokens array<string>")
    for few in (False, True):
        assert {r.place: r.token for r in url_filter.file_rules(targets, rules, few).collect()} == {0: "b", 1: "com", 2: "", 3: "zz"}


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA), RULES).collect() == []


def test_no_row_moves_with_a_small_index(spark):
    plan = judge_urls(spark.range(5).select(F.col("id").alias("page_id"), F.lit("http://a.net/").alias("url")), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
