from __future__ import annotations

import random

import pytest

from pitchlake.llm.queries import URL_RULES
from pitchlake.llm.url_filters import allowed_pages, expressions, judged_urls, rule_table

SCHEMA = "page_id long, url string, html string, host string, rule string, salt string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def by_hand(pages, rules, otherwise="allow"):
    out = []
    for page_id, url in pages:
        host, path = split(url)
        fit = [(len(h) + len(p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        out.append((page_id, host, path, best and best[3], best[2] if best else otherwise))
    return sorted(out, key=repr)


def parted(rules):
    return [(v, *(r[: (r + "/").index("/")], r[(r + "/").index("/") :])) for v, r in rules]


def table(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "host", "rule", "salt") for i, u in urls], SCHEMA).repartition(3)


AWKWARD = [
    (1, "http://example.com/en/1"),
    (2, "https://WWW.Example.COM/en/x?y=/fr/"),
    (3, "https://a.b.www.example.com/en/"),
    (4, "http://example.com/en"),
    (5, "http://example.com/EN/"),
    (6, "http://xexample.com/en/"),
    (7, "http://a.net/es/"),
    (8, "http://net/fr/#/es/"),
    (9, "http://a.net#/es/"),
    (10, "http://com"),
    (11, "http://com?/"),
    (12, None),
    (13, ""),
    (14, "no scheme.com/"),
    (15, "://"),
    (16, "x://a.net/es/://b.com/"),
    (17, "http://.com/"),
    (18, "http://a..net/fr/"),
    (19, "http://user@example.com:80/en/"),
    (20, "http://exämple.com/en/ü"),
    (21, "http://ÀB.com/é\n/x"),
    (22, "http://" + "a." * 5000 + "net" + "/es" * 5000 + "/"),
    (None, "http://example.com/en/1"),
    (None, None),
    (1, "http://example.com/en/1"),
    (1, "http://example.com/en/1"),
]


def test_awkward_urls_equal_brute_force(spark):
    found = judged_urls(table(spark, AWKWARD), rule_table(spark, URL_RULES))
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(AWKWARD, parted(URL_RULES))


def test_any_rules_equal_brute_force(spark):
    rng = random.Random(4)

    def host():
        return ".".join(rng.choices(["a", "b", "com", "www", ""], weights=[4, 4, 4, 2, 1], k=rng.randint(1, 4)))

    def path():
        return "".join(rng.choices(["/", "en", "e", "n", ".", "/en/"], k=rng.randint(0, 6)))

    rules = sorted({(h, p): rng.choice(["allow", "block"]) for h, p in ((host(), rng.choice(["", "/"]) + path()) for _ in range(150))}.items())
    rules = [(v, h, p) for (h, p), v in rules]
    urls = [(i, f"s://{host()}{rng.choice(['', '/' + path()])}{rng.choice(['', '?q', '#f'])}") for i in range(1500)]
    given = spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")
    found = judged_urls(table(spark, urls), given, otherwise="block")
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(urls, rules, "block")


def test_precedence_nulls_and_other_verdicts(spark):
    rules = [("A.com", "/x", "allow"), ("a.com", "/x", "block"), (None, None, "block"), ("b.com", "/", "maybe"), ("b.com", "/", None)]
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = judged_urls(table(spark, [(1, "s://a.com/xy"), (2, "s://b.com/"), (3, None)]), given)
    assert sorted((r.page_id, r.rule, r.verdict) for r in found.collect()) == [(1, "a.com/x", "block"), (2, None, "allow"), (3, "", "block")]


def test_no_rules_and_no_pages(spark):
    pages, rules = table(spark, AWKWARD[:3]), rule_table(spark, URL_RULES)
    assert [(r.rule, r.verdict) for r in judged_urls(pages, rules.limit(0)).collect()] == [(None, "allow")] * 3
    assert judged_urls(pages.limit(0), rules).collect() == []


def test_only_rows_of_allowed_urls_stay(spark):
    pages, rules = table(spark, AWKWARD), rule_table(spark, URL_RULES)
    blocked = [(i, u) for (i, u) in AWKWARD if by_hand([(i, u)], parted(URL_RULES))[0][4] == "block"]
    kept = allowed_pages(pages, rules)
    assert kept.columns == pages.columns
    assert sorted(((r.page_id, r.url) for r in kept.collect()), key=repr) == sorted((x for x in AWKWARD if x not in blocked), key=repr)
    assert allowed_pages(pages, rules, otherwise="block").where("url is null").count() == 0


def test_a_url_of_many_parts_is_expanded_only_to_shapes_of_rules(spark):
    from pyspark.sql import functions as F

    one = table(spark, [AWKWARD[21]]).select(F.size(expressions(F.lit("a." * 5000 + "net"), F.lit("/es" * 5000 + "/"), [(1, 1), (1, 2), (3, 2), (9000, 1)])).alias("n"))
    assert one.first().n == 3


@pytest.mark.parametrize("sf", ["0.001"])
def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet")
    urls = [(r.page_id, r.url) for r in pages.select("page_id", "url").collect()]
    assert sorted(map(tuple, judged_urls(pages, rule_table(spark, URL_RULES)).collect()), key=repr) == by_hand(urls, parted(URL_RULES))
