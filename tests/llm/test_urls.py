"""URL filter: parsing, rules, models against dictionaries of counts."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from grovemart.llm import urls

CASES = {
    "http://A.Example.ORG/en/1x?q#f": ("a.example.org", "/en/1x", "example.org/en/1", "block"),
    "https://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
    "x://b.org/a": ("b.org", "/a", "org/", "allow"),
    "http://org/": ("org", "/", "org/", "allow"),
    "http://corg/": ("corg", "/", None, None),
    "http://example.org": ("example.org", "", None, None),
    "http://www.k.com/fr/9#x": ("www.k.com", "/fr/9", "com/fr/", "allow"),
    "http://com/de/": ("com", "/de/", "com/de/", "block"),
    "http://k.com?x=/de/": ("k.com", "", None, None),
    "a://b://c/d": ("b:", "//c/d", None, None),
    "no scheme/org/": ("", "", None, None),
    "://org/x": ("org", "/x", "org/", "allow"),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "http://ÄB.org/\u00dc": ("Äb.org", "/\u00dc", "org/", "allow"),
    "http://n.org/a\nb": ("n.org", "/a\nb", "org/", "allow"),
}


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "x") for i, u in rows], "page_id long, url string, verdict string, score string")


def test_parts_and_rules(spark):
    found = {r["page_id"]: r for r in urls.judge(pages(spark, enumerate(CASES))).collect()}
    assert len(found) == len(CASES)
    for i, (host, path, rule, verdict) in enumerate(CASES.values()):
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_empty_and_without_evidence(spark):
    assert urls.judge(pages(spark, [])).count() == 0
    rows = urls.judge(pages(spark, [(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None), (None, "")])).collect()
    assert [r["verdict"] for r in rows] == ["allow"] * 4 and len(rows) == 4


def brute_probability(texts, order):
    """Interpolated probabilities from plain counts of (context, character)."""
    counts = defaultdict(Counter)
    for text in texts:
        padded = urls.START * order + text + urls.END
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[padded[i - k : i]][padded[i]] += 1

    def probability(context, character):
        p = 1 / urls.ALPHABET
        for k in range(order + 1):
            seen = counts.get(context[order - k :])
            if seen:
                p = (seen[character] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    return probability


def test_scores_against_counts(spark):
    texts = [r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    judged = urls.judge(pages(spark, list(enumerate(texts)))).collect()
    ruled = {"allow": [], "block": []}
    for r in judged:
        if r["rule"]:
            ruled[r["verdict"]].append(texts[r["page_id"]])
    allow, block = (brute_probability(ruled[v], urls.ORDER) for v in ("allow", "block"))
    free = [r for r in judged if not r["rule"]]
    assert free
    for r in free:
        padded = urls.START * urls.ORDER + texts[r["page_id"]] + urls.END
        ratios = [
            math.log(allow(padded[i - urls.ORDER : i], padded[i])) - math.log(block(padded[i - urls.ORDER : i], padded[i]))
            for i in range(urls.ORDER, len(padded))
        ]
        assert r["score"] == pytest.approx(sum(ratios) / len(ratios), abs=1e-9)


def test_learned_verdicts(spark):
    """URLs no rule decides are judged like the ruled ones they look like."""
    good = [f"http://a{i % 7}.org/garden/rose{i}" for i in range(200)]
    bad = [f"http://b{i % 7}.com/de/casino{i}" for i in range(200)]
    free = [f"http://c{i}.net/garden/rose{i}" for i in range(40)] + [f"http://c{i}.net/de/casino{i}" for i in range(40)]
    rows = urls.judge(pages(spark, list(enumerate(good + bad + free)))).where("rule is null").collect()
    right = sum((r["verdict"] == "allow") == (r["page_id"] < 440) for r in rows)
    assert len(rows) == 80 and right >= 76


def test_threshold_between_the_classes(spark):
    scores = spark.range(100).select(
        F.when(F.col("id") < 50, "allow").otherwise("block").alias("ruled"),
        F.when(F.col("id") < 50, 1.0 + F.col("id") / 100).otherwise(-1.0 - F.col("id") / 100).alias("score"),
    )
    assert -1 < urls.threshold(scores) <= 1
    assert urls.threshold(scores.where("ruled = 'allow'")) == 0


def test_pages_of_a_rule_share_no_key(spark):
    """Only pages without a rule are joined with scores, however many others there are."""
    pages = spark.createDataFrame(
        [(k, "https://www.x.org/a") for k in range(400)] + [(1000, "https://a.net/b"), (1001, "https://b.com/de/x"), (1002, None)] * 2,
        "page_id long, url string",
    )
    judged = urls.judge(pages)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")
    rows = judged.collect()
    assert len(rows) == 406 and sum(r["rule"] == "org/" for r in rows) == 400
    assert {r["verdict"] for r in rows if r["page_id"] == 1001} == {"block"}
