"""The mix: targets, words taken, order in time, and what a rerun gives."""

from collections import Counter, defaultdict

import pytest

from grovemart.llm import mixing
from tests.llm import data


def planned(docs, **options):
    return [r.asDict() for r in mixing.mix(docs, **options).select("doc_id", "source", *mixing.PLAN_COLUMNS, "copies").collect()]


def level_fill(sizes, weights, repeats=3):
    """Targets by raising a water level step by step."""
    target, free, left = {}, dict(weights), float(sum(sizes.values()))
    while free:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
            del free[s]
    return target


def by_rank(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    return {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}


def test_targets_and_taken(spark):
    rows = planned(data.documents(spark))
    assert len(rows) == len(data.ODD)
    sizes = Counter()
    for _, text, source in data.ODD:
        sizes[source] += len(data.WORD.findall(text or ""))
    target = level_fill(sizes, by_rank(rows))
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0)
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - target[source]) < 1


def test_sorted_and_rerun(spark):
    docs = data.documents(spark)
    first, again = planned(docs), planned(docs.repartition(7))
    assert sorted(map(repr, first)) == sorted(map(repr, again))
    positions = [r["position"] for r in first if r["position"] is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] < 1
    assert [r["position"] is None for r in first] == sorted(r["position"] is None for r in first)


def test_schedule_in_time(spark):
    """The third kind of source has no weight in the second half; the first has more there."""
    rows = [(i, " ".join(["w"] * 20), "aaaaabbc"[i % 8]) for i in range(1600)]
    halves = defaultdict(lambda: [0, 0])
    for r in planned(data.documents(spark, rows)):
        if r["position"] is not None:
            halves[r["source"]][r["position"] >= 0.5] += 1
    assert halves["c"][1] == 0
    assert halves["a"][1] / halves["a"][0] == pytest.approx(1.5, rel=0.1)
    assert halves["b"][0] / halves["b"][1] == pytest.approx(1, rel=0.1)


def test_rows_of_the_mix(spark):
    docs = data.documents(spark)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in planned(docs):
        want[r["doc_id"]] += r["taken"]
    have = Counter()
    for r in mixed.collect():
        have[r["doc_id"]] += len(data.WORD.findall(r["text"]))
        assert r["_key"] == "_key" and r["taken"] == "taken"
    assert +want == +have


def test_empty_and_wordless(spark):
    assert planned(data.documents(spark).limit(0)) == []
    rows = planned(data.documents(spark, [(1, None, "a"), (2, "", None)]))
    assert [(r["size"], r["taken"], r["target"], r["position"]) for r in rows] == [(0, 0, 0.0, None)] * 2
    assert mixing.mixed(data.documents(spark).limit(0)).count() == 0
