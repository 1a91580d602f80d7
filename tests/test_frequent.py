"""Most frequent terms by merged summaries against plain counts."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from verdex.operators import frequent


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"t{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    return [rng.choices(words, weights, k=rng.randint(0, 60)) for _ in range(400)] + [["same"] * 500, [None, "t1", None], [], None]


def want(rows, most, most_docs=float("inf")):
    total, docs = Counter(), Counter()
    for r in rows:
        total.update(x for x in r or [] if x is not None)
        docs.update({x for x in r or [] if x is not None})
    kept = sorted((t for t in total if docs[t] <= most_docs), key=lambda t: (-total[t], t.encode()))
    return [(t, total[t], docs[t]) for t in kept[:most]]


@pytest.mark.parametrize("partitions, counters, together", [(1, 10, 1 << 20), (20, 2, 50), (3, 1, 7)])
def test_most_frequent(spark, rows, monkeypatch, partitions, counters, together):
    monkeypatch.setattr(frequent, "COUNTERS", counters)
    monkeypatch.setattr(frequent, "TOGETHER", together)
    monkeypatch.setattr(frequent, "FAN", 4)
    df = spark.createDataFrame([(r,) for r in rows], "grams array<string>").repartition(partitions)
    for most, docs in ((1, float("inf")), (25, 60), (25, float("inf")), (10_000, float("inf"))):
        assert [tuple(r) for r in frequent.most_frequent(df, "grams", most, docs)] == want(rows, most, docs)
    assert frequent.most_frequent(df.limit(0), "grams", 5) == []


def test_a_summary_holds_what_is_above_its_error(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "grams array<string>").repartition(6)
    names, error = frequent.summary(df, "grams", 40)
    counts = dict((t, n) for t, n, _ in want(rows, 10_000))
    assert len(names) <= 40 and 0 < error <= sum(counts.values()) / 41
    assert {t for t, n in counts.items() if n > error} <= set(names)


def test_trimming():
    table, fall = frequent.trimmed(pa.table({"term": ["a", "b", "a", "c"], "n": [2, 1, 3, 4]}), 2)
    assert fall == 1 and sorted(zip(*table.to_pydict().values())) == [("a", 4), ("c", 3)]
