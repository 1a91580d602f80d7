"""Many passes read words and make their grams again; summaries and projections take bounded batches."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from verdex.operators import classify, features, frequent

TEXTS = ["uma casa, duas casas", "", None, "a", "Ação-x é nula 12 e\u00a0casa", "casa " * 700, " \n"]


@pytest.mark.parametrize("stem", [True, False])
def test_words_are_written_and_grams_are_the_same(spark, stem):
    df = spark.createDataFrame([(i % 5, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = features.written_grams(df, "text", stem=stem)
    assert got.columns == ["id", "grams"]
    want = features.with_grams(df, "text", stem=stem).select("id", "grams")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    [path] = {f.rsplit("/", 1)[0] for f in got.inputFiles()}
    assert dict(spark.read.parquet(path).dtypes) == {"id": "int", "_words": "string"}


def test_summaries_take_lists_of_a_bounded_length(spark):
    rows = [([f"t{i % 50}" for i in range(n)],) for n in (30_000, frequent.IN_ROW, 0, 1)] + [(None,), ([None, "t0"],)]
    df = spark.createDataFrame(rows, "grams array<string>")
    lists = [r.terms for r in frequent._lists(df, "grams").collect() if r.terms]
    assert max(map(len, lists)) == frequent.IN_ROW and len(lists) == -(-30_000 // frequent.IN_ROW) + 3
    assert sorted(str(t) for x in lists for t in x) == sorted(str(t) for r in rows for t in r[0] or [])
    assert frequent.summary(df, "grams", 60) == (sorted({f"t{i}" for i in range(50)}), 0)


def test_few_rows_are_dense_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, Vectors.sparse(6, {int(j): float(rng.uniform(0.1, 1)) for j in rng.choice(6, i % 4, replace=False)})) for i in range(50)]
    df = spark.createDataFrame(rows, ["row_id", "features"]).repartition(2)
    project = lambda: {r.row_id: r.features.toArray() for r in classify._fourier_stage(df, 8)(df).collect()}
    want = project()
    monkeypatch.setattr(classify, "FOURIER_ROWS", 3)
    got = project()
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    assert np.allclose(got[0], want[4])  # rows without a value
