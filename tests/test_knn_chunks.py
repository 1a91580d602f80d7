"""Training sets of many stored values go to the queries in parts, with the same votes."""

import tracemalloc

import numpy as np
from pyspark.ml.linalg import Vectors

from verdex.operators import knn


def sparse(rng, n, dim, k):
    at = [np.sort(rng.choice(dim, rng.integers(0, k), replace=False)) for _ in range(n)]
    return [(i, rng.uniform(0.1, 1, len(i))) for i in at]


def test_votes_do_not_depend_on_the_chunks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(None if i % 9 == 0 else i // 2, float(i % 3 == 0), Vectors.sparse(20, i_, v)) for i, (i_, v) in enumerate(sparse(rng, 120, 20, 8))]
    train = spark.createDataFrame(rows, ["row_id", "label", "features"]).repartition(3)
    asked = spark.createDataFrame(rows[:40], ["row_id", "label", "features"])
    want = sorted(map(str, knn.voter(train, 3)(asked).select("row_id", "prediction", "confidence").collect()))
    monkeypatch.setattr(knn, "MAX_TRAINING_ENTRIES", 60)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 8)
    parts = [part for part, _ in knn.chunks(train)]
    assert len(parts) > 3 and sum(len(p.keys) for p in parts) == 120 and all(len(p.values) <= 60 for p in parts)
    assert sorted(map(str, knn.voter(train, 3)(asked).select("row_id", "prediction", "confidence").collect())) == want


def test_one_tile_is_dense_at_a_time():
    vectors = sparse(np.random.default_rng(5), 8 * knn.BLOCK_ROWS, 500, 6)
    tracemalloc.start()
    try:
        knn.TrainingSet(list(range(len(vectors))), [0.0] * len(vectors), 500, vectors)
        assert tracemalloc.get_traced_memory()[1] < 4 * 8 * 500 * knn.BLOCK_ROWS  # all tiles take 8 of these
    finally:
        tracemalloc.stop()
