"""Counts of all grams against plain counts."""

import random
from collections import Counter

from verdex.operators import features


def test_gram_counts(spark):
    rng = random.Random(3)
    rows = [rng.choices([f"t{i}" for i in range(40)], k=rng.randint(0, 30)) for _ in range(60)]
    rows += [["same"] * 50, [None, "t1", None, "t1"], ["", "", "é"], [], None]
    total, docs = Counter(), Counter()
    for r in rows:
        total.update(x for x in r or [] if x is not None)
        docs.update({x for x in r or [] if x is not None})
    found = features.gram_counts(spark.createDataFrame([(r,) for r in rows], "grams array<string>").repartition(3), "grams")
    assert found.columns == ["term", "n_total", "n_docs"]
    assert sorted(map(tuple, found.collect())) == sorted((t, total[t], docs[t]) for t in total)
