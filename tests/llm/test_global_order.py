"""The global order of shingles, ranked a piece at a time."""

import tracemalloc

import numpy as np
import pytest

from verdex.llm import jaccard


@pytest.mark.parametrize("fragments", [1, 3, 7])
def test_order_and_cuts(fragments):
    rng = np.random.default_rng(2)
    for counts in (rng.integers(0, 4, 200_000), rng.pareto(1, 100_000).astype(np.int64), np.full(10, 7), np.zeros(50, int)):
        by_count = np.argsort(counts, kind="stable")
        share = np.cumsum(counts[by_count]) / max(1, counts.sum())
        cuts = np.searchsorted(share, np.arange(1, fragments) / fragments).astype(np.uint64) << np.uint64(64 - jaccard.COUNT_BITS)
        rank, found = jaccard.global_order(counts, fragments)
        assert (rank[by_count] == np.arange(len(counts))).all() and rank.dtype == np.uint32
        assert (found == cuts).all() and found.dtype == np.uint64


def test_order_holds_little_beside_the_counts():
    counts = np.random.default_rng(1).pareto(1, 1 << 20).astype(np.int64)
    tracemalloc.start()
    try:
        jaccard.global_order(counts, 3)
        assert tracemalloc.get_traced_memory()[1] < 2 * counts.nbytes  # whole orders and sums took 3.5 times
    finally:
        tracemalloc.stop()
