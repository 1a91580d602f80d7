"""Substring search for large term lists by an index of q-grams.

Every term is filed under its rarest q-gram, and there by the q-gram's offset in it and its length. A
text looks up its own q-grams; where one has terms, the text around it is looked up among those of one
offset and length, so the cost follows the text and its matches, not the number of terms, nor how many
share a q-gram. Texts stay in their rows; no shuffle.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.operators.terms import keep_rows

#: Length of a q-gram; shorter terms are filed under themselves.
Q = 4
#: Texts that tell which q-grams are rare (those with the smallest hashes). It only steers the speed.
SAMPLE = 500
#: Terms in one index, which every worker holds; longer lists go through several indexes in a row.
TERMS_AT_ONCE = 500_000

#: Characters of a text that are looked up together.
TOGETHER = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _cells(codes: np.ndarray, q: int, bits: int) -> np.ndarray:
    """A cell for the q-gram at each place; equal q-grams have equal cells."""
    n = max(0, len(codes) - q + 1)
    mixed = np.zeros(n, dtype=np.uint64)
    for j in range(q):
        mixed = (mixed + codes[j : j + n]) * _ODD
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def grams(text: str, q: int) -> set[str]:
    return {text[i : i + q] for i in range(len(text) - q + 1)}


class TermIndex:
    """Lower-cased terms by their rarest q-gram, with their places in the list."""

    def __init__(self, terms: Sequence[str], seen: Counter) -> None:
        self.under: dict[int, dict[str, list[tuple[str, int]]]] = {}
        self.everywhere = [place for place, term in enumerate(terms) if not term]  # every text holds the empty string
        for place, term in enumerate(terms):
            if term:
                q = min(Q, len(term))
                rarest = min(grams(term, q), key=lambda g: (seen[g], g))
                self.under.setdefault(q, {}).setdefault(rarest, []).append((term, place))
        # cells that any filed q-gram has, by which most places of a text are passed over
        self.cells = {q: np.zeros(1 << max(16, (16 * len(filed)).bit_length()), dtype=bool) for q, filed in self.under.items()}
        for q, filed in self.under.items():
            bits = len(self.cells[q]).bit_length() - 1
            self.cells[q][_cells(_codes("".join(filed)), q, bits)[::q]] = True
        self.shapes = {q: {g: self._shapes(g, listed) for g, listed in filed.items()} for q, filed in self.under.items()}

    @staticmethod
    def _shapes(gram: str, listed: list[tuple[str, int]]) -> list[tuple[int, int, dict[str, list[int]]]]:
        """(offset of the q-gram, length, the places of each term) of the terms under one q-gram."""
        shapes: dict[tuple[int, int], dict[str, list[int]]] = {}
        for term, place in listed:
            shapes.setdefault((term.index(gram), len(term)), {}).setdefault(term, []).append(place)
        return [(offset, length, named) for (offset, length), named in shapes.items()]

    def _filed_places(self, text: str, q: int) -> Iterator[int]:
        """Where a text may have a q-gram with terms: no such place is left out."""
        filed, bits = self.cells[q], len(self.cells[q]).bit_length() - 1
        for begin in range(0, len(text) - q + 1, TOGETHER):
            found = filed[_cells(_codes(text[begin : begin + TOGETHER + q - 1]), q, bits)]
            yield from (np.flatnonzero(found) + begin).tolist()

    def places(self, text: str) -> list[int]:
        """Places of the terms that a lower-cased text contains, in list order."""
        found = {}
        for q, filed in self.shapes.items():
            for i in self._filed_places(text, q):
                for offset, length, named in filed.get(text[i : i + q], ()):
                    if i >= offset and (term := text[i - offset : i - offset + length]) in named:
                        found[term] = named[term]
        return sorted([*self.everywhere, *(place for own in found.values() for place in own)])


def match_many(df: DataFrame, text: str, terms: Sequence[str], out: str = "terms") -> DataFrame:
    """Adds `out`, the terms that the text contains in any case, in list order; rows without any are dropped.

    The same result as `terms.match_terms`, for lists of thousands and more. Repeated terms are listed
    each; null texts have no term; `terms` is the user's list and fits the driver.
    """
    lower = F.lower(text)
    spark, at_once = df.sparkSession, max(1, TERMS_AT_ONCE)
    some = df.select(lower.alias("t")).orderBy(F.xxhash64("t")).limit(SAMPLE).toPandas()["t"]
    seen = Counter(g for t in some if t is not None for g in grams(t, Q))
    # lower-cased by Spark, as the texts are
    listed = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "place int, term string").select("place", F.lower("term").alias("term"))
    lowered = [r.term for r in listed.orderBy("place").collect()]
    found = F.array().cast("array<string>")
    for begin in range(0, len(lowered), at_once):
        shared = spark.sparkContext.broadcast((TermIndex(lowered[begin : begin + at_once], seen), list(terms[begin : begin + at_once])))
        found = F.concat(found, _finder(shared)(lower))
    return keep_rows(df.withColumn(out, found), F.size(out) > 0)


def _finder(shared) -> Callable:
    @F.pandas_udf("array<string>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, names = shared.value
        for batch in batches:
            yield pd.Series([[] if t is None else [names[p] for p in index.places(t)] for t in batch])

    return find
