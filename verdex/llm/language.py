"""Language identification by bit-sliced Bloom filters of character n-grams.

Every language has a Bloom filter of its most frequent n-grams. The filters are stored bit-sliced:
cell i holds one bit per language, so one look-up (an AND over the probed cells) returns all
languages that contain an n-gram. The number of hits of each language, corrected for the filter's
false positives, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdex.llm.common import stored

SIZES = (3, 4)
#: n-grams are told apart by so many bits of their hash.
GRAM_BITS = 21
#: Most frequent n-grams of a language that its filter holds.
PROFILE = 4000
CELL_BITS, PROBES = 18, 3
#: Characters handled at once; longer texts go piece by piece.
PIECE = 1 << 20
#: Languages whose counts a task holds at once.
HELD = 16
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTER[0]


def grams(text: str) -> Iterator[np.ndarray]:
    """Numbers below 2**GRAM_BITS for the n-grams of a text's lower-cased letters, piece by piece.

    A run of other characters is one boundary. A text without letters gives nothing.
    """
    for begin in range(0, len(text), PIECE):
        part = text[begin : begin + PIECE].lower()
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = _letters()[c]
        if not is_letter.any():
            continue
        c = np.where(is_letter, c, 32)
        c = c[is_letter | np.concatenate(([True], is_letter[:-1]))].astype(np.uint64)
        c = np.concatenate(([32], c, [32])).astype(np.uint64)
        h = c * np.uint64(0x9E3779B97F4A7C15)
        for size in range(2, max(SIZES) + 1):
            if len(c) < size:
                break
            h = (h[: len(c) - size + 1] ^ c[size - 1 :]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            if size in SIZES:
                yield ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """`cells` (cell, word of 64 languages), the languages in bit order, each one's false positive
    rate, the share of its learned n-grams, by count, that its filter holds (1 if not told), and the
    language with the most learned n-grams (ties by name)."""

    languages: tuple[str, ...]
    cells: np.ndarray
    false_rate: np.ndarray
    coverage: tuple[float, ...] = ()
    largest: str = UNKNOWN

    @staticmethod
    def probes(grams_: np.ndarray) -> Iterator[np.ndarray]:
        x = grams_.astype(np.uint64) + np.uint64(1)
        for _ in range(PROBES):
            x = (x ^ (x >> np.uint64(15))) * np.uint64(0xBF58476D1CE4E5B9)
            yield (x >> np.uint64(64 - CELL_BITS)).astype(np.int64)

    @classmethod
    def build(
        cls, profiles: dict[str, np.ndarray], coverage: dict[str, float] | None = None, totals: dict[str, int] | None = None
    ) -> Filters:
        names = tuple(sorted(profiles))
        cells = np.zeros((1 << CELL_BITS, max(1, (len(names) + 63) // 64)), dtype=np.uint64)
        rate = np.zeros(len(names))
        for i, name in enumerate(names):
            bit = np.uint64(1) << np.uint64(i % 64)
            for at in cls.probes(profiles[name]):
                cells[at, i // 64] |= bit
            rate[i] = float(np.mean((cells[:, i // 64] & bit) != 0)) ** PROBES
        return cls(names, cells, rate, tuple((coverage or {}).get(x, 1.0) for x in names),
                   min(names, key=lambda x: (-(totals or {}).get(x, 0), x), default=UNKNOWN))

    def shares(self, text: str) -> np.ndarray | None:
        """Corrected share of the text's n-grams that each language contains; None without letters."""
        hits, n = np.zeros(len(self.languages)), 0
        for g in grams(text):
            found = None
            for at in self.probes(g):
                found = self.cells[at] if found is None else found & self.cells[at]
            n += len(g)
            for i in range(len(self.languages)):
                hits[i] += np.count_nonzero(found[:, i // 64] & (np.uint64(1) << np.uint64(i % 64)))
        if not n:
            return None
        return np.clip((hits / n - self.false_rate) / (1 - self.false_rate), 0, 1)


def fit(labelled: DataFrame, profile: int = PROFILE) -> Filters:
    """Learn filters from all of `labelled` (text, lang); rows with a null are ignored.

    Counts cover all rows; only each language's `profile` most frequent n-grams (ties by number)
    and the sums of all counts reach the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def drain() -> Iterator[pd.DataFrame]:
            for lang, c in held.items():
                at = np.flatnonzero(c)
                yield pd.DataFrame({"lang": lang, "gram": at, "n": c[at].astype(np.int64)})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                if lang not in held and len(held) >= HELD:
                    yield from drain()
                c = held.setdefault(lang, np.zeros(1 << GRAM_BITS, dtype=np.int32))
                for g in grams(text):
                    np.add.at(c, g, 1)
        yield from drain()

    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    counts = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    counts = stored(counts, "gram_counts")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile).select("lang", "gram", "n")
    found, total = top.toPandas(), {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    by_lang = {lang: g for lang, g in found.groupby("lang")}
    return Filters.build(
        {lang: g.gram.to_numpy() for lang, g in by_lang.items()}, {lang: float(g.n.sum() / total[lang]) for lang, g in by_lang.items()},
        total,
    )


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """`docs` (doc_id, text and any columns but the new ones) with lang_pred, score and support.

    lang_pred: the language with the largest corrected share of the text's n-grams (ties by name);
    without a hit in any, the one with the most learned n-grams; `und` for null text, text without
    letters, or if no language has been learned. score: that share among the shares of all languages;
    support: the share itself; both 0 for `und` and without a hit. Repeated rows are judged each; an empty table gives an empty result. Columns of `docs`
    named lang_pred, score or support are replaced.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "support")]
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.cells, filters.false_rate, filters.coverage, filters.largest))

    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Filters(*shared.value)
        for batch in texts:
            out = []
            for text in batch:
                s = own.shares(text) if text and own.languages else None
                best = int(np.argmax(s)) if s is not None else 0
                if s is None:
                    out.append((UNKNOWN, 0.0, 0.0))
                else:
                    out.append((own.languages[best], s[best] / s.sum(), s[best]) if s[best] > 0 else (own.largest, 0.0, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "support"])

    judged = F.pandas_udf(judge, "lang_pred string, score double, support double")
    return docs.select(*[docs[c] for c in keep], judged(docs["text"]).alias("_judged")).select(*[f"`{c}`" for c in keep], "_judged.*")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
