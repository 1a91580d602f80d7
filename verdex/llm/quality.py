"""Quality rules: base measures of a text and cross-document line frequency.

Normalised lines are hashed; for each host the documents that have a line are counted. Lines in more
documents than the limit are boilerplate and removed; a document that loses most of its words with
them is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.llm.common import stored
from verdex.llm.shingles import WordHashes, windows, words

#: A line is boilerplate if more documents of its host have it than this share of them, and this many.
LINE_SHARE, LINE_DOCS = 0.01, 10
#: A document is depleted if it keeps less than this share of its words.
KEPT_SHARE = 0.3
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
#: Up to so many boilerplate lines are broadcast; more are joined by shuffle.
BROADCAST_LINES = 500_000


def line_hashes(text: str) -> list[int | None]:
    """Hash of each line, A-Z lower-cased with runs of white space as one blank; None without a word."""
    return [xxhash.xxh3_64_intdigest(b" ".join(w)) - 2**63 if (w := words(x, True)) else None for x in text.split("\n")]


def repeated_words(hashes: np.ndarray, k: int) -> int:
    """Words in `k`-word windows that the text has twice or more, all places counted."""
    h = windows(hashes, k)
    if len(h) < 2:
        return 0
    _, which, times = np.unique(h, return_inverse=True, return_counts=True)
    steps = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(times[which] > 1)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + k, -1)
    return int(np.count_nonzero(np.cumsum(steps)[:-1]))


def base_measures(text: str, known: WordHashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text, False)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (
        len(w), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(known.of(w), WINDOW),
    )


def boilerplate(docs: DataFrame, line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS) -> DataFrame:
    """Lines above the limit, one row per host: host, lines (array of hashes), n_lines.

    A host's list is bounded: its documents have few lines each, and one in `line_share` of them
    must have a line.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(h, x) for h, t in zip(batch.host, batch.text) for x in {*line_hashes(t)} if x is not None]
            yield (
                pd.DataFrame(found, columns=["host", "line"]).astype({"line": "int64"})
                .groupby(["host", "line"], as_index=False).agg(n=("line", "size"))
            )

    per_line = docs.select("host", "text").mapInPandas(count, "host string, line long, n long")
    per_host = docs.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    # at least `line_docs` first: the join then has few rows
    often = per_line.groupBy("host", "line").agg(F.sum("n").alias("n")).where(F.col("n") > line_docs)
    return (
        often.join(per_host, "host").where(F.col("n") > F.col("docs") * line_share)
        .groupBy("host").agg(F.collect_list("line").alias("lines"), F.count(F.lit(1)).alias("n_lines"))
    )


_OUT = (
    "doc_id long, host string, text string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines_removed long, n_words_left long, base_failed boolean, kept boolean"
)


def apply_rules(
    docs: DataFrame, host: str = "source", line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS,
    kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text and the `host` column): measures, text without
    boilerplate lines, and the verdict.

    base_failed: fewer than 20 words, or more than 30 % of them in repeated windows. kept: neither
    that nor depleted. Line limits: more than `line_docs` documents and more than `line_share` of the
    host's. A line counts once per row, so repeated rows count as documents. Null text is empty
    (and fails), a null host is the host '', an empty table gives an empty result; lines without a
    word are never counted nor removed; other columns are ignored.
    """
    own = docs.select("doc_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    hosts = stored(boilerplate(own, line_share, line_docs), "boilerplate")
    lines = hosts.agg(F.sum("n_lines")).first()[0]
    if (lines or 0) <= BROADCAST_LINES:
        hosts = F.broadcast(hosts)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        columns = [c.split()[0] for c in _OUT.split(", ")]
        for batch in batches:
            bad: dict[str, frozenset[int]] = {}
            rows = []
            for doc, at, text, lines in zip(batch.doc_id, batch.host, batch.text, batch.lines):
                if at not in bad:
                    bad[at] = frozenset(() if lines is None else lines.tolist())
                base = base_measures(text, known)
                left, gone = text, 0
                if bad[at]:
                    keep = [x for x, h in zip(text.split("\n"), line_hashes(text)) if h not in bad[at]]
                    gone = text.count("\n") + 1 - len(keep)
                    left = "\n".join(keep) if gone else text
                n_left = len(words(left, False)) if gone else base[0]
                failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEATED_PERCENT * base[0]
                rows.append((doc, at, left, *base, gone, n_left, failed, not failed and n_left >= kept_share * base[0]))
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return own.join(hosts.select("host", "lines"), "host", "left").mapInPandas(judge, _OUT)
