"""Time plain single-process Python restatements of the text operators, for comparison.

usage: python tools/single_process.py [sf folder]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq

root = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(root), str(root / "tests")]
import brute

from verdex.bindings.queries import TERMS


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"])
    docs = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "text"))))

    def timed(name, fn):
        start = time.perf_counter()
        out = fn()
        print(f"{name:18s} {time.perf_counter() - start:7.2f}s", flush=True)
        return out

    timed("paragraphs", lambda: [brute.paragraphs(t) for _, t in docs])
    timed("term_paragraphs", lambda: brute.term_paragraphs(docs, TERMS))
    words = timed("normalise_tokens", lambda: [brute.tokens(t) for _, t in docs])
    timed("stem every token", lambda: [[brute.stem(w) for w in ws] for ws in words])
    grams = timed("ngrams", lambda: [brute.grams(ws) for ws in words])
    timed("gram counts", lambda: (Counter(g for d in grams for g in d), Counter(g for d in grams for g in set(d))))
    timed("duplicates", lambda: [t for t, n in Counter(t for _, t in docs).items() if n > 1])


if __name__ == "__main__":
    main()
