"""Alignment of two tokenizers over a corpus, with counts of linked id pairs.

First pass: every text is tokenised both ways and cut where tokens of both end; each task counts the
id pairs that end together. The distinct pairs get a minimal perfect hash, built bucket by bucket;
count vectors indexed by it are dense and summed along a tree. Second pass: texts are aligned again
and their pairs looked up by hash, where the key in the slot is compared.

The pairs are bounded by the vocabularies, whatever the corpus: tokens that end together are one
the end of the other's bytes, so `possible_pairs` counts all that can occur (324,300 for the public
files).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.llm.common import pieces, stored, tree_sum
from verdex.llm.packing import Encoder
from verdex.llm.shingles import mixed

#: Pairs in one bucket of the hash, on average.
BUCKET = 4096
#: Most pairs that a pair of vocabularies may allow (about 20 bytes each in every worker).
MOST_PAIRS = 20_000_000
#: Characters of the parts of texts that a worker remembers, and parts looked up together.
REMEMBERED, PARTS = 4_000_000, 1 << 15
#: Parts tokenised in one string, and texts of a batch that are taken at a time.
JOINED, TEXTS = 2048, 500

#: A text may be cut before a blank between two signs that neither library takes for white space.
_SPACE = r"\s\x1c-\x1f\u180e\u200b\ufeff"
_CUT = re.compile(f"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")
_BLANKS = frozenset(re.findall(f"[{_SPACE}]", "".join(map(chr, range(0x10000)))))
_UNEVEN = re.compile(f"^ | $|[{_SPACE}] | [{_SPACE}]")


class Vocabularies:
    """Both tokenizers and the bytes of their tokens.

    `path_a`: a byte-level file of `tokenizers`, read without special tokens and with their strings
    as plain text; `ranks_a`, if any, its vocabulary as ranks, which is quicker. `path_b`: a `sentencepiece` model with byte fallback that puts a blank in front.
    """

    def __init__(self, path_a: str, path_b: str, ranks_a: str | None = None) -> None:
        import sentencepiece

        coder = Encoder(path_a, ranks_a)
        coder.tokenizer.encode_special_tokens = True
        self.encode_a = coder.ids
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            names = json.load(f)["model"]["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
        self.bytes_a = [b""] * (1 + max(names.values()))
        for name, i in names.items():
            if all(c in byte for c in name):
                self.bytes_a[i] = bytes(byte[c] for c in name)
        of = self.b.id_to_piece
        self.bytes_b = [
            bytes([int(of(i)[3:5], 16)]) if self.b.is_byte(i) else of(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        inner = any("▁" in of(i).lstrip("▁") for i in range(self.b.get_piece_size()) if not self.b.is_byte(i))
        if inner or not self.length_b.all():
            raise ValueError("the piece model has an empty token or one with a blank behind another sign, so texts cannot be cut at blanks")

    def possible_pairs(self) -> int:
        """Pairs of which one token's bytes end with the other's: no others can end together."""
        a, b = Counter(x for x in self.bytes_a if x), Counter(self.bytes_b)
        ends = lambda x, of, first: sum(of.get(x[k:], 0) for k in range(first, len(x)))
        return sum(n * ends(x, b, 0) for x, n in a.items()) + sum(n * ends(x, a, 1) for x, n in b.items())


def parts_of(text: str) -> list[str]:
    """Parts of blank+text, each without its leading blank, that both tokenizers treat on their own."""
    if not _UNEVEN.search(text):
        return text.split(" ")
    first, *rest = _CUT.split(" " + text)
    return [first[1:], *rest]


class Aligner:
    """Aligned tokens of parts of texts, remembered; their groups as well, unless `shows` is false."""

    def __init__(self, words: Vocabularies, lookup: Lookup | None = None, shows: bool = True) -> None:
        self.words, self.lookup, self.shows = words, lookup, shows
        self.shown_of = [np.array([f"{i}{end}" for i in range(max(len(words.bytes_a), len(words.bytes_b)))], dtype=object) for end in ",|;"]
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []  # distinct pairs and how often they were counted
        self.of: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        if self.of:
            times = np.repeat(self.times, self.numbers[:, 3])
            if times.any():
                self.counted.append(summed(np.concatenate(self.pairs)[times > 0], times[times > 0]))
        self.of, self.chars = {}, 0
        self.shown: list[str] = []  # groups of each part
        self.pairs: list[np.ndarray] = []  # linked pairs, part after part
        self.times = np.zeros(0, dtype=np.int64)  # how often each part was counted
        self.numbers = np.zeros((0, 6), dtype=np.int64)  # wrong, A tokens, B tokens, links, best links, sum of counts

    def entries(self, parts: list[str]) -> np.ndarray:
        """Numbers of the parts, valid until the next call."""
        new = [p for p in dict.fromkeys(parts) if p not in self.of]
        chars = sum(map(len, new))
        if self.of and self.chars + chars > REMEMBERED:
            self.clear()
            new = list(dict.fromkeys(parts))
            chars = sum(map(len, new))
        if new:
            self._learn(new)
            self.chars += chars
        return np.fromiter(map(self.of.__getitem__, parts), dtype=np.int64, count=len(parts))

    def wrong(self, entries: np.ndarray) -> np.ndarray:
        """Whether the tokens of a part do not give it back. A method, since `entries` puts a new array of numbers."""
        return self.numbers[entries, 0]

    def count(self, entries: np.ndarray) -> None:
        self.times += np.bincount(entries, minlength=len(self.times))

    def _learn(self, new: list[str]) -> None:
        self.learnt: list[np.ndarray] = []
        # parts without white space at an end are tokenised many at once, joined by the blanks they were cut at
        plain = [p for p in new if p and p[0] not in _BLANKS and p[-1] not in _BLANKS and "▁" not in p]
        known = set(plain)
        for some in [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]:
            if not self._add(some):
                for p in some:
                    self._add([p]) or self._wrong(p)
        for p in new:
            if p not in known:
                self._add([p]) or self._wrong(p)
        self.numbers = np.concatenate((self.numbers, *self.learnt))
        self.times = np.concatenate((self.times, np.zeros(len(new), dtype=np.int64)))

    def _wrong(self, part: str) -> None:
        self._append([part], [""] if self.shows else [], np.zeros(0, dtype=np.int64), np.array([[1, 0, 0, 0, 0, 0]]))

    def _append(self, parts: list[str], shown: list[str], pairs: np.ndarray, numbers: np.ndarray) -> None:
        self.of.update(zip(parts, range(len(self.of), len(self.of) + len(parts))))
        self.shown += shown
        self.pairs.append(pairs)
        self.learnt.append(numbers)

    def _add(self, parts: list[str]) -> bool:
        """Align parts; false if their tokens do not give back the text."""
        v, text = self.words, " ".join(parts)
        list_a, list_b = v.encode_a(" " + text), v.b.encode(text)
        whole = (" " + text).encode()
        if b"".join(map(v.bytes_a.__getitem__, list_a)) != whole or b"".join(map(v.bytes_b.__getitem__, list_b)) != whole:
            return False
        a, b = np.array(list_a, dtype=np.int64), np.array(list_b, dtype=np.int64)
        end_a, end_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, common), np.searchsorted(end_b, common)
        pairs = a[last_a] * len(v.bytes_b) + b[last_b]
        ends = np.cumsum([1 + len(p.encode()) for p in parts])  # each part with its blank
        n_a, n_b, links = (np.diff(np.searchsorted(x, ends, side="right"), prepend=0) for x in (end_a, end_b, common))
        numbers = np.zeros((len(parts), 6), dtype=np.int64)
        numbers[:, 1], numbers[:, 2], numbers[:, 3] = n_a, n_b, links
        if self.lookup is not None:
            counts, best = self.lookup.get(pairs)
            part = np.repeat(np.arange(len(parts)), links)
            numbers[:, 4] = np.bincount(part, weights=best, minlength=len(parts))
            np.add.at(numbers[:, 5], part, counts)
        if not self.shows:
            self._append(parts, [], pairs, numbers)
            return True
        # each token behind the tokens of earlier groups of both sides, and those of B behind those of A
        comma, bar, semicolon = self.shown_of
        shown_a, shown_b = comma[a], comma[b]
        shown_a[last_a], shown_b[last_b] = bar[a[last_a]], semicolon[b[last_b]]
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        flat = np.empty(len(a) + len(b), dtype=object)
        flat[np.arange(len(a)) + np.concatenate(([0], last_b + 1))[group_a]] = shown_a
        flat[np.arange(len(b)) + last_a[group_b] + 1] = shown_b
        flat, cut = flat.tolist(), np.cumsum(n_a + n_b).tolist()
        self._append(parts, ["".join(flat[x:y])[:-1] for x, y in zip([0, *cut], cut)], pairs, numbers)
        return True


class Lookup:
    """A minimal perfect hash over pairs: hash levels of bits by bucket; a pair's slot is the rank of its bit."""

    def __init__(self, buckets: list[tuple[list[int], bytes, list[int]]], n_buckets: int) -> None:
        """`buckets`: sizes of the levels, their bits, and the keys in the order of their slots."""
        depth = max((len(s) for s, _, _ in buckets), default=0)
        self.n_buckets = n_buckets
        self.size = np.zeros((n_buckets, depth), dtype=np.int64)
        for i, (sizes, _, _) in enumerate(buckets):
            self.size[i, : len(sizes)] = sizes
        flat = np.cumsum(self.size.ravel()) - self.size.ravel()
        self.start = flat.reshape(self.size.shape)
        self.bit = np.concatenate([np.frombuffer(b, dtype=bool) for _, b, _ in buckets] or [np.zeros(0, dtype=bool)])
        self.rank = (np.cumsum(self.bit) - self.bit).astype(np.int64)
        self.key = np.concatenate([np.array(k, dtype=np.int64) for _, _, k in buckets] or [np.zeros(0, dtype=np.int64)])
        self.count = np.zeros(len(self.key), dtype=np.int64)
        self.best = np.zeros(len(self.key), dtype=bool)

    @classmethod
    def of(cls, parts: dict) -> Lookup:
        """The table with these attributes: broadcasts name classes, and workers need not know this library."""
        own = cls.__new__(cls)
        vars(own).update(parts)
        return own

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are not in the table."""
        out, bucket, open_ = np.full(len(keys), -1), bucket_of(keys, self.n_buckets), np.arange(len(keys))
        for level in range(self.size.shape[1]):
            size = self.size[bucket[open_], level]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            at = self.start[bucket[open_], level] + place(keys[open_], level, size)
            hit = self.bit[at]
            slot = self.rank[at[hit]]
            same = self.key[slot] == keys[open_[hit]]  # a strange key may meet another one's bit
            out[open_[hit][same]] = slot[same]
            open_ = open_[~hit]
        return out

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self.slots(keys)
        known = slot >= 0
        return np.where(known, self.count[slot], 0), known & self.best[slot]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    keys, inverse = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(keys), dtype=np.int64)
    np.add.at(sums, inverse, counts)
    return keys, sums


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64) ^ np.uint64(0x5BD1E995)) % np.uint64(n)).astype(np.int64)


def place(keys: np.ndarray, level: int, size) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mixed(keys.astype(np.uint64) + seed) % np.asarray(size, dtype=np.uint64)).astype(np.int64)


def hash_levels(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes and bits of the levels, and the keys in the order of their bits: on each level the keys
    that are alone in their place stay, the others go on to the next."""
    sizes, bits, order = [], [], []
    while len(keys):
        size = max(8, 2 * len(keys))
        at = place(keys, len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        level = np.zeros(size, dtype=bool)
        level[at[alone]] = True
        sizes.append(size)
        bits.append(level)
        order.append(keys[alone][np.argsort(at[alone])])
        keys = keys[~alone]
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, dtype=kind)
    return sizes, join(bits, bool), join(order, np.int64)


def _blocks(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and parts of texts, so many at once; a longer text comes in several turns, alone."""
    rows, parts, waiting = [], [], 0
    for i, text in enumerate(texts):
        own = parts_of(text) if text else []
        if rows and waiting + len(own) > PARTS:
            yield rows, parts
            rows, parts, waiting = [], [], 0
        rows.append(i)
        parts.append(own)
        waiting += len(own)
    if rows:
        yield rows, parts


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """So many rows of a batch at a time: a batch is as large as its texts are long."""
    for batch in batches:
        for k in range(0, batch.num_rows, TEXTS):
            yield batch.slice(k, TEXTS)


def _turns(parts: list[str]) -> Iterator[list[str]]:
    for k in range(0, len(parts), PARTS):
        yield parts[k : k + PARTS]


def _pairs(paths: tuple, n_buckets: int):
    """Counts of the linked pairs of a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, keys, counts = Aligner(Vocabularies(*paths), shows=False), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def fold() -> None:
            nonlocal keys, counts
            every, number = (np.concatenate([x, *[y[i] for y in aligner.counted]]) for i, x in enumerate((keys, counts)))
            aligner.counted.clear()
            keys, counts = summed(every, number)

        for batch in _some(batches):
            for _, some in _blocks(batch.column(0).to_pylist()):
                if len(some) == 1:
                    # a text that does not come back whole counts nothing: judged before it is counted
                    if not any(aligner.wrong(aligner.entries(t)).any() for t in _turns(some[0])):
                        for t in _turns(some[0]):
                            aligner.count(aligner.entries(t))
                else:
                    entries = aligner.entries([p for own in some for p in own])
                    text = np.repeat(np.arange(len(some)), [len(own) for own in some])
                    wrong = np.bincount(text, weights=aligner.wrong(entries), minlength=len(some)) > 0
                    aligner.count(entries[~wrong[text]])
                if len(aligner.counted) > 8:
                    fold()
        aligner.clear()
        fold()
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket_of(keys, n_buckets)), pa.array(keys), pa.array(counts)], names=["bucket", "pair", "n"]
        )

    return run


def _vectors(lookup):
    """A task's counts as pieces of one dense vector over the slots."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Lookup.of(lookup.value)
        dense = np.zeros(len(table.key), dtype=np.int64)
        for batch in batches:
            np.add.at(dense, table.slots(batch["pair"].to_numpy(dtype=np.int64)), batch["n"].to_numpy(dtype=np.int64))
        yield pieces(dense)

    return run


def _paths(path_a: str | None, path_b: str | None, ranks_a: str | None) -> tuple:
    if path_a is None:
        path_a, ranks_a = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return path_a, path_b or public_tokenizers.path("piece_bpe_32k.model"), ranks_a


def count_pairs(docs: DataFrame, paths: tuple) -> Lookup:
    """First pass over `docs` (text): the table of linked pairs with their counts.

    It has at most `possible_pairs` entries, which follow from the two vocabularies alone; more than
    `MOST_PAIRS` are refused.
    """
    spark, words = docs.sparkSession, Vocabularies(*paths)
    bound, size = words.possible_pairs(), len(words.bytes_b)
    if bound > MOST_PAIRS:
        raise ValueError(f"the vocabularies allow {bound} pairs, more than {MOST_PAIRS}")
    n_buckets = -(-bound // BUCKET)
    counted = stored(docs.select("text").mapInArrow(_pairs(paths, n_buckets), "bucket long, pair long, n long"), "pairs")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        sizes, bits, keys = hash_levels(np.sort(group["pair"].to_numpy(dtype=np.int64)))
        return pd.DataFrame([(group["bucket"].iloc[0], sizes, bits.tobytes(), keys)], columns=["bucket", "sizes", "bits", "keys"])

    built = counted.select("bucket", "pair").distinct().groupBy("bucket").applyInPandas(build, "bucket long, sizes array<long>, bits binary, keys array<long>")
    own = {r.bucket: (list(r.sizes), bytes(r.bits), list(r["keys"])) for r in built.collect()}
    table = Lookup([own.get(b, ([], b"", [])) for b in range(n_buckets)], n_buckets)
    vectors = counted.select("pair", "n").mapInPandas(_vectors(spark.sparkContext.broadcast(vars(table))), "node long, piece long, counts binary")
    table.count = tree_sum(vectors, counted.rdd.getNumPartitions(), len(table.key))
    highest = np.zeros(size, dtype=np.int64)
    np.maximum.at(highest, table.key % size, table.count)
    table.best = table.count == highest[table.key % size]
    return table


def pair_table(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, ranks_a: str | None = None) -> DataFrame:
    """Linked id pairs of the corpus: a_id, b_id, n, is_best (no other pair of the B id has more links)."""
    paths = _paths(path_a, path_b, ranks_a)
    table, size = count_pairs(docs, paths), len(Vocabularies(*paths).bytes_b)
    rows = pd.DataFrame({"a_id": table.key // size, "b_id": table.key % size, "n": table.count, "is_best": table.best})
    return docs.sparkSession.createDataFrame(rows, "a_id long, b_id long, n long, is_best boolean")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, ranks_a: str | None = None) -> DataFrame:
    """Both tokenisations of every text, aligned: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A text is tokenised as blank+text by A (`path_a`) and, by itself, by B (`path_b`), which adds the
    blank. Offsets in bytes where tokens of both end cut them into groups; `groups` reads
    `a1,a2|b1;a3|b2`. The tokens of A and B that end there are linked. A pair's count are its links in
    all texts; `n_best` counts links whose pair has the highest count of its B id, ties included, and
    `count_sum` adds the counts of all links.

    Null and empty texts, and such whose tokens do not give back blank+text, have no tokens: zeros
    and an empty `groups`. Repeated rows and ids are aligned and counted each; a null id stays null;
    a text of any length is aligned in pieces; an empty table gives no rows; other columns are ignored.
    """
    paths = _paths(path_a, path_b, ranks_a)
    shared = docs.sparkSession.sparkContext.broadcast(vars(count_pairs(docs, paths)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Vocabularies(*paths), Lookup.of(shared.value))
        for batch in _some(batches):
            ids = batch.column(0).to_pylist()
            for rows, some in _blocks(batch.column(1).to_pylist()):
                numbers, shown = np.zeros((len(rows), 6), dtype=np.int64), []
                if len(some) == 1:
                    groups = []
                    for t in _turns(some[0]):
                        entries = aligner.entries(t)
                        numbers[0] += aligner.numbers[entries].sum(axis=0)
                        groups.append(";".join(map(aligner.shown.__getitem__, entries.tolist())))
                    shown.append(";".join(groups))
                else:
                    entries, begin = aligner.entries([p for own in some for p in own]), 0
                    listed = entries.tolist()
                    for i, own in enumerate(some):
                        end = begin + len(own)
                        numbers[i] = aligner.numbers[entries[begin:end]].sum(axis=0)
                        shown.append(";".join(map(aligner.shown.__getitem__, listed[begin:end])))
                        begin = end
                wrong = numbers[:, 0] > 0
                numbers[wrong] = 0
                columns = [numbers[:, i] for i in (1, 2, 3, 3, 4, 5)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in rows], pa.int64()), *map(pa.array, columns), pa.array(["" if w else s for w, s in zip(wrong, shown)], pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
                )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
