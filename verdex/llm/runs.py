"""Periodic runs of words: maximal stretches that repeat a period at least so many times.

Longest common extensions come from a difference cover: of the suffixes only those at covered
positions are sorted, by blocks of `COVER` words and doubled ranks; two positions are at most `COVER`
words ahead of a pair of covered ones, those few words are compared, and a sparse table of common
prefixes answers the rest. They drive an enumeration over harmonic grids: a stretch of four periods
holds three grid pairs in a row whose words are equal, so for every period only every p-th word is
looked at, and only such triples are extended.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A perfect difference set: every residue is the difference of two members modulo COVER.
COVER = 31
MEMBERS = np.array([0, 1, 3, 8, 12, 18])
#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Words that are searched together; a longer text is searched alone.
TOGETHER = 1 << 17
#: Grid pairs extended at once.
AT_ONCE = 1 << 18

_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _shifts() -> np.ndarray:
    """For two residues the words until both positions are covered."""
    covered = np.zeros(COVER, dtype=bool)
    covered[MEMBERS] = True
    out = np.zeros((COVER, COVER), dtype=np.int64)
    for a in range(COVER):
        for b in range(COVER):
            out[a, b] = next(d for d in range(COVER) if covered[(a + d) % COVER] and covered[(b + d) % COVER])
    return out


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions to the right in `s`, whose last word occurs once in it."""

    def __init__(self, s: np.ndarray) -> None:
        self.s, blocks = s, -(-len(s) // COVER)
        padded = np.zeros((blocks + 1) * COVER, dtype=">i4")  # big-endian numbers are ordered like their bytes
        padded[: len(s)] = s
        self.blocks = blocks
        self.group = np.full(COVER, -1)
        self.group[MEMBERS] = np.arange(len(MEMBERS))
        # covered positions by residue, so that the next block is the next place
        starts = (MEMBERS[:, None] + COVER * np.arange(blocks)[None, :]).ravel()
        starts = np.minimum(starts, len(padded) - COVER)
        words = padded[starts[:, None] + np.arange(COVER)[None, :]]
        rank = np.unique(np.ascontiguousarray(words).view(f"V{4 * COVER}").ravel(), return_inverse=True)[1].astype(np.int64)
        ranks, step, most = [rank], 1, len(starts)
        while rank.max() + 1 < most and step < blocks:
            rank = np.unique(rank * (most + 1) + self._ahead(rank, step) + 1, return_inverse=True)[1].astype(np.int64)
            ranks.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.at = np.empty(most, dtype=np.int64)
        self.at[order] = np.arange(most)
        self.least = self._table(self._neighbours(order, ranks, words))

    def _ahead(self, rank: np.ndarray, step: int) -> np.ndarray:
        """The rank `step` blocks on, -1 behind the end."""
        rows = rank.reshape(len(MEMBERS), self.blocks)
        out = np.full_like(rows, -1)
        out[:, : self.blocks - step] = rows[:, step:]
        return out.ravel()

    def _neighbours(self, order: np.ndarray, ranks: list[np.ndarray], words: np.ndarray) -> np.ndarray:
        """Common words of each sorted suffix with the one before it."""
        x, y = order[:-1].copy(), order[1:].copy()
        same, last = np.zeros(len(x), dtype=np.int64), len(words) - 1
        for level in reversed(range(len(ranks))):
            equal = ranks[level][x] == ranks[level][y]
            same += np.where(equal, COVER << level, 0)
            x, y = (np.minimum(np.where(equal, z + (1 << level), z), last) for z in (x, y))
        differ = words[x] != words[y]
        same += np.where(differ.any(axis=1), differ.argmax(axis=1), 0)
        return np.concatenate(([0], same))

    @staticmethod
    def _table(lcp: np.ndarray) -> list[np.ndarray]:
        out, width = [lcp], 1
        while 2 * width <= len(lcp):
            out.append(np.minimum(out[-1][: len(out[-1]) - width], out[-1][width:]))
            width *= 2
        return out

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from `i` and from `j` on are equal (i != j, both inside `s`)."""
        shift = SHIFTS[i % COVER, j % COVER]
        out = np.zeros(len(i), dtype=np.int64)
        open_ = np.arange(len(i))
        for d in range(COVER):
            going = open_[shift[open_] > d]
            if not len(going):
                break
            # the last word occurs once, so a pair differs before it could leave `s`
            equal = self.s[i[going] + d] == self.s[j[going] + d]
            out[going[equal]] += 1
            open_ = np.concatenate((open_[shift[open_] <= d], going[equal]))
        rest = open_
        a, b = (self.at[self.group[z % COVER] * self.blocks + z // COVER] for z in (i[rest] + shift[rest], j[rest] + shift[rest]))
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = level == k
            out[rest[of]] += np.minimum(self.least[k][low[of]], self.least[k][high[of] - (1 << int(k)) + 1])
        return out


def grid_pairs(s: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and periods to extend; texts lie in `s` by falling length, up to `ends`."""
    at, periods, waiting = [], [], 0
    active = len(lengths)
    for p in range(1, int(lengths[0]) // LEAST_TIMES + 1 if len(lengths) else 0):
        while active and lengths[active - 1] < LEAST_TIMES * p:
            active -= 1
        grid = s[: ends[active - 1] : p]
        equal = grid[1:] == grid[:-1]
        three = np.flatnonzero(equal[2:] & equal[1:-1] & equal[:-2])
        if len(three):
            # of the pairs in a chain every third one, from its third on: each run of the chain holds one
            chain = np.concatenate(([0], np.flatnonzero(np.diff(three) > 1) + 1))
            length = np.diff(np.concatenate((chain, [len(three)])))
            place = np.arange(len(three)) - np.repeat(chain, length)
            at.append((three[place % 3 == 0] + 2) * p)
            periods.append(np.full(len(at[-1]), p))
            waiting += len(at[-1])
            if waiting >= AT_ONCE:
                yield np.concatenate(at), np.concatenate(periods)
                at, periods, waiting = [], [], 0
    if at:
        yield np.concatenate(at), np.concatenate(periods)


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each text of word numbers (0 and above): rows of start, length, period, by start and period."""
    order = sorted((i for i, x in enumerate(texts) if len(x) >= LEAST_WORDS), key=lambda i: -len(texts[i]))
    found = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
    if not order:
        return found
    top = 1 + max(int(texts[i].max()) for i in order)
    # a text stands between words that occur once, so nothing is equal across texts
    parts = [np.array([top])]
    for k, i in enumerate(order):
        parts += [texts[i], np.array([top + 1 + k])]
    s = np.concatenate(parts).astype(np.int32)
    lengths = np.array([len(texts[i]) for i in order])
    begins = np.cumsum(lengths + 1) - lengths
    forward = backward = None
    runs = np.zeros((0, 3), dtype=np.int64)  # start, end, period
    for i, p in grid_pairs(s, begins + lengths, lengths):
        if forward is None:
            forward, backward = Extensions(s), Extensions(s[::-1])
        j, last = i + p, len(s) - 1
        ahead = forward.right(i, j)
        inner = (i > 0) & (ahead > 0)
        i, j, p, ahead = i[inner], j[inner], p[inner], ahead[inner]
        behind = backward.right(last - (j - 1), last - (i - 1))
        start, end = i - behind, j + ahead
        good = end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * p)
        new = np.stack((start[good], end[good], p[good]), axis=1)
        runs = np.unique(np.concatenate((runs, new)), axis=0)
        # a stretch found under several periods has the smallest, which divides the others
        first = np.concatenate(([True], np.any(runs[1:, :2] != runs[:-1, :2], axis=1))) if len(runs) else []
        runs = runs[first]
    text = np.searchsorted(begins, runs[:, 0], side="right") - 1
    for k in np.unique(text):
        own = runs[text == k]
        own = np.stack((own[:, 0] - begins[k], own[:, 1] - own[:, 0], own[:, 2]), axis=1)
        found[order[k]] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return found


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of `n` words stay: those that no run holds behind its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ready(rows: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        texts = [np.fromiter(map(numbers.__getitem__, w), dtype=np.int64, count=len(w)) for _, w in rows]
        runs, kept = find_runs(texts), []
        for (_, words), own in zip(rows, runs):
            if len(own):
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), own))]
            kept.append(b" ".join(words))
        lists = [[{"start": a, "length": b, "period": c} for a, b, c in x.tolist()] for x in runs]
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in rows], pa.int64()), pa.array([len(w) for _, w in rows], pa.int64()), pa.array(lists, _RUN),
             pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    for batch in batches:
        rows, waiting = [], 0
        for doc, text, tail, period in zip(*batch.to_pydict().values()):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            if period:
                words[tail:] = [words[tail + i % period] for i in range(len(words) - tail)]
            if rows and waiting + len(words) > TOGETHER:
                yield ready(rows)
                rows, waiting = [], 0
            rows.append((doc, words))
            waiting += len(words)
        if rows:
            yield ready(rows)


def periodic_runs(docs: DataFrame, tail: Column | None = None, period: Column | None = None) -> DataFrame:
    """Runs of every text of `docs` (doc_id, text): doc_id, n_words, runs, collapsed.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch of words with smallest period
    q (words q apart are equal), of at least max(6, 4 q) words, that no neighbouring word extends;
    `runs` lists start, length, period by start, then period. `collapsed` are the words that no run
    holds behind its first q, joined by one space. `tail` and `period` plant a test run in a row
    beforehand: from word `tail` on the next `period` words repeat to the end (null or 0: none).

    Null and empty texts have no words, no runs and an empty `collapsed`. Repeated rows and ids are
    judged each; a null id stays null; an empty table gives no rows; other columns are ignored. There
    is no shuffle: a text is one task's work, of n log n steps on its words.
    """
    nothing = F.lit(None).cast("long")
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text"]
    planted = [(c if c is not None else nothing).cast("long").alias(n) for n, c in (("tail", tail), ("period", period))]
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(*columns, *planted).mapInArrow(_search, schema)


def n_words(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def planted_run(doc_id: Column, n: Column) -> tuple[Column, Column]:
    """First word and period of the run planted in a tenth of the rows by crc32 of the id; null in the others."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    here = (h % 10 == 0) & (n > 0)
    tail = F.when(here, g % n)
    return tail, F.when(here, 1 + F.floor((n - tail) / (3 + g % 8)))


def digests(found: DataFrame) -> DataFrame:
    """Per row of `periodic_runs`: number of runs, the one of greatest exponent, digests of runs and words."""
    def before(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        later = F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"]))
        return F.when(a > b, -1).when(a < b, 1).otherwise(later.cast("int"))

    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.get(F.array_sort("runs", before), F.lit(0))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "runs", "collapsed").select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
