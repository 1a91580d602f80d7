"""Exact k-nearest-neighbour vote against training rows in tiles of like rows.

Training rows go to the queries in chunks of `MAX_TRAINING_ROWS` and `MAX_TRAINING_ENTRIES`, each broadcast
in sparse form and released before the next one; the queries stay in their partitions and rows, are not shuffled and
need no key. A hand-labelled set is one chunk and one pass. Inside a chunk, rows are filed by the term
that weighs most in them, heaviest first, and cut into tiles. A tile keeps the largest and smallest
value of each term, which bound its inner products with a query, hence its distances from below; tiles
that cannot hold one of the k nearest are not compared.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdex.runtime import cut, discard

#: Training rows that are broadcast at a time.
MAX_TRAINING_ROWS = 200_000
#: Values stored in the vectors that are broadcast at a time, about: what the driver and a task hold.
MAX_TRAINING_ENTRIES = 4_000_000
#: Training rows in a tile, and query rows that are dense at a time.
BLOCK_ROWS = 1024
#: What rounding can take from a bound on squared distances.
SLACK = 1e-6


# these functions travel to the workers whole, so the library need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TrainingSet:
    """Training rows of one chunk: keys and labels in key order, sparse vectors in order of tiles.

    `ranks` tells a stored vector's place in key order; `tiles` where tiles begin and end.
    """

    def __init__(self, keys: list, labels: list[float], dim: int, vectors: list[tuple]) -> None:
        self.keys, self.labels, self.dim = keys, np.array(labels, dtype=float), dim
        heaviest = [_heaviest(np.asarray(i), np.asarray(v)) for i, v in vectors]
        filed = sorted(range(len(keys)), key=lambda r: (heaviest[r][1], -heaviest[r][0], r))
        self.tiles = np.append(np.arange(0, len(filed), BLOCK_ROWS), len(filed))
        # inside a tile the rows keep the order of their keys
        self.ranks = np.concatenate([np.sort(filed[a:b]) for a, b in zip(self.tiles, self.tiles[1:])])
        self.bounds = np.concatenate(([0], np.cumsum([len(vectors[r][0]) for r in self.ranks]))).astype(np.int64)
        self.indices = np.concatenate([np.asarray(vectors[r][0], dtype=np.int32) for r in self.ranks])
        self.values = np.concatenate([np.asarray(vectors[r][1], dtype=float) for r in self.ranks])
        # one tile is dense at a time
        high, low, least = zip(*((b.max(0), b.min(0), (b * b).sum(1).min()) for b in map(self.block, range(len(self.tiles) - 1))))
        self.high, self.low, self.least = np.stack(high), np.stack(low), np.array(least)

    @classmethod
    def of(cls, parts: dict) -> TrainingSet:
        own = cls.__new__(cls)
        vars(own).update(parts)
        return own

    def block(self, tile: int) -> np.ndarray:
        """The rows of a tile as a dense matrix."""
        begin, end = self.tiles[tile], self.tiles[tile + 1]
        out = np.zeros((end - begin, self.dim))
        stored = slice(self.bounds[begin], self.bounds[end])
        line = np.repeat(np.arange(end - begin), np.diff(self.bounds[begin : end + 1]))
        out[line, self.indices[stored]] = self.values[stored]
        return out

    def floors(self, queries: np.ndarray) -> np.ndarray:
        """What the squared distance of a query (line) to any row of a tile (column) is at least."""
        inner = np.maximum(queries, 0.0) @ self.high.T + np.minimum(queries, 0.0) @ self.low.T
        return (queries * queries).sum(1)[:, None] + self.least[None, :] - 2.0 * inner

    def nearest(self, queries: np.ndarray, k: int, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(distance, training row) of the k nearest rows of each query, by squared Euclidean distance
        to 9 places, ties by key order.

        `within` may give squared distances beyond which a query needs no row; missing ones are infinite.
        """
        k = min(k, len(self.keys))
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), len(self.keys))
        limit = np.full(len(queries), np.inf) if within is None else within
        own, floors = (queries * queries).sum(1), self.floors(queries)
        for tile in np.argsort(floors.min(0), kind="stable") if len(queries) else ():
            need = np.flatnonzero(floors[:, tile] <= np.minimum(best[:, -1], limit) + SLACK)
            if not len(need):
                continue
            block, ranks = self.block(tile), self.ranks[self.tiles[tile] : self.tiles[tile + 1]]
            squared = own[need][:, None] + (block * block).sum(1)[None, :] - 2.0 * (queries[need] @ block.T)
            at = first_smallest(squared := np.round(np.maximum(squared, 0.0), 9), k)
            found = np.concatenate((best[need], np.take_along_axis(squared, at, 1)), axis=1)
            place = np.concatenate((rows[need], ranks[at]), axis=1)
            order = np.lexsort((place, found), axis=1)[:, :k]
            best[need], rows[need] = np.take_along_axis(found, order, 1), np.take_along_axis(place, order, 1)
        return np.sqrt(best), rows


def _heaviest(indices: np.ndarray, values: np.ndarray) -> tuple[float, int]:
    """The largest value and its index, the last one if there are several."""
    if not len(values):
        return 0.0, -1
    most = values.max()
    return float(most), int(indices[values == most].max())


def first_smallest(values: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k smallest values of each line, in rising column order; of equal ones the first."""
    if values.shape[1] <= k:
        return np.broadcast_to(np.arange(values.shape[1]), values.shape)
    last = np.partition(values, k - 1, axis=1)[:, k - 1 : k]
    less, equal = values < last, values == last
    taken = less | (equal & (np.cumsum(equal, axis=1) <= k - less.sum(1)[:, None]))
    return np.nonzero(taken)[1].reshape(len(values), k)


def _packed(vectors: Column) -> Column:
    """Indices and values of sparse vectors as bytes: 12 for an entry, also on the driver."""

    @F.pandas_udf("struct<i:binary, v:binary>")
    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "i": [np.asarray(x, dtype=np.int32).tobytes() for x in batch["i"]],
            "v": [np.asarray(x, dtype=np.float64).tobytes() for x in batch["v"]],
        })

    return pack(vectors)


def chunks(
    train: DataFrame, key: str = "row_id", label: str = "label", features: str = "features", most: int | None = None,
    entries: int | None = None,
) -> Iterator[tuple[TrainingSet, bool]]:
    """(training rows, whether they are the last) at a time, in the order of their keys: at most `most`
    rows, of about `entries` stored values in all.

    More rows than that are sorted and written once, and chunks are ranges of their places there.
    """
    most, entries = most or MAX_TRAINING_ROWS, entries or MAX_TRAINING_ENTRIES
    vector = F.unwrap_udt(features)
    rows = train.select(
        F.col(key).alias("key"), F.col(label).cast("double").alias("label"), vector["size"].alias("dim"),
        vector["indices"].alias("i"), vector["values"].alias("v"),
    )

    def collected(part: DataFrame) -> TrainingSet:
        found = part.select("key", "label", "dim", _packed(F.struct("i", "v")).alias("p")).collect()
        found.sort(key=lambda r: (r.key is not None, r.key, r.label))
        vectors = [(np.frombuffer(r.p.i, dtype=np.int32), np.frombuffer(r.p.v)) for r in found]
        return TrainingSet([r.key for r in found], [r.label for r in found], found[0].dim, vectors)

    n, stored = rows.agg(F.count(F.lit(1)), F.sum(F.size("i"))).first()
    if not n:
        raise ValueError("no training row")
    if n <= most and stored <= entries:
        yield collected(rows), True
        return
    order = (F.asc_nulls_first("key"), "label", F.xxhash64("i", "v"))
    written = cut(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    # an id is the task's number times 2^33 and the row's number in it: some rows on end are a run of ids
    together = min(most, BLOCK_ROWS)
    run = (F.shiftright("_at", 33).alias("task"), F.floor(F.pmod("_at", F.lit(1 << 33)) / together).alias("run"))
    try:
        runs = written.groupBy(*run).agg(
            F.min("_at").alias("begin"), F.count(F.lit(1)).alias("n"), F.sum(F.size("i")).alias("stored")
        ).orderBy("begin").collect()
        begins, n, stored = [runs[0].begin], 0, 0
        for r in runs:
            if n and (n + r.n > most or stored + r.stored > entries):
                begins.append(r.begin)
                n, stored = 0, 0
            n, stored = n + r.n, stored + r.stored
        for begin, end in zip(begins, [*begins[1:], 2**63 - 1]):
            yield collected(written.where((F.col("_at") >= begin) & (F.col("_at") < end))), end == 2**63 - 1
    finally:
        discard(written)


def _dense(batch: pd.DataFrame, dim: int) -> np.ndarray:
    out = np.zeros((len(batch), dim))
    for n, (i, v) in enumerate(zip(batch["i"], batch["v"])):
        out[n, np.asarray(i, dtype=int)] = v
    return out


def _sparse(features: str) -> Column:
    vector = F.unwrap_udt(features)
    return F.struct(vector["indices"].alias("i"), vector["values"].alias("v"))


def _finder(known, k: int, kind: str) -> Callable[[Column, Column], Column]:
    """Function of (sparse vector, neighbours from earlier chunks or null): the k nearest of both."""

    @F.pandas_udf(f"array<struct<neighbour:{kind}, neighbour_label:double, distance:double>>")
    def find(batches: Iterator[tuple[pd.DataFrame, pd.Series]]) -> Iterator[pd.Series]:
        own = TrainingSet.of(known.value)
        for vectors, earlier in batches:
            out = []
            for begin in range(0, len(vectors), BLOCK_ROWS):
                had = [[] if e is None else list(e) for e in earlier.iloc[begin : begin + BLOCK_ROWS]]
                within = np.array([e[-1]["distance"] ** 2 if len(e) >= k else np.inf for e in had])
                distance, rows = own.nearest(_dense(vectors.iloc[begin : begin + BLOCK_ROWS], own.dim), k, within)
                for old, ds, rs in zip(had, distance, rows):
                    new = [{"neighbour": own.keys[r], "neighbour_label": own.labels[r], "distance": d}
                           for d, r in zip(ds, rs) if d < np.inf]
                    # keys rise from chunk to chunk, so a stable sort settles ties by key
                    out.append(sorted(old + new, key=lambda x: x["distance"])[:k] if old else new)
            yield pd.Series(out)

    return find


def _with_neighbours(
    train: DataFrame, k: int, key: str = "row_id", label: str = "label", features: str = "features", most: int | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Adds `_near`, the k nearest training rows from near to far, to rows; nothing else changes."""
    kind, context = dict(train.dtypes)[key], train.sparkSession.sparkContext
    parts = chunks(train, key, label, features, most)
    own, single = next(parts)
    first = context.broadcast(vars(own))
    del own

    def near(df: DataFrame) -> DataFrame:
        find = _finder(first, k, kind)
        out = df.withColumn("_near", find(_sparse(features), F.lit(None).cast(find.returnType)))
        if single:
            return out
        out = cut(out)
        for n, (part, _) in enumerate(chunks(train, key, label, features, most)):
            if n:
                sent = context.broadcast(vars(part))
                last, out = out, cut(out.withColumn("_near", _finder(sent, k, kind)(_sparse(features), F.col("_near"))))
                sent.destroy()
                discard(last)
        return out

    parts.close()
    return near


def nearest(
    train: DataFrame, query: DataFrame, k: int, key: str = "row_id", label: str = "label", features: str = "features",
    most: int | None = None,
) -> DataFrame:
    """(query key, neighbour, neighbour_label, distance): the k nearest training rows of every query row."""
    near = _with_neighbours(train, k, key, label, features, most)
    return near(query.select(key, features)).select(key, F.inline("_near"))


def voter(train: DataFrame, k: int, features: str = "features", most: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """Adds `prediction` and `confidence` to rows by the majority of the k nearest training rows; a
    split vote goes to 0. Every row is kept, whatever its key. Training sets of more than `most` rows
    (`MAX_TRAINING_ROWS`) or `MAX_TRAINING_ENTRIES` stored values take one pass over the rows per chunk."""
    near = _with_neighbours(train, k, features=features, most=most)

    def vote(df: DataFrame) -> DataFrame:
        labels = F.col("_near.neighbour_label")
        ones = F.aggregate(labels, F.lit(0.0), lambda a, x: a + x)
        voted = near(df).withColumn("_p", ones / F.size(labels))
        p = F.col("_p")
        return voted.withColumns({"prediction": (p > 0.5).cast("double"), "confidence": F.greatest(p, 1 - p)}).drop("_p", "_near")

    return vote
