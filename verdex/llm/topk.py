"""Exact top-k search by inner product over a pivot-distance index.

Lengthening every vector by sqrt(M^2 - |x|^2), M the largest norm, makes the largest inner products the
smallest distances. Vectors are keyed by their nearest pivot and the distance to it, cut into annuli
around the pivots, and written in that order. A query first searches the annuli around its own
distance, which gives it a k-th best score; then it expands to all annuli whose bound by the triangle
inequality reaches that score. Queries go through the index in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdex.llm.common import stored

#: Components are floor(SCALE * x).
SCALE = 256
PIVOTS, RINGS = 32, 32
#: Vectors that pivots and ring borders are fitted on: those with the smallest hashes.
SAMPLE = 4096
#: Vectors in one row of the index, and queries in one block.
CHUNK, BLOCK = 4096, 512
#: Components of queries that go through the index together, at most (8 bytes each).
TOGETHER = 1 << 22

_NO_ID = np.iinfo(np.int64).max
#: Largest score told apart, and the score of a place that is not taken.
_TOP, _NONE = 2**63 - 2, -(2**63 - 1)
_VECTOR = "row long, vec_id long, norm double, comps binary"
_KEYED = f"{_VECTOR}, pivot int, ring int, dist double"
_CHUNK = "pivot int, ring int, low double, high double, n int, rows binary, ids binary, comps array<binary>"


def matrix(comps: list[bytes], width: int) -> np.ndarray:
    """Whole-numbered components as doubles, shorter vectors filled up with zeros."""
    out = np.zeros((len(comps), width))
    for i, c in enumerate(comps):
        x = np.frombuffer(c, dtype="<f8")
        out[i, : len(x)] = x
    return out


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ids, vectors = batch.to_pydict().values()
        comps = [np.floor(SCALE * np.array(v, dtype=np.float64)) for v in vectors]
        norm = [float(c @ c) for c in comps]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(norm), pa.array([c.tobytes() for c in comps], pa.binary())],
            names=["row", "vec_id", "norm", "comps"],
        )


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    inf = float("inf")
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))


class Pivots:
    """Reference points in the lengthened space, and borders of the rings around each."""

    def __init__(self, vectors: np.ndarray, norm: np.ndarray, largest: float) -> None:
        self.largest = largest
        points, rng = self.lengthened(vectors, norm), np.random.default_rng(0)
        self.points = points[rng.permutation(len(points))[:PIVOTS]]
        for _ in range(5):
            nearest, _ = self.nearest(points)
            self.points = np.stack([points[nearest == k].mean(axis=0) if (nearest == k).any() else x for k, x in enumerate(self.points)])
        nearest, dist = self.nearest(points)
        share = np.arange(1, RINGS) / RINGS
        self.borders = [np.quantile(dist[nearest == k], share) if (nearest == k).any() else np.zeros(RINGS - 1) for k in range(len(self.points))]

    @np.errstate(over="ignore", invalid="ignore")
    def lengthened(self, vectors: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return np.column_stack((vectors, np.sqrt(np.maximum(0.0, self.largest - norm))))

    @np.errstate(over="ignore", invalid="ignore")
    def distances(self, points: np.ndarray) -> np.ndarray:
        return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in self.points], axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.distances(points)
        k = d.argmin(axis=1)
        return k, d[np.arange(len(d)), k]

    def ring(self, pivot: np.ndarray, dist: np.ndarray) -> np.ndarray:
        return np.array([np.searchsorted(self.borders[p], d, side="right") for p, d in zip(pivot, dist)], dtype=np.int32)


def _keyed(pivots, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pivots.value
            norm = batch.column("norm").to_numpy()
            at, dist = own.nearest(own.lengthened(matrix(batch.column("comps").to_pylist(), width), norm)) if batch.num_rows else (np.zeros(0), np.zeros(0))
            ring = own.ring(at, dist)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at.astype(np.int32)), pa.array(ring, pa.int32()), pa.array(dist)],
                names=[*batch.schema.names, "pivot", "ring", "dist"],
            )

    return run


def _chunks(most: int, rings: bool):
    """Rows of one annulus (or of any, without `rings`) in order as one row, `most` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def ready() -> pa.RecordBatch:
            dists = np.array([r["dist"] for r in held])
            whole = lambda name: np.array([r[name] for r in held], dtype=np.int64).tobytes()
            return pa.RecordBatch.from_pylist([{
                "pivot": held[0]["pivot"], "ring": held[0]["ring"], "low": dists.min(), "high": dists.max(), "n": len(held), "rows": whole("row"),
                "ids": whole("vec_id"), "comps": [r["comps"] for r in held],
            }], schema=pa.schema([
                ("pivot", pa.int32()), ("ring", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int32()),
                ("rows", pa.binary()), ("ids", pa.binary()), ("comps", pa.list_(pa.binary())),
            ]))

        for batch in batches:
            for r in batch.to_pylist():
                if held and (len(held) == most or rings and (r["pivot"], r["ring"]) != (held[0]["pivot"], held[0]["ring"])):
                    yield ready()
                    held = []
                held.append(r)
        if held:
            yield ready()

    return run


class Index(NamedTuple):
    """The written annuli, the coded vectors, the broadcast pivots and the longest vector's length."""

    annuli: DataFrame
    coded: DataFrame
    pivots: object
    width: int


def _dealt(coded: DataFrame, pivots, width: int) -> DataFrame:
    """Vectors with their key, in its order. Ids are in it, so a vector that a third of all rows share is split as well."""
    key = ("pivot", "ring", "vec_id", "row")
    return coded.mapInArrow(_keyed(pivots, width), _KEYED).repartitionByRange(*key).sortWithinPartitions(*key)


def build_index(vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id") -> Index:
    """Index every usable row of `vectors`.

    Pivots and rings are fitted on at most `SAMPLE` rows; they decide how well the search prunes,
    never its result.
    """
    own = vectors.where(usable(F.col(vector_col))).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    coded = stored(own.mapInArrow(_quantise, _VECTOR), "vectors")
    largest, width = coded.agg(F.max("norm"), F.max(F.length("comps"))).first()
    width = (width or 0) // 8
    some = coded.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toPandas()
    pivots = Pivots(matrix(list(some.comps), width), some.norm.to_numpy(), largest) if len(some) else None
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    annuli = stored(_dealt(coded, shared, width).mapInArrow(_chunks(CHUNK, True), _CHUNK), "annuli")
    return Index(annuli, coded, shared, width)


class Queries:
    """A block of queries with their best candidates so far."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, pivots: Pivots, k: int) -> None:
        self.vectors, self.rows, self.k = vectors, rows, k
        self.norm = (vectors**2).sum(axis=1)
        points = np.column_stack((vectors, np.zeros(len(vectors))))
        self.to_pivot, self.largest = pivots.distances(points), pivots.largest
        self.pivot, self.dist = pivots.nearest(points)
        self.ring = pivots.ring(self.pivot, self.dist)
        self.least = np.full(len(rows), -np.inf)  # a score that the k-th best reaches at least

    @np.errstate(over="ignore", invalid="ignore")
    def bound(self, pivot: int, low: float, high: float) -> np.ndarray:
        """The highest score that any vector of an annulus can have with each query."""
        d = self.to_pivot[:, pivot]
        far = np.maximum(0.0, np.maximum(d - high, low - d))
        slack = 1e-9 * (self.norm + self.largest) + 1e-6
        most = (self.norm + self.largest - far**2) / 2 + slack
        return np.where(np.isnan(most), np.inf, most)  # norms beyond a double's range prune nothing


def _scores(queries: np.ndarray, vectors: np.ndarray, exact: bool) -> np.ndarray:
    """Whole-numbered inner products, clipped to 63 bits where they leave them."""
    if exact:
        return (queries @ vectors.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    return np.clip(whole(queries) @ whole(vectors).T, -_TOP, _TOP).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line the first `k` by score (falling), id and row; ids and rows are per column or per cell."""
    ids, rows = np.broadcast_to(ids, scores.shape), np.broadcast_to(rows, scores.shape)
    if scores.shape[1] > 4 * k:
        # whoever has fewer than the k-th best score is out; columns come by id, so of equal ones the first count
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        above, equal = scores > least, scores == least
        keep = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        at = np.nonzero(keep)[1].reshape(len(scores), k)
        scores, ids, rows = (np.take_along_axis(x, at, axis=1) for x in (scores, ids, rows))
    order = np.lexsort((rows, ids, -scores), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (scores, ids, rows))


_FOUND = "query int, score long, vec_id long, row long"


def _search(block, width: int, own_rings: bool):
    """Best candidates of each query among a task's annuli."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = block.value
        k, n = q.k, len(q.rows)
        best = [np.full((n, k), _NONE), np.full((n, k), _NO_ID), np.full((n, k), -1)]
        least = q.least.copy()
        for batch in batches:
            for c in batch.to_pylist():
                # annuli that cannot hold one of the k best are passed by
                wanted = q.bound(c["pivot"], c["low"], c["high"]) >= least
                if own_rings:
                    wanted &= (q.pivot == c["pivot"]) & (np.abs(q.ring - c["ring"]) <= 1)
                at = np.flatnonzero(wanted)
                if not len(at):
                    continue
                vectors = matrix(c["comps"], width)
                rows, ids = (np.frombuffer(c[x], dtype=np.int64) for x in ("rows", "ids"))
                exact = float(q.norm.max(initial=0)) * float((vectors**2).sum(axis=1).max(initial=0)) < 2.0**104
                for some in np.array_split(at, -(-len(at) * len(ids) // (1 << 21)) or 1):
                    scores = _scores(q.vectors[some], vectors, exact)
                    scores[q.rows[some][:, None] == rows[None, :]] = _NONE
                    new = _best(scores, ids[None, :], rows[None, :], k)
                    new[1][new[0] == _NONE], new[2][new[0] == _NONE] = _NO_ID, -1  # the query itself
                    both = _best(*[np.concatenate((old[some], x), axis=1) for old, x in zip(best, new)], k)
                    for old, x in zip(best, both):
                        old[some] = x
                    full = best[2][some][:, k - 1] >= 0
                    least[some] = np.where(full, np.maximum(least[some], best[0][some][:, k - 1]), least[some])
        found = best[2] >= 0
        at = np.nonzero(found)[0].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(x[found]) for x in best]], names=["query", "score", "vec_id", "row"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """The `k` rows of highest inner product with every query row: query_id, rank, vec_id, score.

    Components are floor(256 * x), x as double, so scores are whole numbers. `is_query` is a
    condition on `vec_id`; candidates are all rows but the query's own. Ties go to the smaller
    vec_id, then to the earlier row; a null id counts as the largest. Fewer candidates than `k` give
    fewer ranks.

    Null vectors and such with a null or non-finite component are neither query nor candidate. A
    shorter vector counts as filled up with zeros, an empty one as zero; scores beyond
    2^63 - 2 are clipped to it. Repeated rows are queries and candidates each; an empty table or no query
    gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    index, coded, pivots, width = build_index(vectors, vector_col, id_col)
    chosen = coded.where(is_query & (F.col("vec_id") != _NO_ID))
    packed = _dealt(chosen, pivots, width).mapInArrow(_chunks(BLOCK, False), _CHUNK)
    blocks = stored(packed.withColumn("block", F.monotonically_increasing_id()), "queries")
    sizes = [(r.block, r.n) for r in blocks.select("block", "n").orderBy("pivot", "ring", "block").collect()]
    parts, most = [], max(BLOCK, TOGETHER // max(1, width))
    while sizes:
        turn, total = [], 0
        while sizes and (not turn or total + sizes[0][1] <= most):
            block, n = sizes.pop(0)
            turn.append(block)
            total += n
        packed = blocks.where(F.col("block").isin(turn)).collect()
        comps = matrix([c for r in packed for c in r.comps], width)
        numbers, ids = (np.concatenate([np.frombuffer(r[x], dtype=np.int64) for r in packed]) for x in ("rows", "ids"))
        queries = Queries(comps, numbers, pivots.value, k)
        near = index.where(F.concat_ws(",", "pivot", "ring").isin(_own_rings(queries)))
        first = _merged(near, spark.sparkContext.broadcast(queries), width, True, k)
        seen = first.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).toPandas()
        queries.least[seen["query"].to_numpy(dtype=np.int64)] = seen["least"].to_numpy()
        found = _merged(index, spark.sparkContext.broadcast(queries), width, False, k)
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "query int, query_id long")
        found = found.join(F.broadcast(names), "query").select(
            "query_id", "rank", F.nullif("vec_id", F.lit(_NO_ID)).alias("vec_id"), "score")
        parts.append(stored(found, "found"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _own_rings(q: Queries) -> list[str]:
    near = {(int(p), int(r) + d) for p, r in zip(q.pivot, q.ring) for d in (-1, 0, 1)}
    return [f"{p},{r}" for p, r in sorted(near)]


def _merged(index: DataFrame, block, width: int, own_rings: bool, k: int) -> DataFrame:
    """The k best of each query over all tasks."""
    found = index.select("pivot", "ring", "low", "high", "rows", "ids", "comps").mapInArrow(_search(block, width, own_rings), _FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
