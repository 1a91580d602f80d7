"""Helpers of the training-data operators: shared storage, union by component, column hygiene."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Counts in a piece of a vector (8 bytes each), and vectors that are summed at once.
PIECE, FAN = 1 << 14, 16
#: Pieces of a sum that come to the driver together, about.
PIECES_AT_ONCE = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it from there.

    It cuts the lineage, survives the loss of any executor, and later reads keep column pruning.
    The folder is deleted when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that `stored` returned, when nothing reads it any more."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_PIECES = "node long, piece long, counts binary"


def pieces(dense: np.ndarray) -> pd.DataFrame:
    """A task's vector of counts, cut into pieces for `tree_sum`; pieces of zeros are left out."""
    node = TaskContext.get().partitionId()
    cut = [(k, dense[k * PIECE : (k + 1) * PIECE]) for k in range(-(-len(dense) // PIECE))]
    rows = [(node, k, x.astype(np.int64).tobytes()) for k, x in cut if x.any()]
    return pd.DataFrame(rows, columns=["node", "piece", "counts"])


def tree_sum(vectors: DataFrame, nodes: int, size: int) -> np.ndarray:
    """Sum of vectors of `size` counts that `nodes` tasks left as `pieces`: `FAN` at a time along a tree."""

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PIECE, dtype=np.int64)
        for x in group["counts"]:
            total[: len(x) // 8] += np.frombuffer(x, dtype=np.int64)
        return pd.DataFrame([(group["node"].iloc[0] // FAN, group["piece"].iloc[0], total.tobytes())], columns=["node", "piece", "counts"])

    while True:
        vectors = vectors.groupBy((F.col("node") / FAN).cast("long").alias("parent"), "piece").applyInPandas(added, _PIECES)
        nodes = -(-nodes // FAN)
        if nodes <= 1:
            break
    out = np.zeros(-(-size // PIECE) * PIECE, dtype=np.int64)
    # a partition at a time comes to the driver, so each holds a few pieces only
    for r in vectors.repartition(-(-size // (PIECES_AT_ONCE * PIECE)) or 1, "piece").toLocalIterator():
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = np.frombuffer(r["counts"], dtype=np.int64)
    return out[:size]


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected `edges` (u, v): one row (node, component) per node.

    The component is the smallest node in it. Null ends and loops are ignored; no edges give no
    rows. Alternating large-star and small-star steps: each step takes one minimum per node
    (combined before the shuffle) and joins it back to the edges, so a hub costs its degree and is
    never held in one row. Every step is written to shared storage.
    """

    def with_least(e: DataFrame) -> DataFrame:
        return e.join(e.groupBy("u").agg(F.min("v").alias("m")), "u")

    e = edges.select("u", "v").where(F.col("u") != F.col("v"))
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            with_least(both)
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        pairs = with_least(large).select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        )).alias("p")).select("p.*")
        last, e = e, stored(pairs.where(F.col("u") != F.col("v")).distinct(), "edges")
        discard(last)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator of one row.

    The optimiser otherwise writes a column's expression into each place that uses it, and computes
    it once per use, in lambdas once per element.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def small(df: DataFrame, rows: int) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows; beyond, joins shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
