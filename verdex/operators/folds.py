"""Repeatable stratified splits, exact at any size.

Rows are ranked within their class by a digest of seed and id. A window over a whole class would
put half of all rows in one task, so the rank is taken in two steps: within (class, digest prefix)
by a window over a small bucket, plus the number of rows in the class's lower buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 3  # hex digits of the digest: 4096 buckets per class


def digest(seed: Column, id: str) -> Column:
    return F.md5(F.concat_ws(":", seed.cast("string"), F.col(id).cast("string")))


def rank_in_class(df: DataFrame, groups: list[str], order: str) -> DataFrame:
    """Adds `nth`, the rank (from 1) of each row within its group by the hex digest `order`, and
    `group_size`."""
    bucketed = df.withColumn("_bucket", F.substring(order, 1, PREFIX_DIGITS))
    sizes = bucketed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # Per group at most 16 ** PREFIX_DIGITS rows: one row per bucket.
    group = Window.partitionBy(*groups)
    below = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *groups, "_bucket", F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_offset"),
        F.sum("_size").over(group).alias("group_size"),
    )
    within = Window.partitionBy(*groups, "_bucket").orderBy(order)
    ranked = bucketed.withColumn("_rank", F.row_number().over(within))
    return ranked.join(offsets, [*groups, "_bucket"]).withColumn("nth", F.col("_rank") + F.col("_offset")).drop(
        "_bucket", "_rank", "_offset"
    )


def stratified_split(
    df: DataFrame, id: str, label: str, test_share: float = 0.25, seed: int = 42
) -> DataFrame:
    """(id, label, is_test): the first ceil(share * n) rows of every class by digest are the test set.

    `id` names a row; rows that share an id share a digest and have no order of their own.
    """
    ranked = rank_in_class(df.select(id, label, digest(F.lit(seed), id).alias("_h")), [label], "_h")
    return ranked.select(id, label, (F.col("nth") <= F.ceil(F.col("group_size") * test_share)).alias("is_test"))


def split_cuts(
    df: DataFrame, id: str, label: str, test_share: float = 0.25, seed: int = 42
) -> dict:
    """{label: greatest digest of its test set}: one digest per class, the split of `stratified_split`."""
    ranked = rank_in_class(df.select(id, label, digest(F.lit(seed), id).alias("_h")), [label], "_h")
    last = ranked.where(F.col("nth") == F.ceil(F.col("group_size") * test_share))
    return {r[label]: r["_h"] for r in last.select(label, "_h").collect()}


def in_test(cuts: dict, id: str, label: str, seed: int = 42) -> Column:
    """Whether a row is in the test set of `split_cuts`: row by row, without a join.

    Rows of a class that share an id share a digest, and so are on the same side.
    """
    own, out = digest(F.lit(seed), id), F.lit(False)
    for value, last in cuts.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(value)), own <= F.lit(last)).otherwise(out)
    return out


def fold_table(
    df: DataFrame, id: str, label: str, k: int = 10, repeats: int = 5, seed: int = 42
) -> DataFrame:
    """(repeat, id, label, fold): `repeats` stratified partitions of the rows into `k` folds."""
    repeated = df.select(
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"), id, label
    ).withColumn("_h", digest(F.col("repeat") + F.lit(seed), id))
    ranked = rank_in_class(repeated, ["repeat", label], "_h")
    return ranked.select(
        "repeat", id, label, F.pmod(F.col("nth") - 1, F.lit(k)).cast("int").alias("fold")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): balanced weights n_rows / (n_classes * n_of_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (classes * F.col("n")))
