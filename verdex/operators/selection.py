"""Comparing models over folds: Friedman, Nemenyi, and the selection cascade.

Score tables are one row per model and fold, so they are small whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdex.functions.tails import chi2_sf, range_sf
from verdex.operators.metrics import METRICS
from verdex.runtime import cut


def fold_ranks(scores: DataFrame, block: str, item: str, score: str) -> DataFrame:
    """Adds `rank` (ascending, ties averaged) and `tied` (rows of the same score) within a block."""
    same = Window.partitionBy(block, score)
    ordered = Window.partitionBy(block).orderBy(score)
    return scores.select(block, item, score).withColumn("tied", F.count(F.lit(1)).over(same)).withColumn(
        "rank", F.rank().over(ordered) + (F.col("tied") - 1) / 2
    )


def mean_ranks(scores: DataFrame, block: str, item: str, score: str) -> DataFrame:
    """(item, mean_rank, blocks)."""
    ranks = fold_ranks(scores, block, item, score)
    return ranks.groupBy(item).agg(F.avg("rank").alias("mean_rank"), F.count(F.lit(1)).alias("blocks"))


def friedman(scores: DataFrame, block: str, item: str, score: str) -> DataFrame:
    """(items, blocks, statistic, p_value), with the correction for ties.

    Fully tied scores give no statistic (null).
    """
    ranks = fold_ranks(scores, block, item, score)
    # Each row of a tie of t stands for t^2 - 1, so a tie adds t * (t^2 - 1).
    sums = ranks.groupBy(item).agg(
        F.sum("rank").alias("r"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("tied") * F.col("tied") - 1).alias("t"),
    )
    parts = sums.agg(
        F.count(F.lit(1)).alias("k"), F.max("n").alias("n"),
        F.sum(F.col("r") * F.col("r")).alias("ss"), F.sum("t").alias("ties"),
    )
    k, n = F.col("k"), F.col("n")
    correction = 1 - F.col("ties") / (n * k * (k * k - 1))
    raw = 12 / (n * k * (k + 1)) * F.col("ss") - 3 * n * (k + 1)
    statistic = F.when(correction > 0, F.try_divide(raw, correction))
    out = parts.select(k.alias("items"), n.alias("blocks"), statistic.alias("statistic"))
    return out.withColumn("p_value", chi2_sf()(F.col("statistic"), F.col("items") - 1))


def nemenyi(scores: DataFrame, block: str, item: str, score: str) -> DataFrame:
    """(item_a, item_b, q, p_value) for every ordered pair of items, from their ranks per block."""
    ranks = fold_ranks(scores, block, item, score)
    items = ranks.agg(F.count_distinct(item)).scalar()
    a = ranks.select(block, F.col(item).alias("item_a"), F.col("rank").alias("rank_a"))
    b = ranks.select(block, F.col(item).alias("item_b"), F.col("rank").alias("rank_b"))
    pairs = a.join(b, block).groupBy("item_a", "item_b").agg(
        F.abs(F.avg(F.col("rank_a") - F.col("rank_b"))).alias("gap"), F.count(F.lit(1)).alias("n")
    )
    q = F.col("gap") / F.sqrt(items * (items + 1) / (6.0 * F.col("n")))
    tested = pairs.select("item_a", "item_b", q.alias("q"), items.alias("k"))
    p_value = range_sf()(F.col("q") * F.sqrt(F.lit(2.0)), F.col("k"))
    return tested.select("item_a", "item_b", "q", p_value.alias("p_value"))


def select_model(
    cv: DataFrame, test: DataFrame, order: Sequence[str], metrics: Sequence[str] = METRICS, alpha: float = 0.05
) -> tuple[str, DataFrame]:
    """The winner of the cascade, and its trace (step, metric, p_value, model).

    `cv` is long (model, metric, block, score), `test` has (model, accuracy), `order` lists the
    models; it settles ties. Per metric: if the Friedman test finds a difference, keep the model
    with the best mean and those the Nemenyi test does not tell from it. With two candidates left
    there is no Friedman test, so both go on.
    """
    cv = cut(cv)  # every round reads it
    candidates, trace = list(order), []
    for step, metric in enumerate(metrics, start=1):
        if len(candidates) == 1:
            break
        p_value = None
        scores = cv.where((F.col("metric") == metric) & F.col("model").isin(candidates))
        if len(candidates) > 2:
            p_value = friedman(scores, "block", "model", "score").first()["p_value"]
        if p_value is not None and p_value < alpha:
            means = {r["model"]: r["m"] for r in scores.groupBy("model").agg(F.avg("score").alias("m")).collect()}
            best = max(candidates, key=lambda m: (round(means[m], 12), -candidates.index(m)))
            pairs = nemenyi(scores, "block", "model", "score").where(F.col("item_a") == best)
            rivals = {r["item_b"] for r in pairs.where(F.col("p_value") >= alpha).collect()}
            candidates = [m for m in candidates if m == best or m in rivals]
        trace += [(step, metric, p_value, m) for m in candidates]
    if len(candidates) > 1:
        accuracy = {r["model"]: r["accuracy"] for r in test.select("model", "accuracy").collect()}
        best = max(candidates, key=lambda m: (accuracy[m], -candidates.index(m)))
        trace.append((len(metrics) + 1, "test accuracy", None, best))
        candidates = [best]
    schema = "step int, metric string, p_value double, model string"
    return candidates[0], cv.sparkSession.createDataFrame(trace, schema)
