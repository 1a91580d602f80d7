"""The seven text classifiers, their grids, grid search, scoring and feature importance.

Training rows are `row_id`, `grams` (array of 1- and 2-grams) and `label` (0.0 / 1.0).
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.operators.features import column_stats, fit_tfidf, with_grams, written_grams
from verdex.operators.folds import digest, fold_table, in_test, rank_in_class, split_cuts
from verdex.operators.knn import voter
from verdex.operators.metrics import METRICS, binary_metrics
from verdex.runtime import cut

SEED = 42
LABELS = ("Não", "Sim")  # in alphabetical order: 0 and 1

# The models in order, and the grid of each.
GRIDS = {
    "LogisticRegression": {"max_features": [1500, 2000, 3000], "C": [1, 10, 20]},
    "RandomForest": {"max_features": [1500, 2000, 3000], "n_estimators": [200, 300], "max_depth": [20, None]},
    "BoostedTreesWeighted": {
        "max_features": [1500, 2000, 3000], "n_estimators": [100, 200], "learning_rate": [0.05, 0.1],
    },
    "BoostedTrees": {"max_features": [1500, 2000, 3000], "n_estimators": [100, 200], "max_depth": [3, 6]},
    "SVC": {"max_features": [1500, 2000, 3000], "C": [1, 10], "kernel": ["linear", "rbf"]},
    "KNeighbors": {"max_features": [1500, 2000, 3000], "n_neighbors": [3, 5, 7]},
    "MLPClassifier": {"max_features": [1500, 2000, 3000], "hidden": [50, 100]},
}
SCALED = ("LogisticRegression", "SVC", "KNeighbors", "MLPClassifier")
WEIGHTED = ("LogisticRegression", "RandomForest", "BoostedTreesWeighted", "SVC")
MAX_TREE_DEPTH = 30  # MLlib's limit; stands for "no limit"
FOURIER_FEATURES = 512  # approximation of the RBF kernel: its error falls with the root of the width
FOURIER_ROWS = 512  # rows that are projected, and held dense, at a time
MLP_ITERATIONS = 1000
SVC_ITERATIONS = 10_000  # stands for "no limit"; a warning tells when it is reached
MAX_BINS = 255  # split candidates of a feature
# Training rows are dealt by id, whatever the cluster and the input's layout. A tree's samples depend on
# the partitions, so their number is fixed (for hand-labelled sets, up to some million rows); the optimum
# of the other solvers does not, and they get one partition for every so many rows.
TREE_PARTITIONS = 8
ROWS_PER_PARTITION = 5_000
TREES = ("RandomForest", "BoostedTreesWeighted", "BoostedTrees")


@dataclass
class TextModel:
    """A fitted classifier: `transform` adds `prediction` and `confidence`."""

    name: str
    params: dict
    terms: list[str]
    featurise: Callable[[DataFrame], DataFrame]
    predict: Callable[[DataFrame], DataFrame]
    importances: Sequence[float] | None = field(default=None)
    solver: object = field(default=None)  # the MLlib model, where there is one

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [c for c in df.columns if c not in ("prediction", "confidence")]
        return self.predict(self.featurise(df)).select(*keep, "prediction", "confidence")


def encode_labels(df: DataFrame, col: str = "label", labels: Sequence[str] = LABELS) -> DataFrame:
    """Label text to its place in the alphabetical list, as a double."""
    code = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(col)) - 1
    return df.withColumn(col, code.cast("double"))


def decode_labels(c: F.Column, labels: Sequence[str] = LABELS) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in labels]), c.cast("int") + 1)


def _dealt(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows in an order and partitions that only depend on them."""
    return rows.repartition(partitions, "row_id").sortWithinPartitions("row_id", "label")


@contextmanager
def _training(rows: DataFrame, weighted: bool, partitions: int | None = None):
    """(rows with `weight`, row count), held in memory while an iterative solver reads them.

    `weight` is balanced, or 1. Without `partitions` there is one for every `ROWS_PER_PARTITION` rows.
    """
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    if weighted:
        for label, n in counts.items():
            weight = F.when(F.col("label") == label, F.lit(total / (len(counts) * n))).otherwise(weight)
    held = _dealt(rows, partitions or -(-total // ROWS_PER_PARTITION) or 1).withColumn("weight", weight).persist()
    try:
        yield held, total
    finally:
        held.unpersist()


def _from_probability(model) -> Callable[[DataFrame], DataFrame]:
    def predict(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("confidence", F.array_max(vector_to_array("probability")))

    return predict


def _fit_svc(rows: DataFrame, n: int, C: float):
    """Linear SVC with Platt's sigmoid, fitted on margins of rows the SVC did not see."""

    def svc(df: DataFrame, size: float):
        solver = LinearSVC(
            regParam=1.0 / (C * size), weightCol="weight", standardization=False, tol=1e-3,
            maxIter=SVC_ITERATIONS,
        )
        df = df.persist()
        try:
            model = solver.fit(df)
        finally:
            df.unpersist()
        if model.summary().totalIterations >= SVC_ITERATIONS:
            warnings.warn(f"the SVC stopped after {SVC_ITERATIONS} iterations without converging", stacklevel=2)
        return model

    def margins(model, df: DataFrame) -> DataFrame:
        out = model.transform(df).withColumn("_margin", vector_to_array("rawPrediction")[1])
        return out.withColumn("_m", array_to_vector(F.array("_margin")))

    hashed = rows.withColumn("_h", digest(F.lit(SEED), "row_id"))
    thirds = rank_in_class(hashed, ["label"], "_h").withColumn("_part", F.pmod("nth", F.lit(3)))
    thirds = _dealt(thirds, -(-n // ROWS_PER_PARTITION) or 1).select("features", "label", "weight", "_part").persist()
    unseen = None
    try:
        for part in range(3):
            held = thirds.where(F.col("_part") == part)
            out = margins(svc(thirds.where(F.col("_part") != part), n * 2 / 3), held).select("_m", "label")
            unseen = out if unseen is None else unseen.unionByName(out)
        sigmoid = LogisticRegression(featuresCol="_m", rawPredictionCol="_raw", predictionCol="_p").fit(unseen)
    finally:
        thirds.unpersist()
    model = svc(rows, n)

    def predict(df: DataFrame) -> DataFrame:
        return sigmoid.transform(margins(model, df)).withColumn(
            "confidence", F.array_max(vector_to_array("probability"))
        )

    return predict, [abs(x) for x in model.coefficients], model


def _fourier_stage(rows: DataFrame, width: int = FOURIER_FEATURES) -> Callable[[DataFrame], DataFrame]:
    """Random Fourier features (Rahimi & Recht 2007) of the RBF kernel, gamma = 1 / (d * variance).

    The projection is drawn again from the seed, once in every task, instead of being shipped; sparse
    vectors are multiplied as they are.
    """
    _, mean, variance = column_stats(rows, "features")
    d = len(mean)
    overall = sum(mean) / d
    total = sum(v + m * m for m, v in zip(mean, variance)) / d - overall**2
    gamma, seed = 1.0 / (d * total), SEED

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        rng = np.random.default_rng(seed)
        w = rng.normal(0.0, np.sqrt(2.0 * gamma), (d, width))
        b = rng.uniform(0.0, 2 * np.pi, width)
        for batch in batches:
            for begin in range(0, len(batch), FOURIER_ROWS):
                some = batch.iloc[begin : begin + FOURIER_ROWS]
                sums = np.stack([x @ w[i] for i, x in zip(some["indices"], some["values"])])
                yield pd.Series(list(np.sqrt(2.0 / width) * np.cos(sums + b)))

    def stage(df: DataFrame) -> DataFrame:
        v = F.unwrap_udt("features")
        sparse = F.struct(v["indices"].alias("indices"), v["values"].alias("values"))
        return df.withColumn("features", array_to_vector(project(sparse)))

    return stage


def fit_model(name: str, train: DataFrame, featurised=None, **params) -> TextModel:
    """Fit one classifier. `featurised` may hand in (rows, featurise, terms) shared by a grid."""
    max_features = params.get("max_features", GRIDS[name]["max_features"][0])
    rows, featurise, terms = featurised or featurise_rows(train, max_features, name in SCALED)
    if name == "KNeighbors":
        return TextModel(name, params, terms, featurise, voter(rows, params.get("n_neighbors", 3)))
    if name == "SVC" and params.get("kernel", "linear") == "rbf":
        stage = _fourier_stage(rows, params.get("fourier_features", FOURIER_FEATURES))
        rows, plain = stage(rows), featurise
        featurise = lambda df: stage(plain(df))
    with _training(rows, name in WEIGHTED, params.get("partitions", TREE_PARTITIONS if name in TREES else None)) as (rows, n):
        predict, importances, solver = _fit_solver(name, rows, n, len(terms), params)
    if params.get("kernel") == "rbf":
        importances = None
    return TextModel(name, params, terms, featurise, predict, importances, solver)


def _fit_solver(name: str, rows: DataFrame, n: int, n_terms: int, params: dict):
    """(predict, importances or None, MLlib model) of the named solver on weighted feature rows."""
    if name == "LogisticRegression":
        model = LogisticRegression(
            regParam=1.0 / (params.get("C", 1) * n), elasticNetParam=0.0, standardization=False,
            weightCol="weight", maxIter=1000, tol=1e-4,
        ).fit(rows)
        return _from_probability(model), [abs(x) for x in model.coefficients], model
    if name == "RandomForest":
        model = RandomForestClassifier(
            numTrees=params.get("n_estimators", 200), maxDepth=params.get("max_depth", 20) or MAX_TREE_DEPTH,
            weightCol="weight", seed=SEED, maxBins=MAX_BINS,
        ).fit(rows)
        return _from_probability(model), model.featureImportances.toArray().tolist(), model
    if name in ("BoostedTreesWeighted", "BoostedTrees"):
        preset = (
            {"stepSize": params.get("learning_rate", 0.05), "maxDepth": 5, "minInstancesPerNode": 20}
            if name == "BoostedTreesWeighted"
            else {"stepSize": 0.3, "maxDepth": params.get("max_depth", 3)}
        )
        model = GBTClassifier(
            maxIter=params.get("n_estimators", 100), weightCol="weight", seed=SEED, maxBins=MAX_BINS, **preset
        ).fit(rows)
        return _from_probability(model), model.featureImportances.toArray().tolist(), model
    if name == "SVC":
        return _fit_svc(rows, n, params.get("C", 1))
    if name == "MLPClassifier":
        model = MultilayerPerceptronClassifier(
            layers=[n_terms, params.get("hidden", 50), 2], seed=SEED,
            maxIter=params.get("max_iter", MLP_ITERATIONS),
        ).fit(rows)
        return _from_probability(model), None, model
    raise ValueError(f"unknown model {name}")


def featurise_rows(train: DataFrame, max_features: int, scale: bool):
    """(rows with `features`, the featuriser, its terms), fitted on the training rows alone."""
    model, terms = fit_tfidf(train, max_features=max_features, scale=scale)
    drop = ["_counts", "_weighted"] + (["_unit"] if scale else [])

    def featurise(df: DataFrame) -> DataFrame:
        return model.transform(df).drop(*drop)

    return featurise(train), featurise, terms


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def fold_columns(df: DataFrame, k: int, repeats: int, seed: int = SEED) -> DataFrame:
    """(row_id, `r0`, `r1`, …): one row per id, its fold in every repeat."""
    folds = fold_table(df, "row_id", "label", k, repeats, seed)
    wide = folds.groupBy("row_id").pivot("repeat", list(range(repeats))).agg(F.first("fold"))
    return wide.withColumnsRenamed({str(r): f"r{r}" for r in range(repeats)})


def wide_folds(df: DataFrame, k: int, repeats: int, seed: int = SEED) -> DataFrame:
    """The rows with one fold column per repeat (`r0`, `r1`, …)."""
    return df.join(fold_columns(df, k, repeats, seed), "row_id")


SCORE_SCHEMA = "model string, point int, params string, repeat int, fold int, " + ", ".join(
    f"{m} double" for m in METRICS
)


def grid_search(
    train: DataFrame, name: str, grid: Mapping[str, Sequence] | None = None, k: int = 10,
    repeats: int = 5, parallelism: int = 4,
) -> tuple[TextModel, dict, DataFrame]:
    """(model refitted with the best point, that point, fold scores of every point).

    `train` should be a written table (see `train_table`): every fold reads it. Within a fold the
    vocabulary is fitted once per `max_features` and shared by the other parameters. All three
    metrics are taken from the same fits, so the best point needs no further cross-validation.
    Folds run side by side as Spark jobs; only one row of metrics per fit comes to the driver.
    """
    points = grid_points(grid or GRIDS[name])
    folded = cut(wide_folds(train, k, repeats))

    def one_fold(task: tuple[int, int]) -> list[tuple]:
        repeat, fold = task
        seen = folded.where(F.col(f"r{repeat}") != fold)
        held = folded.where(F.col(f"r{repeat}") == fold)
        out = []
        for size in sorted({p["max_features"] for p in points}):
            rows, featurise, terms = featurise_rows(seen, size, name in SCALED)
            rows = rows.select("row_id", "features", "label").persist()
            try:
                for number, point in enumerate(points):
                    if point["max_features"] != size:
                        continue
                    model = fit_model(name, seen, (rows, featurise, terms), **point)
                    row = binary_metrics(model.transform(held)).first()
                    out.append((name, number, json.dumps(point), repeat, fold, *(row[m] for m in METRICS)))
            finally:
                rows.unpersist()
        return out

    tasks = [(r, f) for r in range(repeats) for f in range(k)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        scored = pool.map(inheritable_thread_target(train.sparkSession)(one_fold), tasks)
    rows = sorted(r for part in scored for r in part)
    means = {
        n: round(sum(r[5] for r in rows if r[1] == n) / len(tasks), 12) for n in range(len(points))
    }
    best = points[max(means, key=lambda n: (means[n], -n))]
    scores = train.sparkSession.createDataFrame(rows, SCORE_SCHEMA)
    return fit_model(name, train, **best), best, scores


def train_table(df: DataFrame, id: str, text: str, label: str) -> DataFrame:
    """(row_id, label, is_test, grams), written once: the text stage is free of folds.

    As many rows as `df` has: the split is one digest per class, compared row by row.
    """
    rows = df.select(F.col(id).alias("row_id"), F.col(label).alias("label"), F.col(text).alias("_text"))
    rows = rows.withColumn("is_test", in_test(split_cuts(df, id, label), "row_id", "label"))
    return written_grams(rows, "_text")


def train_and_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("not is_test").drop("is_test"), df.where("is_test").drop("is_test")


def feature_importance(model: TextModel, spark, k: int = 20) -> DataFrame:
    """(feature, importance): the k largest tree importances or absolute coefficients."""
    if model.importances is None:
        raise ValueError(f"{model.name} with {model.params} has no feature importance")
    pairs = list(zip(model.terms, (float(x) for x in model.importances)))
    table = spark.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def score_base(model: TextModel, df: DataFrame, id: str, text: str) -> DataFrame:
    """All rows with `predicted_label` and `prediction_confidence`; their own columns are kept."""
    rows = with_grams(df.withColumn("row_id", F.col(id)), text)
    scored = model.transform(rows)
    return scored.select(
        *df.columns,
        decode_labels(F.col("prediction")).alias("predicted_label"),
        F.col("confidence").alias("prediction_confidence"),
    )


def positives_with_metadata(scored: DataFrame, catalogue: DataFrame, id: str = "id", positive: str = "Sim") -> DataFrame:
    """Catalogue rows of the documents with a positive paragraph."""
    hits = scored.where(F.col("predicted_label") == positive).select(id).distinct()
    return catalogue.join(hits, id, "left_semi")
