"""From labelled paragraphs to a chosen classifier, a scored corpus and its catalogue rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.operators.classify import (
    GRIDS,
    LABELS,
    TextModel,
    encode_labels,
    feature_importance,
    grid_points,
    grid_search,
    positives_with_metadata,
    score_base,
    train_and_test,
    train_table,
)
from verdex.operators.folds import in_test, split_cuts
from verdex.operators.metrics import METRICS, binary_metrics, class_report, confusion, model_summary
from verdex.operators.selection import select_model
from verdex.runtime import cut
from verdex.sources.files import file_stem
from verdex.sources.tables import labelled_only, positional_load, require_rows


def train_and_select(
    labelled: DataFrame,
    id: str,
    text: str,
    label: str,
    grids: Mapping[str, Mapping[str, Sequence]] = GRIDS,
    k: int = 10,
    repeats: int = 5,
    parallelism: int = 4,
) -> tuple[TextModel, dict[str, DataFrame]]:
    """(winner, tables). `label` is 0.0 / 1.0.

    Each model is tuned by cross-validated precision on the training three quarters; the winner is
    chosen by the test cascade on the fold scores of each model's best point. Tables: `scores` of
    all fits, `cv` and `test` metrics, their `summary`, the cascade's `trace`, the test
    `predictions`, and the winner's `confusion`, `report` and, where it has one, `importance`.
    """
    train, test = train_and_test(train_table(labelled, id, text, label))
    models, scores, predictions = {}, [], []
    for name, grid in grids.items():
        model, best, fits = grid_search(train, name, grid, k, repeats, parallelism)
        models[name] = model
        scores.append(fits.withColumn("is_best", F.col("point") == grid_points(grid).index(best)))
        predictions.append(
            model.transform(test).select(F.lit(name).alias("model"), "row_id", "label", "prediction")
        )
    fits = reduce(DataFrame.unionByName, scores)
    predicted = cut(reduce(DataFrame.unionByName, predictions))
    tested = binary_metrics(predicted, ("model",))
    cv = fits.where("is_best").select(
        "model", F.concat_ws(":", "repeat", "fold").alias("block"), *METRICS
    ).unpivot(["model", "block"], list(METRICS), "metric", "score")
    winner, trace = select_model(cv, tested, list(grids))
    of_winner = predicted.where(F.col("model") == winner)
    tables = {
        "scores": fits,
        "cv": cv,
        "test": tested,
        "summary": model_summary(cv, tested),
        "trace": trace,
        "predictions": predicted,
        "confusion": confusion(of_winner),
        "report": class_report(of_winner, names=LABELS),
    }
    if models[winner].importances is not None:
        tables["importance"] = feature_importance(models[winner], labelled.sparkSession)
    return models[winner], tables


def classify_paragraphs(table: DataFrame, **search) -> tuple[DataFrame, TextModel, dict[str, DataFrame]]:
    """A table with the label first and the text last -> (scored table, winner, tables).

    Rows get an id once, in a written copy, so that repeated rows stay apart. Every row is scored,
    also those trained on; `in_training` tells them.
    """
    base = cut(positional_load(table).withColumn("row_id", F.monotonically_increasing_id()))
    labelled = encode_labels(labelled_only(require_rows(base)))
    model, tables = train_and_select(labelled, "row_id", "text", "label", **search)
    scored = score_base(model, base, "row_id", "text")
    # one digest per class tells the split again, so nothing is joined to the scored corpus
    cuts = split_cuts(labelled, "row_id", "label")
    coded = encode_labels(scored.withColumn("_label", F.col("label")), "_label")
    used = F.col("_label").isNotNull() & ~in_test(cuts, "row_id", "_label")
    return coded.withColumn("in_training", used).drop("row_id", "_label"), model, tables


def positives(scored: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue rows of the rulings with a positive paragraph: the input of the reports."""
    return positives_with_metadata(scored.withColumn("id", file_stem(F.col("nome_pdf"))), catalogue)
