"""Most frequent terms by mergeable Misra-Gries summaries, completed to exact counts.

Every task keeps a summary of a bounded number of counters; summaries are merged along a tree and cut
back to that bound each time. What is cut off is remembered, so the last summary holds every term that
occurs more often than its error. A second pass counts just these terms exactly. What is shuffled is
bounded by the summaries, not by the number of distinct terms.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext, TaskContext, cloudpickle
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Counters of a summary per term that is wanted, to begin with; summaries merged at once.
COUNTERS, FAN = 10, 16
#: Occurrences counted together in a task, and those that travel to it in one row.
TOGETHER, IN_ROW = 1 << 20, 64

_SUMMARY = "node long, term string, n long"
_NAMES = ["node", "term", "n"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def trimmed(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """`table` (term, n) summed by term and cut back to `counters` terms, and by how much counts fell."""
    table = table.group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
    if len(table) <= counters:
        return table, 0
    # the first counter too many sets what all of them lose
    order = pc.select_k_unstable(table, counters + 1, sort_keys=[("n", "descending")])
    fall = table["n"][order[counters].as_py()].as_py()
    table = table.filter(pc.greater(table["n"], fall))
    return table.set_column(1, "n", pc.subtract(table["n"], fall)), fall


def _table(term: pa.Array, n: pa.Array) -> pa.Table:
    return pa.table({"term": term.cast(pa.string()), "n": n.cast(pa.int64())})


def _summarise(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, error, waiting, size = _table(pa.array([], pa.string()), pa.array([], pa.int64())), 0, [], 0

        def fold() -> None:
            nonlocal held, error
            counted = pc.value_counts(pa.chunked_array(waiting, pa.string()).drop_null().combine_chunks())
            held, fall = trimmed(pa.concat_tables([held, _table(counted.field("values"), counted.field("counts"))]), counters)
            error += fall
            waiting.clear()

        for batch in batches:
            waiting.append(batch.column(0).flatten().cast(pa.string()))
            size += len(waiting[-1])
            if size >= TOGETHER:
                fold()
                size = 0
        if waiting:
            fold()
        yield from _rows(TaskContext.get().partitionId(), held, error).to_batches()

    return run


def _rows(node: int, held: pa.Table, error: int) -> pa.Table:
    """A summary as rows; the one without a term holds its error."""
    terms = pa.concat_arrays([*held["term"].chunks, pa.array([None], pa.string())])
    numbers = pa.concat_arrays([*held["n"].chunks, pa.array([error], pa.int64())])
    return pa.table([pa.array([node] * len(terms), pa.int64()), terms, numbers], names=_NAMES)


def _merge(counters: int):
    def run(group: pa.Table) -> pa.Table:
        own = pc.is_null(group["term"])
        held, fall = trimmed(group.filter(pc.invert(own)).select(["term", "n"]), counters)
        return _rows(group["node"][0].as_py() // FAN, held, pc.sum(group.filter(own)["n"]).as_py() + fall)

    return run


def _occurrences(df: DataFrame, terms: str) -> DataFrame:
    """A row per occurrence: a batch of rows is as long as terms are, whatever the texts' lengths."""
    return _lists(df, terms).select(F.explode("terms").alias("term"))


def _lists(df: DataFrame, terms: str) -> DataFrame:
    """Rows of at most `IN_ROW` occurrences, which cost a task far less than a row each, and a batch of
    rows is bounded as well. Generators get outer form, so that no size filter is inferred."""
    at = F.when(F.size(terms) > 0, F.sequence(F.lit(0), F.floor((F.size(terms) - 1) / IN_ROW).cast("int")))
    each = F.transform(at, lambda i: F.slice(terms, i * IN_ROW + 1, IN_ROW))
    return df.select(F.explode_outer(each).alias("terms"))


def summary(df: DataFrame, terms: str, counters: int) -> tuple[list[str], int]:
    """At most `counters` terms of the array column `terms`, and the count that no other term exceeds."""
    nodes, rows = df.rdd.getNumPartitions(), _lists(df, terms).mapInArrow(_summarise(counters), _SUMMARY)
    while True:
        rows = rows.groupBy((F.col("node") / FAN).cast("long").alias("up")).applyInArrow(_merge(counters), _SUMMARY)
        nodes = -(-nodes // FAN)
        if nodes <= 1:
            break
    found = rows.toPandas()
    is_term = found["term"].notna()
    return sorted(found["term"][is_term]), int(found["n"][~is_term].sum())


def count_model(names: list[str], terms: str, out: str) -> CountVectorizerModel:
    """`from_vocabulary`, which hands the names to the JVM one call each, in one call for all."""
    if "" in names or any("\n" in name for name in names):
        return CountVectorizerModel.from_vocabulary(names, inputCol=terms, outputCol=out)
    array = SparkContext._active_spark_context._jvm.org.apache.commons.lang3.StringUtils.split("\n".join(names), "\n")
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    return model.setInputCol(terms).setOutputCol(out)._set(vocabSize=len(names))


def exact_counts(df: DataFrame, terms: str, names: list[str]) -> pd.DataFrame:
    """term, n_total and n_docs of the named terms: one pass, a row per name and task in the shuffle."""
    given = df.select(F.coalesce(terms, F.array().cast("array<string>")).alias(terms))
    vectors = count_model(names, terms, "_v").transform(given)
    v = F.unwrap_udt("_v")
    cells = vectors.select(F.inline(F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("n"))))
    found = cells.groupBy("idx").agg(F.sum("n").cast("long").alias("n_total"), F.count(F.lit(1)).alias("n_docs")).toPandas()
    found.insert(0, "term", [names[i] for i in found.pop("idx")])
    return found


def most_frequent(df: DataFrame, terms: str, most: int, most_docs: float = float("inf")) -> list[Row]:
    """(term, n_total, n_docs) of the `most` terms with the highest totals among those in at most
    `most_docs` rows; ties by term. Exact.

    `df` is read twice and should be written. The summary's error proves that nothing is missing: a
    term outside it occurs no more often than that. If the last term taken does not occur more
    often, the summary gets four times the counters.
    """
    counters = max(1, COUNTERS * most)
    while True:
        names, error = summary(df, terms, counters)
        if not names:
            return []
        found = exact_counts(df, terms, names)
        found = found[found["n_docs"] <= most_docs]
        found = found.assign(key=[t.encode() for t in found["term"]]).sort_values(["n_total", "key"], ascending=[False, True])
        if not error or len(found) >= most and found["n_total"].iloc[most - 1] > error:
            kept = found.head(most)
            return [Row(term=t, n_total=int(n), n_docs=int(d)) for t, n, d in zip(kept["term"], kept["n_total"], kept["n_docs"])]
        counters *= 4
