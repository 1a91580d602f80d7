"""Bag-of-words features: vocabulary, TF-IDF, scaling.

Fitting a vocabulary shuffles summaries of bounded size (`frequent`). Everything after it works
inside a row, against a vocabulary of at most `max_features` terms.
"""

from __future__ import annotations

import math
import sys

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.functions.stem import stem_words
from verdex.functions.stem_rules import STEPS
from verdex.functions.text import ngrams, tokens, vectoriser_tokens
from verdex.operators.frequent import most_frequent
from verdex.runtime import cut

MAX_FEATURES = 1500
MAX_DF = 0.95


def with_grams(df: DataFrame, text: str, out: str = "grams", stem: bool = True) -> DataFrame:
    """Adds the 1- and 2-grams of the (stemmed) text. Each stage is a projection; no shuffle."""
    return with_words(df, text, stem).withColumn(out, ngrams(F.col("_words"))).drop("_words")


def written_grams(df: DataFrame, text: str, out: str = "grams", stem: bool = True) -> DataFrame:
    """As `with_grams`, without the text, for many passes: the words are written once, joined by blanks,
    which no word holds. Grams are several times longer and are cheaper made again than read."""
    worded = with_words(df, text, stem).withColumn("_words", F.concat_ws(" ", "_words"))
    kept = cut(worded.select(*[c for c in df.columns if c != text], "_words"))
    split = F.when(F.col("_words") != "", F.split("_words", " ")).otherwise(F.array().cast("array<string>"))
    return kept.withColumn("_words", split).withColumn(out, ngrams(F.col("_words"))).drop("_words")


def with_words(df: DataFrame, text: str, stem: bool = True) -> DataFrame:
    """Adds `_words`, the (stemmed) words as a vectoriser reads them."""
    staged = df.withColumn("_words", tokens(F.col(text)))
    if stem:
        staged = staged.withColumn("_words", stem_words("_words"))
    return staged.withColumn("_words", vectoriser_tokens(F.col("_words")))


def stem_vocab(df: DataFrame, words: str, steps=STEPS) -> DataFrame:
    """(token, stem) for every distinct token; each is stemmed once.

    The outer generator keeps Spark from inferring a size filter, for which it would compute the
    token array a second time.
    """
    each = df.select(F.explode_outer(words).alias("token")).where(F.col("token").isNotNull())
    return each.distinct().select("token", stem_words("array(token)", steps)[0].alias("stem"))


def gram_counts(df: DataFrame, grams: str) -> DataFrame:
    """(term, n_total, n_docs) of every term, in one pass with partial counts before the shuffle.

    The grams of a row are sorted, so a gram that differs from the one before it marks the row as
    one more document with that gram.
    """
    ordered = df.select(F.sort_array(grams).alias("g"))
    head = F.slice("g", F.lit(1), F.greatest(F.size("g") - 1, F.lit(0)))
    before = F.concat(F.array(F.lit(None).cast("string")), head)
    pairs = ordered.select(F.inline(F.arrays_zip(F.col("g").alias("term"), before.alias("before"))))
    return pairs.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~F.col("term").eqNullSafe(F.col("before"))).alias("n_docs"),
    )


def vocabulary(
    df: DataFrame, grams: str, max_df: float = MAX_DF, max_features: int = MAX_FEATURES
) -> DataFrame:
    """(term, idx, n_total, n_docs, idf): the `max_features` most frequent terms that occur in at
    most a `max_df` share of the rows; ties by term, indexed in term order.

    `df` should be a written table: it is read once for the summaries and once for the exact counts.
    """
    n_rows = df.count()
    kept = sorted(most_frequent(df, grams, max_features, max_df * n_rows), key=lambda r: r.term.encode())
    rows = [(r.term, i, r.n_total, r.n_docs, math.log((1 + n_rows) / (1 + r.n_docs)) + 1) for i, r in enumerate(kept)]
    return df.sparkSession.createDataFrame(rows, "term string, idx int, n_total long, n_docs long, idf double")


def fit_tfidf(
    df: DataFrame, grams: str = "grams", out: str = "features",
    max_df: float = MAX_DF, max_features: int = MAX_FEATURES, scale: bool = False,
) -> tuple[PipelineModel, list[str]]:
    """Row-wise TF-IDF (raw count x smooth idf, L2 norm) and its terms, in vector order."""
    terms = vocabulary(df, grams, max_df, max_features).orderBy("idx").select("term", "idf").collect()
    if not terms:
        raise ValueError("no term is left for the vocabulary")
    counts = CountVectorizerModel.from_vocabulary(
        [t.term for t in terms], inputCol=grams, outputCol="_counts"
    )
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([t.idf for t in terms]), inputCol="_counts", outputCol="_weighted"
    )
    stages = [counts, weigh, Normalizer(p=2.0, inputCol="_weighted", outputCol="_unit" if scale else out)]
    model = PipelineModel(stages=stages)
    if scale:
        model = PipelineModel(stages=[*stages, fit_scaling(model.transform(df), "_unit", out)])
    return model, [t.term for t in terms]


def column_stats(df: DataFrame, vectors: str) -> tuple[int, list[float], list[float]]:
    """(rows, mean, population variance) of the columns of sparse vectors.

    The stored entries are summed by column, combined before the shuffle: a row per column and task,
    not a dense buffer. Entries that are not stored are zeros and are added by formula.
    """
    v = F.unwrap_udt(vectors)
    n, size = df.agg(F.count(F.lit(1)), F.max(v["size"])).first()
    cells = df.select(F.inline(F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("value"))))
    stats = cells.groupBy("idx").agg(F.count(F.lit(1)).alias("k"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    mean, variance = [0.0] * (size or 0), [0.0] * (size or 0)
    for r in stats.collect():  # at most a row per column
        mean[r.idx] = r.m * r.k / n
        variance[r.idx] = (r.k * r.v + r.k * (n - r.k) / n * r.m**2) / n
    return n, mean, variance


def fit_scaling(df: DataFrame, vectors: str, out: str) -> ElementwiseProduct:
    """Division by the population standard deviation, without centring; constants stay as they are."""
    n, mean, variance = column_stats(df, vectors)
    eps = sys.float_info.epsilon
    factors = []
    for m, v in zip(mean, variance):
        constant = v <= n * eps * v + (n * m * eps) ** 2  # no more than rounding noise
        factors.append(1.0 if constant else v**-0.5)
    return ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=vectors, outputCol=out)


def vector_cells(df: DataFrame, key: str, vectors: str) -> DataFrame:
    """(key, idx, value) for the stored entries of sparse vectors."""
    parts = df.select(key, F.unwrap_udt(vectors).alias("v"))
    cells = F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("value"))
    return parts.select(key, F.inline(cells))


def tfidf_terms(
    df: DataFrame, key: str, grams: str, max_df: float = MAX_DF, max_features: int = MAX_FEATURES,
    scale: bool = False,
) -> DataFrame:
    """TF-IDF in long form: (key, term, value)."""
    model, terms = fit_tfidf(df, grams, "_tfidf", max_df, max_features, scale)
    names = F.split(F.lit("\n".join(terms)), "\n")  # folded to one constant array
    cells = vector_cells(model.transform(df.select(key, grams)), key, "_tfidf")
    return cells.select(key, F.element_at(names, F.col("idx") + 1).alias("term"), "value")
