"""Toxicity by multiple-instance learning.

Only documents are labelled, but sentences are what offends. A sentence's probability is a logistic
function of hashed word and character n-gram features; a document's is the noisy-or of its
sentences'. Training fits the sentence model to the document labels; afterwards the same sentence
probabilities point at the offending sentences. A sentence without any word of weight has no evidence
and cannot offend; otherwise the many harmless sentences of a long text would add up.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURE_BITS = 18
#: n-grams inside a word, its ends marked.
NGRAMS = (3, 4, 5)
#: Documents that the model is fitted on at most (chosen by a hash of the id), and the longest one
#: taken, in characters; scoring has no such bounds.
TRAIN_DOCS, TRAIN_CHARS = 6000, 60_000
STEPS, RATE, DECAY = 200, 0.1, 1e-3
#: A feature is used if the share of documents that have it differs between the labels by so many
#: standard errors; the many others would only fit the sample's noise.
LEAST_Z = 6.0
THRESHOLD = 0.3
#: Distinct words whose weight a task remembers.
REMEMBERED = 500_000
#: Characters handled at once.
PIECE = 1 << 20

_TOKEN = re.compile(r"\w+|[.!?\n]")
_END = frozenset(".!?\n")


def features(word: str) -> list[int]:
    """Numbers of a lower-cased word's features: the word and its n-grams, each once."""
    marked = f"<{word}>"
    parts = {marked[i : i + k] for k in NGRAMS for i in range(len(marked) - k + 1)} | {"=" + word}
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1) for x in parts]


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray

    def word(self, word: str) -> float:
        return float(self.weights[features(word)].sum())


class Words(dict):
    """Weight of each word under a model; marks of a sentence's end weigh nothing."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = 0.0 if word in _END else self.model.word(word)
        return value


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Spans of a text's sentences: up to and with `.`, `!`, `?` or a line feed; only those with a word."""
    begin = 0
    for m in re.finditer(r"[.!?\n]+|\Z", text):
        if re.search(r"\w", text[begin : m.end()]):
            yield begin, m.end()
        begin = m.end()


def _logits(tokens: list[str], known: Words) -> np.ndarray:
    """Logit of each sentence with evidence, in a token list: the bias and the weights of its words."""
    ends = np.fromiter((t in _END for t in tokens), dtype=bool, count=len(tokens))
    weights = np.fromiter(map(known.__getitem__, tokens), dtype=float, count=len(tokens))
    number = np.cumsum(ends) - ends
    evidence = np.bincount(number, weights=weights != 0) > 0
    return known.model.bias + np.bincount(number, weights=weights)[evidence]


def score_text(text: str | None, known: Words) -> float:
    """Noisy-or over the sentences of a whole text; 0 without one that has evidence."""
    lower, log_clean, begin = (text or "").lower(), 0.0, 0
    while begin < len(lower):
        end = min(len(lower), begin + PIECE)
        if end < len(lower):  # cut behind a sentence; one longer than a piece is cut where it is
            end = max(lower.rfind(x, begin, end) for x in ".\n!?") + 1 or end
            end = end if end > begin else begin + PIECE
        tokens = _TOKEN.findall(lower, begin, end)
        if tokens:
            log_clean -= float(np.logaddexp(0, _logits(tokens, known)).sum())
        begin = end
    return float(-np.expm1(log_clean)) if log_clean else 0.0


def sample(labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of `labels` (doc_id, label) that `fit` would take first: those with the smallest hash."""
    known = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    return known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "label").limit(train_docs)


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model:
    """Fit the sentence model to document labels.

    `labelled`: doc_id, text, label (1 or 0; other rows are ignored). At most `train_docs` documents
    of at most `train_chars` characters are used, those with the smallest hash of the id; the fit is
    a full-batch gradient descent on the log loss of the noisy-or. Without both labels the model
    has no evidence, and all scores are 0.
    """
    rows = (
        labelled.where(F.col("label").isin(0, 1) & F.col("text").isNotNull() & (F.length("text") <= train_chars))
        .select(F.col("label").cast("int").alias("label"), "text", F.xxhash64(F.col("doc_id").cast("string")).alias("at"))
        .orderBy("at", "text", "label").limit(train_docs).toPandas()
    )
    y = rows.label.to_numpy(dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return Model(-10.0, np.zeros(1 << FEATURE_BITS))
    size, known, counts = 1 << FEATURE_BITS, {}, np.zeros((2, 1 << FEATURE_BITS))
    texts = [text.lower() for text in rows.pop("text")]
    for label, text in zip(y.astype(int), texts):
        found = set(re.findall(r"\w+", text))
        known.update((word, np.array(features(word), dtype=np.int32)) for word in found if word not in known)
        if found:
            counts[label, np.unique(np.concatenate([known[word] for word in found]))] += 1
    n0, n1 = float((y == 0).sum()), float((y == 1).sum())
    share = counts.sum(axis=0) / len(y)
    error = np.sqrt(np.maximum(share * (1 - share), 1 / len(y) ** 2) * (1 / n0 + 1 / n1))
    used = np.abs(counts[1] / n1 - counts[0] / n0) >= LEAST_Z * error

    # sentences with evidence: the used features of their distinct words
    pair_sentence, pair_feature, doc_of = array("i"), array("i"), array("i")
    used_of = {word: x[used[x]].tolist() for word, x in known.items()}
    del known
    for doc, text in enumerate(texts):
        for a, b in sentences(text):
            found = [x for word in set(re.findall(r"\w+", text[a:b])) for x in used_of[word]]
            if found:
                pair_feature.extend(found)
                pair_sentence.extend([len(doc_of)] * len(found))
                doc_of.append(doc)
    if not doc_of:
        return Model(-10.0, np.zeros(size))
    sentence, flat, doc = (np.array(x, dtype=np.int32) for x in (pair_sentence, pair_feature, doc_of))

    weights, bias = np.zeros(size), -4.0
    m, s, mb, sb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, STEPS + 1):
        logit = bias + np.bincount(sentence, weights=weights[flat], minlength=len(doc))
        log_clean = -np.bincount(doc, weights=np.logaddexp(0, logit), minlength=len(y))
        clean = np.exp(log_clean)
        # d loss / d logit: p for label 0, -p * clean / (1 - clean) for label 1
        factor = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        slope = factor[doc] / (1 + np.exp(-logit)) / len(y)
        g = np.bincount(flat, weights=slope[sentence], minlength=size) + DECAY * weights / len(y)
        gb = float(slope.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
        c, d = 1 - 0.9**step, 1 - 0.999**step
        weights -= RATE * (m / c) / (np.sqrt(s / d) + 1e-9)
        bias -= RATE * (mb / c) / (np.sqrt(sb / d) + 1e-9)
    return Model(float(bias), weights)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= `threshold`) of every row of `docs`.

    Whole texts of any length. Null and empty texts and texts without evidence score 0. Repeated rows
    and ids are scored each; an empty table gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))

    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Words(Model(*shared.value))
        for batch in texts:
            yield pd.Series([score_text(x, known) for x in batch], dtype=float)

    scored = docs.select("doc_id", F.pandas_udf(judge, "double")("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def locate(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Offending sentences: doc_id, begin, end (code points of the text), sentence, score.

    A row for each sentence whose own probability is at least `threshold`; others give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words(Model(*shared.value))
        for batch in batches:
            out = []
            for doc, text in zip(batch.doc_id, batch.text):
                for a, b in sentences(text or ""):
                    weights = [known[t] for t in _TOKEN.findall(text[a:b].lower()) if t not in _END]
                    p = 1 / (1 + np.exp(-(known.model.bias + sum(weights)))) if any(weights) else 0.0
                    if p >= threshold:
                        out.append((doc, a, b, text[a:b], p))
            yield pd.DataFrame(out, columns=["doc_id", "begin", "end", "sentence", "score"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(find, "doc_id long, begin long, end long, sentence string, score double")
