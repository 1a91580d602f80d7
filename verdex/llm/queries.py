"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdex.llm import (
    alignment, chat, decontaminate, jaccard, language, packing, quality, runs, secrets, substrings, topk, toxicity, urls,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens: one row per piece."""
    return packing.pieces_of(packing.pack(table(spark, sf_dir, "documents")))


@query
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the fixed rules and its aliases."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation's formatted text, read back, and of a planted one."""
    text = "<|im_end|><|im_start|>assistant ok"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.segments(turns.unionByName(planted)))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and line-frequency verdict of every document."""
    return quality.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return language.predict(docs.select("doc_id", "text"), filters).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "support"
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    # the fit takes so many labelled documents at most: choosing them first spares moving the texts
    sample = toxicity.sample(labels.where(~language.held_out(F.col("doc_id"))))
    model = toxicity.fit(docs.join(F.broadcast(sample), "doc_id"))
    return toxicity.score(docs, model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left in every document without the 50-byte strings of smaller ids."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy component of every document."""
    return jaccard.near_groups(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key-like string of every document and whether it is a secret; never the string itself."""
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "number", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"),
        "probability", "is_secret",
    )


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by both tokenizers aligned, with the corpus counts of its linked pairs."""
    found = alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


@query
def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them with a planted one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tail, period = runs.planted_run(F.col("doc_id"), runs.n_words(F.col("text")))
    return runs.digests(runs.periodic_runs(docs, tail, period))
