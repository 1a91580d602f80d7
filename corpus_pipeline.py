"""The corpus pipeline: `documents` through five stages, each written and read again.

Language ID rejects documents without a language; of near copies one document stays; documents that
hold a benchmark item go; secrets are masked; what is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdex.llm import decontaminate, jaccard, language, packing, secrets
from verdex.llm.common import small, stored

#: A document is rejected if fewer of its n-grams belong to the language found than this share of what
#: that language's filter covers of its own training texts (little where a script has many characters).
LEAST_SUPPORT = 0.3
#: Document ids up to which they are broadcast; more are joined by shuffle.
BROADCAST_IDS = 200_000

_KEY = "_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc): each row of `docs` as one struct, so that its columns clash with none, and a key of it.

    The key is a 64-bit hash of id and text. Ids may be null or repeated; only rows with the same id
    and the same text share a key.
    """
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    return docs.select(key.alias(_KEY), F.struct(*docs.columns).alias("doc"))


def _by_key(keyed: DataFrame) -> DataFrame:
    """What the operators read, under the key instead of the id."""
    return keyed.select(F.col(_KEY).alias("doc_id"), F.col("doc.text").alias("text"))


def _without(keyed: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of `keyed` whose key is not in `dropped` (a column of keys), as they came."""
    gone = stored(dropped.toDF("_gone").distinct(), "dropped")
    return keyed.join(small(gone, BROADCAST_IDS), F.col(_KEY) == F.col("_gone"), "left_anti").select("doc.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known, learned from the column `lang`.

    Rejected: null text, no letters, or too few n-grams of any language. Repeated rows are judged
    each. If no row has a language, nothing can be learned and every row with letters stays.
    """
    filters = language.fit(docs)
    if not filters.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), filters)
    limits = F.create_map(*[F.lit(x) for lang, c in zip(filters.languages, filters.coverage) for x in (lang, LEAST_SUPPORT * c)])
    known = F.col("lang_pred") != language.UNKNOWN
    return judged.where(known & (F.col("support") >= limits[F.col("lang_pred")])).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the document with the smallest id, null ids last.

    Rows that repeat an id, or have none, are judged each by its own text; among them the smallest hash
    of the text stays. Of rows with the same id and text one stays, the smallest by the other columns.
    Texts without words have no copies.
    """
    keyed = _keyed(docs)
    groups = stored(jaccard.near_groups(_by_key(keyed)).select(F.col("doc_id").alias(_KEY), "component_id"), "groups")
    repeated = groups.groupBy(F.col(_KEY).alias("_again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_again")
    repeated = stored(repeated, "repeated")
    # a component's smallest key names it, and its own row has that key
    linked = groups.where(F.col(_KEY) != F.col("component_id")).distinct()
    members = stored(linked.unionByName(linked.select(F.col("component_id").alias(_KEY), "component_id").distinct()), "members")
    named = keyed.select(F.col("doc.doc_id").alias("doc_id"), _KEY).join(small(members, BROADCAST_IDS), _KEY)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _KEY))
    stays = stored(named.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{_KEY}").alias("_stays")), "stays")
    dropped = members.join(small(stays, BROADCAST_IDS), F.col(_KEY) == F.col("_stays"), "left_anti").select(_KEY)
    if not repeated.isEmpty():  # equal rows are rare as a rule, and then no text is moved
        match, keys = F.col(_KEY) == F.col("_again"), small(repeated, BROADCAST_IDS)
        equal = keyed.join(keys, match, "left_semi").groupBy(_KEY).agg(F.min("doc").alias("doc"))
        keyed = keyed.join(keys, match, "left_anti").unionByName(equal)
    return _without(keyed, dropped)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold an item of the table `benchmark`; others of the same or no id stay.

    Null and empty texts hold none and stay; equal rows go or stay together; an empty table drops none.
    """
    items, keyed = spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _keyed(docs)
    return _without(keyed, decontaminate.find_leaks(_by_key(keyed), items).select("doc_id"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; `n_chars` is counted anew where a text holds the mask.

    Rows are masked by their own secrets, whatever their ids.
    """
    keyed = _keyed(docs)
    found = secrets.find_secrets(_by_key(keyed))
    own = keyed.select(F.col(_KEY).alias("doc_id"), F.col("doc.text").alias("text"), "doc")
    masked = secrets.redact(own, found)
    masked = masked.select(*[F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
    changed = F.contains("text", F.lit(secrets.MASK))
    return masked.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 tokens: sequence_id, n_tokens, padded_to, ids, pieces.

    A null or empty text is its end token alone; repeated rows are packed each; other columns are ignored.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("secret_scan", secret_scan),
    ("pack", pack),
]

#: SimHash, forest and tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's sequences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
