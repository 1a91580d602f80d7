"""Benchmark decontamination by SimHash.

For each benchmark item the windows of as many words are taken from the documents. A window's
fingerprint is the 64-bit SimHash of its five-word shingles. All fingerprints within a Hamming radius
are found by multi-index blocks: with one block more than the radius, two fingerprints within it agree
in at least one whole block, so an equality join on blocks misses none. What is found is verified
exactly by the weighted Jaccard similarity of the shingles (weight: how often a shingle occurs).

A window without any shingle of an item of its size has similarity 0 with all of them, so only
windows around such shingles are fingerprinted; equal windows are fingerprinted once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdex.llm.common import pinned, small, stored

SHINGLE, PERCENT = 5, 80
#: Similarity 0.8 means about 9.7 differing bits of 64, with a deviation of 2.9.
RADIUS = 20
#: Benchmark shingles, block rows and document seeds up to which they are broadcast.
BROADCAST_ROWS = 500_000

_NO_ID = -(2**63)


def word_list(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")


def grams(hashes: Column, k: int) -> Column:
    """Hash of each run of `k` words, given an array column of word hashes; empty if there are fewer."""
    n = F.size(hashes) - k
    at = F.when(n >= 0, F.sequence(F.lit(0), F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))


def with_simhash(df: DataFrame, shingles: str) -> DataFrame:
    """Add `fingerprint`: the 64-bit SimHash of an array column of 64-bit hashes. A bit is set if more
    than half of the hashes have it.

    Four bits at a time are counted in the 16-bit lanes of a number, which hold up to 65,535 hashes;
    the bits of longer arrays are counted one by one.
    """
    call, zero, bits = F.call_function, F.lit(0).cast("long"), F.sequence(F.lit(0), F.lit(63))
    # bit j of a nibble goes to bit 16 * j
    spread, ones = F.lit((1 << 45) | (1 << 30) | (1 << 15) | 1), F.lit(0x0001000100010001)

    def lane(shift: int) -> Column:
        add = lambda a, x: a + (F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(15)) * spread).bitwiseAND(ones)
        return F.aggregate(shingles, zero, add)

    lanes = F.array(*[lane(shift) for shift in range(0, 64, 4)])
    few = F.transform(bits, lambda b: call(
        "shiftrightunsigned", F.get("_lanes", (b / 4).cast("int")), (16 * (b % 4)).cast("int")
    ).bitwiseAND(F.lit(0xFFFF)))
    many = F.transform(bits, lambda b: F.aggregate(
        shingles, zero, lambda a, x: a + call("shiftrightunsigned", x, b).bitwiseAND(F.lit(1))
    ))
    small_enough = F.size(shingles) <= 65_535
    counted = pinned(df, _lanes=F.when(small_enough, lanes))
    counted = pinned(counted, _counts=F.when(small_enough, few).otherwise(many))
    print_ = F.aggregate(bits, zero, lambda a, b: F.when(
        2 * F.get("_counts", b) > F.size(shingles), a.bitwiseOR(call("shiftleft", F.lit(1).cast("long"), b))
    ).otherwise(a))
    return pinned(counted, fingerprint=print_).drop("_lanes", "_counts")


def blocks(fingerprint: Column, radius: int) -> Column:
    """The fingerprint cut into radius + 1 blocks: an array of (block, bits)."""
    n = radius + 1
    ends = [64 * i // n for i in range(n + 1)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
        for i, (a, b) in enumerate(zip(ends, ends[1:]))
    ])


def shared_weight(a: str, b: str) -> Column:
    """Sum over all shingles of the smaller count in the arrays `a` and `b`."""
    both = F.array_intersect(a, b)
    single = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda c, x: F.size(F.filter(c, lambda y: y == x))
    counted = F.aggregate(both, F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    return F.when(single, F.size(both)).otherwise(counted)


def _words_of(df: DataFrame, *keep: str) -> DataFrame:
    return pinned(df.select(*keep, "text"), hashes=F.transform(word_list(F.col("text")), lambda x: F.xxhash64(x))).drop("text")


def _grams_of(df: DataFrame, k: int) -> DataFrame:
    return pinned(df, grams=grams(F.col("hashes"), k))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, percent: int = PERCENT, radius: int = RADIUS
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    `docs`: doc_id, text; `benchmark`: item_id, text. Columns: doc_id, item_id, start_word, n_words,
    hamming, similarity; one row per pair, for the most similar window (the first of several). A
    window is as long as the item, or the whole document if that is shorter. Words are lower-cased
    runs of letters, marks and digits; an item of fewer than `k` words is one shingle of its length.

    Null texts and texts or items without words are in no pair. Repeated rows and ids give one pair
    per doc_id and item_id; a null id is reported as null. Empty tables give an empty result; other
    columns are ignored.
    """
    # a key of id and text, so that what is gathered per key is bounded by one text
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    own = docs.select(key.alias("doc"), F.col("doc_id").cast("long").alias("id"), "text")
    named = benchmark.select(F.coalesce("item_id", F.lit(_NO_ID)).cast("long").alias("item"), "text")
    items = _words_of(named, "item").where(F.size("hashes") > 0).select(
        "item", "hashes", F.size("hashes").alias("w"), F.least(F.size("hashes"), F.lit(k)).alias("k")
    )
    items = stored(items, "items")
    lengths = [r[0] for r in items.select("k").distinct().orderBy("k").collect()]  # at most `k` numbers
    if not lengths:
        empty = "doc_id long, item_id long, start_word int, n_words int, hamming int, similarity double"
        return docs.sparkSession.createDataFrame([], empty)

    windows, targets = [], []
    for m in lengths:
        of = stored(with_simhash(_grams_of(items.where(F.col("k") == m).drop("k"), m), "grams").drop("hashes"), "item_grams")
        targets.append(of)
        sizes = of.select(F.explode("grams").alias("gram"), "w").distinct().groupBy("gram").agg(F.collect_set("w").alias("ws"))
        places = _grams_of(_words_of(own, "doc"), m).select("doc", F.posexplode("grams").alias("pos", "gram"))
        seeds = (
            places.join(small(sizes, BROADCAST_ROWS), "gram").select("doc", "pos", F.explode("ws").alias("w"))
            .groupBy("doc", "w").agg(F.collect_set("pos").alias("at"))
            .groupBy("doc").agg(F.collect_list(F.struct("w", "at")).alias("seeds"))
        )
        seeds = stored(seeds, "seeds")
        near = own.join(small(seeds, BROADCAST_ROWS // 10), "doc")
        near = _grams_of(_words_of(near, "doc", "id", "seeds"), m)
        # every start of a window that holds a seed and lies inside the document
        last = F.greatest(F.size("hashes") - F.col("s.w"), F.lit(0))
        starts = F.array_distinct(F.flatten(F.transform("s.at", lambda p: F.sequence(
            F.greatest(p - (F.col("s.w") - m), F.lit(0)), F.least(p, last)
        ))))
        here = near.select("id", "hashes", "grams", F.explode("seeds").alias("s")).select(
            "id", "grams", F.col("s.w").alias("w"), F.explode(starts).alias("start")
        )
        cut = F.slice("grams", F.col("start") + 1, F.greatest(F.col("w") - (m - 1), F.lit(1)))
        windows.append(stored(pinned(here.select("id", "w", "start", cut.alias("grams")), key=F.xxhash64("grams")), "windows"))

    unite = lambda frames: reduce(DataFrame.unionByName, frames)
    window, target = unite(windows), unite(targets)
    prints = stored(with_simhash(window.select("w", "key", "grams").dropDuplicates(["w", "key"]), "grams"), "fingerprints")
    block = lambda df, *keep: df.select(*keep, "fingerprint", F.inline(blocks(F.col("fingerprint"), radius)))
    of_items = block(target, "item", "w").withColumnRenamed("fingerprint", "item_print")
    close = (
        block(prints, "w", "key")
        .join(small(of_items, BROADCAST_ROWS), ["w", "block", "bits"])
        .withColumn("hamming", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))))
        .where(F.col("hamming") <= radius)
        .select("w", "key", "item", "hamming").distinct()
    )
    pairs = prints.select("w", "key", "grams").join(close, ["w", "key"]).join(
        small(target.select("item", F.col("grams").alias("item_grams")), BROADCAST_ROWS // 10), "item"
    )
    shared = shared_weight("grams", "item_grams")
    verified = (
        pinned(pairs, shared=shared, all=F.size("grams") + F.size("item_grams"))
        .where(100 * F.col("shared") >= percent * (F.col("all") - F.col("shared")))
        .select("w", "key", "item", "hamming", (F.col("shared") / (F.col("all") - F.col("shared"))).alias("similarity"))
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("at"), "w", "hamming"))
    return (
        window.select("id", "w", "key", "start").join(verified, ["w", "key"])
        .groupBy("id", "item").agg(best.alias("m"))
        .select(
            F.col("id").alias("doc_id"), F.nullif("item", F.lit(_NO_ID)).alias("item_id"),
            (-F.col("m.at")).alias("start_word"), F.col("m.w").alias("n_words"), F.col("m.hamming").alias("hamming"),
            F.col("m.similarity").alias("similarity"),
        )
    )
