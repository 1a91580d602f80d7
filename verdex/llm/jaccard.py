"""N-gram Jaccard join by vertical partitioning.

All shingles have one global order, rare ones first. Documents with the same set are one class. Two
classes can only be similar if they share a shingle among the first of each (prefix filter), so those
prefixes are the candidate index. Candidates are verified by vertical partitioning: the global order
is cut into fragments, each set into its segments, the overlap of a pair is counted fragment by
fragment and summed per pair.

What is asked for are the components under the links, so a group of n near copies need not be spelt
out as n * n pairs: first each class is compared with one partner it shares a prefix shingle with,
then only pairs of different components are left. In a shingle's group these are the members outside
its largest component against all others; when that is still far more than the index, further rounds
of a few partners each come first. The last round compares every pair that is left and whose shared
prefix shingles can suffice, so no link between different components is missed.

Each class has a mark of parity bits. Two sets' marks differ in at most as many bits as the sets have
shingles that are not common to both, so pairs whose marks differ in more than a link allows are ruled
out where they meet, without their shingles.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdex.llm.common import components, discard, pieces, stored, tree_sum
from verdex.llm.shingles import Hasher, shingle_set

SHINGLE, PERCENT = 5, 80
#: Shingles are counted by so many bits of their hash; the table of counts is the size of this alone.
COUNT_BITS = 22
FRAGMENTS = 3
#: Pairs left to compare, per row of the candidate index, above which another round of one partner
#: each comes first.
LEFT_PER_ROW = 2
MAX_ROUNDS = 6
#: Share of the pairs left at which a round has not helped.
LEAST_FALL = 0.7
#: Partners of a class in a round, but for the first.
PARTNERS = 8
#: Words of 64 bits in a class's mark. Marks of random sets differ in half their bits, so this many
#: rule out most pairs of up to about 2,000 shingles, and fewer of larger ones.
MARK_WORDS = 16
#: Up to so many document keys are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 500_000

#: Cells that are ranked at a time.
RANKED_AT_ONCE = 1 << 16

_TOP = np.iinfo(np.int64).max
_COUNT_MASK = np.uint64((1 << COUNT_BITS) - 1)


def needed_overlap(n: int, percent: int) -> int:
    """Fewest shingles a set of `n` shares with a set that it links to."""
    return -(-percent * n // 100)


def similar(shared, n, m, percent: int):
    """Whether sets of `n` and `m` with `shared` in common link (numbers or columns)."""
    return 100 * shared >= percent * (n + m - shared)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else df


def _digest(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - 2**63


def mark_of(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each of the mark's bits."""
    odd = np.bincount((s >> np.uint64(40)) % np.uint64(64 * MARK_WORDS), minlength=64 * MARK_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_link(mark_a: str, mark_b: str, percent: int) -> Column:
    """Whether the marks of two classes of n_a and n_b shingles allow a link."""
    apart = sum((F.bit_count(F.col(mark_a)[i].bitwiseXOR(F.col(mark_b)[i])) for i in range(MARK_WORDS)), F.lit(0))
    both = F.col("n_a") + F.col("n_b")
    return apart <= both - 2 * F.ceil(percent * both / (100 + percent) - 1e-9)


_MEASURED = "doc long, n long, class long, mark array<long>, node long, piece long, counts binary"


def _measure(k: int):
    """Size and digest of each set, and how many sets have the shingles of each count cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, counts = Hasher(), np.zeros(1 << COUNT_BITS, dtype=np.int32)
        for batch in batches:
            rows, cells, waiting = [], [], 0
            for text in batch.text:
                s = shingle_set(hasher.words(text, True), k)
                cells.append((s & _COUNT_MASK).astype(np.int32))
                waiting += len(s)
                if waiting > 1 << 20:
                    np.add.at(counts, np.concatenate(cells), 1)
                    cells, waiting = [], 0
                rows.append((len(s), _digest(s), mark_of(s)))
            if cells:
                np.add.at(counts, np.concatenate(cells), 1)
            size, digest, mark = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"doc": batch.doc, "n": size, "class": digest, "mark": mark, "node": pd.NA, "piece": pd.NA, "counts": None})
        yield pieces(counts).assign(doc=pd.NA, n=0, mark=None, **{"class": 0})

    def typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in run(batches):
            x = x.astype({"doc": "Int64", "n": "int64", "class": "int64", "node": "Int64", "piece": "Int64"})
            yield x[["doc", "n", "class", "mark", "node", "piece", "counts"]]

    return typed


def global_order(counts: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of shingles, by the count of their cell and then by hash: the cells' ranks, and the
    places that cut it into fragments of about equal weight. Besides the result nothing as long as
    `counts` is held."""
    value, places = Counter(), range(0, len(counts), RANKED_AT_ONCE)
    for begin in places:
        value.update(dict(zip(*(x.tolist() for x in np.unique(counts[begin : begin + RANKED_AT_ONCE], return_counts=True)))))
    values = np.array(sorted(value), dtype=np.int64)
    cells = np.array([value[v] for v in values.tolist()], dtype=np.int64)
    # the rank of the next cell of each count; the cells come in their own order
    following = np.cumsum(cells) - cells
    starts, before = following.tolist(), (np.cumsum(values * cells) - values * cells).tolist()
    rank = np.empty(len(counts), dtype=np.uint32)
    for begin in places:
        at = np.searchsorted(values, counts[begin : begin + RANKED_AT_ONCE])
        order = np.argsort(at, kind="stable")
        found, first, many = np.unique(at[order], return_index=True, return_counts=True)
        rank[begin + order] = np.repeat(following[found] - first, many) + np.arange(len(order))
        following[found] += many
    total = max(1, int((values * cells).sum()))
    cuts = np.full(fragments - 1, len(counts), dtype=np.uint64)
    for i in range(1, fragments):
        for v, n, start, sum_before in zip(values.tolist(), cells.tolist(), starts, before):
            if (sum_before + v * n) / total >= i / fragments:
                cuts[i - 1] = start + bisect_left(range(n), i / fragments, key=lambda t: (sum_before + (t + 1) * v) / total)
                break
    return rank, cuts << np.uint64(64 - COUNT_BITS)



def placed(hashes: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles' places in the order, smallest first; equal only for equal shingles."""
    own = rank[(hashes & _COUNT_MASK).astype(np.int64)].astype(np.uint64)
    return np.sort((own << np.uint64(64 - COUNT_BITS)) | (hashes >> np.uint64(COUNT_BITS)))


def _prefixes(k: int, percent: int, order):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, parts, size = Hasher(), [], 0
        for batch in batches:
            for text in batch.text:
                s = shingle_set(hasher.words(text, True), k)
                if len(s):
                    head = placed(s, order.value[0])[: len(s) - needed_overlap(len(s), percent) + 1]
                    parts.append((head.view(np.int64), _digest(s), len(s)))
                    size += len(head)
                if size > 200_000:
                    yield table(parts)
                    parts, size = [], 0
        if parts:
            yield table(parts)

    def table(parts: list[tuple[np.ndarray, int, int]]) -> pd.DataFrame:
        heads, digests, sizes = zip(*parts)
        lengths = [len(x) for x in heads]
        return pd.DataFrame({
            "gram": np.concatenate(heads), "class": np.repeat(np.array(digests, dtype=np.int64), lengths),
            "n": np.repeat(sizes, lengths), "pos": np.concatenate([np.arange(x) for x in lengths]),
            "end": np.repeat([x[-1] for x in heads], lengths),
        })

    return run


def _segments(k: int, order):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            rows = []
            for text in batch.text:
                s = shingle_set(hasher.words(text, True), k)
                digest = _digest(s)
                places = placed(s, order.value[0])
                for i, part in enumerate(np.split(places, np.searchsorted(places, order.value[1]))):
                    if len(part):
                        rows.append((digest, i, part.view(np.int64)))
            yield pd.DataFrame(rows, columns=["class", "fragment", "grams"])

    return run


def verify(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The linked ones of `pairs` (a, n_a, b, n_b): overlaps by fragment, summed per pair.

    `segments`: class, fragment, grams, of all classes in the pairs; copies of a row do not matter.
    """
    sides = pairs.select("*", F.explode(F.array("a", "b")).alias("class")).join(segments, "class")
    of = lambda side: F.any_value(F.when(F.col("class") == F.col(side), F.col("grams")), F.lit(True))
    return (
        sides.groupBy("a", "n_a", "b", "n_b", "fragment").agg(of("a").alias("g_a"), of("b").alias("g_b"))
        .where("g_a is not null and g_b is not null")
        .select("a", "n_a", "b", "n_b", F.size(F.array_intersect("g_a", "g_b")).alias("shared"))
        .groupBy("a", "n_a", "b", "n_b").agg(F.sum("shared").alias("shared"))
        .where(similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b")
    )


def with_most(index: DataFrame, percent: int) -> DataFrame:
    """Adds `most`: what a class can share at most with one whose prefix ends no earlier in the order.

    A shingle of its prefix that such a class has is in that one's prefix too, and so in the index;
    the others of the prefix are not shared.
    """
    own = index.groupBy("class").agg(F.count(F.lit(1)).alias("met"), F.any_value("n").alias("n"))
    # in a prefix are n - needed + 1 shingles
    most = own.select("class", (F.col("met") + F.ceil(percent * F.col("n") / 100 - 1e-9) - 1).alias("most"))
    return index.join(most, "class")


def collapsed(index: DataFrame) -> DataFrame:
    """`index` (gram, class and more) with one gram for all that have the same classes: the first in
    the order, with their number as `weight`. In a family of near copies hundreds are alike."""
    mark = F.sum(F.xxhash64("class").cast("decimal(38,0)"))
    lists = index.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), mark.alias("mark"), F.min("class").alias("low"), F.max("class").alias("high"))
    first = lists.groupBy("m", "mark", "low", "high").agg(F.min("gram").alias("gram"), F.count(F.lit(1)).alias("weight"))
    return stored(index.join(first.select("gram", "weight"), "gram"), "collapsed")


def class_components(index: DataFrame, marks: DataFrame, segments_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Components of the classes in `index` (gram, class, n, pos, end): class, component.

    `marks` (class, mark) has every class; `segments_of` gives the segments of the classes in a frame (class).
    """
    index = collapsed(with_most(index, percent))
    size = index.count()
    joined = None  # class, component, as far as known
    links = tested = None
    last, rounds, before = False, max(1, MAX_ROUNDS), float("inf")
    for turn in range(rounds + 1):
        if joined is None:
            members = index.withColumn("component", F.col("class"))
        else:
            known = joined.select(F.col("node").alias("class"), "component")
            members = index.join(known, "class", "left").withColumn("component", F.coalesce("component", "class"))
            sizes = members.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("m"))
            top = F.max(F.struct("m", "component"))
            groups = sizes.groupBy("gram").agg(F.sum("m").alias("all"), top.alias("top")).where("all > top.m")
            groups = stored(groups.select("gram", "all", F.col("top.m").alias("m"), F.col("top.component").alias("major")), "groups")
            work = groups.agg(F.sum((F.col("all") - F.col("m")) * F.col("all"))).first()[0] or 0
            if not work:
                break
            # rounds end when they stop helping: members that link to nothing stay outside for good
            last = work <= LEFT_PER_ROW * size or work > LEAST_FALL * before or turn == rounds
            before = work
        one = members.select("gram", "weight", F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("p_a"), F.col("component").alias("c_a"), F.col("end").alias("e_a"), F.col("most").alias("m_a"))
        two = members.select("gram", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("p_b"), F.col("component").alias("c_b"), F.col("end").alias("e_b"), F.col("most").alias("m_b"))
        # behind the first shingle in common no more can be shared than what follows in either set
        most = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
        close = similar(most, F.col("n_a"), F.col("n_b"), percent) & (F.col("c_a") != F.col("c_b"))
        if last:
            # members outside the largest component against all
            minor = one.join(groups.select("gram", "major"), "gram").where(F.col("c_a") != F.col("major"))
            minor = minor.join(marks.select(F.col("class").alias("a"), F.col("mark").alias("mark_a")), "a")
            two = two.join(groups.select("gram"), "gram", "left_semi")
            two = two.join(marks.select(F.col("class").alias("b"), F.col("mark").alias("mark_b")), "b")
            once = (F.col("c_b") == F.col("major")) | (F.col("a") < F.col("b"))
            sizes_fit = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
            # what the one whose prefix ends first can share at most
            enough = similar(F.when(F.col("e_a") <= F.col("e_b"), F.col("m_a")).otherwise(F.col("m_b")), F.col("n_a"), F.col("n_b"), percent)
            found = minor.join(two, "gram").where(sizes_fit & enough & may_link("mark_a", "mark_b", percent) & (F.col("c_a") != F.col("c_b")) & once)
            # of the `least` shingles that a link shares, at most n - first can lie behind a set's
            # prefix of n - needed + 1; so many at least are in both prefixes
            least = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent) - 1e-9)
            needed = F.greatest(F.ceil(percent * F.col("n_a") / 100 - 1e-9), F.ceil(percent * F.col("n_b") / 100 - 1e-9))
            # a shingle's largest component may differ from the next one's, so a pair comes either way round
            ends = F.array_sort(F.array(F.struct(F.col("a").alias("id"), F.col("n_a").alias("n")), F.struct(F.col("b").alias("id"), F.col("n_b").alias("n"))))
            found = (
                found.select("weight", ends.alias("p"))
                .select("weight", *[F.col("p")[i][f].alias(name) for i, f, name in ((0, "id", "a"), (0, "n", "n_a"), (1, "id", "b"), (1, "n", "n_b"))])
                .groupBy("a", "n_a", "b", "n_b").agg(F.sum("weight").alias("met"))
                .where(F.col("met") >= least + 1 - needed).drop("met")
            )
        else:
            # of its shingles' first members by a hash, the first is a class's partner; once components
            # are known, members outside a shingle's largest component get several from inside it
            seeds = range(1 if joined is None else PARTNERS)
            if joined is not None:
                major = groups.select("gram", "major")
                one = one.join(major, "gram").where(F.col("c_a") != F.col("major")).drop("major")
                two = two.join(major, "gram").where(F.col("c_b") == F.col("major")).drop("major")
            place = lambda i: F.xxhash64(F.col("b"), F.lit(turn * PARTNERS + i))
            first = [F.min(F.struct(F.lit(i).alias("seed"), place(i).alias("at"), "b", "n_b", "p_b", "c_b")) for i in seeds]
            heads = two.groupBy("gram").agg(F.array(*first).alias("h")).select("gram", F.inline("h"))
            found = (
                one.join(heads, "gram").where(close)
                .groupBy("a", "n_a", "seed").agg(F.min(F.struct("at", "b", "n_b")).alias("h")).select("a", "n_a", "h.b", "h.n_b")
            )
        swap = F.col("a") > F.col("b")
        pairs = found.select(
            F.least("a", "b").alias("a"), F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
            F.greatest("a", "b").alias("b"), F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
        ).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        if not last:
            for side in ("a", "b"):
                pairs = pairs.join(marks.select(F.col("class").alias(side), F.col("mark").alias(f"mark_{side}")), side)
            pairs = pairs.where(may_link("mark_a", "mark_b", percent)).select("a", "n_a", "b", "n_b")
        pairs = stored(pairs, "pairs")
        classes = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        new = stored(verify(pairs, segments_of(classes), percent), "links")
        links = new if links is None else links.unionByName(new)
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        joined = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if last:
            break
    return joined.select(F.col("node").alias("class"), "component")


def near_groups(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A document's set are its distinct
    `k`-word shingles; with fewer words, the whole sequence as one; without words or text it is empty
    and links with nothing. Documents link when shared / united shingles >= `percent` / 100;
    component_id is the smallest doc_id that links reach, the own one included.

    Repeated rows are judged each and link like other copies; rows with one doc_id and different
    texts are different members. Null ids count as larger than all others, so a component has a null
    component_id only if all its ids are null. An empty table gives an empty result; other columns
    are ignored. Sets are told apart by size and a 64-bit digest, shingles by a 64-bit hash.
    """
    spark = docs.sparkSession
    own = docs.select(F.coalesce("doc_id", F.lit(_TOP)).cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    both = stored(own.mapInPandas(_measure(k), _MEASURED), "sets")
    base = both.where("piece is null").select("doc", "n", "class", "mark")
    counted = both.where("piece is not null").select("node", "piece", "counts")
    order = spark.sparkContext.broadcast(global_order(tree_sum(counted, own.rdd.getNumPartitions(), 1 << COUNT_BITS), FRAGMENTS))

    words = [F.any_value(F.col("mark")[i]).alias(f"m{i}") for i in range(MARK_WORDS)]
    named = base.where("n > 0").groupBy("class").agg(F.min("doc").alias("least"), *words)
    classes = stored(named.select("class", "least", F.array(*[f"m{i}" for i in range(MARK_WORDS)]).alias("mark")), "classes")
    least, marks = classes.select("class", "least"), classes.select("class", "mark")
    firsts = least.select(F.col("least").alias("doc")).distinct()
    others = stored(base.select("doc").distinct().join(firsts, "doc", "left_anti"), "others")
    reps = own.join(_small(others), "doc", "left_anti")
    rows = reps.select("text").mapInPandas(_prefixes(k, percent, order), "gram long, class long, n long, pos long, end long")
    same = Window.partitionBy("gram")
    index = stored(
        rows.withColumns({"low": F.min("class").over(same), "high": F.max("class").over(same)})
        .where("low < high").select("gram", "class", "n", "pos", "end").distinct(),
        "index",
    )

    def segments_of(classes: DataFrame) -> DataFrame:
        wanted = stored(classes.join(least, "class").select(F.col("least").alias("doc")).distinct(), "wanted")
        texts = own.join(_small(wanted), "doc", "left_semi").select("text")
        return texts.mapInPandas(_segments(k, order), "class long, fragment int, grams array<long>")

    joined = class_components(index, marks, segments_of, percent)
    order.destroy()  # what follows reads stored tables only
    smallest = (
        least.join(joined, "class", "left").withColumn("component", F.coalesce("component", "class"))
    )
    named = smallest.groupBy("component").agg(F.min("least").alias("id"))
    per_class = smallest.join(named, "component").select("class", "id")
    number = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("id"))
    return base.join(per_class, "class", "left").select(
        F.nullif("doc", F.lit(_TOP)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(number, F.lit(_TOP)).alias("component_id"),
    )
