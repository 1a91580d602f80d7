"""Jaccard join and repeated substrings."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from verdex.llm import jaccard, shingles, substrings


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    """Every pair of rows, and union-find."""
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    top = 2**63 - 1
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), top), top if doc is None else doc)
    return sorted((-1 if d is None else d, len(sets[i]), -1 if least[root(i)] == top else least[root(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("seed,rounds", [(1, 6), (2, 0), (3, 1)])
def test_groups_against_all_pairs(spark, seed, rounds, monkeypatch):
    monkeypatch.setattr(jaccard, "MAX_ROUNDS", rounds)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, passage = [], rng.choices(vocabulary, k=60)
    for base in range(8):
        body = rng.choices(vocabulary, k=rng.choice([3, 5, 20, 60, 120]))
        for _ in range(rng.choice([1, 2, 12, 40])):
            copy = list(body)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            copy = copy[: len(copy) - rng.choice([0, 0, 1, 8])]
            if rng.random() < 0.2:
                copy += passage
            rows.append((len(rows) * 3 + base, rng.choice([" ", "\n", "  "]).join(copy)))
    rng.shuffle(rows)
    rows += [(5000, None), (5001, ""), (5002, " \n "), (5003, "A b"), (5004, "a B"), (rows[0][0], rows[0][1]), (rows[1][0], rows[2][1]),
             (None, rows[3][1]), (None, "only nulls have this text of more words"), (None, "only nulls have this text of more words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"class": F.lit(1), "n": F.lit("x"), "component": F.lit(0)})
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
        for r in jaccard.near_groups(df.repartition(3)).collect()
    )
    assert got == brute_groups(rows)


def test_a_large_group_is_linear_work(spark):
    """1,500 near copies of one text: one group, and far fewer pairs than 1,500 * 1,499 / 2."""
    rng = random.Random(6)
    body = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(1500):
        copy = list(body)
        for _ in range(2):
            copy[rng.randrange(200)] = f"x{d}"
        rows.append((d, " ".join(copy)))
    seen = []
    verify = jaccard.verify
    try:
        jaccard.verify = lambda pairs, *rest: (seen.append(pairs.count()), verify(pairs, *rest))[1]
        got = jaccard.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).select("component_id").distinct().collect()
    finally:
        jaccard.verify = verify
    assert [r.component_id for r in got] == [0] and sum(seen) < 15_000


def test_groups_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_groups(df).count() == 0


def test_order_is_a_bijection_with_rare_cells_first():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, 1 << jaccard.COUNT_BITS)
    hashes = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    rank, cuts = jaccard.global_order(counts, 3)
    placed = jaccard.placed(hashes, rank)
    assert len(np.unique(placed)) == len(hashes) and len(cuts) == 2
    order = sorted(hashes.tolist(), key=lambda h: (rank[h & ((1 << jaccard.COUNT_BITS) - 1)], h >> jaccard.COUNT_BITS))
    cells = [counts[h & ((1 << jaccard.COUNT_BITS) - 1)] for h in order]
    assert cells == sorted(cells)
    assert len(shingles.shingle_set(hashes[:3], 5)) == 1 and len(shingles.shingle_set(hashes[:0], 5)) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_marks_differ_in_no_more_bits_than_the_sets_in_shingles(spark, seed):
    """Also for sets far larger than the mark; so no pair that links is ruled out."""
    rng = np.random.default_rng(seed)
    rows = []
    for n in (1, 2, 7, 100, 3000, 20_000):
        for share in (0.0, 0.1, 0.2, 0.25, 1.0):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = np.union1d(a[int(share * len(a)) :], rng.integers(0, 2**63, int(share * n / 2)).astype(np.uint64))
            if not len(b):
                continue
            x, y = jaccard.mark_of(a), jaccard.mark_of(b)
            shared = len(np.intersect1d(a, b))
            apart = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert apart <= len(a) + len(b) - 2 * shared
            rows.append((x.tolist(), y.tolist(), len(a), len(b), bool(jaccard.similar(shared, len(a), len(b), 80))))
    df = spark.createDataFrame(rows, "mark_a array<long>, mark_b array<long>, n_a long, n_b long, link boolean")
    judged = df.select("link", jaccard.may_link("mark_a", "mark_b", 80).alias("may")).collect()
    assert all(r.may for r in judged if r.link) and any(r.link for r in judged) and not all(r.may for r in judged)


def test_a_family_just_below_the_threshold_is_not_compared_pair_by_pair(spark):
    """600 texts that share most shingles but link with none: few of the 179,700 pairs are verified."""
    rng = random.Random(9)
    body = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(600):
        copy = list(body)
        for at in rng.sample(range(0, 300, 6), 6):
            copy[at] = f"x{d}_{at}"
        rows.append((d, " ".join(copy)))
    seen = []
    verify = jaccard.verify
    try:
        jaccard.verify = lambda pairs, *rest: (seen.append(pairs.count()), verify(pairs, *rest))[1]
        got = jaccard.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))
        found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    finally:
        jaccard.verify = verify
    assert found == brute_groups(rows) and sum(seen) < 20_000


# Substrings ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_induced_sorting_against_all_windows(seed, monkeypatch):
    rng = random.Random(seed)
    for _ in range(40):
        monkeypatch.setattr(substrings, "PIECE", rng.choice([7, 50, 1 << 18]))
        alphabet = rng.choice([b"a", b"ab", b"abcd", bytes(range(200))])
        base = bytes(rng.choice(alphabet) for _ in range(rng.choice([40, 100, 300])))
        contexts, least = [], []
        for _ in range(rng.randint(1, 12)):
            at = rng.randrange(len(base))
            x = bytearray(base[at : at + rng.randint(32, 120)])
            if rng.random() < 0.5:
                x[rng.randrange(len(x))] = rng.choice(alphabet)
            contexts.append(bytes(x))
            least.append(rng.randint(0, 6))
        n = rng.choice([32, 50])
        batches = iter([(contexts[:3], np.array(least[:3])), (contexts[3:], np.array(least[3:]))])
        sizes, found = substrings.covered(batches, n, held=rng.choice([1, 1000, 1 << 26]))
        first = {}
        for c, d in zip(contexts, least):
            for i in range(len(c) - n + 1):
                first[c[i : i + n]] = min(first.get(c[i : i + n], 99), d)
        want = [i + n <= len(c) and first[c[i : i + n]] < d for c, d in zip(contexts, least) for i in range(len(c))]
        assert sizes.tolist() == [len(c) for c in contexts] and found.tolist() == want


def test_meeting_stream_for_any_batches(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(800):
        n = int(rng.integers(1, 40))
        rows = np.stack([
            rng.integers(0, 4, n), rng.integers(0, 3, n) * 256 + rng.integers(0, 3, n), rng.integers(0, 3, n),
            rng.integers(50, 52, n), rng.integers(0, 5, n), np.arange(n),
        ]).astype(np.int64)
        rows = rows[:, np.lexsort((rows[5], rows[4], rows[3], rows[2], rows[0]))]
        monkeypatch.setattr(substrings, "TOGETHER", int(rng.choice([0, 1, 3, 5, 100])))
        k = int(rng.integers(1, n + 1))
        parts = [pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:, i : i + k]], names=list(substrings._COLUMNS)) for i in range(0, n, k)]
        got = [(a, s) for x in substrings._meet(iter(parts)) for a, s in zip(x.column(0).to_pylist(), x.column(2).to_pylist())]
        groups = {}
        for r in rows.T.tolist():
            groups.setdefault((r[0], r[2], r[3]), []).append(r)
        whole, needed, allowed = set(), set(), set()
        for key, g in groups.items():
            least = min(r[4] for r in g)
            others = [o for k2, o in groups.items() if k2[0] == key[0] and k2 != key]
            for r in g:
                if r[4] > least:
                    whole.add(r[5])
                    continue
                allowed.add(r[5])
                sides = lambda q, w: (q[1] >> 8 == w[1] >> 8 != 0) or (q[1] & 255 == w[1] & 255 != 0)
                if any(min(q[4] for q in o) != least and any(sides(q, w) for q in o for w in g) for o in others):
                    needed.add(r[5])
        assert len(got) == len(set(got)) and {s for a, s in got if a is None} == whole
        assert needed <= {s for a, s in got if a is not None} <= allowed


def brute_removed(rows, n):
    """(removed bytes, spans, digest of the rest) of every row, from all strings of `n` bytes."""
    top, first = 2**63 - 1, {}
    for doc, text in rows:
        data, doc = (text or "").encode(), top if doc is None else doc
        for i in range(len(data) - n + 1):
            first[data[i : i + n]] = min(first.get(data[i : i + n], top), doc)
    out = []
    for doc, text in rows:
        data, own = (text or "").encode(), top if doc is None else doc
        gone = bytearray(len(data))
        for i in range(len(data) - n + 1):
            if first[data[i : i + n]] < own:
                gone[i : i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((-1 if doc is None else doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept if runs else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_against_all_strings(spark, seed, monkeypatch):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdé ", "the of and"])
    passages = ["".join(rng.choice(alphabet) for _ in range(k)) for k in (49, 50, 51, 80, 200, 700)]
    rows = []
    for d in range(60):
        parts = ["".join(rng.choice("qwertyuiop äö") for _ in range(rng.randrange(120)))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += [p if rng.random() < 0.5 else p[a:] + p[:a], "".join(rng.choice("zxcvbnm") for _ in range(rng.randrange(30)))]
        rows.append((d * 2, "".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "a" * 300), (205, "a" * 120), (206, passages[5] * 2), (206, passages[5] * 2),
             (207, passages[4]), (207, passages[3] + "x" + passages[4]), (None, passages[4] + "y" * 60), (None, "y" * 60), (208, "p" * 49), (209, "p" * 49),
             (210, "s" * 3000 + passages[4] + "t" * 3000), (4, "other text of four " + passages[3])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"doc": F.lit(1), "sha": F.lit("x"), "start": F.lit(0), "size": F.lit(2)})
    got = sorted(
        ((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, None if r.kept is None else bytes(r.kept))
         for r in substrings.remove_repeats(df.repartition(4)).collect()), key=str)
    assert got == brute_removed(rows, 50)


def test_runs_of_equal_bytes_and_short_periods_at_all_phases(spark):
    rng, rows = random.Random(4), []
    noise = lambda n: "".join(rng.choice("abcdefghijkl") for _ in range(n))
    for phase in range(64):  # each run only in two documents; "\u0100" and on have two bytes
        run = rng.choice([chr(0x100 + phase) * 35, f"{chr(0x100 + phase)}-=" * 20, f"{chr(0x100 + phase)}{'.' * 20}" * 5])
        size = rng.choice([50, 55, 60, 66])
        rows += [(len(rows) + k, noise(n) + run.encode()[:size].decode(errors="ignore") + noise(rng.randrange(60)))
                 for k, n in enumerate((rng.randrange(100), 100 + phase))]
    for mark in "-=_*. ":
        rows += [(len(rows) + k, noise(rng.randrange(130)) + mark * (50 + 3 * k) + noise(40)) for k in range(3)]
    got = sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, None if r.kept is None else bytes(r.kept))
         for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_removed(rows, 50)


def test_long_texts_are_cut_into_pieces_that_lose_nothing(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(5000)).encode()

    def strings(found):
        return {(int(s) + j, int(a)) for _, start, size, anchor, _, _ in found for s, z, a in zip(start, size, anchor) for j in range(z - 49)}

    whole = strings(substrings.Contexts(50).batches(iter([text])))
    monkeypatch.setattr(substrings, "PIECE", 600)
    assert strings(substrings.Contexts(50).batches(iter([text]))) == whole and len(whole) == 5000 - 49


def test_places_of_null_and_repeated_ids_stay_with_their_own_text(spark, monkeypatch):
    rng, arrays = random.Random(5), []
    noise = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    shared, seen = [noise(120) for _ in range(4)], substrings.stored

    def spy(df, name):
        out = seen(df, name)
        if name in ("places", "marks"):
            arrays.append(out.select(F.max(F.size(name)), F.count(F.lit(1))).first())
        return out

    monkeypatch.setattr(substrings, "stored", spy)
    rows = [(k, shared[k] + noise(30)) for k in range(4)]
    rows += [(i, noise(40) + rng.choice(shared) + noise(40)) for i in [None] * 60 + [7] * 60] + [(None, "same " + shared[0])] * 40 + [(8, "tiny"), (8, shared[1])]
    got = sorted(
        ((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, None if r.kept is None else bytes(r.kept))
         for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_removed(rows, 50)
    (most_places, texts), (most_marks, cut) = arrays
    assert texts >= 120 and cut == 122 and most_places < 60 and most_marks < 60  # per text, not per id


def test_removal_from_nothing(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
