"""Tokenizer alignment, exact top-k search and periodic runs against brute force."""

import json
import pickle
import random
from collections import Counter
from math import floor

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from verdex.llm import alignment, runs, topk

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "The quick brown fox", "", None, " two  blanks and\n a line ", "it's <|endoftext|> here <s> and </s>", "naïve café 東京 🙂 नमस्ते",
    "blank▁sign is lost", "x" * 3000, "\t\ttabs  nbsp em \x1c fs", "a", " ", "The quick brown fox", "tail blank ",
    "mongolian᠎ sep zero​ width", "1234567 12 3.5e10 ,,, ...", " ́combining", "newline.\nNext line", "nul\x00byte",
]


def brute_alignment(texts):
    """Whole texts, tokenised at once; groups and links from sets of offsets."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    decode = {c: i for i, c in byte_signs().items()}
    names = {i: t for t, i in json.load(open(PATH_A, encoding="utf-8"))["model"]["vocab"].items()}
    rows, pairs = [], Counter()
    for text in texts:
        ia, ib = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        ba = [bytes(decode[c] for c in names[i]) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not text or b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            rows.append(None)
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        common = sorted(set(ea) & set(eb))
        def cut(ids, ends):
            of = np.searchsorted(common, ends)
            return [[ids[i] for i in own] for own in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(of)) + 1)]

        at = dict(zip(eb, ib))
        links = [(x, at[e]) for x, e in zip(ia, ea) if e in at]
        pairs.update(links)
        groups = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in zip(cut(ia, ea), cut(ib, eb)))
        rows.append((len(ia), len(ib), len(common), links, groups))
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    zero = (0, 0, 0, 0, 0, 0, "")
    return pairs, [zero if r is None else (*r[:3], len(r[3]), sum(pairs[p] == best[p[1]] for p in r[3]), sum(pairs[p] for p in r[3]), r[4]) for r in rows]


def byte_signs():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def some_texts(spark, sf):
    given = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    return TEXTS + given + given[:3]


def test_alignment(spark, some_texts, monkeypatch):
    rows = [(i if i != 5 else None, x, "clash", 1) for i, x in enumerate(some_texts)] + [(7, some_texts[7], "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, pair int").repartition(5)
    pairs, want = brute_alignment([r[1] for r in rows])
    got = alignment.align(docs).collect()
    assert sorted(map(str, [tuple(r) for r in got])) == sorted(str((d, *w)) for (d, *_), w in zip(rows, want))
    assert {(r.a_id, r.b_id): r.n for r in alignment.pair_table(docs).collect()} == dict(pairs)


def test_alignment_in_small_turns_and_of_nothing(spark, some_texts):
    words = alignment.Vocabularies(*alignment._paths(None, None, None))
    text = " ".join(x for x in some_texts if x and "▁" not in x)
    aligner = alignment.Aligner(words)
    parts = alignment.parts_of(text)
    shown = []
    for k in range(0, len(parts), 7):
        entries = aligner.entries(parts[k : k + 7])
        shown += [aligner.shown[i] for i in entries]
        aligner.chars = alignment.REMEMBERED - 20  # the next turn starts anew
    assert ";".join(shown) == brute_alignment([text])[1][0][-1]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty).count() == 0 and alignment.pair_table(empty).count() == 0


def test_texts_that_are_taken_alone(spark, monkeypatch):
    """Long texts on end, each in turns of its own, with parts that no text before had."""
    monkeypatch.setattr(alignment, "PARTS", 50)
    texts = [" ".join(f"text{i} part{i * 1000 + j}" for j in range(60)) for i in range(3)] + ["one more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    pairs, want = brute_alignment(texts)
    got = sorted(alignment.align(docs).collect())
    assert [tuple(r) for r in got] == [(i, *w) for i, w in enumerate(want)]
    assert {(r.a_id, r.b_id): r.n for r in alignment.pair_table(docs).collect()} == dict(pairs)


def test_pairs_of_remembered_parts_are_summed_at_once(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 2000)
    texts = [" ".join(f"w{i * 40 + j} the of" for j in range(60)) for i in range(30)]
    aligner = alignment.Aligner(alignment.Vocabularies(*alignment._paths(None, None, None)), shows=False)
    counts = Counter()
    for text in texts:
        aligner.count(aligner.entries(alignment.parts_of(text)))
    aligner.clear()
    for keys, n in aligner.counted:
        assert len(np.unique(keys)) == len(keys) and n.all()
        counts.update(dict(zip(keys.tolist(), n.tolist())))
    want = brute_alignment(texts)[0]
    assert len(aligner.counted) > 1 and not aligner.shown
    assert counts == Counter({x * len(aligner.words.bytes_b) + y: n for (x, y), n in want.items()})


def test_what_is_broadcast_names_no_class_of_the_library(spark):
    """Workers need not have the library: plain values go to them, from which the table is made again."""
    docs = spark.createDataFrame([(1, "some words of a text"), (2, "a text")], "doc_id long, text string")
    table = alignment.count_pairs(docs, alignment._paths(None, None, None))
    assert {type(x).__module__.split(".")[0] for x in vars(table).values()} <= {"numpy", "builtins"}
    again = alignment.Lookup.of(pickle.loads(pickle.dumps(vars(table))))
    assert (again.slots(table.key) == np.arange(len(table.key))).all() and (again.get(table.key)[0] == table.count).all()


def test_minimal_hash_knows_its_keys_only():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**40, 5000))
    n = 3
    built = []
    for b in range(n):
        sizes, bits, order = alignment.hash_levels(keys[alignment.bucket_of(keys, n) == b])
        built.append((sizes, bits.tobytes(), order.tolist()))
    table = alignment.Lookup(built, n)
    assert sorted(table.slots(keys)) == list(range(len(keys))) and (table.key[table.slots(keys)] == keys).all()
    others = np.setdiff1d(rng.integers(0, 2**40, 5000), keys)
    assert (table.slots(others) == -1).all()


def test_pairs_stay_below_what_the_vocabularies_allow():
    assert alignment.Vocabularies(PATH_A, PATH_B).possible_pairs() == 324_300


def brute_top(rows, k):
    """rows: (vec_id, vector) in order."""
    ok = [(d, [floor(256 * x) for x in v]) for d, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    top, none = 2**63 - 2, 2**63 - 1
    out = []
    for i, (d, q) in enumerate(ok):
        if d is None or d % 2:
            continue
        score = lambda v: max(-top, min(top, sum(x * y for x, y in zip(q, v))))
        others = sorted((-score(v), none if e is None else e) for j, (e, v) in enumerate(ok) if j != i)
        out += [(d, r + 1, None if e == none else e, -s) for r, (s, e) in enumerate(others[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(4096, 512, 1 << 22), (7, 30, 300)])
def test_top_k(spark, monkeypatch, sizes):
    for name, x in zip(("CHUNK", "BLOCK", "TOGETHER"), sizes):
        monkeypatch.setattr(topk, name, x)
    rng = random.Random(4)
    same = [0.5, -0.25, 0.1, 0.9]
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(150)] + [(200 + i, list(same)) for i in range(70)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (304, [float("inf"), 0.0, 0.0, 0.0]), (None, [2.0] * 4)]
    rows += [(306, []), (308, [0.5]), (10, [0.1] * 4), (10, [0.1] * 4)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "vec_id long, embedding array<double>, score double, rank string").repartition(4)
    got = topk.search(df, F.col("vec_id") % 2 == 0, 5)
    assert sorted(map(tuple, got.collect()), key=str) == brute_top(rows, 5) and dict(got.dtypes)["rank"] == "int"


def test_top_k_of_few_large_or_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    large = [(0, [1e300, 1.0]), (1, [-1e300, 0.0]), (2, [1e17, 5.0]), (3, [3.0, -2.5])]
    got = topk.search(spark.createDataFrame(large, schema), F.col("vec_id") % 2 == 0, 5)
    assert sorted(map(tuple, got.collect()), key=str) == brute_top(large, 5)
    one = spark.createDataFrame([(0, [1.0])], schema)
    assert topk.search(one, F.col("vec_id") == 0).count() == 0
    assert topk.search(one.limit(0), F.col("vec_id") == 0).columns == ["query_id", "rank", "vec_id", "score"]


def brute_runs(w):
    out = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - p:
            begin = i
            while i < len(w) - p and w[i] == w[i + p]:
                i += 1
            if i - begin + p >= max(6, 4 * p):
                out.setdefault((begin, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def test_runs_of_many_texts_at_once(monkeypatch):
    rng = random.Random(1)
    for trial in range(120):
        monkeypatch.setattr(runs, "AT_ONCE", rng.choice([1, 50, 1 << 18]))
        texts = []
        for _ in range(rng.randint(1, 12)):
            k, n = rng.choice([1, 2, 3, 5, 30]), rng.choice([0, 3, 6, 20, 100, 300])
            w = [rng.randrange(k) for _ in range(n)]
            if rng.random() < 0.7 and n > 5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w[a:] = [w[a + i % p] for i in range(n - a)]
            texts.append(np.array(w, dtype=np.int64))
        for text, found in zip(texts, runs.find_runs(texts)):
            assert [tuple(x) for x in found.tolist()] == brute_runs(text.tolist())


def test_extensions():
    rng = np.random.default_rng(2)
    s = np.concatenate((np.tile(rng.integers(0, 2, 50), 9), rng.integers(0, 2, 300), [7]))
    i, j = rng.integers(0, len(s), (2, 4000))
    i, j = i[i != j], j[i != j]
    want = [next(k for k in range(len(s)) if s[x + k] != s[y + k]) if max(x, y) < len(s) - 1 else 0 for x, y in zip(i, j)]
    assert runs.Extensions(s).right(i, j).tolist() == want


def test_run_rows(spark, monkeypatch):
    monkeypatch.setattr(runs, "TOGETHER", 40)
    rows = [
        (1, "a b " * 5 + "c"), (2, None), (3, ""), (4, "no run here"), (None, "x " * 7), (5, "u v " * 6 + "\n\tw"), (5, "x " * 7),
        (6, "one two three " * 4 + "q q q q q q " + "one two"), (7, "a b a b a b a x"), (8, "a a a a a"),
    ]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, runs string, period int")
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    for doc, text in rows:
        words = (text or "").encode().split()
        want = brute_runs(words)
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        assert (doc, len(words), want, kept) in [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert runs.digests(runs.periodic_runs(docs.limit(0))).count() == 0
    best = {r.doc_id: r for r in runs.digests(runs.periodic_runs(docs.where("doc_id = 6"))).collect()}[6]
    assert (best.n_runs, best.start, best.length, best.period, best.exponent_milli) == (2, 12, 6, 1, 6000)
