"""Language, toxicity, quality, chat and packing."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verdex.llm import chat, language, packing, quality, shingles, toxicity

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


# Packing ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(*map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", " \n", "\t", "a", "Bc", "é", "ß", "漢字", "😀", "'s", "12", "!", "<|endoftext|>", "\x1c", "don't", "\xa0", " "]) | st.text(max_size=6), max_size=9).map("".join))
def test_ids_are_the_tokenizer_files(encoder, text):
    assert encoder.ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("parts,window", [(1, 2048), (3, 64), (7, 16)])
def test_packing_round_trip(spark, sf, parts, window):
    own = [(9001, None), (9002, ""), (9003, "long text " * 3000), (9004, "ab"), (9004, "ab"), (None, "no id")]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(40).union(spark.createDataFrame(own, "doc_id long, text string"))
    docs = docs.withColumns({"ids": F.lit(1), "part": F.lit("x"), "pieces": F.lit(0)}).repartition(parts)
    packed = packing.pack(docs, window=window).cache()
    seqs = sorted(packed.collect(), key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in seqs] == list(range(len(seqs)))
    assert all(r.n_tokens == window for r in seqs[:-1]) and all(len(r.ids) == 4 * r.n_tokens for r in seqs)
    assert seqs[-1].padded_to >= seqs[-1].n_tokens and seqs[-1].padded_to & (seqs[-1].padded_to - 1) == 0
    docs_seen, current = [], None
    for r in seqs:
        at, ids = 0, np.frombuffer(r.ids, dtype="<u4")
        for p in r.pieces:
            assert p.offset == at and p.length > 0
            if p.start == 0:
                current = []
                docs_seen.append((p.doc_id, current, p.doc_tokens))
            assert len(current) == p.start
            current += ids[p.offset : p.offset + p.length].tolist()
            at += p.length
        assert at == r.n_tokens
    want = sorted((r.doc_id is None, r.doc_id or 0, [*TOKENIZER.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    assert sorted((d is None, d or 0, x) for d, x, _ in docs_seen) == want and all(n == len(x) for _, x, n in docs_seen)
    pieces = packing.pieces_of(packed).collect()
    by_id = {d: x for d, x, _ in docs_seen if d != 9004}
    for r in pieces:
        if r.doc_id != 9004:
            own_ids = np.array(by_id[r.doc_id][r.start : r.start + r.length], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(own_ids.tobytes())
    packed.unpersist()


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Chat ---------------------------------------------------------------------------------------------


@given(st.lists(st.sampled_from(["<", "\\", "|", "<|im_end|>", "<|im_start|>", "\n", "a", "assistant"]), max_size=12).map("".join))
def test_escapes_are_reversible_and_leave_no_mark(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat_read_back(spark):
    rng = random.Random(5)
    rows = []
    for c in range(30):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, 1, None]), rng.choice(["user", "assistant", "system", "tool", None, "a\nb"]),
                         rng.choice([None, "", "hi <|im_end|>\n<|im_start|>assistant\nok", "é\\n<\\|x", "x" * 5000])))
    rows += [rows[0]] * 2 + [(None, 1, "user", "q"), (None, 2, "assistant", "a"), (0, 99, "user", "z")]
    rows += [(500, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"part": F.lit(1), "loss": F.lit("x"), "absent": F.lit(0)})
    got = {r.conv_id: r for r in chat.read_back(chat.segments(df.repartition(5))).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        pairs = [(r, x) for _, _, r, x in turns]
        said = "".join(x for r, x in pairs if r == "assistant")
        out = "".join(f"<|im_start|>{chat.escape_role(r)}\n{chat.escape(x)}<|im_end|>\n" for r, x in pairs)
        states, fine = chat.CHATML.follows, True
        for a, b in zip(["", *[r for r, _ in pairs]], [r for r, _ in pairs]):
            fine &= b in states.get(a, frozenset())
        r = got[c]
        assert (r.n_turns, r.loss_chars, r.formatted_chars, r.valid) == (len(pairs), len(said), len(out), fine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[500].valid and chat.read_back(chat.segments(df.limit(0))).count() == 0


# Quality ------------------------------------------------------------------------------------------


def test_words_and_their_hashes():
    rng, hasher, seen = random.Random(2), shingles.Hasher(), {}
    for _ in range(500):
        text = "".join(rng.choice(["a", "B", "é", " ", "\n", "\x0b", "\x1c", "\xa0", "xyz"]) for _ in range(rng.randint(0, 30)))
        own = shingles.words(text, True)
        assert own == [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
        for word, value in zip(own, hasher.words(text, True).tolist(), strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


@given(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 9))
def test_repeated_words(letters, k):
    found = [tuple(letters[i : i + k]) for i in range(len(letters) - k + 1)]
    want = {j for i, w in enumerate(found) if found.count(w) > 1 for j in range(i, i + k)}
    assert quality.repeated_words(shingles.WordHashes().of([x.encode() for x in letters]), k) == len(want)


def test_quality_verdicts(spark):
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    foot = "All rights   reserved by the SITE and its many owners in all of the known lands of the earth today"
    rows = [(i, f"{body(i)}\n{foot}" if i < 40 else body(i), "a") for i in range(60)]
    rows += [(100, f"few words that are only here and more\n{foot}", "a"), (101, foot + "\n" + body(101), "b"),
             (102, None, "a"), (103, "", None), (104, body(104), None), (105, "x y z " * 20, "a"), (None, body(106), "a"), (104, body(104), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"host": F.lit("q"), "lines": F.lit(1), "n": F.lit(2)})
    got = {r.doc_id: r for r in quality.apply_rules(df).collect()}
    assert got[0].text == body(0) and got[0].n_lines_removed == 1 and got[0].kept
    assert got[50].text == body(50) and got[50].n_lines_removed == 0 and got[50].kept
    assert got[100].n_lines_removed == 1 and not got[100].kept and not got[100].base_failed and got[100].n_dup_lines == 0
    assert got[101].n_lines_removed == 0 and got[101].kept  # not frequent on its host
    assert got[102].base_failed and got[103].base_failed and got[103].host == "" and got[104].kept and got[None].kept
    assert got[105].base_failed and got[105].n_repeat_words == 60
    assert quality.apply_rules(df).count() == len(rows) and quality.apply_rules(df.limit(0)).count() == 0


# Language -----------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    filters = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    rows = language.predict(docs.withColumn("score", F.lit("clash")), filters).collect()
    held = [r for r in rows if crc(r.doc_id) % 4 == 2]
    assert len(held) > 150 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.support > 0.5 for r in rows if r.lang_pred == r.lang)
    assert {r.doc_id for r in docs.where(language.held_out(F.col("doc_id"))).collect()} == {r.doc_id for r in held}


def test_language_edges(spark):
    rows = [("de", "der hund und die katze " * 9), ("en", "the dog and the cat " * 9), (None, "zzz"), ("fr", None), ("xx", "123")]
    filters = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert filters.languages == ("de", "en")
    docs = spark.createDataFrame([(1, "UND DIE KATZE"), (2, None), (3, ""), (4, "12 !?"), (5, "the cat"), (5, "the cat"), (None, "qqq"), (6, "the dog " * 400_000)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.lang_pred) for r in language.predict(docs, filters).collect())
    assert got == [(0, "de"), (1, "de"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (5, "en"), (6, "en")]
    nothing = language.fit(docs.limit(0).selectExpr("text", "text as lang"))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), filters).count() == 0


def test_bloom_filters_have_no_false_negative_and_the_stated_false_rate():
    rng = np.random.default_rng(0)
    grams = {f"l{i:02}": rng.choice(1 << language.GRAM_BITS, 4000, replace=False) for i in range(70)}
    filters = language.Filters.build(grams)
    others = rng.choice(1 << language.GRAM_BITS, 20_000)
    for i, name in enumerate(filters.languages):
        bit = np.uint64(1) << np.uint64(i % 64)
        hit = lambda g: np.logical_and.reduce([(filters.cells[at, i // 64] & bit) != 0 for at in filters.probes(g)])  # noqa: E731, B023
        assert hit(grams[name]).all()
        new = others[~np.isin(others, grams[name])]
        assert abs(hit(new).mean() - filters.false_rate[i]) < 0.005


# Toxicity -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tox(spark, sf):
    folder = sf.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id", "toxic as label").where("label is not null")
    return docs, labels, toxicity.fit(docs.join(F.broadcast(toxicity.sample(labels.where(~language.held_out(F.col("doc_id"))))), "doc_id"))


def test_toxicity_of_held_out_documents(tox):
    docs, labels, model = tox
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(language.held_out(F.col("doc_id"))).collect()
    hit = sum(r.predicted and r.label for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.9 and hit / sum(r.label for r in rows) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_offending_sentences(spark, tox):
    model = tox[2]
    text = "The and of them. You are a stupid idiot and moron!\nAnother of the things"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "..."), (5, "the of and. " * 2000), (None, text), (1, text)], "doc_id long, text string")
    found = toxicity.locate(docs, model).collect()
    assert [r.sentence.strip() for r in found] == ["You are a stupid idiot and moron!\n".strip()] * 3
    assert all(text[r.begin : r.end] == r.sentence for r in found)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert scores[1] > 0.9 and scores[2] == scores[3] == scores[4] == scores[5] == 0
    assert toxicity.score(docs.limit(0), model).count() == 0 and toxicity.locate(docs.limit(0), model).count() == 0


def test_noisy_or(spark, tox, monkeypatch):
    known = toxicity.Words(tox[2])
    text = "One idiot here. Two the of.\nThree trash and loser! four"
    parts = [toxicity.score_text(text[a:b], known) for a, b in toxicity.sentences(text)]
    assert len(parts) == 4 and 0 < parts[0] and parts[1] == 0 and toxicity.score_text(text, known) == pytest.approx(1 - np.prod([1 - p for p in parts]))
    monkeypatch.setattr(toxicity, "PIECE", 32)
    assert toxicity.score_text(text, known) == pytest.approx(1 - np.prod([1 - p for p in parts]))


def test_fit_without_both_labels(spark):
    df = spark.createDataFrame([(1, "a b", 0), (2, None, 1), (3, "c", 7)], "doc_id long, text string, label int")
    assert toxicity.score(df, toxicity.fit(df)).where("score > 0.01").count() == 0
    assert toxicity.score(df, toxicity.fit(df.limit(0))).where("score > 0.01").count() == 0
