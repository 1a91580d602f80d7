"""Large term lists: the q-gram index against one `contains` per term."""

import random

import pytest

from verdex.operators import term_index
from verdex.operators.terms import match_terms


@pytest.mark.parametrize("at_once", [500_000, 7])
def test_same_as_one_contains_per_term(spark, monkeypatch, at_once):
    monkeypatch.setattr(term_index, "TERMS_AT_ONCE", at_once)
    rng = random.Random(2)
    letters = "abÉ İß 東."
    word = lambda n: "".join(rng.choices(letters, k=n))
    texts = [word(rng.randint(0, 60)) for _ in range(60)] + [None, "", "Ab", "a" * 5000]
    terms = [word(rng.randint(1, 6)) for _ in range(40)] + ["a", "ab", "AB", "aaaa", "東", "a"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, text string, t string").repartition(3)
    key = lambda r: r.id
    got, want = (sorted(f(df, "text", terms).collect(), key=key) for f in (term_index.match_many, match_terms))
    assert got == want and len(got) > 10
    assert term_index.match_many(df.limit(0), "text", terms).count() == 0
    assert term_index.match_many(df, "text", []).count() == 0


def test_only_terms_under_the_texts_grams_are_searched():
    seen = term_index.Counter({"aaaa": 9, "aaab": 1})
    index = term_index.TermIndex(["aaaab", "b", ""], seen)
    assert index.under == {4: {"aaab": [("aaaab", 0)]}, 1: {"b": [("b", 1)]}}
    assert index.places("xaaaabx") == [0, 1, 2] and index.places("aaaa") == [2]


def test_terms_under_one_gram_are_not_each_searched_for():
    terms = [f"{n:08d}" for n in range(2000)] + ["0000x"]
    index = term_index.TermIndex(terms, term_index.Counter())

    class Text(str):
        searched = 0

        def __contains__(self, term):
            Text.searched += 1
            return super().__contains__(term)

    # all are under "0000"; a text that has it is not gone through once for each of them
    assert set(index.under[4]) == {"0000"}
    assert index.places(Text("a 00001234, 00000007 0000x 0000")) == [7, 1234, 2000]
    assert Text.searched < 10 and [len(x) for _, _, x in index.shapes[4]["0000"]] == [2000, 1]
    assert index.places("000012340") == [1234] and index.places("000") == []


def test_long_texts_are_looked_up_in_pieces(monkeypatch):
    monkeypatch.setattr(term_index, "TOGETHER", 5)
    index = term_index.TermIndex(["abcdefgh", "ghij", "é東", "𝄞x", "zz"], term_index.Counter())
    text = "..abcdefghij é東 𝄞x"
    assert all(index.places(" " * k + text) == [0, 1, 2, 3] for k in range(8))
