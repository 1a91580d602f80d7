import brute
import pytest
from pyspark.sql import functions as F

from verdex.functions import text as T
from verdex.functions.stem import stem_words
from verdex.functions.stem_rules import STEPS
from verdex.operators import terms

TERMS = ["Teorema de Coase", "coase", "ção", "Kaldor–Hicks", "north"]


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


def test_clean_text(spark):
    got = column(spark, ["\r\n a  ", None, "", "a\nb\rc", "\xa0x　\x1f", "a  b"], T.clean_text)
    assert got == ["a", None, "", "a b c", "x", "a  b"]


def test_truncate_text(spark):
    values = ["a" * 5, "a" * 6, "abcd😀f", None, "é" * 6]
    got = column(spark, values, lambda c: T.truncate_text(c, 5))
    assert got == ["a" * 5, "aaaaa...", "abcd😀...", None, "ééééé..."]


def test_list_to_string(spark):
    df = spark.createDataFrame(
        [(0, ["a", None, "b"]), (1, []), (2, None), (3, ["x"])], "i int, v array<string>"
    )
    got = [r[0] for r in df.orderBy("i").select(T.list_to_string(F.col("v"))).collect()]
    assert got == ["a; b", "", None, "x"]


def test_variant_to_string(spark):
    values = ['["a",null,"b"]', '"z"', "[]", None, "7", "[1,2]"]
    got = column(spark, values, lambda c: T.variant_to_string(F.parse_json(c)))
    assert got == ["a; b", "z", "", None, "7", "1; 2"]


def test_html_to_text(spark):
    html = "<html><!-- x\n --><SCRIPT a='1'>var t='</p>';</script><nav>menu</nav><p>Um&nbsp;\n dois</p><b>três</b><footer>f</footer>"
    assert column(spark, [html, "", None], T.html_to_text) == ["Um&nbsp; dois três", "", None]


EDGES = [
    "", "no dot at all", "...", " . . ", "a" * 299 + ". b.", "a" * 300 + ". b.", "x" * 900 + ". tail",
    "art. 5 da lei", "vale 1.5 hoje.", ("curta. " * 100), "a\n\n b  c\x1cd. e",
    "fim sem ponto " * 50, ". começa com ponto. segue", ("z" * 298 + ". " + "y") * 5, "😀" * 150 + ". " + "é" * 200 + ". fim",
]


@pytest.mark.parametrize("least", [300, 5])
def test_paragraphs_edges(spark, least):
    df = spark.createDataFrame(list(enumerate(EDGES)), "id int, text string")
    got = {i: [] for i in range(len(EDGES))}
    for r in terms.paragraphs(df, "id", "text", least).orderBy("id", "pos").collect():
        got[r.id].append(r.paragraph)
    assert got == {i: brute.paragraphs(t, least) for i, t in enumerate(EDGES)}


def test_paragraphs_of_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [tuple(r) for r in terms.paragraphs(docs, "doc_id", "text").orderBy("doc_id", "pos").collect()]
    want = [
        (r.doc_id, i, p)
        for r in docs.orderBy("doc_id").collect()
        for i, p in enumerate(brute.paragraphs(r.text))
    ]
    assert got == want


def test_term_match_edges(spark):
    texts = ["O TEOREMA DE COASE vale", "Northern lights", "eficiência de Kaldor–Hicks", "Kaldor-Hicks", "NADA", "Ação", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.terms for r in terms.match_terms(df, "t", TERMS).collect()}
    assert got == {0: ["Teorema de Coase", "coase"], 1: ["north"], 2: ["Kaldor–Hicks"], 5: ["ção"]}
    assert {r.i for r in terms.search_any(df, "t", TERMS).collect()} == set(got)


def test_term_paragraphs_dedup(spark):
    boiler = "coase " + "mesmo texto de abertura " * 13
    docs = [
        ("a", f"{boiler} um. {boiler} dois."),  # same first 100 characters: first kept
        ("b", f"{boiler} um."),  # another document keeps its own
        ("c", ("sem termo " * 31) + ". " + ("sem termo " * 31) + "coase."),  # filter before dedup
        ("d", "nada."),
    ]
    df = spark.createDataFrame(docs, "id string, text string")
    got = sorted((r.id, r.pos, list(r.terms), r.paragraph) for r in terms.term_paragraphs(df, "id", "text", TERMS).collect())
    assert got == sorted(brute.term_paragraphs(docs, TERMS))
    assert [g[0] for g in got] == ["a", "b", "c"]
    assert got[2][1] == 1


def test_term_paragraphs_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    one = terms.term_paragraphs(docs, "doc_id", "text", ["the", "nicht"]).collect()
    many = terms.term_paragraphs(docs.repartition(7), "doc_id", "text", ["the", "nicht"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, many)) and one


def test_forty_terms():
    assert len(terms.SEARCH_TERMS) == 40


def test_tokens(spark):
    values = ["NÃO-rivais", "ü û", "÷ ×", "1 2 3", "!?.", "a b\x1dc", "", None, "Ação do STF, art. 5º"]
    got = column(spark, values, T.tokens)
    assert got == [None if v is None else brute.tokens(v) for v in values]
    assert got[0] == ["nãorivais"]


def test_ngrams(spark):
    for words in ([], ["um"], ["um", "dois"], ["um", "a", "dois", "três"], ["a÷b", "cd÷ef"]):
        df = spark.createDataFrame([(words,)], "w array<string>")
        df = df.select(T.vectoriser_tokens(F.col("w")).alias("w"))
        assert df.select(T.ngrams(F.col("w"))).first()[0] == brute.grams(words)


def test_stems(spark, sf):
    words = (
        "bons aviões mães normais papéis fuzis casas lápis mais meninas professora chefona inglesa "
        "amanhã felizmente experimente cansadíssimo amiguinho caminho canção menina barcaça computador "
        "legalidade julgamento constitucional cantaríamos correndo partiu externalidades regulatória "
        "consequencialismo econômica litigância rivais s a ão é"
    ).split()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = docs.select(F.explode_outer(T.tokens(F.col("text"))).alias("w")).distinct().dropna()
    words = sorted(set(words) | {r.w for r in found.collect()})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = dict(df.select("w", stem_words("array(w)")[0]).collect())
    assert got == {w: brute.stem(w) for w in words}
    assert got["meninas"] == "menin" and got["normais"] == "norm" and got["felizmente"] == "feliz"


def test_a_very_long_document(spark):
    text = "Uma frase com  coase.\n Outra frase, mais longa do que a primeira\u2003sem ponto " * 20000
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = [r.paragraph for r in terms.paragraphs(df, "id", "text").orderBy("pos").collect()]
    assert got == brute.paragraphs(text)


def test_prefilter_never_changes_the_result(spark, sf):
    """Also for terms that end in a dot, at the end of a document."""
    df = spark.createDataFrame([(1, "x. Sem arte nem"), (2, "y. Uma arte. Fim"), (3, "z. Outra Art.")], "id int, text string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").cast("int").alias("id"), "text")
    for rows, words in ((df, ("art.", "arte.")), (docs, ("the.", "on.", "nicht"))):
        cut = terms.match_terms(terms.paragraphs(rows, "id", "text"), "paragraph", words)
        want = terms.dedup_prefix(cut, "id", "paragraph", "pos").select("id", "pos")
        got = terms.term_paragraphs(rows, "id", "text", words).select("id", "pos")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r.id for r in terms.term_paragraphs(df, "id", "text", ("art.", "arte.")).collect()) == [2, 3]


# Published examples of the stemmer's steps: a word and what the step leaves of it.
EXAMPLES = {
    "plural": "bons bom balões balão capitães capitão normais normal papéis papel lençóis lençol barris barril casas casa",
    "feminine": "chefona chefão professora professor americana americano sozinha sozinho inglesa inglês famosa famoso maníaca maníaco "
    "prática prático cansada cansado mantida mantido passiva passivo primeira primeiro",
    "augmentative": "fortíssimo fort chiquérrimo chiqu",
    "adverb": "felizmente feliz",
    "verb": "cantaríamo cant beberíamo beb partiríamo part cantássemo cant cantando cant bebendo beb partindo part propondo prop "
    "cantava cant bebiam beb agrava agrava",
    "vowel": "menina menin grande grand menino menin",
}


@pytest.mark.parametrize("step", EXAMPLES)
def test_stems_of_example_words(spark, step):
    pairs = EXAMPLES[step].split()
    df = spark.createDataFrame([(pairs[::2],)], "w array<string>")
    assert df.select(stem_words("w", dict.fromkeys(STEPS, ()) | {step: STEPS[step]})).first()[0] == pairs[1::2]
