import json

import pytest
from pyspark.sql import functions as F

from verdex.operators import audit, catalogue
from verdex.plans import corpus
from verdex.sources import files, pages, sinks, tables


def page(hits, total):
    return json.dumps({"result": {"hits": {"total": {"value": total}, "hits": hits}}}, ensure_ascii=False)


@pytest.fixture
def folder(tmp_path):
    one = {"_score": 2.5, "_source": {
        "id": "sjur1", "titulo": "ADI 1", "ministro_facet": ["A", None, "B"], "is_colac": True,
        "julgamento_data": "2020-02-03", "publicacao_data": "03/02/2020", "dg_atualizado_em": "x",
        "ementa_texto": "\n" + "é" * 1200 + "\r", "acordao_ata": "curta\nata", "ods_onu": 7}}
    two = {"_source": {"id": "sjur2", "ministro_facet": "C"}}
    (tmp_path / "pagina1.txt").write_text(page([one], 3), encoding="utf-8")
    (tmp_path / "pagina2.txt").write_text("{bad", encoding="utf-8")
    (tmp_path / "pagina3.txt").write_text('{"x": 1}', encoding="utf-8")
    (tmp_path / "pagina4.txt").write_text(page([], 3), encoding="utf-8")
    (tmp_path / "pagina5.txt").write_text(page([two], 3), encoding="utf-8")
    return tmp_path


def test_read_hits(spark, folder):
    paths = [f"{folder}/pagina{i}.txt" for i in range(1, 7)]
    hits, quarantine = pages.read_hits(spark, paths)
    got = [r.id for r in hits.orderBy("page", "pos").select("hit._source.id").collect()]
    assert got == ["sjur1", "sjur2"]
    bad = {r.page.rsplit("/", 1)[1]: r.reason for r in quarantine.collect()}
    assert bad == {
        "pagina2.txt": "invalid JSON", "pagina3.txt": "no result.hits.hits", "pagina6.txt": "not found"}
    raw, _ = pages.read_raw_pages(spark, paths[:5])
    audit = pages.hits_audit(pages.parse_pages(raw)).first()
    assert (audit.pages, audit.declared, audit.actual, audit.missing) == (3, 3, 2, 1)


def test_page_order(spark):
    rows = [(f"file:///d1/pagina{n}.txt", p) for n in (10, 9, 1) for p in (1, 0)]
    df = spark.createDataFrame(rows, "page string, pos int")
    got = [(r.page[17:-4], r.pos) for r in pages.in_page_order(df).collect()]
    assert got == [("1", 0), ("1", 1), ("9", 0), ("9", 1), ("10", 0), ("10", 1)]


def test_no_page_at_all(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pages.read_raw_pages(spark, [f"{tmp_path}/none.txt"])


def test_catalogue(spark, folder):
    hits, _ = pages.read_hits(spark, [f"{folder}/pagina*.txt"])
    table = catalogue.coerce_dates(catalogue.catalogue(hits))
    assert len(table.columns) == 36
    kinds = dict(table.dtypes)
    assert [kinds[c] for c in catalogue.DATE_COLUMNS] == ["timestamp_ntz"] * 4
    one, two = table.orderBy("id").collect()
    assert one.ministro_facet == "A; B" and two.ministro_facet == "C" and one.ods_onu == "7"
    assert one.ementa_texto == "é" * 1000 + "..." and one.acordao_ata == "curta ata"
    assert str(one.julgamento_data) == str(one.publicacao_data) == "2020-02-03 00:00:00"
    assert one.dg_atualizado_em is None and one.is_colac is True and two.is_colac is None
    assert one.score == 2.5 and two.score is None and two.ementa_texto is None


def test_coerce_dates(spark):
    values = ["2021-05-06", "06/05/2021", "x", "2021", None, "2021-05-06T07:08:09", "31/02/2021", "6/5/2021 07:08:09"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, julgamento_data string")
    got = [r[1] and str(r[1]) for r in catalogue.coerce_dates(df).orderBy("i").collect()]
    assert got == ["2021-05-06 00:00:00"] * 2 + [None, "2021-01-01 00:00:00", None, "2021-05-06 07:08:09", None, "2021-05-06 07:08:09"]


def test_files_and_ids(spark, tmp_path):
    for name in ("a.pdf", "b.c.PDF", "d.txt", ".pdf"):
        (tmp_path / name).write_bytes(b"x")
    ids = {r.id for r in files.file_ids(spark, str(tmp_path)).collect()}
    assert {"a", "b.c"} <= ids and "d" not in ids
    csv = tmp_path / "ids.csv"
    csv.write_text("﻿titulo,id\nx,1\ny,\nz,1\nw,abc\n", encoding="utf-8")
    assert {r.id for r in tables.catalogue_ids(spark, str(csv)).collect()} == {"1", "abc"}


def test_ingest_documents(spark, tmp_path):
    (tmp_path / "one.PDF").write_bytes(b"p1|p2 ")
    (tmp_path / "two.pdf").write_bytes(b"\xff\xfe")
    got = {
        r.nome_pdf: (r.texto_completo, r.error)
        for r in files.ingest_documents(spark, str(tmp_path), lambda b: b.decode("ascii").split("|")).collect()
    }
    assert got["one.PDF"] == ("p1\np2", None)
    assert got["two.pdf"][0] == "" and got["two.pdf"][1].startswith("UnicodeDecodeError")
    (tmp_path / "p.html").write_text("<p>olá <b>mundo</b></p>", encoding="utf-8")
    html = files.ingest_documents(spark, str(tmp_path), suffix="html").first()
    assert (html.nome_pdf, html.texto_completo) == ("p.html", "olá mundo")


def test_fold_pages(spark):
    rows = [("d", n, f"p{n}") for n in range(700)] + [("e", 2, " b "), ("e", 1, " a"), ("e", 3, None)]
    df = spark.createDataFrame(rows, "doc string, n int, t string").repartition(5)
    got = dict(files.fold_pages(df, "doc", "n", "t").collect())
    assert got == {"d": "\n".join(f"p{n}" for n in range(700)), "e": "a\n b"}


def test_tables(spark):
    df = spark.createDataFrame(
        [("Sim", "a", "t", 1, "x"), ("?", "b", "t", 2, "y"), (None, "c", "t", 3, "z"), ("Não", "d", "t", 4, None)],
        "c0 string, c1 string, c2 string, other int, c9 string")
    loaded = tables.positional_load(df)
    assert loaded.columns == ["label", "nome_pdf", "termos_encontrados", "text"] and loaded.count() == 3
    assert [r.nome_pdf for r in tables.labelled_only(loaded).collect()] == ["a"]
    assert tables.select_present(df, ["c9", "zz", "c0"]).columns == ["c9", "c0"]
    profile = {r.column: (r.position, r.type, r.non_null, r.rows) for r in tables.profile(df).collect()}
    assert profile["c0"] == (1, "string", 3, 4) and profile["other"] == (4, "int", 4, 4)


def test_resolve_columns(spark):
    df = spark.createDataFrame(
        [("2020-01-02", "ADI", "X"), ("bad", "RE", "Y")], "data_julgamento string, Classe string, ministro string")
    out = tables.resolve_columns(df)
    assert [tuple(r)[1:] for r in out.collect()] == [("ADI", "X", 2020)]
    with pytest.raises(ValueError):
        tables.resolve_columns(df.select(F.lit(1).alias("zzz")))
    with pytest.raises(ValueError):
        tables.require_rows(out.where("ano = 1"))


def test_comparison_years(spark):
    df = spark.createDataFrame([("2001-02-03", "1"), ("x", "2")], ["ANO", "NÚMERO DO PROCESSO"])
    assert [r.ano for r in tables.comparison_years(df).collect()] == [2001]
    ints = spark.createDataFrame([(2001, "1")], ["ANO", "NÚMERO DO PROCESSO"])
    assert [r.ano for r in tables.comparison_years(ints).collect()] == [2001]
    with pytest.raises(ValueError):
        tables.comparison_years(df.select("ANO"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", é', ["x", "y"])], "i int, t string, l array<string>")
    sinks.write_csv(df, f"{tmp_path}/csv")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").first()
    assert tuple(back) == ("1", 'a "q", é', "x, y")
    sinks.write_parquet(df, f"{tmp_path}/pq")
    assert spark.read.parquet(f"{tmp_path}/pq").first().l == ["x", "y"]
    sinks.write_json(df, f"{tmp_path}/json")
    assert "é" in spark.read.text(f"{tmp_path}/json").first().value


def test_catalogue_ids_of_titles_with_line_feeds(spark, tmp_path):
    df = spark.createDataFrame([("1", 'linha um\nlinha dois, "x"'), ("2", "y\r\nz"), (None, "w")], "id string, titulo string")
    sinks.write_csv(df, f"{tmp_path}/cat")
    assert sorted(r.id for r in tables.catalogue_ids(spark, f"{tmp_path}/cat").collect()) == ["1", "2"]


def test_duplicates_in_text_order(spark):
    same = "p" * 120
    rows = [(1, same + "b"), (2, same + "a"), (3, same + "b"), (4, same + "a"), (5, "once"), (6, None), (7, None)]
    got = audit.duplicate_rows(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()
    assert [(r.id, r.copies) for r in got] == [(2, 2), (4, 2), (1, 2), (3, 2)]


def test_merge_without_hits_writes_nothing(spark, tmp_path):
    (tmp_path / "p1.txt").write_text("{}")
    out = corpus.merge_pages(spark, [f"{tmp_path}/p1.txt", f"{tmp_path}/none.txt"], f"{tmp_path}/out")
    assert not (tmp_path / "out").exists() and out["quarantine"].count() == 2
