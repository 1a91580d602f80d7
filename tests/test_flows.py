import json
import random

from pyspark.sql import functions as F

from verdex.plans import corpus, evidence, reports
from verdex.sources import tables


def test_pages_to_checked_catalogue(spark, tmp_path):
    for n in (1, 2):
        hits = [
            {"_score": n + i / 10, "_source": {"id": f"r{n}{i}", "julgamento_data": f"201{n}-01-0{i + 1}",
             "processo_classe_processual_unificada_classe_sigla": "ADI", "relator_processo_nome": f"M{i}"}}
            for i in range(3)]
        page = {"result": {"hits": {"total": {"value": 7}, "hits": hits}}}
        (tmp_path / f"pagina{n}.txt").write_text(json.dumps(page), encoding="utf-8")
    paths = [f"{tmp_path}/pagina{n}.txt" for n in (1, 2, 3)]
    told = corpus.merge_pages(spark, paths, f"{tmp_path}/merged")
    assert told["audit"].first().missing == 1 and told["quarantine"].count() == 1
    assert spark.read.json(f"{tmp_path}/merged").count() == 6
    assert corpus.build_catalogue(spark, paths, f"{tmp_path}/catalogue").count() == 6
    folder = tmp_path / "files"
    folder.mkdir()
    for name in ("r10.pdf", "r11.PDF", "zz.pdf"):
        (folder / name).write_bytes(b"x")
    checked = corpus.check_corpus(spark, f"{tmp_path}/catalogue", str(folder))
    assert [r.id for r in checked["missing"].collect()] == ["r12", "r20", "r21", "r22"]
    assert [r.id for r in checked["extra"].collect()] == ["zz"]


def test_files_to_reports(spark, tmp_path):
    rng = random.Random(4)
    folder = tmp_path / "files"
    folder.mkdir()
    filler = "o tribunal decidiu por maioria nos termos do voto do relator sorteado na sessão"
    for i in range(60):
        yes = i % 2 == 0
        words = filler.split() + (["eficiência", "mercado", "incentivos"] if yes else ["agravo", "prazo", "custas"]) * 4
        rng.shuffle(words)
        text = f"Coase {i} " + " ".join(words * 2) + ". " + "sem o termo buscado " * 20
        (folder / f"r{i}.pdf").write_bytes(text.encode())
    (folder / "bad.pdf").write_bytes(b"\xff")
    docs = corpus.build_documents(spark, str(folder), f"{tmp_path}/docs", lambda b: [b.decode()])
    assert docs.count() == 61 and docs.where("texto_completo = ''").count() == 1
    found = corpus.build_term_paragraphs(docs, f"{tmp_path}/found")
    assert found.columns == ["nome_pdf", "termos_encontrados", "paragrafo_completo"] and found.count() == 60
    assert corpus.check_duplicates(docs)["stats"].first().duplicates == 0
    number = F.regexp_extract("nome_pdf", r"r(\d+)", 1).cast("int")
    label = F.when(number >= 50, None).when(number % 2 == 0, "Sim").otherwise("Não")
    hand = found.select(label.alias("rotulo"), "nome_pdf", "termos_encontrados", "paragrafo_completo")
    grids = {"LogisticRegression": {"max_features": [50], "C": [1, 10]},
             "KNeighbors": {"max_features": [50], "n_neighbors": [3]}}
    scored, model, told = evidence.classify_paragraphs(hand, grids=grids, k=3, repeats=1)
    rows = scored.collect()
    assert len(rows) == 60 and scored.where("in_training").count() == 50 - told["predictions"].where("model = 'KNeighbors'").count()
    truth = {r.nome_pdf: "Sim" if int(r.nome_pdf[1:-4]) % 2 == 0 else "Não" for r in rows}
    assert sum(truth[r.nome_pdf] == r.predicted_label for r in rows) >= 57
    assert {"summary", "trace", "confusion", "report"} <= set(told) and told["report"].count() == 5
    meta = spark.createDataFrame(
        [(f"r{i}", f"{2012 + i % 3}-05-01", "ADI" if i % 4 else "RE", f"M{i % 5}") for i in range(60)],
        "id string, julgamento_data string, processo_classe_sigla string, relator_processo string")
    results = tables.resolve_columns(evidence.positives(scored, meta))
    positive = {r.nome_pdf for r in rows if r.predicted_label == "Sim"}
    assert results.count() == len(positive)
    year = reports.report_year(results)
    assert year.count() == 14 and year.agg(F.sum("n")).first()[0] == len(positive)
