import hashlib
import math
import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from verdex.operators import audit, counts, folds, metrics, text_order
from verdex.plans import reports


def test_missing_and_extra(spark):
    a = spark.createDataFrame([("1",)] * 500 + [("2",), ("3",), (None,)], "id string")
    b = spark.createDataFrame([("2",)] * 500 + [("9",), (None,)], "id string")
    assert [r.id for r in audit.missing_ids(a, b, "id").collect()] == ["1", "3"]
    assert [r.id for r in audit.missing_ids(b, a, "id").collect()] == ["9"]


def test_duplicates_with_a_hot_text(spark):
    texts = ["boilerplate " * 20] * 4000 + ["x", "x", None, None, "only"] + [f"t{i}" for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(6)
    stats = audit.duplicate_stats(df, "text").first()
    assert tuple(stats) == (8005, 4004, 4001)
    rows = audit.duplicate_rows(df, "id", "text")
    got = [(r.id, r.preview, r.copies) for r in rows.collect()]
    n = Counter(t for t in texts if t is not None)
    want = {(i, t if len(t) <= 100 else t[:100] + "...", n[t]) for i, t in enumerate(texts) if t and n[t] > 1}
    assert set(got) == want and len(got) == len(want)
    assert [g[1] for g in got] == sorted(g[1] for g in got)


@pytest.mark.parametrize("most", [0, 1000])
def test_text_places_refine_ties(spark, most, monkeypatch):
    monkeypatch.setattr(text_order, "BROADCAST_KEYS", most)
    rng = random.Random(8)
    texts = {"", "a", "ab", "é", "\U0001f600", "\uffee"} | {"a" * n for n in (3, 4, 5, 19, 20, 21, 83, 84, 85, 400)}
    texts |= {"licença " * 20 + rng.choice("abé") * rng.randint(0, 90) + str(rng.randint(0, 9)) for _ in range(60)}
    texts = sorted(texts)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "_key int, _text string").repartition(5)
    keys = rows.dropDuplicates(["_key"]).select("_key", F.substring("_text", 1, 4).alias("_prefix"))
    got = {r._key: r._place for r in text_order.text_places(rows, keys, piece=4).collect()}
    order = sorted(range(len(texts)), key=lambda i: texts[i].encode())
    assert got == {i: n for n, i in enumerate(order)}


def test_duplicates_are_listed_without_moving_whole_texts(spark):
    df = spark.createDataFrame([(i, f"text {i // 2} " * 50) for i in range(40)], "id int, body_text string")
    plan = audit.duplicate_rows(df, "id", "body_text")._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert shuffled and not any("body_text" in line for line in shuffled)


def test_no_duplicates_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    assert audit.duplicate_rows(df, "id", "text").collect() == []
    assert audit.duplicate_rows(df.limit(0), "id", "text").collect() == []
    assert tuple(audit.duplicate_stats(df.limit(0), "text").first()) == (0, 0, 0)


@pytest.fixture(scope="module")
def results(spark):
    rows = (
        [(2019, "A", "r1")] * 3 + [(2020, "B", "r1")] * 3 + [(2020, "A", "r2")] * 2 + [(2022, "C", None)]
        + [(2031, "A", "r3"), (None, "D", "r1"), (2021, None, "r4")]
    )
    return spark.createDataFrame(rows, "ano int, classe string, relator string")


def test_value_counts(results):
    assert [tuple(r) for r in counts.value_counts(results, "classe").collect()] == [
        ("A", 6), ("B", 3), ("C", 1), ("D", 1)]
    assert [tuple(r) for r in counts.top_k(results, "classe", 3).collect()] == [("A", 6), ("B", 3), ("C", 1)]
    share = {r.classe: r.pct for r in counts.label_share(results, "classe").collect()}
    assert share["A"] == pytest.approx(600 / 11) and sum(share.values()) == pytest.approx(100)


def test_reports(results):
    year = [tuple(r) for r in reports.report_year(results, 2018, 2022).collect()]
    assert year == [(2018, 0), (2019, 3), (2020, 5), (2021, 1), (2022, 1)]
    assert [r.classe for r in reports.report_top_class(results, 2).collect()] == ["B", "A"]
    assert [r.relator for r in reports.report_top_rapporteur(results).collect()] == ["r4", "r3", "r2", "r1"]
    table = reports.report_rapporteur_year(results, 2019, 2021, 2)
    assert table.columns == ["ano", "r1", "r2"]
    assert [tuple(r) for r in table.collect()] == [(2019, 3, 0), (2020, 3, 2), (2021, 0, 0)]
    pct = reports.report_class_pct(results, 2019, 2022, 2).collect()
    assert [tuple(r) for r in pct] == [(2019, 100.0, 0.0), (2020, 40.0, 60.0), (2021, 0.0, 0.0), (2022, 0.0, 0.0)]
    heat = reports.report_class_heat(results, 2019, 2021, 2)
    assert heat.columns == ["classe", "2019", "2020", "2021"]
    assert [tuple(r) for r in heat.collect()] == [("A", 3, 2, 0), ("B", 0, 3, 0)]
    both = reports.report_compare(results, results.where("ano = 2022"), 2021, 2023)
    assert [tuple(r) for r in both.collect()] == [(2021, 1, 0), (2022, 1, 1), (2023, 0, 0)]
    with pytest.raises(ValueError):
        reports.report_year(results.drop("ano"))


def test_crosstabs(results):
    wide = counts.crosstab_top(results, "ano", "classe", 2)
    assert [tuple(r) for r in wide.collect()] == [(2019, 3, 0), (2020, 2, 3), (2022, 0, 0), (2031, 1, 0)]
    pct = {(r.ano, r.classe): r.pct for r in counts.crosstab_pct(results, "ano", "classe", 2).collect()}
    assert pct == {(2019, "A"): 100.0, (2020, "A"): 40.0, (2020, "B"): 60.0, (2031, "A"): 100.0}


def md5(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, "Sim" if i % 5 else "Não") for i in range(503)] + [(1000, "rare")]
    return spark.createDataFrame(rows, "id int, label string").repartition(5)


def test_split(labelled):
    rows = [tuple(r) for r in folds.stratified_split(labelled, "id", "label").collect()]
    want = set()
    for label in ("Sim", "Não", "rare"):
        ids = sorted((i for i, l, _ in rows if l == label), key=lambda i: md5(42, i))
        want |= set(ids[: math.ceil(0.25 * len(ids))])
    assert {i for i, _, t in rows if t} == want and len(rows) == 504


def test_folds(labelled):
    rows = [tuple(r) for r in folds.fold_table(labelled, "id", "label", 10, 3).collect()]
    assert len(rows) == 3 * 504
    for repeat in range(3):
        for label in ("Sim", "Não", "rare"):
            part = [(i, f) for r, i, l, f in rows if r == repeat and l == label]
            order = sorted((i for i, _ in part), key=lambda i: md5(42 + repeat, i))
            assert {i: f for i, f in part} == {i: n % 10 for n, i in enumerate(order)}
    again = [tuple(r) for r in folds.fold_table(labelled.repartition(2), "id", "label", 10, 3).collect()]
    assert sorted(again) == sorted(rows)


def test_class_weights(labelled):
    got = {r.label: r.weight for r in folds.class_weights(labelled, "label").collect()}
    assert got["rare"] == pytest.approx(504 / 3) and got["Não"] == pytest.approx(504 / (3 * 101))


def test_comparison_bars_are_sorted_by_precision(spark):
    rows = [("b", 0.9, 0.5), ("a", 0.7, 0.8), ("c", 0.6, 0.8)]
    bars = metrics.model_comparison(spark.createDataFrame(rows, "model string, accuracy double, precision_sim double").repartition(3))
    got = [tuple(r) for r in bars.collect()]
    assert [g[0] for g in got] == ["a", "a", "c", "c", "b", "b"]
    assert got[:2] == [("a", "accuracy", 0.7), ("a", "precision_sim", 0.8)]
