import math
import random

import brute
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from verdex.functions.tails import chi2_sf, range_sf
from verdex.operators import classify, features, folds, knn, metrics, selection
from verdex.plans.evidence import train_and_select

WORDS = "lei custo mercado firma coase recurso ação voto turma pleno relator direito norma bem".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = []
    for i in range(90):
        label = float(i % 3 != 0)
        words = rng.choices(WORDS, k=rng.randint(0, 30)) + (["externalidade"] * 2 if label else ["agravo"])
        rows.append((i, label, " ".join(words)))
    return spark.createDataFrame(rows, "row_id int, label double, text string").repartition(4)


def grams_of(df):
    return {r.row_id: brute.grams([brute.stem(w) for w in brute.tokens(r.text)]) for r in df.collect()}


def test_vocabulary_and_tfidf(corpus):
    grams = features.with_grams(corpus, "text")
    want_grams = grams_of(corpus)
    assert {r.row_id: r.grams for r in grams.collect()} == want_grams
    for size in (1500, 20):
        ids = sorted(want_grams)
        want = brute.tfidf([want_grams[i] for i in ids], size=size)
        got = {}
        for r in features.tfidf_terms(grams, "row_id", "grams", max_features=size).collect():
            got.setdefault(r.row_id, {})[r.term] = r.value
        for i, w in zip(ids, want):
            assert got.get(i, {}) == pytest.approx(w)


def test_max_df_drops_terms_of_every_row(spark):
    df = spark.createDataFrame([(i, ["all", f"t{i % 3}"]) for i in range(9)], "row_id int, grams array<string>")
    assert {r.term for r in features.vocabulary(df, "grams").collect()} == {"t0", "t1", "t2"}
    empty = spark.createDataFrame([(1, [])], "row_id int, grams array<string>")
    assert features.vocabulary(empty, "grams").collect() == []
    with pytest.raises(ValueError):
        features.fit_tfidf(empty)


def test_scaling(spark):
    rows = [(Vectors.sparse(3, {0: 1.0, 1: 0.3}),), (Vectors.sparse(3, {0: 4.0, 1: 0.3}),), (Vectors.sparse(3, {1: 0.3}),)]
    df = spark.createDataFrame(rows, ["v"])
    got = np.array([r.x.toArray() for r in features.fit_scaling(df, "v", "x").transform(df).collect()])
    want = np.array([r[0].toArray() for r in rows])
    std = want.std(axis=0)
    std[1:] = 1.0  # a constant and an empty column stay as they are
    assert got == pytest.approx(want / std)


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_knn_is_exact_over_blocks(spark, block_rows, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    dense = np.round(rng.random((60, 6)) * (rng.random((60, 6)) < 0.5), 1)
    dense[10] = dense[11] = dense[12]  # ties
    rows = [(i, float(i % 2), Vectors.sparse(6, {j: float(x) for j, x in enumerate(v) if x})) for i, v in enumerate(dense)]
    df = spark.createDataFrame(rows, ["row_id", "label", "features"])
    train, query = df.where("row_id < 40"), df.where("row_id >= 40 or row_id = 11")
    got = {}
    for r in knn.nearest(train, query, 3).collect():
        got.setdefault(r.row_id, set()).add((r.neighbour, r.neighbour_label, round(r.distance, 6)))
    for q in [11, *range(40, 60)]:
        d = np.round(((dense[:40] - dense[q]) ** 2).sum(1), 9)
        order = sorted(range(40), key=lambda t: (d[t], t))[:3]
        assert got[q] == {(t, float(t % 2), round(math.sqrt(d[t]), 6)) for t in order}
    votes = {r.row_id: (r.prediction, r.confidence) for r in knn.voter(train, 3)(query).collect()}
    for q, found in got.items():
        p = sum(l for _, l, _ in found) / 3
        assert votes[q] == (float(p > 0.5), pytest.approx(max(p, 1 - p)))


def test_knn_keeps_null_and_repeated_ids(spark):
    rows = [(i, float(i > 2), Vectors.sparse(1, {0: float(i)})) for i in range(6)]
    train = spark.createDataFrame(rows, ["row_id", "label", "features"])
    asked = train.selectExpr("case when row_id < 2 then null when row_id < 4 then 9 else row_id end as row_id", "features")
    votes = sorted((r.row_id is None, r.row_id or 0, r.prediction) for r in knn.voter(train, 1)(asked).collect())
    assert votes == [(False, 4, 1.0), (False, 5, 1.0), (False, 9, 0.0), (False, 9, 1.0), (True, 0, 0.0), (True, 0, 0.0)]
    with pytest.raises(ValueError):
        knn.voter(train.limit(0), 1)


@pytest.mark.parametrize("k", [1, 4, 80])
def test_knn_over_chunks_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(k)
    dense = np.round(rng.normal(0, 1, (70, 9)) * (rng.random((70, 9)) < 0.3), 1)
    dense[20:30] = dense[5]  # ties across chunks
    dense[40] = 0
    keys = [None if i < 3 else i // 2 for i in range(50)]
    rows = [(q, float(i % 3 == 0), Vectors.sparse(9, {j: float(x) for j, x in enumerate(v) if x}), i)
            for i, (q, v) in enumerate(zip(keys + list(range(100, 120)), dense))]
    df = spark.createDataFrame(rows, ["row_id", "label", "features", "n"])
    train, query = df.where("n < 50").repartition(3), df.where("n >= 50")
    got = {}
    for r in knn.nearest(train, query, k, most=11).collect():
        got.setdefault(r.row_id, []).append((round(r.distance, 6), r.neighbour, r.neighbour_label))
    order = lambda d, t: (d[t], keys[t] is not None, keys[t] or 0, rows[t][1])
    for q in range(100, 120):
        d = np.round(((dense[:50] - dense[q - 50]) ** 2).sum(1), 9)
        first = sorted(range(50), key=lambda t: order(d, t))[:k]
        want = [(round(math.sqrt(d[t]), 6), keys[t], rows[t][1]) for t in first]
        assert [x[0] for x in got[q]] == [x[0] for x in want]
        assert sorted(map(str, got[q])) == sorted(map(str, want))
    whole = {r.row_id: (r.prediction, round(r.confidence, 9)) for r in knn.voter(train, k)(query).collect()}
    assert {r.row_id: (r.prediction, round(r.confidence, 9)) for r in knn.voter(train, k, most=11)(query).collect()} == whole


def test_knn_skips_tiles_that_cannot_hold_a_neighbour(monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(5)
    vectors = [([t], [1.0 + 0.01 * float(rng.random())]) for t in range(32) for _ in range(8)]
    own = knn.TrainingSet(list(range(len(vectors))), [0.0] * len(vectors), 32, vectors)
    read, block = [], own.block
    own.block = lambda tile: read.append(tile) or block(tile)
    _, rows = own.nearest(np.eye(32)[:1], 3)
    assert len(read) == 1 and set(rows[0]) <= set(range(8))


@pytest.mark.parametrize("name,params", [
    ("LogisticRegression", {"C": 1}), ("RandomForest", {"n_estimators": 5, "max_depth": 4}),
    ("BoostedTreesWeighted", {"n_estimators": 2}), ("BoostedTrees", {"n_estimators": 2}), ("SVC", {"C": 1}),
    ("KNeighbors", {"n_neighbors": 3}), ("MLPClassifier", {"hidden": 3, "max_iter": 10}),
])
def test_models_do_not_depend_on_partitions(split, name, params):
    train, test = split
    found = [
        {r.row_id: (r.prediction, round(r.confidence, 5)) for r in classify.fit_model(name, train.repartition(n), **params).transform(test).collect()}
        for n in (1, 7)
    ]
    assert found[0] == found[1]


def test_train_table_keeps_every_row_and_splits_by_id(spark):
    rows = [(f"d{i // 3}", f"texto numero {i} casa rua", float(i // 3 % 2)) for i in range(60)]
    table = classify.train_table(spark.createDataFrame(rows, "id string, text string, label double"), "id", "text", "label")
    sides = {}
    for r in table.collect():
        sides.setdefault(r.row_id, []).append(r.is_test)
    assert table.count() == 60 and all(len(v) == 3 and len(set(v)) == 1 for v in sides.values())
    assert 12 <= sum(v[0] for v in sides.values()) * 3 <= 24


def test_split_cuts_are_the_stratified_split(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(200)], "id long, label long")
    cuts = folds.split_cuts(df, "id", "label")
    got = {(r.id, r.t) for r in df.select("id", folds.in_test(cuts, "id", "label").alias("t")).collect()}
    assert got == {(r.id, r.is_test) for r in folds.stratified_split(df, "id", "label").collect()}


def test_confusion_keeps_a_class_without_rows(spark):
    right = spark.createDataFrame([(1.0, 1.0)] * 3, "label double, prediction double")
    assert [tuple(r) for r in metrics.confusion(right).collect()] == [(0.0, 0, 0), (1.0, 0, 3)]


def test_metrics_edges(spark):
    none = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert metrics.binary_metrics(none).first().asDict() == pytest.approx(
        {"precision_sim": 0.0, "accuracy": 0.5, "f1_macro": (2 / 3) / 2})
    right = spark.createDataFrame([(1.0, 1.0)] * 3, "label double, prediction double")
    assert metrics.binary_metrics(right).first().asDict() == {"precision_sim": 1.0, "accuracy": 1.0, "f1_macro": 1.0}
    report = {r.name: r for r in metrics.class_report(none).collect()}
    assert report["1"].recall == 0 and report["0"].recall == 1 and report["accuracy"].f1 == 0.5
    assert [tuple(r) for r in metrics.confusion(none).collect()] == [(0.0, 1, 0), (1.0, 1, 0)]


def test_grid_summary_and_comparison(spark):
    scores = spark.createDataFrame(
        [("a", 0.5), ("a", 0.7), ("b", 0.6), ("b", 0.6), ("c", 0.1), ("c", 0.1)], "point string, score double")
    got = [(r.point, r.rank, round(r.std_score, 6)) for r in metrics.grid_summary(scores).collect()]
    assert got == [("a", 1, 0.1), ("b", 1, 0.0), ("c", 3, 0.0)]
    test = spark.createDataFrame([("m", 0.9, 0.8, 0.7)], "model string, accuracy double, precision_sim double, f1_macro double")
    assert {(r.metric, r.score) for r in metrics.model_comparison(test).collect()} == {("accuracy", 0.9), ("precision_sim", 0.8)}


def long_scores(spark, table, metric="precision_sim"):
    rows = [(m, str(b), metric, float(s)) for m, values in table.items() for b, s in enumerate(values)]
    return spark.createDataFrame(rows, "model string, block string, metric string, score double")


def test_friedman_known_values(spark):
    """Worked example of a four-treatment, no-tie table, and one with ties by the formula."""
    table = {"a": [1, 2, 3, 1], "b": [2, 1, 1, 2], "c": [3, 3, 2, 3]}
    r = selection.friedman(long_scores(spark, table), "block", "model", "score").first()
    sums = [7, 6, 11]
    want = 12 / (4 * 3 * 4) * sum(s * s for s in sums) - 3 * 4 * 4
    assert r.statistic == pytest.approx(want) and r.p_value == pytest.approx(math.exp(-want / 2))
    rng = random.Random(5)
    table = {m: [rng.randint(0, 3) for _ in range(12)] for m in "abcd"}
    r = selection.friedman(long_scores(spark, table), "block", "model", "score").first()
    per_block = [brute.ranks([table[m][b] for m in "abcd"]) for b in range(12)]
    rank_sums = [sum(p[i] for p in per_block) for i in range(4)]
    ties = sum(
        c**3 - c for b in range(12) for v in set(table[m][b] for m in "abcd")
        for c in [sum(table[m][b] == v for m in "abcd")])
    want = (12 / (12 * 4 * 5) * sum(s * s for s in rank_sums) - 3 * 12 * 5) / (1 - ties / (12 * 4 * 15))
    assert r.statistic == pytest.approx(want)
    tied = selection.friedman(long_scores(spark, {m: [1, 1] for m in "abc"}), "block", "model", "score").first()
    assert tied.statistic is None and tied.p_value is None


def test_tails(spark):
    """Against published table values: chi-square 5 % points, studentized range at infinite df."""
    chi = spark.createDataFrame([(3.841, 1.0), (5.991, 2.0), (7.815, 3.0), (12.592, 6.0), (0.0, 3.0)], "x double, df double")
    got = [r[0] for r in chi.select(chi2_sf()("x", "df")).collect()]
    assert got[:4] == pytest.approx([0.05] * 4, abs=2e-4) and got[4] == 1.0
    q = spark.createDataFrame([(2.772, 2), (3.314, 3), (3.633, 4), (4.170, 7), (0.0, 3)], "q double, k int")
    got = [r[0] for r in q.select(range_sf()("q", "k")).collect()]
    assert got[:4] == pytest.approx([0.05] * 4, abs=2e-4) and got[4] == 1.0


def test_select_model(spark):
    rng = random.Random(2)
    base = [rng.random() * 0.1 for _ in range(30)]
    table = {
        "worst": [0.1 + b for b in base], "good": [0.8 + b + rng.random() * 0.001 for b in base],
        "twin": [0.8 + b + rng.random() * 0.001 for b in base], "bad": [0.3 + b for b in base],
    }
    cv = None
    for metric in metrics.METRICS:
        part = long_scores(spark, table, metric)
        cv = part if cv is None else cv.unionByName(part)
    test = spark.createDataFrame([(m, a) for m, a in [("worst", 1.0), ("good", 0.8), ("twin", 0.9), ("bad", 0.99)]], "model string, accuracy double")
    winner, trace = selection.select_model(cv, test, list(table))
    assert winner == "twin"
    steps = {}
    for r in trace.collect():
        steps.setdefault(r.step, []).append(r.model)
    assert steps == {1: ["good", "twin"], 2: ["good", "twin"], 3: ["good", "twin"], 4: ["twin"]}
    same = {m: [0.5] * 5 for m in "xyz"}
    tied = spark.createDataFrame([(m, 0.5) for m in "xyz"], "model string, accuracy double")
    assert selection.select_model(long_scores(spark, same), tied, list("zxy"))[0] == "z"


@pytest.fixture(scope="module")
def split(corpus):
    return classify.train_and_test(classify.train_table(corpus, "row_id", "text", "label"))


@pytest.mark.parametrize("name,params", [
    ("LogisticRegression", {"C": 1}),
    ("RandomForest", {"n_estimators": 5, "max_depth": None}),
    ("BoostedTreesWeighted", {"n_estimators": 3, "learning_rate": 0.1}),
    ("BoostedTrees", {"n_estimators": 3, "max_depth": 3}),
    ("SVC", {"C": 1, "kernel": "linear"}),
    ("SVC", {"C": 1, "kernel": "rbf"}),
    ("KNeighbors", {"n_neighbors": 3}),
    ("MLPClassifier", {"hidden": 5, "max_iter": 60}),
])
def test_classifiers(split, name, params):
    train, test = split
    model = classify.fit_model(name, train, **params)
    rows = model.transform(test).collect()
    assert sorted(r.row_id for r in rows) == sorted(r.row_id for r in test.collect())
    assert all(r.prediction in (0.0, 1.0) and 0.0 <= r.confidence <= 1.0 + 1e-9 for r in rows)
    if name != "KNeighbors":
        assert sum(r.prediction == r.label for r in rows) / len(rows) > 0.6
    if name not in ("KNeighbors", "SVC"):
        again = classify.fit_model(name, train, **params).transform(test).collect()
        assert {r.row_id: r.prediction for r in again} == {r.row_id: r.prediction for r in rows}
    spark = train.sparkSession
    if model.importances is None:
        with pytest.raises(ValueError):
            classify.feature_importance(model, spark)
    else:
        top = classify.feature_importance(model, spark, 5).collect()
        assert len(top) == 5 and [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_logistic_regression_is_the_optimum_it_should_be(split):
    """Zero gradient of C * sum(balanced weight * log loss) + |w|^2 / 2, the intercept not penalised."""
    train, _ = split
    model = classify.fit_model("LogisticRegression", train, C=10)
    rows = model.featurise(train).select("features", "label").collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])
    weight = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    w, b = model.solver.coefficients.toArray(), model.solver.intercept
    off = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    gradient = 10 * x.T @ off + w
    scale = np.abs(10 * x.T @ (weight * (0.5 - y))).max()  # the gradient at zero
    assert np.abs(gradient).max() < 1e-2 * scale and abs(10 * off.sum()) < 1e-2 * scale


def test_linear_svc_objective(split):
    """No better than the solver's: nudged coefficients do not lower the weighted hinge objective."""
    train, _ = split
    model = classify.fit_model("SVC", train, C=1, kernel="linear")
    rows = model.featurise(train).select("features", "label").collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([2 * r.label - 1 for r in rows])
    weight = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == -1).sum()))
    w, b = model.solver.coefficients.toArray(), model.solver.intercept

    def objective(w, b):
        return (weight * np.maximum(0, 1 - y * (x @ w + b))).sum() + w @ w / 2

    best, rng = objective(w, b), np.random.default_rng(0)
    assert best < objective(w * 0, 0.0)
    for size in (0.3, 0.1):
        for _ in range(20):
            nudge = rng.normal(0, size * np.abs(w).mean(), len(w))
            assert objective(w + nudge, b) > best * 0.99


def test_train_select_score(corpus, spark):
    grids = {
        "LogisticRegression": {"max_features": [20, 40], "C": [1]},
        "KNeighbors": {"max_features": [20], "n_neighbors": [3, 5]},
        "BoostedTrees": {"max_features": [20], "n_estimators": [2], "max_depth": [2]},
    }
    model, tables = train_and_select(corpus, "row_id", "text", "label", grids, k=3, repeats=1)
    assert model.name in grids
    assert tables["scores"].count() == (2 + 2 + 1) * 3
    assert tables["cv"].count() == 3 * 3 * 3
    assert tables["test"].count() == 3
    scored = classify.score_base(model, corpus, "row_id", "text").collect()
    assert len(scored) == 90 and {r.predicted_label for r in scored} <= {"Sim", "Não"}
    meta = spark.createDataFrame([(i, f"m{i}") for i in range(200)], "row_id int, m string")
    pred = spark.createDataFrame(scored)
    positives = {r.row_id for r in scored if r.predicted_label == "Sim"}
    assert {r.row_id for r in classify.positives_with_metadata(pred, meta, "row_id").collect()} == positives


def test_label_codes(spark):
    df = spark.createDataFrame([("Sim",), ("Não",)], "label string")
    coded = classify.encode_labels(df)
    assert [r.label for r in coded.collect()] == [1.0, 0.0]
    assert [r[0] for r in coded.select(classify.decode_labels(F.col("label"))).collect()] == ["Sim", "Não"]


def test_grids_have_the_published_points():
    assert sum(len(classify.grid_points(g)) for g in classify.GRIDS.values()) == 72
