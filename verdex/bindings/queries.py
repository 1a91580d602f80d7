"""Registered queries: each wires the given tables to one operator of the library."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdex.functions import text as T
from verdex.operators import audit, catalogue, classify, counts, features, folds, grid, metrics, selection, term_index, terms
from verdex.plans import reports
from verdex.runtime import shared_path, spread
from verdex.sources import files, pages, sinks, tables

TERMS = ("the of", "nicht", "ción", "Elle un", "license", "token", "mit ", "apache", "Geau", "@")
FIRST_YEAR, LAST_YEAR = 1996, 2003
PAGE_HITS = 100
WANTED = ("c_name", "c_phone", "c_nationkey", "c_mktsegment", "c_comment")
FOLDS, REPEATS = 10, 5
VOCABULARIES = (1500, 2000, 3000)
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FLAGS = dict(zip(pages.FLAG_FIELDS, ("click", "error", "purchase", "signup", "view")))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


# Sources ----------------------------------------------------------------------------------------


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as API pages of at most PAGE_HITS hits, and for each page a cut-off copy and one
    of another shape, as bad pages."""
    events = table(spark, sf_dir, "events")
    faces = F.when(F.col("event_type") == "click", F.to_json(F.array("event_type", F.lit(None), F.col("user_id").cast("string"))))
    source = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("titulo"),
        F.lit("events").alias("base"),
        F.col("user_id").cast("string").alias("relator_processo_nome"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("julgamento_data"),
        F.date_format("ts", "dd/MM/yyyy").alias("publicacao_data"),
        F.col("event_type").alias("dg_atualizado_em"),
        *[(F.col("event_type") == kind).alias(flag) for flag, kind in FLAGS.items()],
        F.parse_json(F.coalesce(faces, F.concat(F.lit('"'), "event_type", F.lit('"')))).alias("ministro_facet"),
        F.concat(F.lit("\r\n "), F.repeat(F.concat("props", F.lit("\n")), F.least(F.lit(120), "user_id").cast("int"))).alias("ementa_texto"),
    )
    hit = F.struct(F.col("event_id").alias("n"), F.struct(F.col("value").alias("_score"), source.alias("_source")).alias("hit"))
    paged = events.groupBy(F.floor(F.col("event_id") / PAGE_HITS).alias("page")).agg(
        F.array_sort(F.collect_list(hit), lambda a, b: F.when(a["n"] < b["n"], -1).otherwise(1)).alias("h")
    )
    total = events.agg(F.count(F.lit(1)) + F.count_if(F.col("event_type") == "error")).scalar()
    envelope = F.struct(
        F.struct(F.struct(total.alias("value")).alias("total"), F.col("h.hit").alias("hits")).alias("hits")
    )
    good = paged.select("page", F.to_json(F.struct(envelope.alias("result"))).alias("body"))
    cut_off = good.select("page", F.expr("left(body, length(body) - 2)").alias("body"))
    other = good.select("page", F.to_json(F.struct(F.col("page").alias("x"))).alias("body"))
    return good.unionByName(cut_off).unionByName(other)


def hit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.split_hits(pages.parse_pages(raw_pages(spark, sf_dir)))[0]


@query
def ingest_hits(spark, sf_dir):
    """Quarantined pages by reason."""
    return counts.value_counts(pages.split_hits(pages.parse_pages(raw_pages(spark, sf_dir)))[1], "reason")


@query
def merge_pages(spark, sf_dir):
    return hit_rows(spark, sf_dir).select(
        "page", "pos", F.col("hit._source.id").alias("id"), F.col("hit._score").alias("score")
    )


@query
def hits_audit(spark, sf_dir):
    return pages.hits_audit(pages.parse_pages(raw_pages(spark, sf_dir)))


@query
def positional_load(spark, sf_dir):
    return tables.positional_load(table(spark, sf_dir, "customer"))


@query
def labelled_only(spark, sf_dir):
    loaded = tables.positional_load(table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderkey", "o_custkey", "o_orderpriority"))
    return tables.labelled_only(loaded, ("F", "O"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    named = joined.select(
        F.col("o_orderdate").alias("julgamento_data"),
        F.col("o_orderpriority").alias("processo_classe_sigla"),
        F.col("n_name").alias("relator_processo"),
    )
    return tables.resolve_columns(named)


@query
def resolve_columns(spark, sf_dir):
    return counts.value_counts(results(spark, sf_dir).withColumn("k", F.concat_ws("|", "ano", "classe", "relator")), "k")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ANO"), F.col("l_orderkey").cast("string").alias("NÚMERO DO PROCESSO")
    )
    return tables.comparison_years(named)


@query
def yearly_counts_b(spark, sf_dir):
    return counts.value_counts(shipments(spark, sf_dir), "ano")


@query
def extract_text(spark, sf_dir):
    html = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return html.select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query
def fold_pages(spark, sf_dir):
    return files.fold_pages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


# Scalar functions -------------------------------------------------------------------------------


def catalogue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.coerce_dates(catalogue.catalogue(hit_rows(spark, sf_dir)))


QUERIES["catalogue"] = catalogue_rows


@query
def list_to_string(spark, sf_dir):
    items = F.array(
        "p_name", F.when(F.col("p_size") < 25, F.col("p_brand")), F.col("p_size").cast("string")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        T.list_to_string(F.when(F.col("p_size") < 40, items)).alias("joined"),
        T.variant_to_string(F.parse_json(F.to_json(items))).alias("from_variant"),
    )


@query
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("text"))


@query
def truncate_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.truncate_text(F.col("text"), 1000).alias("text"))


@query
def coerce_dates(spark, sf_dir):
    as_text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.col("o_orderpriority"))
    )
    dated = table(spark, sf_dir, "orders").select("o_orderkey", as_text.alias("julgamento_data"))
    return catalogue.coerce_dates(dated)


@query
def select_present(spark, sf_dir):
    return tables.select_present(table(spark, sf_dir, "customer"), WANTED)


@query
def head(spark, sf_dir):
    return tables.head(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderkey")


@query
def profile(spark, sf_dir):
    return tables.profile(table(spark, sf_dir, "orders"))


@query
def label_encode(spark, sf_dir):
    """Order priorities as their place in the alphabetical list, and back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label_index"))
    coded = classify.encode_labels(orders, "label_index", PRIORITIES)
    return coded.withColumn("decoded", classify.decode_labels(F.col("label_index"), PRIORITIES))


@query
def normalise_tokens(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", F.concat_ws(" ", T.tokens(F.col("text"))).alias("tokens")
    )


# Text -------------------------------------------------------------------------------------------


@query
def term_match(spark, sf_dir):
    matched = terms.match_terms(documents(spark, sf_dir), "text", TERMS)
    return matched.select("doc_id", F.concat_ws(", ", "terms").alias("terms"))


@query
def search_any(spark, sf_dir):
    return terms.search_any(documents(spark, sf_dir), "text", TERMS).select("doc_id")


@query
def paragraphs(spark, sf_dir):
    return terms.paragraphs(documents(spark, sf_dir), "doc_id", "text")


@query
def dedup_prefix(spark, sf_dir):
    cut = terms.paragraphs(documents(spark, sf_dir), "doc_id", "text")
    return terms.dedup_prefix(cut, "doc_id", "paragraph", "pos")


@query
def term_paragraphs(spark, sf_dir):
    found = terms.term_paragraphs(documents(spark, sf_dir), "doc_id", "text", TERMS)
    return found.withColumn("terms", F.concat_ws(", ", "terms"))


@query
def stem_vocab(spark, sf_dir):
    worded = documents(spark, sf_dir).select(T.tokens(F.col("text")).alias("words"))
    return features.stem_vocab(worded, "words")


def gram_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_grams(documents(spark, sf_dir), "text", stem=False).select("doc_id", "grams")


def written_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words written once, for the passes of the vocabulary, the scaling and the output."""
    return features.written_grams(documents(spark, sf_dir), "text", stem=False)


@query
def ngrams(spark, sf_dir):
    return features.gram_counts(gram_rows(spark, sf_dir), "grams")


@query
def tfidf_top_terms(spark, sf_dir):
    return rounded(features.vocabulary(written_grams(spark, sf_dir), "grams"), "idf")


@query
def tfidf_terms(spark, sf_dir):
    return rounded(features.tfidf_terms(written_grams(spark, sf_dir), "doc_id", "grams"), "value")


@query
def scale_features(spark, sf_dir):
    return rounded(features.tfidf_terms(written_grams(spark, sf_dir), "doc_id", "grams", scale=True), "value")


# Audits -----------------------------------------------------------------------------------------


@query
def missing_files(spark, sf_dir):
    listed = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    present = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return audit.missing_ids(listed, present, "id")


@query
def extra_files(spark, sf_dir):
    """Files are the documents; the catalogue lists those labelled as of good quality."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    listed = good.select(F.col("doc_id").cast("string").alias("id"))
    present = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return audit.missing_ids(present, listed, "id")


@query
def catalogue_audit(spark, sf_dir):
    """Documents that a catalogue lacks, after the catalogue has been written and read as CSV. It lists
    the labelled documents; their titles are whole texts, with line feeds and quotes."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("titulo"))
    listed = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    path = shared_path(spark, "catalogue")
    sinks.write_csv(docs.join(listed, "id", "left_semi"), path)
    return audit.missing_ids(docs.select("id"), tables.catalogue_ids(spark, path), "id")


@query
def duplicate_stats(spark, sf_dir):
    return audit.duplicate_stats(documents(spark, sf_dir), "text")


@query
def duplicate_rows(spark, sf_dir):
    return audit.duplicate_rows(documents(spark, sf_dir), "doc_id", "text")


# Counts -----------------------------------------------------------------------------------------


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, toxic): quality 1 is 'Sim', 0 is 'Não'."""
    label = F.when(F.col("quality") == 1, "Sim").otherwise("Não")
    return table(spark, sf_dir, "labels").select("doc_id", label.alias("label"), "quality", "toxic")


@query
def value_counts(spark, sf_dir):
    return counts.value_counts(table(spark, sf_dir, "part"), "p_brand")


@query
def label_share(spark, sf_dir):
    return rounded(counts.label_share(labelled(spark, sf_dir), "label"), "pct")


@query
def top_k(spark, sf_dir):
    return counts.top_k(table(spark, sf_dir, "part"), "p_brand", 8)


@query
def year_spine(spark, sf_dir):
    return counts.year_spine(counts.value_counts(results(spark, sf_dir), "ano"), FIRST_YEAR, LAST_YEAR)


@query
def compare_years(spark, sf_dir):
    a = counts.value_counts(results(spark, sf_dir), "ano")
    return counts.compare_years(a, counts.value_counts(shipments(spark, sf_dir), "ano"), FIRST_YEAR, LAST_YEAR)


def long_form(wide: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """Wide tables are checked in long form, where the order of columns is a value too."""
    cols = [c for c in wide.columns if c != key]
    cells = [F.struct(F.lit(i).alias("place"), F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for i, c in enumerate(cols)]
    return wide.select(key, F.inline(F.array(*cells)))


@query
def crosstab_top(spark, sf_dir):
    return long_form(counts.crosstab_top(results(spark, sf_dir), "ano", "relator", 6), "ano", "relator", "n")


@query
def crosstab_pct(spark, sf_dir):
    return rounded(counts.crosstab_pct(results(spark, sf_dir), "ano", "relator", 6), "pct")


@query
def crosstab_t(spark, sf_dir):
    years = list(range(FIRST_YEAR, LAST_YEAR + 1))
    return long_form(counts.crosstab_t(results(spark, sf_dir), "ano", "relator", 6, years), "relator", "ano", "n")


# Reports ----------------------------------------------------------------------------------------


@query
def report_year(spark, sf_dir):
    return reports.report_year(results(spark, sf_dir), FIRST_YEAR, LAST_YEAR)


@query
def report_top_class(spark, sf_dir):
    branded = table(spark, sf_dir, "part").select(F.col("p_brand").alias("classe"))
    return reports.report_top_class(branded)


@query
def report_top_rapporteur(spark, sf_dir):
    return reports.report_top_rapporteur(results(spark, sf_dir))


@query
def report_rapporteur_year(spark, sf_dir):
    wide = reports.report_rapporteur_year(results(spark, sf_dir), FIRST_YEAR, LAST_YEAR)
    return long_form(wide, "ano", "relator", "n")


@query
def report_class_pct(spark, sf_dir):
    wide = reports.report_class_pct(results(spark, sf_dir), FIRST_YEAR, LAST_YEAR, 4)
    return rounded(long_form(wide, "ano", "classe", "pct"), "pct")


@query
def report_class_heat(spark, sf_dir):
    wide = reports.report_class_heat(results(spark, sf_dir), FIRST_YEAR, LAST_YEAR, 4)
    return long_form(wide, "classe", "ano", "n")


@query
def report_compare(spark, sf_dir):
    return reports.report_compare(results(spark, sf_dir), shipments(spark, sf_dir), FIRST_YEAR, LAST_YEAR)


# Splits, metrics, tests -------------------------------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    return folds.stratified_split(labelled(spark, sf_dir), "doc_id", "label")


@query
def fold_table(spark, sf_dir):
    return folds.fold_table(labelled(spark, sf_dir), "doc_id", "label")


@query
def class_weights(spark, sf_dir):
    return rounded(folds.class_weights(labelled(spark, sf_dir), "label"), "weight")


@query
def confusion(spark, sf_dir):
    return metrics.confusion(labelled(spark, sf_dir), "quality", "toxic")


@query
def binary_metrics(spark, sf_dir):
    return rounded(
        metrics.binary_metrics(labelled(spark, sf_dir), (), "quality", "toxic"), *metrics.METRICS
    )


@query
def class_report(spark, sf_dir):
    return rounded(
        metrics.class_report(labelled(spark, sf_dir), "quality", "toxic"), "precision", "recall", "f1"
    )


@query
def fold_metrics(spark, sf_dir):
    """`toxic` stands for the predictions of one model per document source."""
    sources = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("model"))
    rows = labelled(spark, sf_dir)
    folded = folds.fold_table(rows, "doc_id", "label", FOLDS, REPEATS).drop("label")
    pred = folded.join(rows, "doc_id").join(sources, "doc_id").select(
        "model", "repeat", "fold", F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )
    return rounded(metrics.fold_metrics(pred), *metrics.METRICS)


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per model and fold: mean event value per type and tenth of the users."""
    return table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("model"), F.pmod("user_id", F.lit(10)).alias("fold")
    ).agg(F.round(F.avg("value"), 5).alias("score"))


@query
def grid_summary(spark, sf_dir):
    return rounded(
        metrics.grid_summary(event_scores(spark, sf_dir), "model", "score"), "mean_score", "std_score"
    )


def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three metrics per model and fold, from three aggregates of the events.

    The first is raised by the length of the model's name, so that the cascade has something to find.
    """
    lift = 6.0 * F.least(F.length("event_type"), F.lit(6))
    return table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("model"), F.pmod("user_id", F.lit(10)).cast("string").alias("block")
    ).agg(
        F.round(F.avg(F.col("value") + lift), 5).alias("precision_sim"),
        F.max("value").alias("accuracy"),
        F.min("value").alias("f1_macro"),
    ).unpivot(["model", "block"], list(metrics.METRICS), "metric", "score")


def test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model")).agg(
        F.round(F.avg("value"), 6).alias("accuracy"),
        F.round(F.avg(F.col("value") * F.col("value")), 6).alias("precision_sim"),
        F.round(F.avg(F.sqrt(F.abs("value"))), 6).alias("f1_macro"),
    )


@query
def model_summary(spark, sf_dir):
    return rounded(
        metrics.model_summary(cv_scores(spark, sf_dir), test_scores(spark, sf_dir)),
        "cv_accuracy", "cv_precision_sim",
    )


@query
def model_comparison(spark, sf_dir):
    return metrics.model_comparison(test_scores(spark, sf_dir))


@query
def friedman_stat(spark, sf_dir):
    return rounded(
        selection.friedman(event_scores(spark, sf_dir), "fold", "model", "score"), "statistic", "p_value"
    )


@query
def nemenyi_q(spark, sf_dir):
    return rounded(selection.nemenyi(event_scores(spark, sf_dir), "fold", "model", "score"), "q", "p_value")


@query
def select_model(spark, sf_dir):
    tested = test_scores(spark, sf_dir)
    order = [r[0] for r in tested.select("model").orderBy("model").collect()]
    _, trace = selection.select_model(cv_scores(spark, sf_dir), tested, order)
    return rounded(trace, "p_value")


# Classifiers ------------------------------------------------------------------------------------


def training_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of all labelled documents."""
    rows = table(spark, sf_dir, "labels").join(documents(spark, sf_dir), "doc_id")
    rows = rows.select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    return classify.train_and_test(classify.train_table(rows, "doc_id", "text", "label"))


def classified(spark: SparkSession, sf_dir: str, name: str, **params) -> DataFrame:
    """Test rows with the prediction of one classifier trained on the training rows."""
    train, test = training_rows(spark, sf_dir)
    scored = classify.fit_model(name, train, **params).transform(test)
    return scored.select("row_id", "label", "prediction", F.round("confidence", 6).alias("confidence"))


for key, name, params in (
    ("clf_logistic", "LogisticRegression", {"C": 1}),
    ("clf_forest", "RandomForest", {"n_estimators": 200, "max_depth": 20}),
    ("clf_gbt_a", "BoostedTreesWeighted", {"n_estimators": 100, "learning_rate": 0.05}),
    ("clf_gbt_b", "BoostedTrees", {"n_estimators": 100, "max_depth": 3}),
    ("clf_svc", "SVC", {"C": 1, "kernel": "linear"}),
    ("clf_svc_rbf", "SVC", {"C": 1, "kernel": "rbf"}),
    ("clf_knn", "KNeighbors", {"n_neighbors": 3}),
    ("clf_mlp", "MLPClassifier", {"hidden": 50}),
):
    QUERIES[key] = partial(classified, name=name, **params)


@query
def grid_search(spark, sf_dir):
    """Every point of the two grids whose fits share their passes, on all 10 x 5 folds."""
    train, _ = training_rows(spark, sf_dir)
    return rounded(grid.batched_scores(train), *metrics.METRICS)


@query
def term_index_match(spark, sf_dir):
    """Documents with any of the thousands of words of the benchmark and page texts, and which."""
    given = table(spark, sf_dir, "benchmark").select("text").unionByName(table(spark, sf_dir, "pages").select(F.col("url").alias("text")))
    words = given.select(F.explode(F.split("text", "[ /.]+")).alias("w")).where("length(w) >= 4").distinct()
    listed = sorted((r.w for r in words.collect()), key=str.encode)
    found = term_index.match_many(documents(spark, sf_dir), "text", listed)
    return found.select("doc_id", F.size("terms").cast("long").alias("n_terms"), F.md5(F.array_join("terms", "\n")).alias("terms_md5"))


@query
def fold_vocabularies(spark, sf_dir):
    """Every fold's vocabularies, taken from the total counts by subtraction: size, least count, digest of the terms."""
    rows = documents(spark, sf_dir).join(labelled(spark, sf_dir).select("doc_id", "label"), "doc_id")
    train = features.written_grams(rows.withColumnRenamed("doc_id", "row_id"), "text", stem=False)
    spaces, _ = grid.fold_spaces(train, VOCABULARIES)
    found = []
    for i, (repeat, fold, size) in enumerate(spaces.keys):
        own = spaces.vocabulary(i)
        digest = hashlib.md5(" ".join(term for term, *_ in own).encode()).hexdigest()
        found.append((repeat, fold, size, len(own), int(spaces.n_rows[i]), min(n for _, n, _ in own), digest))
    return spark.createDataFrame(
        found, "repeat int, fold int, size int, n_terms long, n_rows long, least_count long, terms_md5 string")


@query
def feature_importance(spark, sf_dir):
    train, _ = training_rows(spark, sf_dir)
    model = classify.fit_model("LogisticRegression", train)
    return rounded(classify.feature_importance(model, spark), "importance")


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its prediction, and whether the model saw it in training."""
    train, _ = training_rows(spark, sf_dir)
    model = classify.fit_model("LogisticRegression", train)
    # the split is a digest per class, so a row's side needs its label, of which a document has one at most
    given = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    cuts = folds.split_cuts(given, "doc_id", "label")
    scored = classify.score_base(model, documents(spark, sf_dir), "doc_id", "text").drop("text")
    known = F.col("label").isNotNull() & ~folds.in_test(cuts, "doc_id", "label")
    return scored.join(given, "doc_id", "left").withColumn("in_training", known).drop("label")


@query
def score_base(spark, sf_dir):
    return rounded(scored_documents(spark, sf_dir), "prediction_confidence")


@query
def positives_with_metadata(spark, sf_dir):
    """`quality` stands for the prediction; the documents' own columns are the catalogue."""
    pred = labelled(spark, sf_dir).withColumnRenamed("label", "predicted_label")
    meta = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return classify.positives_with_metadata(pred, meta, "doc_id")
