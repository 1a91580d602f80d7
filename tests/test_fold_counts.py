"""Fold vocabularies: texts' grams stay in the training table, names reach the JVM in one call."""

from pyspark.ml.feature import CountVectorizerModel

from verdex.operators import frequent, grid


def training(spark):
    rows = [(i, float(i % 2), [f"w{i % 7}", "and", f"x{i % 3}", f"w{i % 7} and"]) for i in range(60)]
    rows += [(None, 1.0, ["lost"] * 50), (60, None, ["void"] * 50)]
    return spark.createDataFrame(rows, "row_id long, label double, grams array<string>")


def test_grams_are_not_written_with_the_folds(spark, monkeypatch):
    written = []

    def cut(df, *more):
        written.append(df.columns)
        return keep(df, *more)

    keep = grid.cut
    monkeypatch.setattr(grid, "cut", cut)
    spaces, rows = grid.fold_spaces(training(spark), [4, 8], 3, 2, max_df=1.0)
    assert written and not any("grams" in columns for columns in written)
    assert rows.columns == ["row_id", "label", "r0", "r1", "idx", "n"] and rows.count() == 60
    # rows without an id or a label have no fold and count for nothing
    assert "lost" not in spaces.terms and "void" not in spaces.terms
    assert sum(spaces.n_rows) == 2 * 2 * 120  # in two repeats and sizes, a row is in two of three trainings
    assert spaces.vocabulary(0)[0][:2] == ("and", spaces.n_rows[0])


def test_names_reach_the_jvm_in_one_call(spark, monkeypatch):
    names = ["and", "é ü", "漢字", "x1", " "]
    df = spark.createDataFrame([(["and", "é ü", "and"],), (["漢字", "zz", " "],), (None,)], "g array<string>")
    asked = CountVectorizerModel.from_vocabulary(names, inputCol="g", outputCol="v")
    with monkeypatch.context() as patch:
        patch.setattr(CountVectorizerModel, "_new_java_array", None)
        model = frequent.count_model(names, "g", "v")
        found = frequent.exact_counts(df, "g", names).set_index("term")
    given = df.where("g is not null")
    assert model.vocabulary == names and model.getOrDefault("vocabSize") == len(names)
    assert model.transform(given).collect() == asked.transform(given).collect()
    assert dict(found["n_total"]) == {"and": 2, "é ü": 1, "漢字": 1, " ": 1}
    # names that the separator or the emptiness of a name would spoil go one by one
    assert frequent.count_model(["a\nb", "", "c"], "g", "v").vocabulary == ["a\nb", "", "c"]
