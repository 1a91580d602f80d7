"""Summaries take occurrences a few at a time, however long the rows are."""

from verdex.operators import frequent


def test_long_rows_come_in_short_batches(spark):
    rows = [([f"t{i % 50}" for i in range(n)],) for n in (30_000, 25_000, 0, 3)] + [(None,)]
    df = spark.createDataFrame(rows, "grams array<string>").coalesce(1)

    def lengths(batches):
        for batch in batches:
            yield batch.slice(0, 0)
            assert batch.num_rows <= 10_000 and batch.nbytes < 1 << 20

    frequent._occurrences(df, "grams").mapInArrow(lengths, "term string").collect()
    assert frequent._occurrences(df, "grams").count() == 55_003
    names, error = frequent.summary(df, "grams", 60)
    assert len(names) == 50 and error == 0
