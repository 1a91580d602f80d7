"""Counts, shares, top-k and crosstabs. Every one starts from a partial aggregate on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdex.runtime import cut


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n): nulls dropped, most frequent first, ties by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col))


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    return value_counts(df, col).limit(k)


def label_share(df: DataFrame, col: str) -> DataFrame:
    """Value counts with their share in percent."""
    counts = value_counts(df, col)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", 100.0 * F.col("n") / total)


def spine(df: DataFrame, lo: int, hi: int, col: str = "ano") -> DataFrame:
    """The years lo..hi, one row each."""
    return df.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias(col))


def year_spine(counts: DataFrame, lo: int, hi: int, col: str = "ano") -> DataFrame:
    """Counts on the years lo..hi: gaps are 0, other years are dropped."""
    inside = counts.where(F.col(col).between(lo, hi))
    return spine(counts, lo, hi, col).join(inside, col, "left").fillna(0).orderBy(col)


def compare_years(a: DataFrame, b: DataFrame, lo: int, hi: int, col: str = "ano") -> DataFrame:
    """Two yearly counts (ano, n) side by side on the spine."""
    both = a.withColumnRenamed("n", "n_a").join(b.withColumnRenamed("n", "n_b"), col, "full")
    return year_spine(both, lo, hi, col)


def cells(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long counts (row, col, n), written once: the top values and the table both come from them."""
    return cut(df.where(F.col(col).isNotNull()).groupBy(row, col).agg(F.count(F.lit(1)).alias("n")))


def top_values(counted: DataFrame, col: str, k: int) -> list:
    """The k most frequent values of `col` in long counts, on the driver: k values at most."""
    totals = counted.groupBy(col).agg(F.sum("n").alias("n"))
    return [r[0] for r in totals.orderBy(F.desc("n"), F.asc(col)).limit(k).select(col).collect()]


def crosstab_top(df: DataFrame, row: str, col: str, k: int) -> DataFrame:
    """Row values by the k most frequent column values, columns in that order.

    A row value that occurs only with other column values stays as a row of zeros.
    """
    counted = cells(df, row, col)
    values = top_values(counted, col, k)
    table = counted.where(F.col(row).isNotNull()).groupBy(row).pivot(col, values).agg(F.sum("n"))
    return table.fillna(0).orderBy(row)


def crosstab_pct(df: DataFrame, row: str, col: str, k: int) -> DataFrame:
    """Long form (row, col, n, pct): share within the row, over the k column values only."""
    counted = cells(df, row, col)
    wanted = counted.where(F.col(col).isin(top_values(counted, col, k)) & F.col(row).isNotNull())
    # At most k rows per row value.
    total = F.sum("n").over(Window.partitionBy(row))
    return wanted.withColumn("pct", F.coalesce(F.try_divide(100.0 * F.col("n"), total), F.lit(0.0)))


def crosstab_t(df: DataFrame, row: str, col: str, k: int, rows: list) -> DataFrame:
    """The k column values as rows, the given row values as columns."""
    counted = cells(df, row, col)
    wanted = counted.where(F.col(col).isin(top_values(counted, col, k)))
    return wanted.groupBy(col).pivot(row, rows).agg(F.sum("n")).fillna(0).orderBy(col)
