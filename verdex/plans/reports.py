"""The report tables: counts per year, class and rapporteur of resolved results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.operators import counts as C

# The years of the spine, and how many classes and rapporteurs are shown.
FIRST_YEAR, LAST_YEAR = 2012, 2025
TOP_CLASSES, TOP_RAPPORTEURS, TOP_CROSS = 8, 15, 6


def _need(df: DataFrame, *fields: str) -> None:
    absent = [f for f in fields if f not in df.columns]
    if absent:
        raise ValueError(f"report needs the fields {absent}, which were not mapped")


def report_year(df: DataFrame, lo: int = FIRST_YEAR, hi: int = LAST_YEAR) -> DataFrame:
    _need(df, "ano")
    return C.year_spine(C.value_counts(df, "ano"), lo, hi)


def report_top_class(df: DataFrame, k: int = TOP_CLASSES) -> DataFrame:
    """The k most frequent classes, least frequent first (display order)."""
    _need(df, "classe")
    return C.top_k(df, "classe", k).orderBy("n", F.desc("classe"))


def report_top_rapporteur(df: DataFrame, k: int = TOP_RAPPORTEURS) -> DataFrame:
    _need(df, "relator")
    return C.top_k(df, "relator", k).orderBy("n", F.desc("relator"))


def report_rapporteur_year(
    df: DataFrame, lo: int = FIRST_YEAR, hi: int = LAST_YEAR, k: int = TOP_CROSS
) -> DataFrame:
    """Year by the k most frequent rapporteurs."""
    _need(df, "ano", "relator")
    return C.year_spine(C.crosstab_top(df, "ano", "relator", k), lo, hi)


def report_class_pct(
    df: DataFrame, lo: int = FIRST_YEAR, hi: int = LAST_YEAR, k: int = TOP_CROSS
) -> DataFrame:
    """Year by the k most frequent classes, percent within the year; an empty year is all 0."""
    _need(df, "ano", "classe")
    table = C.crosstab_top(df, "ano", "classe", k)
    values = table.columns[1:]
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return C.year_spine(table, lo, hi).select(
        "ano",
        *[F.coalesce(F.try_divide(100.0 * F.col(f"`{v}`"), total), F.lit(0.0)).alias(v) for v in values],
    )


def report_class_heat(
    df: DataFrame, lo: int = FIRST_YEAR, hi: int = LAST_YEAR, k: int = TOP_CROSS
) -> DataFrame:
    """The k most frequent classes by year; years without any are columns of zeros."""
    _need(df, "ano", "classe")
    return C.crosstab_t(df, "ano", "classe", k, list(range(lo, hi + 1)))


def report_compare(a: DataFrame, b: DataFrame, lo: int = FIRST_YEAR, hi: int = LAST_YEAR) -> DataFrame:
    """Records per year of two tables with `ano`."""
    _need(a, "ano")
    _need(b, "ano")
    return C.compare_years(C.value_counts(a, "ano"), C.value_counts(b, "ano"), lo, hi)
