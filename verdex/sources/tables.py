"""Reading tables by position or by alias, and small projections over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdex.functions.dates import parse_date

# Accepted column names per report field, in order of preference.
RESULT_ALIASES = {
    "data": ("data", "data_julgamento", "julgamento_data", "date", "Data"),
    "classe": ("classe", "processo_classe_sigla", "tipo_processo", "Class", "Classe"),
    "relator": ("relator", "relator_processo", "ministro", "Relator", "Ministro"),
}
# The classes a hand label may have; others are unlabelled rows.
VALID_LABELS = ("Sim", "Não")
# The columns the comparison set must have.
COMPARISON_COLUMNS = ("ANO", "NÚMERO DO PROCESSO")


def positional_load(df: DataFrame) -> DataFrame:
    """Columns 0, 1, 2 and the last one as a labelled-paragraph table; rows without text go."""
    first, second, third = df.columns[:3]
    return df.select(
        F.col(f"`{first}`").alias("label"),
        F.col(f"`{second}`").alias("nome_pdf"),
        F.col(f"`{third}`").alias("termos_encontrados"),
        F.col(f"`{df.columns[-1]}`").alias("text"),
    ).dropna(subset=["text"])


def labelled_only(df: DataFrame, values: Sequence[str] = VALID_LABELS, col: str = "label") -> DataFrame:
    return df.where(F.col(col).isin(*values))


def year_of(df: DataFrame, col: str) -> F.Column:
    """Year of a date, timestamp or text column; an integer column already is the year."""
    kind = dict(df.dtypes)[col]
    if kind in ("int", "bigint", "smallint"):
        return F.col(f"`{col}`").cast("int")
    if kind == "string":
        return F.year(parse_date(F.col(f"`{col}`")))
    return F.year(F.col(f"`{col}`"))


def resolve_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = RESULT_ALIASES) -> DataFrame:
    """Each field from the first alias present; with `data`, undated rows go and `ano` is added.

    No matching column, and no dated row, are errors.
    """
    picked = {
        field: next((name for name in names if name in df.columns), None)
        for field, names in aliases.items()
    }
    picked = {field: name for field, name in picked.items() if name}
    if not picked:
        raise ValueError(f"no column of {df.columns} matches any accepted name")
    out = df.select(*[F.col(f"`{name}`").alias(field) for field, name in picked.items()])
    if "data" in picked:
        if dict(out.dtypes)["data"] == "string":
            out = out.withColumn("data", parse_date(F.col("data")))
        out = require_rows(out.dropna(subset=["data"]).withColumn("ano", F.year("data")))
    return out


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no valid row left")
    return df


def comparison_years(df: DataFrame, required: Sequence[str] = COMPARISON_COLUMNS) -> DataFrame:
    """(ano) per dated row of the comparison set; the first required column holds the date."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"comparison set lacks {absent}")
    return df.select(year_of(df, required[0]).alias("ano")).dropna()


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """Row per column: position, name, type, non-null count, row count. One aggregate, one scan."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names)]
    )
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"),
            F.col(f"_{i}").alias("non_null"), F.col("_rows").alias("rows"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*lines)))


def catalogue_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-null `id` of a catalogue CSV, read as text, with the options `write_csv` uses.

    Fields may hold line feeds, so a file cannot be split. Spark's CSV writer gives many files; for
    repeated use keep the catalogue in Parquet.
    """
    csv = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return csv.select(F.col("id").cast("string")).dropna().distinct()
