"""Sinks. CSV goes out without a byte-order mark; Spark's reader drops one if present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _flat(df: DataFrame, sep: str = ", ") -> DataFrame:
    """CSV has no arrays: join them."""
    return df.select(
        *[F.array_join(c, sep).alias(c) if t.startswith("array") else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    _flat(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines, one hit or row per line; non-ASCII characters are written as they are."""
    df.write.mode(mode).json(path)
