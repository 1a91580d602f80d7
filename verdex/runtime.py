"""Helpers for lineage and input spread."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path in `folder` or the shared folder, deleted when the session's JVM ends."""
    folder = folder or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def cut(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write `df` once as Parquet and read it from there: statistics and column pruning stay.

    It goes to a new subfolder of `folder`, else of the shared folder that the session names in
    `spark.checkpoint.dir`, else of the warehouse; never to a machine's own temporary folder. The
    subfolder is deleted when the session's JVM ends.
    """
    path = shared_path(df.sparkSession, "cut", folder)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that `cut` returned, when nothing reads it any more."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(df.cut_at)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame) -> DataFrame:
    """Split a scan over all cores when its files give fewer input splits than there are cores.

    Large inputs have more splits than cores and pass unchanged, without a shuffle. Call it on a
    plain scan (or a projection of one) ahead of CPU-heavy text work.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
