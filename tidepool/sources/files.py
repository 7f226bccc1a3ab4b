"""Batch sources: text lines (S1), headered CSV (S2), the driver's Parquet tables."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line (``value STRING``).

    ``min_partitions`` is a lower bound like ``textFile(path, n)``: the data
    is only redistributed when the scan produced fewer partitions.
    """
    df = spark.read.text(path)
    return spread(df, min_partitions) if min_partitions else df


def read_csv_strings(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A headered CSV with every column read as STRING (no type inference)."""
    reader = spark.read.option("header", "true").option("inferSchema", "false")
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Redistribute a scan that yields fewer splits than the cluster has cores.

    A Parquet row group is never split, so a table written as one large row
    group is read by one task and every per-row step after it runs serially.
    Large inputs have many splits and pass through untouched (the check is a
    plan-time partition count, no job); only an under-split input pays one
    exchange. It hashes all columns of ``df`` (so apply it after the
    projection): deterministic on retry without the local sort a round-robin
    exchange needs, and identical rows are the only ones kept together.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except PySparkException:  # a Spark Connect session has no RDD view: leave the plan as is
        return df
    return df.repartition(want, *df.columns) if have < want else df


def read_table(spark: SparkSession, base_dir: str, name: str,
               columns: list[str] | None = None, spread_out: bool = False) -> DataFrame:
    """One of the driver's tables, ``<base_dir>/<name>.parquet``.

    ``spread_out`` (with the ``columns`` used) for inputs followed by heavy
    per-row work (tokenising, JSON, hashing) before their first shuffle; a
    plan that shuffles right after the scan gains nothing from it.
    """
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if spread_out else df
