"""Grouping keys for rows that go through pandas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULLS = "tp_nulls"


def null_free(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with null-free key columns and ``NULLS``, which says where a null was.

    In a pandas frame a null beside whole numbers turns them into floats, under which
    Spark would then file a state or a group.
    """
    nulls = F.concat(*(F.when(F.col(k).isNull(), "1").otherwise("0") for k in keys))
    out = df.withColumn(NULLS, nulls)
    for k in keys:
        kind = df.schema[k].dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"key column {k} is of type {kind.simpleString()}; keys are single values")
        instead = F.lit("1970-01-01") if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.lit(
            b"" if isinstance(kind, T.BinaryType) else "" if isinstance(kind, T.StringType) else False
            if isinstance(kind, T.BooleanType) else 0)
        out = out.withColumn(k, F.coalesce(F.col(k), instead.cast(kind)))
    return out


def with_nulls(keys: list[str], of: str = "") -> list[Column]:
    """The key columns with their nulls again (``of``: the struct that holds them)."""
    at = f"{of}." if of else ""
    return [F.when(F.substring(f"{at}{NULLS}", i + 1, 1) == "0", F.col(at + k)).alias(k) for i, k in enumerate(keys)]
