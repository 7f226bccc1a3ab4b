"""Time columns as integers (used to cut and compare times in the operators)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(df: DataFrame, time_col: str) -> Column:
    """Microseconds since the epoch; a TIMESTAMP_NTZ is read as UTC wall-clock time.

    Built from the wall-clock fields, so no session time zone (and no
    daylight-saving shift) enters a TIMESTAMP_NTZ gap.
    """
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        c = F.col(time_col)
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
        # Zone offsets are whole seconds, so the micro-of-second survives the cast.
        fraction = F.pmod(F.unix_micros(c.cast("timestamp")), F.lit(1_000_000))
        return (days * 86_400_000_000 + F.hour(c).cast("bigint") * 3_600_000_000
                + F.minute(c).cast("bigint") * 60_000_000
                + F.second(c).cast("bigint") * 1_000_000 + fraction)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(time_col))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.col(time_col).cast("bigint")
    raise TypeError(f"{time_col} must be a timestamp or an integer of microseconds")
