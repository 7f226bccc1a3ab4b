"""Counting operators.

Every aggregate here is decomposable (count, sum, max), so Spark runs it as a
partial aggregate before the shuffle and a final one after it: a hot key that
holds a third of all rows sends one partial row per map task across the
network, never its rows. Nothing collects a group into a list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.scalar import utf16_length
from tidepool.functions.timecols import epoch_micros


def word_count(words: DataFrame, word_col: str = "word", out: str = "n") -> DataFrame:
    """A1: occurrences per word (map-side combined, like ``reduceByKey``)."""
    return words.groupBy(word_col).agg(F.count(F.lit(1)).alias(out))


def distinct_count(counts: DataFrame, out: str = "n_distinct") -> DataFrame:
    """A2: number of rows of a count result, i.e. the number of distinct keys."""
    return counts.agg(F.count(F.lit(1)).alias(out))


def tag_size(tags: DataFrame, movie_col: str = "movieId", user_col: str = "userId",
             tag_col: str = "tag", out: str = "tagSize", keep_user: bool = False) -> DataFrame:
    """A3 + P9: total UTF-16 length of the tags of each (movie, user) pair.

    NULL tags add nothing and a group of only NULL tags gives 0. The user key
    is dropped afterwards (keeping one row per pair, duplicates included)
    unless ``keep_user``. A sum of lengths, not a UDF over ``collect_list``,
    so no group is ever held in memory.
    """
    sized = (tags.groupBy(movie_col, user_col)
             .agg(F.coalesce(F.sum(utf16_length(tag_col)), F.lit(0).cast("bigint")).alias(out)))
    return sized if keep_user else sized.select(movie_col, out)


# Microseconds per unit of a window length.
_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def duration_micros(duration: str) -> int:
    """Microseconds of a window length such as ``"5 seconds"``."""
    number, unit = duration.split()
    return int(number) * _UNIT_US[unit.rstrip("s")]


def _by_window(df: DataFrame, time_col: str, duration: str, keys: tuple[str, ...],
               aggs: list[Column], start_col: str) -> DataFrame:
    if df.isStreaming:
        # Grouping on the window struct itself keeps the link to a watermark on
        # ``time_col``, so the same code runs in a streaming append query.
        grouped = df.groupBy(F.window(time_col, duration).alias("_window"), *keys).agg(*aggs)
        return grouped.select(F.col("_window.start").alias(start_col), *keys,
                              *[c for c in grouped.columns if c != "_window" and c not in keys])
    # ``window`` drops rows without a time; the plain start keeps them as one NULL group.
    inside = F.pmod(epoch_micros(df, time_col), F.lit(duration_micros(duration)))
    seconds = inside.cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(7,0)")
    zero = F.lit(0)
    start = F.col(time_col) - F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    names = [f"_key{i}" for i in range(len(keys))]
    grouped = df.groupBy(start.alias("_start"), *[F.col(k).alias(n) for k, n in zip(keys, names)])
    out = grouped.agg(*aggs)
    return out.select(F.col("_start").alias(start_col),
                      *[F.col(n).alias(k) for k, n in zip(keys, names)],
                      *[c for c in out.columns if c != "_start" and c not in names])


def count_per_window(df: DataFrame, time_col: str, key_col: str, duration: str,
                     out: str = "n", start_col: str = "window_start") -> DataFrame:
    """A4/A5: rows per key per tumbling window (the table form of a per-batch count)."""
    return _by_window(df, time_col, duration, (key_col,),
                      [F.count(F.lit(1)).alias(out)], start_col)


def max_string_per_window(df: DataFrame, time_col: str, id_col: str, duration: str,
                          out: str = "max_id", start_col: str = "window_start") -> DataFrame:
    """Greatest id per window in string order (``'9' > '10'``); NULL ids are skipped."""
    return _by_window(df, time_col, duration, (),
                      [F.max(F.col(id_col).cast("string")).alias(out)], start_col)


def rows_per_window(df: DataFrame, time_col: str, duration: str,
                    start_col: str = "window_start") -> DataFrame:
    """A7 (table form): rows per window."""
    return _by_window(df, time_col, duration, (), [F.count(F.lit(1)).alias("n_rows")],
                      start_col)


def running_total(per_batch: DataFrame, order_col: str, value_col: str,
                  out: str = "running_total", group_seconds: int = 86_400) -> DataFrame:
    """A8 (table form): total of ``value_col`` over this and all earlier batches.

    A prefix sum without a single-partition window: batches are grouped by
    ``group_seconds`` of ``order_col`` (a timestamp); each group takes its
    own running sum, the group totals take theirs (one row per group, so
    that window is small), and the group offsets join back.
    """
    group_us = int(group_seconds) * 1_000_000
    staged = per_batch.withColumn("_us", epoch_micros(per_batch, order_col))
    grp = F.expr(f"(_us - pmod(_us, {group_us}L)) div {group_us}L")
    staged = staged.withColumn("_grp", F.coalesce(grp, F.lit(-(2 ** 63)))).drop("_us")
    inside = Window.partitionBy("_grp").orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = staged.withColumn("_local", F.sum(value_col).over(inside))
    earlier = Window.orderBy("_grp").rowsBetween(Window.unboundedPreceding, -1)
    # Group totals come from the ranked rows (already partitioned by group),
    # so both branches share one exchange instead of recomputing the input.
    offsets = (local.groupBy("_grp").agg(F.max("_local").alias("_group_total"))
               .withColumn("_offset", F.coalesce(F.sum("_group_total").over(earlier), F.lit(0)))
               .select("_grp", "_offset"))
    return (local.join(offsets, "_grp")
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint"))
            .drop("_grp", "_local", "_offset"))


def batch_running_totals(df: DataFrame, time_col: str, duration: str,
                         start_col: str = "window_start") -> DataFrame:
    """A7 + A8: rows per window and the running total since the first window."""
    return running_total(rows_per_window(df, time_col, duration, start_col),
                         start_col, "n_rows")


def batch_stats(batch: DataFrame) -> DataFrame:
    """Row count and number of non-empty partitions of a batch, in one pass."""
    return (batch.select(F.spark_partition_id().alias("_part"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("_part").alias("n_partitions")))


def reconcile(sent: DataFrame, counted: DataFrame, key_col: str = "word",
              value_col: str = "n") -> DataFrame:
    """Keys whose sent and counted totals differ (missing counts as 0).

    Both inputs hold one row per key, so the full outer join is over distinct
    keys only.
    """
    s = sent.select(F.col(key_col), F.col(value_col).alias("sent"))
    c = counted.select(F.col(key_col), F.col(value_col).alias("counted"))
    zero = F.lit(0).cast("bigint")
    return (s.join(c, key_col, "full_outer")
            .select(key_col, F.coalesce("sent", zero).alias("sent"),
                    F.coalesce("counted", zero).alias("counted"))
            .where(F.col("sent") != F.col("counted")))


def union_all(*dfs: DataFrame) -> DataFrame:
    """One dataset from many, duplicates kept, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)
