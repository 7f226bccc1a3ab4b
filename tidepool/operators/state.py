"""Running count per key with an idle timeout, as a table query.

Semantics (the keyed state function of the word and symbol streams):
rows of one key are taken in ``(time, tiebreak)`` order; each row outputs
the number of rows of its key since the key was last idle, itself included.
A key is idle when the next row comes strictly more than ``idle_seconds``
after the previous one; then the count restarts at 1 and the old count is
reported once as a timeout. At the end of the data a key is timed out when
the greatest time seen (over all keys) is strictly more than
``idle_seconds`` after its last row, as a watermark would decide.

Rows without a time come first and join their key's first segment; a key
that has only such rows is timed out as soon as any time was seen (its last
time and its expiry are NULL).

Scale: one key may hold a third of all rows, so no row-level window is
partitioned by key alone. Rows are range-partitioned by (key, time,
tiebreak), which balances by count, whatever the times are: bursts, equal
times and missing times are cut like anything else. Each (key, partition)
group is ranked on its own, one summary row per group is scanned per key,
and the carried values join back. The per-key scan runs over partitions,
not rows, and nothing runs while the plan is built.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidepool.functions.timecols import epoch_micros

_K = "_tp_key"
_T = "_tp_t"
_P = "_tp_part"


def _key_struct(key_cols: list[str]) -> Column:
    # A struct is never NULL even when its fields are, so NULL keys stay one
    # group in joins as they do in windows.
    return F.struct(*[F.col(k) for k in key_cols])


def running_counts(df: DataFrame, key_cols: str | list[str], time_col: str,
                   tiebreak_col: str, idle_seconds: float = 300.0,
                   partitions: int | None = None, out: str = "n") -> DataFrame:
    """Every input row with its running count ``out`` and ``ends_segment``.

    ``ends_segment`` is true on the last row before a timeout. ``partitions``
    sets the number of ranges (default: the session's shuffle partitions,
    coalesced by size); it changes the plan, never the result. The ranged rows stay
    persisted on disk until ``release`` is called on the result.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    idle_us = int(round(idle_seconds * 1_000_000))
    latest = df.agg(F.max(time_col).alias(time_col))
    global_max = latest.select(epoch_micros(latest, time_col)).scalar()

    base = df.withColumn(_K, _key_struct(keys)).withColumn(_T, epoch_micros(df, time_col))
    order = [_K, _T, tiebreak_col]
    ranged = base.repartitionByRange(partitions, *order) if partitions else base.repartitionByRange(*order)
    # Ranges come from a sample, so two evaluations could cut differently: the numbered
    # rows are kept (on disk, recomputed from the same ranges if an executor is lost),
    # and both sides of the join below read the same numbers. Nothing runs yet.
    # The run's own tag keeps Spark from answering a later call, perhaps on a table that
    # has grown since, with the rows kept by this one.
    kept = (ranged.withColumn(_P, F.spark_partition_id()).withColumn("_tp_run", F.lit(uuid.uuid4().hex))
            .persist(StorageLevel.DISK_ONLY))
    base = kept.drop("_tp_run")

    # Rows ranked inside their (key, range), with the restarts that fall inside it.
    inside = Window.partitionBy(_K, _P).orderBy(_T, tiebreak_col)
    sofar = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.coalesce((F.col(_T) - F.lag(_T).over(inside)) > idle_us, F.lit(False))
    ranked = (base.withColumn("_rn", F.row_number().over(inside))
              .withColumn("_gap", gap)
              .withColumn("_next_t", F.lead(_T).over(inside))
              .withColumn("_is_last", F.lead(F.lit(True)).over(inside).isNull()))
    ranked = ranked.withColumn("_from", F.max(F.when(F.col("_gap"), F.col("_rn"))).over(sofar))

    # One summary row per (key, range), from the ranked rows (no further exchange).
    summary = ranked.groupBy(_K, _P).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min(_T).alias("_first_t"), F.max(_T).alias("_last_t"),
        F.max("_from").alias("_from_last"))
    by_key = Window.partitionBy(_K).orderBy(_P)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    after = by_key.rowsBetween(1, Window.unboundedFollowing)
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    restart = F.coalesce((F.col("_first_t") - F.max("_last_t").over(before)) > idle_us, F.lit(False))
    has_gap = F.col("_from_last").isNotNull()
    summary = (summary.withColumn("_restart", restart)
               .withColumn("_next_first_t", F.min("_first_t").over(after))
               .withColumn("_has_more", F.lead(F.lit(True)).over(by_key).isNotNull())
               # What this range adds to the segment that is open behind it.
               .withColumn("_tail", F.when(has_gap, F.col("_cnt") - F.col("_from_last") + 1)
                           .otherwise(F.col("_cnt")))
               .withColumn("_run", F.sum((has_gap | F.col("_restart")).cast("int")).over(upto)))
    in_run = (Window.partitionBy(_K, "_run").orderBy(_P)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summary = summary.withColumn("_open", F.sum("_tail").over(in_run))
    carried = F.when(F.col("_restart"), F.lit(0)).otherwise(
        F.coalesce(F.lag("_open").over(by_key), F.lit(0)))
    summary = summary.select(_K, _P, carried.alias("_carried"), "_next_first_t", "_has_more")

    joined = ranked.join(summary, [_K, _P], "inner")
    count = (F.when(F.col("_from").isNotNull(), F.col("_rn") - F.col("_from") + 1)
             .otherwise(F.col("_carried") + F.col("_rn")))
    t = F.col(_T)
    nxt = F.coalesce(F.col("_next_t"), F.when(F.col("_is_last"), F.col("_next_first_t")))
    at_end = F.col("_is_last") & ~F.col("_has_more")
    idle_at_end = F.when(t.isNull(), global_max.isNotNull()).otherwise((global_max - t) > idle_us)
    ends = F.when(at_end, F.coalesce(idle_at_end, F.lit(False))).otherwise(
        F.coalesce((nxt - t) > idle_us, F.lit(False)))
    counted = joined.select(*[F.col(c) for c in df.columns], count.cast("bigint").alias(out), ends.alias("ends_segment"))
    counted._tp_kept = kept
    return counted


def release(counted: DataFrame) -> None:
    """Give back the disk that ``running_counts`` (or what was made of its result here) holds."""
    kept = getattr(counted, "_tp_kept", None)
    if kept is not None:
        kept.unpersist()


def _holding(out: DataFrame, counted: DataFrame) -> DataFrame:
    out._tp_kept = getattr(counted, "_tp_kept", None)
    return out


def idle_timeouts(counted: DataFrame, key_cols: str | list[str], time_col: str,
                  idle_seconds: float = 300.0, out: str = "n") -> DataFrame:
    """One row per timeout: the key, the time of its last row and its last count."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    expires = F.col(time_col) + F.expr(f"INTERVAL {float(idle_seconds)} SECONDS")
    ended = counted.where(F.col("ends_segment"))
    return _holding(ended.select(*keys, F.col(time_col).alias("last_time"), F.col(out), expires.alias("expires_at")), counted)


def state_outputs(counted: DataFrame, key_cols: str | list[str], time_col: str,
                  idle_seconds: float = 300.0, out: str = "n") -> DataFrame:
    """T1 + T2 as one output: running-count rows and timeout rows (``timed_out``).

    This is everything the keyed state function emits, so its row count is
    the number the per-batch counter adds up. One pass: each row yields its
    count row and, if it ends a segment, the timeout row after it.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    expires = F.col(time_col) + F.expr(f"INTERVAL {float(idle_seconds)} SECONDS")
    row = F.struct(F.col(time_col).alias("at"), F.lit(False).alias("timed_out"))
    timeout = F.struct(expires.alias("at"), F.lit(True).alias("timed_out"))
    emitted = F.when(F.col("ends_segment"), F.array(row, timeout)).otherwise(F.array(row))
    both = counted.select(*keys, F.col(out), F.explode(emitted).alias("_emit"))
    return _holding(both.select(*keys, "_emit.at", F.col(out), "_emit.timed_out"), counted)
