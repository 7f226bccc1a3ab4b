"""Running count per key for micro-batches with hot keys.

``streaming.state`` hands all rows of a key in a micro-batch to one call. Here a batch is a
table: it is range-partitioned by (key, time, tiebreak), so a key with nine tenths of the
rows fills many ranges; each range is counted on its own, one summary row per (key, range)
is scanned per key together with the key's stored state, and the carried counts
join back. The state is a ``BucketTable`` of (key, n, last_us): a batch rewrites only the
buckets of the keys it changed, after its output is written, and a replayed batch starts
from the state before it. No Python runs on rows.

Semantics are those of the state function: a row counts on unless its time is strictly more
than ``idle_seconds`` past the key's greatest time so far; rows without a time join the
current segment; every closed segment gives one ``timed_out`` row, also that of a key that is
idle when the batch ends (by the greatest event time seen, or by the wall clock). As batches
only come with data, a wall-clock timeout is reported with the next batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidepool.functions.timecols import epoch_micros
from tidepool.sinks.buckets import BucketTable
from tidepool.streaming import jobs

_K, _T, _P = "_tp_key", "_tp_t", "_tp_part"


class Advanced(NamedTuple):
    """What one batch gives."""

    outputs: DataFrame          # key columns, at, tiebreak, n, timed_out
    state: DataFrame            # key columns, n, last_us of the batch's keys that go on
    gone: DataFrame             # key columns of keys that timed out
    kept: DataFrame             # the ranged rows; unpersist when done


def advance(batch: DataFrame, state: DataFrame | None, key_cols: list[str], time_col: str, tiebreak_col: str,
            idle_seconds: float = 300.0, now_us: int | None = None) -> Advanced:
    """Count ``batch`` on from ``state`` (key columns, n, last_us); keys idle at ``now_us`` time out.

    Without ``now_us`` no key times out at the end of the batch.
    """
    idle = int(round(idle_seconds * 1_000_000))
    key = F.struct(*key_cols)             # never null itself, so null keys join like others
    rows = batch.select(key.alias(_K), epoch_micros(batch, time_col).alias(_T), F.col(tiebreak_col).alias("tie"))
    # The numbered rows are kept, since ranges come from a sample and both sides of the joins must agree.
    ranged = (rows.repartitionByRange(_K, _T, "tie").withColumn(_P, F.spark_partition_id())
              .persist(StorageLevel.DISK_ONLY))
    held = None if state is None else state.select(key.alias(_K), F.lit(-1).alias(_P), F.col("n").alias("held"),
                                                   F.col("last_us").alias("top"))

    by_key = Window.partitionBy(_K).orderBy(_P)
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    tops = ranged.groupBy(_K, _P).agg(F.max(_T).alias("top"))
    if held is not None:
        tops = tops.unionByName(held.select(_K, _P, "top"))
    tops = tops.withColumn("top_before", F.max("top").over(earlier)).where(F.col(_P) >= 0).drop("top")

    # Times never move back: a late row has the time of the latest row before it.
    inside = Window.partitionBy(_K, _P).orderBy(_T, "tie")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    sofar = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = ranged.join(tops, [_K, _P]).withColumn(
        "clock", F.when(F.col(_T).isNotNull(), F.greatest(_T, "top_before")))
    timed = timed.withColumn("clock_before", F.coalesce(F.max("clock").over(before), F.col("top_before")))
    timed = timed.withColumn("nth", F.row_number().over(inside)).withColumn(
        "restart", F.coalesce(F.col("clock") - F.col("clock_before") > idle, F.lit(False)))
    timed = timed.withColumn("begun", F.max(F.when(F.col("restart"), F.col("nth"))).over(sofar))

    sums = timed.groupBy(_K, _P).agg(F.count(F.lit(1)).alias("rows"), F.max("begun").alias("last_begun"),
                                     F.max(F.coalesce("clock", "top_before")).alias("top"))
    sums = sums.select(_K, _P, "top", F.col("last_begun").isNotNull().alias("cut"),
                       F.coalesce(F.col("rows") - F.col("last_begun") + 1, F.col("rows")).alias("adds"))
    if held is not None:
        sums = sums.unionByName(held.select(_K, _P, "top", F.lit(False).alias("cut"), F.col("held").alias("adds")))
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("segment", F.sum(F.col("cut").cast("int")).over(upto))
    in_segment = Window.partitionBy(_K, "segment").orderBy(_P).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("open", F.sum("adds").over(in_segment))
    sums = (sums.withColumn("carried", F.coalesce(F.lag("open").over(by_key), F.lit(0)))
            .withColumn("top", F.max("top").over(upto)).withColumn("is_last", F.lead(_P).over(by_key).isNull()))

    counted = timed.join(sums.where(F.col(_P) >= 0).select(_K, _P, "carried"), [_K, _P])
    n = F.when(F.col("begun").isNotNull(), F.col("nth") - F.col("begun") + 1).otherwise(F.col("carried") + F.col("nth"))
    counted = counted.withColumn("n", n.cast("long"))
    closed = F.coalesce(F.lag("n").over(inside), F.col("carried"))
    counted = counted.withColumn("closed", F.when(F.col("restart"), closed.cast("long")))

    def out(at_us, tie, number, timed_out):
        return F.struct(F.timestamp_micros(at_us).alias("at"), tie.alias(tiebreak_col), number.alias("n"),
                        F.lit(timed_out).alias("timed_out"))

    no_tie = F.lit(None).cast(batch.schema[tiebreak_col].dataType)
    row = out(F.col(_T), F.col("tie"), F.col("n"), False)
    closing = out(F.col("clock_before") + idle, no_tie, F.col("closed"), True)
    emitted = F.when(F.col("restart"), F.array(closing, row)).otherwise(F.array(row))
    outputs = counted.select(_K, F.explode(emitted).alias("o")).select(f"{_K}.*", "o.*")

    ends = sums.where("is_last").select(_K, _P, F.col("open").cast("long").alias("n"), F.col("top").alias("last_us"))
    over = F.lit(False) if now_us is None else F.coalesce(F.lit(now_us) - F.col("last_us") > idle, F.lit(False))
    idle_now = ends.where(over)
    outputs = outputs.unionByName(idle_now.select(f"{_K}.*", out(F.col("last_us") + idle, no_tie, F.col("n"), True)
                                                  .alias("o")).select(*key_cols, "o.*"))
    return Advanced(outputs, ends.where(~over & (F.col(_P) >= 0)).select(f"{_K}.*", "n", "last_us"),
                    idle_now.select(f"{_K}.*"), ranged)


class RangedCounter:
    """``foreachBatch`` action: the outputs of each batch to ``<output_path>/batch_id=<id>``, then its state."""

    def __init__(self, key_cols: str | list[str], time_col: str, tiebreak_col: str, state_path: str, output_path: str,
                 idle_seconds: float = 300.0, event_time: bool = False, buckets: int = 64, vacuum_every: int = 100,
                 output: Callable[[DataFrame], DataFrame] | None = None):
        self.key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
        self.time_col, self.tiebreak_col = time_col, tiebreak_col
        self.state_path, self.output_path = state_path, output_path.rstrip("/")
        self.idle_seconds, self.event_time, self.buckets, self.vacuum_every = idle_seconds, event_time, buckets, vacuum_every
        self.output = output or (lambda rows: rows)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = BucketTable(spark, self.state_path, self.key_cols, self.buckets)
        before = table.manifest()
        if before is not None and before["batch_id"] >= batch_id:
            return               # replayed after its state was put in place: output and state are there
        now = int(time.time() * 1_000_000)
        if self.event_time:
            top = batch.agg(F.max(epoch_micros(batch, self.time_col))).first()[0]
            now = max((t for t in (top, (before or {}).get("now_us")) if t is not None), default=None)
        done = advance(batch, table.read() if before else None, self.key_cols, self.time_col, self.tiebreak_col,
                       self.idle_seconds, now)
        try:
            self.output(done.outputs).write.mode("overwrite").parquet(f"{self.output_path}/batch_id={batch_id}")
            table.upsert(done.state, batch_id, deletes=done.gone, extra={"now_us": now})
        finally:
            done.kept.unpersist()
        if (batch_id + 1) % self.vacuum_every == 0:
            table.vacuum()


def ranged_running_count_job(events: DataFrame, key_cols: str | list[str], time_col: str, tiebreak_col: str,
                             checkpoint: str, output_path: str, *, idle_seconds: float = 300.0, event_time: bool = False,
                             buckets: int = 64, interval_seconds: float | None = 5, available_now: bool = False,
                             monitor: jobs.BatchMonitor | None = None) -> StreamingQuery:
    """T1 T2 T3 A8(b) K6 on a stream whose keys may be hot; state and offsets live beside each other.

    The monitor's total adds up the rows given out, count rows and timeouts.
    """
    monitor = monitor or jobs.BatchMonitor()
    counter = RangedCounter(key_cols, time_col, tiebreak_col, f"{checkpoint.rstrip('/')}_counts", output_path, idle_seconds,
                            event_time, buckets, output=monitor.output)
    return jobs.start(events, checkpoint, foreach_batch=monitor.within(counter), interval_seconds=interval_seconds,
                      available_now=available_now)
