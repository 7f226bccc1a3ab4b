"""The reference's programs as jobs: batch word count and tag sizes, and the
stream jobs (words and symbols per batch, running counts, trade table sink).

Each job is a composition of the library's operators with a reader and a
writer; stream jobs return the started ``StreamingQuery``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions import records, text
from tidepool.operators import aggregates as agg
from tidepool.sinks.buckets import BucketTable, bucket_writer
from tidepool.sinks.files import write_csv
from tidepool.sinks.table import batch_writer
from tidepool.sources.files import read_csv_strings, read_lines
from tidepool.sources.streams import (
    rate_cap_options,
    read_records,
    resolve_start,
    start_filter,
    start_options,
    union_streams,
)
from tidepool.streaming import jobs
from tidepool.streaming.ranged import ranged_running_count_job
from tidepool.streaming.state import running_count_stream

# The sink columns of the two trade tables.
TRADE_V1_COLUMNS = ["id", "tickerSymbol", "tradeType", "price", "quantity"]
TRADE_V2_COLUMNS = ["id", "symbol", "trade", "price", "quantity", "data"]


def word_count_job(spark: SparkSession, input_path: str, output_path: str,
                   min_partitions: int = 3) -> int:
    """Batch word count: lines -> tokens -> (word, n) written as Parquet.

    Returns the number of distinct words, counted from the written result
    rather than by recomputing the counts.
    """
    lines = read_lines(spark, input_path, min_partitions)
    counts = agg.word_count(text.tokens(lines, "value", "word"))
    counts.write.mode("overwrite").parquet(output_path)
    return spark.read.parquet(output_path).count()


def tag_size_job(spark: SparkSession, source_csv: str, target_csv: str,
                 num_files: int = 10, narrow: bool = False) -> int:
    """Tag sizes per (movie, user) from a headered CSV to at most ``num_files`` CSV files.

    Returns the elapsed milliseconds, which the reference prints.
    """
    started = time.time()
    tags = read_csv_strings(spark, source_csv)
    write_csv(agg.tag_size(tags), target_csv, num_files=num_files, narrow=narrow)
    return int((time.time() - started) * 1000)


def _records(spark: SparkSession, fmt: str, path: str | None, options: dict[str, str] | None,
             checkpoint: str, start=None, schema=None, value_col: str = "value",
             time_col: str | None = None) -> DataFrame:
    """S3 + S4: byte records from the start position on.

    Kafka takes the position itself; for other sources it is fixed when the
    query is first created and records that arrived before it are left out,
    also after a restart.
    """
    options = dict(options or {})
    if start is not None and fmt == "kafka":
        options |= start_options(fmt, start)
    recs = read_records(spark, fmt, path, options, schema, value_col, time_col)
    if start is not None and fmt != "kafka":
        recs = recs.where(start_filter(resolve_start(spark, checkpoint, start), "arrived_at"))
    return recs


def _parsed(recs: DataFrame, version: str, strict: bool) -> DataFrame:
    """P1 + P3/P4: ``value, arrived_at, arrival_seq, trade``; ``trade`` is NULL for no trade."""
    return records.parse_trades_bytes(recs, "value", "trade", version, strict)


def word_count_stream_job(spark: SparkSession, fmt: str, path: str | None, checkpoint: str,
                          sink: Callable[[DataFrame, int], None],
                          options: dict[str, str] | None = None, start=None, schema=None,
                          time_col: str | None = None,
                          interval_seconds: float | None = 2, available_now: bool = False,
                          monitor: jobs.BatchMonitor | None = None) -> StreamingQuery:
    """A4: words of byte records counted per micro-batch, each batch handed to ``sink``."""
    recs = _records(spark, fmt, path, options, checkpoint, start, schema, time_col=time_col)
    monitor = (monitor or jobs.BatchMonitor()).within(jobs.per_batch_word_counts(sink))
    return jobs.start(recs, checkpoint, foreach_batch=monitor,
                      interval_seconds=interval_seconds, available_now=available_now)


def symbol_count_stream_job(spark: SparkSession, fmt: str, path: str | None, checkpoint: str,
                            sink: Callable[[DataFrame, int], None],
                            options: dict[str, str] | None = None, version: str = "v1",
                            start=None, schema=None, time_col: str | None = None,
                            interval_seconds: float | None = 5, available_now: bool = False,
                            monitor: jobs.BatchMonitor | None = None) -> StreamingQuery:
    """P3 P7 A5 A8(a): trades parsed strictly and counted per symbol in each micro-batch.

    The monitor's total adds up the rows of the count result: the distinct
    symbols of each batch.
    """
    recs = _records(spark, fmt, path, options, checkpoint, start, schema, time_col=time_col)
    key = records.layout(version)[0][0]
    monitor = monitor or jobs.BatchMonitor()
    monitor.within(jobs.per_batch_key_counts(key, sink, monitor.output),
                   prepare=jobs.accepted_trades(f"{checkpoint}_rejects"))
    return jobs.start(_parsed(recs, version, strict=True), checkpoint, foreach_batch=monitor,
                      interval_seconds=interval_seconds, available_now=available_now)


def _batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch to its own folder, so that a replayed batch replaces itself."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return run


def running_count_stream_job(spark: SparkSession, events: DataFrame, key_col: str,
                             time_col: str, tiebreak_col: str | None, checkpoint: str,
                             output_path: str, idle_seconds: float = 300.0,
                             interval_seconds: float | None = 5,
                             available_now: bool = False, time_mode: str = "ProcessingTime",
                             watermark_delay: str | None = None, hot_keys: bool = False,
                             monitor: jobs.BatchMonitor | None = None) -> StreamingQuery:
    """T1 T2 T3 A8(b) K6: running counts with idle timeouts, written batch by batch, restartable.

    The default counts every record in arrival order and times idle keys out on
    the wall clock (``time_col`` is then the arrival time). In event time Spark
    drops rows later than ``watermark_delay``, which must be given; see
    ``jobs.late_rows``. The monitor logs the rows the state function gave and
    their running total. ``hot_keys`` counts each batch in ranges (``streaming.ranged``): no
    task gets all rows of a key, and no row is late.
    """
    if hot_keys:
        if tiebreak_col is None:
            raise ValueError("ranges of a hot key need a tiebreak column")
        return ranged_running_count_job(events, key_col, time_col, tiebreak_col, checkpoint, output_path,
                                        idle_seconds=idle_seconds, event_time=time_mode == "EventTime",
                                        interval_seconds=interval_seconds, available_now=available_now, monitor=monitor)
    if time_mode == "ProcessingTime" and available_now:
        raise ValueError("processing-time timeouts keep an availableNow query running; "
                         "use a processing-time trigger or event time")
    if time_mode == "EventTime" and watermark_delay is None:
        raise ValueError("event time needs a watermark_delay: later rows are dropped")
    out = running_count_stream(events, key_col, time_col, tiebreak_col, idle_seconds,
                               watermark_delay or "0 seconds", time_mode=time_mode)
    monitor = (monitor or jobs.BatchMonitor()).within(_batch_files(output_path))
    return jobs.start(out, checkpoint, foreach_batch=monitor,
                      interval_seconds=interval_seconds, available_now=available_now)


def trade_running_count_job(spark: SparkSession, sources: list[dict], checkpoint: str,
                            output_path: str, version: str = "v1", start=None, **more) -> StreamingQuery:
    """The configured main program: byte records of several shards, united, parsed strictly,
    keyed by symbol and counted while the symbol is not idle (S3 S4 S7 P3 P7 T1-T3 A8 K6).

    ``sources`` are the arguments of ``read_records`` per shard (``fmt``, ``path``,
    ``options``, ``schema``, ``time_col``); ``more`` goes to ``running_count_stream_job``.
    """
    shards = [_records(spark, checkpoint=checkpoint, start=start,
                       **({"path": None, "options": None} | source)) for source in sources]
    parsed = _parsed(union_streams(*shards), version, strict=True)
    key, ident = records.layout(version)[0][0], records.layout(version)[-1][0]
    trades = parsed.select(f"trade.{key}", f"trade.{ident}", "arrived_at")
    return running_count_stream_job(spark, trades, key, "arrived_at", ident, checkpoint, output_path, **more)


def word_running_count_job(spark: SparkSession, lines: DataFrame, checkpoint: str,
                           output_path: str, time_col: str | None = None, **more) -> StreamingQuery:
    """Running count of each word of a stream of lines (S5 P2 T1 T2), e.g. of ``read_socket_lines``.

    Without ``time_col`` a line's time is that of its micro-batch.
    """
    timed = lines if time_col else lines.withColumn("arrived_at", F.current_timestamp())
    at = time_col or "arrived_at"
    words = text.tokens(timed, "value", "word", split_lines_first=True, keep=(at,))
    return running_count_stream_job(spark, words, "word", at, None, checkpoint, output_path, **more)


def trade_table_stream_job(spark: SparkSession, fmt: str, path: str | None, checkpoint: str,
                           table_path: str, options: dict[str, str] | None = None,
                           version: str = "v2", key_cols: list[str] | None = None,
                           with_payload: bool = True, strict: bool = True, start=None,
                           schema=None, time_col: str | None = None, cap: dict | None = None,
                           sink_format: str = "parquet",
                           sink_options: dict[str, str] | None = None,
                           snapshot_path: str | None = None, compact_every: int | None = None,
                           buckets: int | None = None, bytes_per_second: float | None = None,
                           interval_seconds: float | None = 10, available_now: bool = False,
                           monitor: jobs.BatchMonitor | None = None) -> StreamingQuery:
    """Trades to a keyed table, batch by batch.

    The last trade to arrive per key (``id`` by default) of each non-empty batch
    is written; the monitor logs rows, partitions, the running total and the
    greatest id. ``cap`` are the arguments of ``rate_cap_options``. Records that
    are no trades go to ``<checkpoint>_rejects``. With ``buckets`` the table is a
    ``sinks.buckets.BucketTable``, read without any reduction; ``bytes_per_second`` limits
    what each of its write tasks passes on.
    """
    options = dict(options or {}) | (rate_cap_options(fmt, **cap) if cap else {})
    recs = _records(spark, fmt, path, options, checkpoint, start, schema, time_col=time_col)
    columns = [c for c in (TRADE_V2_COLUMNS if version == "v2" else TRADE_V1_COLUMNS)
               if c != "data"]
    derive = None
    if with_payload and version == "v2":
        # Added after the per-key reduction: only kept rows get a payload.
        def derive(rows: DataFrame) -> DataFrame:
            return rows.withColumn("data", records.payload("id", 1024))
    if bytes_per_second and not buckets:
        raise ValueError("the write rate is limited for bucket tables; other stores have their own option")
    if buckets:
        writer = bucket_writer(BucketTable(spark, table_path, key_cols or ["id"], buckets), columns + ["arrived_at"],
                               ["arrived_at", "arrival_seq"], derive=derive, rate=bytes_per_second)
    else:
        writer = batch_writer(table_path, columns + ["arrived_at"], key_cols or ["id"],
                              ["arrived_at", "arrival_seq"], fmt=sink_format, options=sink_options,
                              derive=derive, snapshot_path=snapshot_path, compact_every=compact_every)
    monitor = (monitor or jobs.BatchMonitor()).within(
        writer, prepare=jobs.accepted_trades(f"{checkpoint}_rejects"),
        extra={"max_id": F.max(F.col("id").cast("string"))})
    return jobs.start(_parsed(recs, version, strict), checkpoint, foreach_batch=monitor,
                      interval_seconds=interval_seconds, available_now=available_now)
