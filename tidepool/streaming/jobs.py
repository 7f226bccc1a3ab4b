"""Wiring of streaming queries (T3-T5, K4, K6, A4-A8 per batch, P11).

A query is a streaming DataFrame plus a sink, a trigger and a checkpoint
folder. Restart is Spark's: a query started again with the same
``checkpointLocation`` resumes from its committed offsets and state.
Per-batch driver code runs in ``foreachBatch``.
"""

from __future__ import annotations

import datetime as _dt
import logging
import socket
import threading
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions import text
from tidepool.functions.records import decode_utf8
from tidepool.operators import aggregates as agg
from tidepool.session import checkpoint_root
from tidepool.sources.streams import in_source_order

log = logging.getLogger("tidepool.streaming")


def trigger_options(interval_seconds: float | None = None,
                    available_now: bool = False) -> dict:
    """T4: a fixed batch interval, or process what is there and stop."""
    if available_now:
        return {"availableNow": True}
    if interval_seconds:
        return {"processingTime": f"{interval_seconds} seconds"}
    return {}


def start(df: DataFrame, checkpoint: str | None, *, sink: str = "parquet",
          path: str | None = None, output_mode: str = "append",
          options: dict[str, str] | None = None, interval_seconds: float | None = None,
          available_now: bool = False,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          query_name: str | None = None) -> StreamingQuery:
    """Start ``df`` with a checkpoint (create, or resume if it exists).

    Without an explicit ``checkpoint`` the query named ``query_name`` keeps
    its checkpoint under the session's shared ``spark.checkpoint.dir``.
    """
    if checkpoint is None:
        if not query_name:
            raise ValueError("give a checkpoint folder or a query name to derive one")
        checkpoint = f"{checkpoint_root(df.sparkSession)}/{query_name}"
    writer = (df.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint)
              .trigger(**trigger_options(interval_seconds, available_now)))
    if query_name:
        writer = writer.queryName(query_name)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(sink).options(**(options or {}))
    return writer.start(path) if path else writer.start()


def console(df: DataFrame, checkpoint: str, rows: int = 10, **kw) -> StreamingQuery:
    """K4: print the first ``rows`` rows of every batch."""
    return start(df, checkpoint, sink="console", options={"numRows": str(rows),
                                                          "truncate": "false"}, **kw)


def words_of_records(records: DataFrame) -> DataFrame:
    """P1 + P2 on byte records: one row per token (records are not cut at newlines)."""
    lines = records.select(decode_utf8("value").alias("line"), "arrived_at")
    return text.tokens(lines, "line", "word", keep=("arrived_at",))


def observed(metrics: Observation, rows: DataFrame, wait_seconds: float = 10.0) -> dict:
    """The values of ``metrics``; if nothing has run the observed ``rows``, they are run for it."""
    for _ in range(2):
        found: list[dict] = []
        reader = threading.Thread(target=lambda: found.append(metrics.get), daemon=True)
        reader.start()
        reader.join(wait_seconds)
        if found and found[0]:
            return found[0]
        rows.write.format("noop").mode("overwrite").save()
    raise RuntimeError("the batch's metrics did not arrive")


class BatchMonitor:
    """Per-batch driver code around an optional batch action, in the action's own job.

    The rows of a batch, rejected records and the numbers of the status line are observed
    (``DataFrame.observe``) while ``action(rows, batch_id)`` writes them; nothing is
    persisted or counted by a job of its own. After it the running total since this driver
    started is advanced (A8) and a status line logged (K6); a batch without rows gives
    neither, and what its action left is taken back by the action's ``discard``, if it has one.

    ``prepare`` (see ``accepted_trades``) turns the raw batch into the rows to act on.
    ``extra`` are further aggregates over these rows for the record of the batch. The total
    adds up the rows, or those of a result that the action hands to ``output``. Several
    actions (``within``) are several jobs; the rows are then persisted for them.
    """

    def __init__(self, action: Callable[[DataFrame, int], None] | None = None,
                 logger: logging.Logger | None = None, keep_batches: int = 1000,
                 prepare: Prepare | None = None, extra: dict[str, Column] | None = None):
        self.actions = [action] if action is not None else []
        self.prepare, self.extra = prepare, extra
        self.total = 0
        # Recent batches only, so a stream running for months holds bounded
        # driver memory; ``total`` still counts every batch.
        self.history: deque[dict] = deque(maxlen=keep_batches)
        self.log = logger or log
        self.host = socket.gethostname()
        self._output: tuple[Observation, DataFrame] | None = None

    def within(self, action: Callable[[DataFrame, int], None] | None = None, **parts) -> BatchMonitor:
        """Add a job's action before the monitor's own, and parts it has not set itself."""
        if action is not None:
            self.actions.insert(0, action)
        for name, part in parts.items():
            if getattr(self, name) is None:
                setattr(self, name, part)
        return self

    def output(self, result: DataFrame) -> DataFrame:
        """``result``, observed: its rows are what this batch adds to the total."""
        metrics = Observation()
        result = result.observe(metrics, F.count(F.lit(1)).alias("n"))
        self._output = metrics, result
        return result

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._output = None
        rows, rejects, rejected = batch, None, None
        if self.prepare is not None:
            rejected = Observation()
            batch = batch.observe(rejected, F.count_if(self.prepare.rejects).alias("n"))
            rows, rejects = self.prepare(batch), batch.where(self.prepare.rejects)
        metrics = Observation()
        rows = rows.observe(metrics, F.count(F.lit(1)).alias("n"), *(c.alias(n) for n, c in (self.extra or {}).items()))
        kept = rows.persist() if len(self.actions) > 1 else None
        try:
            for action in self.actions:
                action(rows, batch_id)
            seen = observed(metrics, rows)
            if rejects is not None and (n := observed(rejected, rows)["n"]):
                self.prepare.keep(rejects, batch_id, n, self.log)
            if seen["n"] == 0:
                for action in self.actions:
                    getattr(action, "discard", lambda *_: None)(batch.sparkSession, batch_id)
                return
            self.total += observed(*self._output)["n"] if self._output else seen["n"]
            record = {"batch_id": batch_id, "time": _dt.datetime.now().isoformat(), "host": self.host, "n_rows": seen["n"],
                      "n_partitions": batch.rdd.getNumPartitions(), "total": self.total}
            more = {name: seen[name] for name in self.extra or {}}
            self.history.append(record | more)
            self.log.info("%s %s batch=%d rows=%d partitions=%d total=%d%s", record["time"], self.host, batch_id, seen["n"],
                          record["n_partitions"], self.total, "".join(f" {k}={v}" for k, v in more.items()))
        finally:
            if kept is not None:
                kept.unpersist()


class Prepare:
    """What a batch's raw rows become, and where the others go."""

    rejects: Column

    def __call__(self, batch: DataFrame) -> DataFrame:
        raise NotImplementedError

    def keep(self, rejects: DataFrame, batch_id: int, n: int, logger: logging.Logger) -> None:
        raise NotImplementedError


class accepted_trades(Prepare):
    """The parsed trades of a batch; records that are none go to ``rejects_path``.

    Takes rows ``value, arrived_at, arrival_seq, trade``; a rejected record is
    one whose trade is NULL. Only a batch that has some pays a job for them: their bytes
    are written per batch (a replayed batch overwrites its own folder) and their number is logged.
    """

    def __init__(self, rejects_path: str):
        self.path = rejects_path.rstrip("/")
        self.rejects = F.col("trade").isNull()

    def __call__(self, batch: DataFrame) -> DataFrame:
        return (in_source_order(batch).where(F.col("trade").isNotNull())
                .select("trade.*", "arrived_at", "arrival_seq"))

    def keep(self, rejects: DataFrame, batch_id: int, n: int, logger: logging.Logger) -> None:
        rejects.select("value", "arrived_at").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        logger.warning("batch=%d: %d records are no trades, kept in %s", batch_id, n, self.path)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's watermark has dropped, over the progress it still keeps."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
               for op in p["stateOperators"])


def per_batch_word_counts(sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A4: stateless word count of each micro-batch of word records, handed to ``sink``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        counts = agg.word_count(words_of_records(batch))
        sink(counts.withColumn("batch_id", F.lit(batch_id)), batch_id)
    return run


def per_batch_key_counts(key_col: str, sink: Callable[[DataFrame, int], None],
                         output: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A5: stateless count per key (e.g. trade symbol) of each micro-batch.

    ``output`` (``BatchMonitor.output``) makes the monitor's total add up the counted keys.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        counts = agg.word_count(batch.select(key_col), key_col)
        counts = output(counts) if output else counts
        sink(counts.withColumn("batch_id", F.lit(batch_id)), batch_id)
    return run


def per_batch_max_id(id_col: str, sink: Callable[[DataFrame, int], None]
                     ) -> Callable[[DataFrame, int], None]:
    """Greatest id of each micro-batch in string order."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = batch.agg(F.max(F.col(id_col).cast("string")).alias("max_id"))
        sink(out.withColumn("batch_id", F.lit(batch_id)), batch_id)
    return run


def windowed_key_counts(events: DataFrame, time_col: str, key_col: str, duration: str,
                        watermark_delay: str) -> DataFrame:
    """A4/A5 by event time: rows per key per tumbling window, emitted once final.

    The deterministic stand-in for a per-batch count: the same answer as
    ``count_per_window`` on the table, for every window the watermark has
    closed. Rows later than ``watermark_delay`` allows are dropped (a rule the
    processing-time batches of the reference do not have); ``late_rows``
    reports how many.
    """
    ts = F.col(time_col).cast("timestamp")
    rows = events.withColumn(time_col, ts).withWatermark(time_col, watermark_delay)
    return agg.count_per_window(rows, time_col, key_col, duration)
