"""Running count per key on a stream, with idle timeout.

The stream form of ``tidepool.operators.state``: one output row per input
record with the key's count since it was last idle, plus one
``timed_out`` row when a key goes idle for strictly more than
``idle_seconds`` of event time. Idle periods inside one micro-batch are
found by the gap check on the sorted rows; idle periods at the end of the
data are found by an event-time timer that fires when the watermark passes
the key's deadline. State per key is two numbers (count, last time), kept in
the state store and restored from the checkpoint on restart.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, IntegerType, LongType, ShortType,
                               StructField, StructType, TimestampType)

from tidepool.streaming.keyed import KeyState, keyed_state

if TYPE_CHECKING:
    import pandas as pd

STATE_SCHEMA = "n bigint, last_us bigint"

_EPOCH_US = "tp_epoch_us"
_NO_TIE = "tp_no_tie"


class RunningCount:
    """The counting state function, an instance of ``keyed.keyed_state``.

    Each call gets one key's rows as a pandas frame; gaps, restarts and counts are computed
    with numpy (no per-row Python). In arrival order each frame is handled in turn, so a hot
    key needs one frame of memory; in time order the key's rows of the batch are sorted
    together, which the source's intake cap bounds (``ranged`` has no such bound).
    """

    def __init__(self, tiebreak_col: str, idle_seconds: float, integer_ties: bool = True):
        self.tiebreak_col, self.integer_ties = tiebreak_col, integer_ties
        self.idle_us = int(round(idle_seconds * 1_000_000))

    def __call__(self, key: tuple, frame: pd.DataFrame | None, state: KeyState) -> Iterable[pd.DataFrame]:
        if frame is None:
            n, last = state.get()
            return [self._frame([last + self.idle_us], [None], [n], [True])]
        n, last = state.get() if state.exists else (0, None)
        frames, n, last = self._advance(frame, n, last)
        state.update(n, last)
        state.expire_at(last + self.idle_us)      # once the clock is strictly more than idle past the last row
        return frames

    def _frame(self, at_us, tiebreak, n, timed_out, no_time=None):
        import pandas as pd
        at = pd.to_datetime(pd.Series(at_us, dtype="int64"), unit="us", utc=True)
        if no_time is not None and no_time.any():
            at = at.mask(pd.Series(no_time))
        ties = pd.Series(tiebreak, dtype="Int64" if self.integer_ties else object)
        return pd.DataFrame({"at": at, self.tiebreak_col: ties, "n": pd.Series(n, dtype="int64"),
                             "timed_out": pd.Series(timed_out, dtype="bool")})

    def _advance(self, part, n0: int, last0: int | None):
        """Count one frame of rows in their order; returns (output frames, count, last time).

        The last time never moves back: a row older than it counts on, without a gap.
        """
        import numpy as np
        # Rows without a time join the current segment (no gap); their output time stays NULL.
        no_time = part[_EPOCH_US].isna().to_numpy()
        timed = part[_EPOCH_US].dropna()
        fill = last0 if last0 is not None else (int(timed.iloc[0]) if len(timed) else 0)
        at = part[_EPOCH_US].fillna(fill).to_numpy(dtype="int64")
        ids = part[self.tiebreak_col].to_numpy()
        latest = np.maximum.accumulate(at if last0 is None else np.maximum(at, last0))
        prev = np.empty_like(latest)
        prev[1:] = latest[:-1]
        prev[0] = latest[0] if last0 is None else last0
        restart = (at - prev) > self.idle_us  # never true for row 0 without state
        idx = np.arange(len(at))
        seg_start = np.maximum.accumulate(np.where(restart, idx, 0))
        before = np.where(np.cumsum(restart) == 0, n0, 0)
        n = before + (idx - seg_start) + 1
        # A timeout row for the segment each restart closes.
        at_break = np.flatnonzero(restart)
        closed_n = np.where(at_break > 0, n[at_break - 1], n0)
        frames = [self._frame(prev[at_break] + self.idle_us, [None] * len(at_break), closed_n,
                              [True] * len(at_break)),
                  self._frame(at, ids, n, [False] * len(at), no_time)]
        return frames, int(n[-1]), int(latest[-1])


def running_count_stream(events: DataFrame, key_col: str, time_col: str,
                         tiebreak_col: str | None = None,
                         idle_seconds: float = 300.0, watermark_delay: str = "0 seconds",
                         time_mode: str = "EventTime", initial_state: DataFrame | None = None) -> DataFrame:
    """T1 + T2 on a stream: ``key, at, <tiebreak>, n, timed_out`` in append mode.

    ``time_mode="ProcessingTime"`` is the reference's clock: ``time_col``
    should then be the arrival time (``arrived_at``), and idle keys time out
    when the wall clock passes their deadline, also while no data arrives.
    Use it with a processing-time trigger (an ``availableNow`` query would
    keep running batches for the pending timers).

    Every record is counted, in arrival order. In event time, rows of one
    batch are taken in time order, and rows later than ``watermark_delay``
    allows are dropped by Spark; ``jobs.late_rows`` reports how many. Rows an
    earlier batch has overtaken are counted in arrival order and never move
    the key's last time back. Without ``tiebreak_col`` (text lines have none)
    rows of one time are in arrival order and the output has no such column.
    A TIMESTAMP_NTZ input is read in the session time zone. The key column keeps its type;
    ``initial_state`` (key, n, last_us) is what a new query counts on from.
    """
    if tiebreak_col is None:
        out = running_count_stream(events.withColumn(_NO_TIE, F.lit(0).cast("bigint")), key_col,
                                   time_col, _NO_TIE, idle_seconds, watermark_delay, time_mode, initial_state)
        return out.drop(_NO_TIE)
    # A column that is a timestamp already stays as it is, with the watermark it may have.
    ts = F.col(time_col) if isinstance(events.schema[time_col].dataType, TimestampType) else F.col(time_col).cast("timestamp")
    tie_type = events.schema[tiebreak_col].dataType
    integer_ties = isinstance(tie_type, (LongType, IntegerType, ShortType, ByteType))
    tie = F.col(tiebreak_col).cast("bigint") if integer_ties else F.col(tiebreak_col)
    if time_mode not in ("EventTime", "ProcessingTime"):
        raise ValueError("time_mode is 'EventTime' or 'ProcessingTime'")
    rows = events.select(key_col, ts.alias(time_col), F.unix_micros(ts).alias(_EPOCH_US), tie.alias(tiebreak_col))
    in_time_order = time_mode == "EventTime"
    output = StructType([StructField("at", TimestampType(), True),
                         StructField(tiebreak_col, LongType() if integer_ties else tie_type, True),
                         StructField("n", LongType(), True), StructField("timed_out", BooleanType(), True)])
    return keyed_state(rows, key_col, RunningCount(tiebreak_col, idle_seconds, integer_ties), STATE_SCHEMA, output,
                       time_mode=time_mode, time_col=time_col, watermark_delay=watermark_delay if in_time_order else None,
                       order_cols=[_EPOCH_US, tiebreak_col] if in_time_order else None, initial_state=initial_state)
