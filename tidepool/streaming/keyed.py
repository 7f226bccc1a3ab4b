"""A user's own state function over a keyed stream.

The function gets a key, the key's new rows and the key's state, and yields output rows;
once for each Arrow chunk of rows, and once without rows when the key times out, after
which its state is gone. ``running_count_stream`` is one such function.

State is a row of any schema in the state store, so it is restored from the checkpoint
on restart. ``read_state`` gives the state of a checkpoint as a table, and a new query, with
another function or other sources, goes on from such a table as its ``initial_state``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)
from pyspark.sql.types import LongType, StructField, StructType

from tidepool.functions.keys import NULLS, null_free, with_nulls

if TYPE_CHECKING:
    import pandas as pd

STATE_NAME = "state"
_DEADLINE = "tp_deadline_ms"
TIME_MODES = ("EventTime", "ProcessingTime", "None")


class KeyState:
    """The state of one key, as its function sees it."""

    def __init__(self, values: tuple | None, deadline_ms: int | None, timing_out: bool = False):
        self._values, self._before = values, deadline_ms
        self._deadline_ms = deadline_ms
        self.timing_out = timing_out

    @property
    def exists(self) -> bool:
        return self._values is not None

    def get(self) -> tuple:
        """The values, in the order of the state schema."""
        if self._values is None:
            raise KeyError("the key has no state")
        return self._values

    def update(self, *values) -> None:
        if self.timing_out:
            raise ValueError("a key that times out cannot be given a state")
        self._values = values

    def remove(self) -> None:
        self._values, self._deadline_ms = None, None

    def expire_at(self, micros: int | None) -> None:
        """Time the key out once the clock has passed this many microseconds since 1970 (None: never)."""
        self._deadline_ms = None if micros is None else micros // 1000 + 1


StateFunction = Callable[[tuple, "pd.DataFrame | None", KeyState], "Iterable[pd.DataFrame]"]


class KeyedStateProcessor(StatefulProcessor):
    """Calls a state function and keeps its key's state, deadline and timer."""

    def __init__(self, function: StateFunction, key_cols: list[str], state_schema: StructType,
                 idle_ms: int | None, time_col: str | None, order_cols: list[str] | None):
        self.function, self.key_cols, self.names = function, key_cols, state_schema.fieldNames()
        self.schema = StructType([*state_schema.fields, StructField(_DEADLINE, LongType(), True)])
        self.idle_ms, self.time_col, self.order_cols = idle_ms, time_col, order_cols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(STATE_NAME, self.schema)

    def _load(self, timing_out: bool = False) -> KeyState:
        if not self.state.exists():
            return KeyState(None, None)
        *values, deadline = self.state.get()
        return KeyState(tuple(values), deadline, timing_out)

    def _store(self, held: KeyState) -> None:
        if held._before is not None and held._before != held._deadline_ms:
            self.handle.deleteTimer(held._before)
        if not held.exists:
            self.state.clear()
            return
        self.state.update((*held._values, held._deadline_ms))
        if held._deadline_ms is not None and held._before != held._deadline_ms:
            self.handle.registerTimer(held._deadline_ms)

    def _named(self, key: tuple, frames: Iterable[pd.DataFrame] | None):
        import pandas as pd
        key = _key_of(key)
        for frame in frames or ():
            keys = {c: pd.Series([k] * len(frame), dtype=object, index=frame.index)
                    for c, k in zip(self.key_cols, key, strict=True)}
            yield pd.concat([pd.DataFrame(keys, index=frame.index), frame], axis=1)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        import pandas as pd
        held, latest = self._load(), None
        if self.order_cols:
            whole = pd.concat(list(rows), ignore_index=True)
            rows = [whole.sort_values(self.order_cols, kind="mergesort", na_position="first")]
        for frame in rows:
            if frame.empty:
                continue
            if self.idle_ms is not None and self.time_col:
                top = frame[self.time_col].max()
                latest = top if latest is None or top > latest else latest
            yield from self._named(key, self.function(_key_of(key), frame, held))
        if self.idle_ms is not None and held.exists:
            now = timerValues.getCurrentProcessingTimeInMs() if latest is None else int(pd.Timestamp(latest).value // 1_000_000)
            held._deadline_ms = max(held._before or 0, now + self.idle_ms + 1)
        self._store(held)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        held = self._load(timing_out=True)
        if not held.exists or held._deadline_ms != expiredTimerInfo.getExpiryTimeInMs():
            return          # refreshed or removed since this timer was set
        yield from self._named(key, self.function(_key_of(key), None, held))
        self.state.clear()

    def handleInitialState(self, key, initialState, timerValues: TimerValues) -> None:
        for row in initialState.itertuples(index=False):
            row = row._asdict()
            deadline = row.get(_DEADLINE)
            deadline = None if deadline is None or deadline != deadline else int(deadline)
            if deadline is None and self.idle_ms is not None and not self.time_col:
                deadline = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms + 1
            self.state.update((*(_plain(row[n]) for n in self.names), deadline))
            if deadline is not None:
                self.handle.registerTimer(deadline)

    def close(self) -> None:
        pass


def _plain(value):
    """A pandas cell as a state value."""
    if value is None or value != value:
        return None
    return value.item() if hasattr(value, "item") else value


def _key_of(key: tuple) -> tuple:
    """The key values out of a grouping key (see ``null_free``)."""
    *values, nulls = key
    return tuple(None if null == "1" else value for value, null in zip(values, nulls, strict=True))


def has_watermark(rows: DataFrame, time_col: str) -> bool:
    """Whether the time column carries a watermark already (of each shard, see ``union_streams``)."""
    return "spark.watermarkDelayMs" in rows.schema[time_col].metadata


def _struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def keyed_state(rows: DataFrame, key_cols: str | list[str], function: StateFunction, state_schema: StructType | str,
                output_schema: StructType | str, *, time_mode: str = "ProcessingTime", idle_seconds: float | None = None,
                time_col: str | None = None, watermark_delay: str | None = None, order_cols: list[str] | None = None,
                initial_state: DataFrame | None = None) -> DataFrame:
    """The stream of ``function``'s output rows, after the key columns.

    ``key_cols`` are single values of any type and keep it; ``state_schema`` and ``output_schema`` are DDL or structs.
    ``idle_seconds`` times a key out when no row came for longer: by the wall clock, or in event
    time by ``time_col``, which then needs a ``watermark_delay``. A function may instead set a
    deadline itself (``KeyState.expire_at``). ``order_cols`` sorts a key's rows of one micro-batch
    before the function sees them, which takes them into memory together; without it they
    come chunk by chunk in arrival order. ``initial_state`` holds the key columns and the
    state's fields (see ``read_state``) and is used when the query is first created.
    """
    if time_mode not in TIME_MODES:
        raise ValueError(f"time_mode is one of {TIME_MODES}")
    if time_mode == "EventTime":
        has_own = time_col in rows.columns and has_watermark(rows, time_col)
        if not time_col or (watermark_delay is None and not has_own):
            raise ValueError("event time needs a time_col and a watermark_delay: later rows are dropped")
        rows = rows if has_own else rows.withWatermark(time_col, watermark_delay)
    if time_mode == "None" and idle_seconds is not None:
        raise ValueError("idle keys need a clock: event or processing time")
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    state, out = _struct(state_schema), _struct(output_schema)
    clash = set(keys) & set(out.fieldNames())
    if clash:
        raise ValueError(f"the function's output repeats the key columns {sorted(clash)}")
    idle_ms = None if idle_seconds is None else int(round(idle_seconds * 1000))
    processor = KeyedStateProcessor(function, keys, state, idle_ms, time_col if time_mode == "EventTime" else None, order_cols)
    schema = StructType([*(rows.schema[k] for k in keys), *out.fields])
    first = None
    if initial_state is not None:
        deadline = F.col(_DEADLINE) if _DEADLINE in initial_state.columns else F.lit(None).cast("long")
        first = null_free(initial_state.select(*keys, *state.fieldNames(), deadline.alias(_DEADLINE)), keys)
        first = first.groupBy(*keys, NULLS)
    return null_free(rows, keys).groupBy(*keys, NULLS).transformWithStateInPandas(processor, schema, "Append", time_mode, initialState=first)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys and state values that a query's checkpoint holds, with their deadlines."""
    stored = (spark.read.format("statestore").option("stateVarName", STATE_NAME).load(checkpoint))
    keys = [c for c in stored.schema["key"].dataType.fieldNames() if c != NULLS]
    return stored.select(*with_nulls(keys, "key"), "value.*")
