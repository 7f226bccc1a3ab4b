"""State functions of the user's own: restart, timeouts, key types, state export and seeding."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from test_streaming import run, write_part
from tidepool.streaming import jobs
from tidepool.streaming.keyed import KeyState, keyed_state, read_state
from tidepool.streaming.state import running_count_stream

SCHEMA = "day date, shop int, price double, at timestamp"


def moment(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def make_dearest():
    # Made inside a function, so that workers get it by value.
    def dearest(key, frame, state):
        """Per key the price so far highest and the number of frames it rose in; a free gift clears the key."""
        import pandas as pd
        if frame is None:
            top, rises = state.get()
            yield pd.DataFrame({"top": [top], "rises": [rises], "closed": [True]})
            return
        top, rises = state.get() if state.exists else (float("-inf"), 0)
        best = frame["price"].max()
        if best > top:
            top, rises = best, rises + 1
        if (frame["price"] == 0).any():
            state.remove()
        else:
            state.update(float(top), int(rises))
        yield pd.DataFrame({"top": [float(top)], "rises": [int(rises)], "closed": [False]})

    return dearest


dearest = make_dearest()


def stream_of(spark, src, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "part*"))


def frame_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


DAY, NEXT = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
PARTS = [
    [(DAY, 1, 5.0, moment(0)), (DAY, 1, 7.0, moment(1)), (NEXT, 1, 3.0, moment(2)), (None, None, 1.0, moment(3))],
    [(DAY, 1, 6.0, moment(10)), (NEXT, 1, 0.0, moment(11)), (None, None, 2.0, moment(12)), (DAY, 2, 4.0, moment(13))],
    [(DAY, 1, 9.0, moment(2000)), (NEXT, 1, 2.0, moment(2000))],
]
WANT = [
    (DAY, 1, 7.0, 1, False), (NEXT, 1, 3.0, 1, False), (None, None, 1.0, 1, False),
    (DAY, 1, 7.0, 1, False), (NEXT, 1, 3.0, 1, False), (None, None, 2.0, 2, False), (DAY, 2, 4.0, 1, False),
    (DAY, 1, 9.0, 2, False), (NEXT, 1, 2.0, 1, False),
]


def dearest_query(spark, scratch, **more):
    out = keyed_state(stream_of(spark, f"{scratch}/src"), ["day", "shop"], dearest, "top double, rises int",
                      "top double, rises int, closed boolean", **({"time_mode": "None"} | more))
    return jobs.start(out, f"{scratch}/ck", sink="parquet", path=f"{scratch}/out", available_now=True)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_another_function_over_two_typed_keys_survives_a_restart(spark, scratch):
    write_part(frame_of(spark, PARTS[0]), f"{scratch}/src", 0, PARTS[0])
    run(dearest_query(spark, scratch))
    for i in (1, 2):
        write_part(frame_of(spark, PARTS[i]), f"{scratch}/src", i, PARTS[i])
        run(dearest_query(spark, scratch))
    got = spark.read.parquet(f"{scratch}/out")
    assert [f.dataType.simpleString() for f in got.schema] == ["date", "int", "double", "int", "boolean"]
    assert rows_of(got) == sorted(WANT, key=repr)
    assert rows_of(read_state(spark, f"{scratch}/ck").select("day", "shop", "top", "rises")) == sorted(
        [(DAY, 1, 9.0, 2), (NEXT, 1, 2.0, 1), (None, None, 2.0, 2), (DAY, 2, 4.0, 1)], key=repr)


def test_idle_keys_time_out_in_event_time(spark, scratch):
    for i, part in enumerate(PARTS):
        write_part(frame_of(spark, part), f"{scratch}/src", i, part)
    run(dearest_query(spark, scratch, time_mode="EventTime", time_col="at", watermark_delay="0 seconds", idle_seconds=600))
    got = [r for r in rows_of(spark.read.parquet(f"{scratch}/out")) if r[4]]
    assert got == sorted([(DAY, 2, 4.0, 1, True), (None, None, 2.0, 2, True)], key=repr)
    left = rows_of(read_state(spark, f"{scratch}/ck").select("day", "shop"))
    assert (DAY, 2) not in left and (None, None) not in left


def test_a_changed_query_goes_on_from_exported_counts(spark, scratch):
    """Counts of one query's checkpoint seed another query, with other sources and its own checkpoint."""
    schema = "k int, at timestamp, id bigint"
    first = [(i % 3, moment(i), i) for i in range(30)]
    second = [(i % 3, moment(i), i) for i in range(30, 60)]
    for name, rows in (("a", first), ("b", second)):
        write_part(spark.createDataFrame(rows, schema), f"{scratch}/{name}", 0, rows)

    def start(name, **more):
        out = running_count_stream(stream_of(spark, f"{scratch}/{name}", schema), "k", "at", "id", 300, **more)
        run(jobs.start(out, f"{scratch}/ck-{name}", sink="parquet", path=f"{scratch}/out-{name}", available_now=True))
        return spark.read.parquet(f"{scratch}/out-{name}").where("not timed_out")

    start("a")
    exported = read_state(spark, f"{scratch}/ck-a").select("k", "n", "last_us")
    assert sorted(map(tuple, exported.select("k", "n").collect())) == [(0, 10), (1, 10), (2, 10)]
    exported.write.parquet(f"{scratch}/exported")
    got = start("b", initial_state=spark.read.parquet(f"{scratch}/exported"))
    assert got.schema["k"].dataType.simpleString() == "int"
    assert sorted((r["id"], r["n"]) for r in got.collect()) == [(i, i // 3 + 1) for i in range(30, 60)]


def test_wrong_uses_are_refused(spark, scratch):
    write_part(frame_of(spark, PARTS[0]), f"{scratch}/src", 0, PARTS[0])
    rows = stream_of(spark, f"{scratch}/src")
    with pytest.raises(ValueError, match="time_mode"):
        keyed_state(rows, "day", dearest, "n int", "m int", time_mode="Sometime")
    with pytest.raises(ValueError, match="watermark_delay"):
        keyed_state(rows, "day", dearest, "n int", "m int", time_mode="EventTime")
    with pytest.raises(ValueError, match="clock"):
        keyed_state(rows, "day", dearest, "n int", "m int", time_mode="None", idle_seconds=5)
    with pytest.raises(ValueError, match="repeats the key"):
        keyed_state(rows, "day", dearest, "n int", "day date")


def test_state_handle():
    state = KeyState(None, None)
    assert not state.exists
    with pytest.raises(KeyError):
        state.get()
    state.update(1, "a")
    assert state.exists and state.get() == (1, "a")
    state.remove()
    assert not state.exists
    with pytest.raises(ValueError, match="times out"):
        KeyState((1,), 5, timing_out=True).update(2)
