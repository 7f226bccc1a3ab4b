"""Hot keys on a stream: ranges, summaries and stored state against a plain loop and the table form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_streaming import _table_form, run, write_part, write_parts
from tidepool.streaming import ranged

SCHEMA = "k string, ts timestamp, id bigint"
IDLE = 300


def moment(s):
    return None if s is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def plain(batches, event_time=True):
    """(rows of each batch, timeouts of each batch, state) by a loop over rows."""
    state, now, out = {}, None, []
    for batch in batches:
        rows = []
        for k, t, i in sorted(batch, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            n, last = state.get(k, (0, None))
            if t is not None and last is not None and t - last > IDLE:
                rows.append((k, last + IDLE, None, n, True))
                n = 0
            rows.append((k, t, i, n + 1, False))
            state[k] = (n + 1, last if t is None else t if last is None else max(t, last))
        now = max([t for _, t, _ in batch if t is not None] + ([now] if now is not None else []), default=None)
        for k, (n, last) in list(state.items()):
            if event_time and now is not None and last is not None and now - last > IDLE:
                rows.append((k, last + IDLE, None, n, True))
                del state[k]
        out.append(rows)
    return out, state


def seconds(ts):
    return None if ts is None else (ts - dt.datetime(2024, 1, 1)).total_seconds()


def random_batches(seed):
    rng = random.Random(seed)
    ids = iter(range(10_000))
    at, batches = 0, []
    for _ in range(4):
        batch = []
        for _ in range(rng.choice([1, 60, 150])):
            at += rng.choice([0, 0, 1, 5, 200])
            late = rng.choice([0, 0, 0, -400, -2000])
            key = rng.choice(["hot"] * 9 + [None, "a", "b", "c"])
            batch.append((key, None if rng.random() < 0.05 else max(0, at + late), next(ids)))
        batches.append(batch)
    return batches


@pytest.mark.parametrize("seed", range(3))
def test_batches_are_those_of_a_plain_loop(spark, scratch, seed):
    batches = random_batches(seed)
    want, state = plain(batches)
    counter = ranged.RangedCounter("k", "ts", "id", f"{scratch}/state", f"{scratch}/out", IDLE, event_time=True, buckets=3)
    for b, batch in enumerate(batches):
        frame = spark.createDataFrame([(k, moment(t), i) for k, t, i in batch], SCHEMA)
        counter(frame, b)
        counter(frame, b)                                       # replayed: nothing changes
        got = [(r["k"], seconds(r["at"]), r["id"], r["n"], r["timed_out"])
               for r in spark.read.parquet(f"{scratch}/out/batch_id={b}").collect()]
        assert sorted(got, key=repr) == sorted(((k, None if t is None else float(t), i, n, o) for k, t, i, n, o in want[b]), key=repr)
    table = ranged.BucketTable(spark, f"{scratch}/state", ["k"]).read().collect()
    base = 1_704_067_200
    assert {r["k"]: (r["n"], None if r["last_us"] is None else r["last_us"] / 1e6 - base) for r in table} == state


def test_no_task_gets_more_than_a_range_of_a_hot_key(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("ts"), "id")
    done = ranged.advance(rows, None, ["k"], "ts", "id", IDLE)
    sizes = [r["count"] for r in done.kept.groupBy("_tp_key", "_tp_part").count().collect() if r["_tp_key"]["k"] == "hot"]
    assert len(sizes) >= 6 and max(sizes) < 18_000 / 3
    last = done.outputs.where("k = 'hot'").orderBy(F.desc("n")).first()
    assert last["n"] == 18_000
    plan = done.outputs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    done.kept.unpersist()


def test_a_stream_with_restart_gives_the_table_form(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.when(F.col("event_id") % 10 > 0, "hot").otherwise(F.col("event_type")).alias("event_type"), "ts", "event_id")
    write_parts(events.where("event_id < 600"), f"{scratch}/src", 2, "event_id")

    def start():
        stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/src/part*"))
        run(ranged.ranged_running_count_job(stream, "event_type", "ts", "event_id", f"{scratch}/ck", f"{scratch}/out",
                                            idle_seconds=IDLE, event_time=True, available_now=True))

    start()
    write_part(events, f"{scratch}/src", 9, events.where("event_id >= 600").orderBy("event_id").collect())
    start()
    got = spark.read.parquet(f"{scratch}/out").select("event_type", "at", "n", "timed_out")
    want = _table_form(events)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_wall_clock_timeouts_come_with_the_next_batch(spark, scratch, monkeypatch):
    counter = ranged.RangedCounter("k", "ts", "id", f"{scratch}/state", f"{scratch}/out", IDLE, buckets=2)
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    for b, (clock, rows) in enumerate(((10, [("a", moment(5), 1)]), (400, [("b", moment(399), 2)]))):
        monkeypatch.setattr(ranged.time, "time", lambda c=clock: base + c)
        counter(spark.createDataFrame(rows, SCHEMA), b)
    got = [(r["k"], r["n"], r["timed_out"]) for r in spark.read.parquet(f"{scratch}/out/batch_id=1").collect()]
    assert sorted(got) == [("a", 1, True), ("b", 1, False)]
    assert [r["k"] for r in ranged.BucketTable(spark, f"{scratch}/state", ["k"]).read().collect()] == ["b"]
