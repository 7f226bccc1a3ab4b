"""Running counts with idle timeout against a brute-force Python model."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool.operators import state

IDLE = 300


def brute_force(rows, idle_s=IDLE):
    """rows: (key, ts, id). Returns ({id: n}, sorted timeout tuples)."""
    by_key = {}
    for k, ts, i in rows:
        by_key.setdefault(k, []).append((ts, i))
    gmax = max(ts for _, ts, _ in rows)
    counts, timeouts = {}, []
    for k, items in by_key.items():
        items.sort()
        n, last = 0, None
        for ts, i in items:
            if last is not None and (ts - last) > dt.timedelta(seconds=idle_s):
                timeouts.append((k, last, n))
                n = 0
            n += 1
            last = ts
            counts[i] = n
        if (gmax - last) > dt.timedelta(seconds=idle_s):
            timeouts.append((k, last, n))
    return counts, sorted(timeouts, key=lambda t: (str(t[0]), t[1]))


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "user_id",
                                                                   "ts", "event_id")


@pytest.mark.parametrize("partitions", [None, 1, 7, 64])
def test_running_counts_match_brute_force(spark, events, partitions):
    rows = [(r.event_type, r.ts, r.event_id) for r in events.collect()]
    want_counts, want_timeouts = brute_force(rows)
    counted = state.running_counts(events, "event_type", "ts", "event_id", IDLE,
                                   partitions=partitions)
    got = {r.event_id: r.n for r in counted.select("event_id", "n").collect()}
    assert got == want_counts
    t = state.idle_timeouts(counted, "event_type", "ts", IDLE).collect()
    got_t = sorted(((r.event_type, r.last_time, r.n) for r in t), key=lambda x: (str(x[0]), x[1]))
    assert got_t == want_timeouts


def test_hot_and_null_keys(spark, events):
    # One key holds most rows, another key is NULL; ties on time are broken by id.
    skewed = events.select(
        F.when(F.col("event_id") % 10 < 7, F.lit("hot"))
         .when(F.col("event_id") % 10 == 7, F.lit(None))
         .otherwise(F.col("event_type")).alias("k"),
        (F.col("ts") - F.expr("INTERVAL 1 SECOND") * (F.col("event_id") % 2)).alias("ts"),
        "event_id")
    rows = [(r.k, r.ts, r.event_id) for r in skewed.collect()]
    want_counts, want_timeouts = brute_force(rows, idle_s=60)
    counted = state.running_counts(skewed, "k", "ts", "event_id", 60, partitions=11)
    got = {r.event_id: r.n for r in counted.select("event_id", "n").collect()}
    assert got == want_counts
    got_t = sorted(((r.k, r.last_time, r.n) for r in
                    state.idle_timeouts(counted, "k", "ts", 60).collect()),
                   key=lambda x: (str(x[0]), x[1]))
    assert got_t == want_timeouts


def test_no_window_partitioned_by_key_alone(spark, events):
    """The row-level windows are partitioned by (key, range), never by key only."""
    counted = state.running_counts(events, "event_type", "ts", "event_id", IDLE)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        if "_tp_t" in spec:
            assert "_tp_part" in spec.split("_tp_t")[0], spec


def test_bursts_equal_and_missing_times_are_cut(spark):
    """50,000 rows of a key in one second, at one time or without a time: no range holds many more than its share."""
    n, parts = 50_000, 20
    rows = spark.range(n).select(
        F.lit("k").alias("k"), "id",
        F.when(F.col("id") % 3 == 0, F.timestamp_micros(F.lit(10 ** 15) + F.col("id")))
         .when(F.col("id") % 3 == 1, F.timestamp_micros(F.lit(10 ** 15))).alias("ts"))
    late = spark.range(1).select(F.lit("k").alias("k"), (F.col("id") + n).alias("id"),
                                 F.timestamp_micros(F.lit(10 ** 15 + 30 * 86_400 * 10 ** 6)).alias("ts"))
    both = rows.unionByName(late)
    counted = state.running_counts(both, "k", "ts", "id", 300, partitions=parts)
    assert counted.agg(F.max("n")).first()[0] == n
    assert counted.where("ends_segment").select("n").collect()[0]["n"] == n
    ranges = both.repartitionByRange(parts, F.struct("k"), "ts", "id").groupBy(F.spark_partition_id()).count()
    assert ranges.agg(F.max("count")).first()[0] < 3 * n / parts


def test_keys_without_times_time_out(spark):
    rows = [("a", None, 1), ("a", None, 2), ("b", dt.datetime(2024, 1, 1), 3), ("b", None, 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id long")
    got = {r.id: (r.n, r.ends_segment) for r in state.running_counts(df, "k", "ts", "id", 300).collect()}
    assert got == {1: (1, False), 2: (2, True), 4: (1, False), 3: (2, False)}
    none = df.where("ts is null")
    assert not any(r.ends_segment for r in state.running_counts(none, "k", "ts", "id", 300).collect())


def test_no_job_while_the_plan_is_built(spark, events):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    state.idle_timeouts(state.running_counts(events, "event_type", "ts", "event_id", IDLE), "event_type", "ts")
    spark.sparkContext._jsc.clearJobGroup()
    assert not tracker.getJobIdsForGroup("plan-only")


def test_a_table_that_grew_is_read_again(spark, events, scratch):
    path = f"{scratch}/events"
    small = events.where("event_id < 100")
    small.write.parquet(path)
    first = state.running_counts(spark.read.parquet(path), "event_type", "ts", "event_id", IDLE).count()
    events.where("event_id >= 100 and event_id < 150").write.mode("append").parquet(path)
    second = state.running_counts(spark.read.parquet(path), "event_type", "ts", "event_id", IDLE).count()
    assert (first, second) == (100, 150)


def test_release_gives_the_kept_rows_back(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("ts"), "id")
    counted = state.running_counts(df, "k", "ts", "id")
    ended = state.idle_timeouts(counted, "k", "ts")
    assert counted.count() == 100
    assert counted._tp_kept.storageLevel.useDisk
    state.release(ended)
    assert not counted._tp_kept.storageLevel.useDisk
    assert counted.count() == 100        # without the copy it is computed again
    state.release(df)
