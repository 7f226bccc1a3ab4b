"""Streams against their table forms, restarts against uninterrupted runs."""

import os
import time

import pytest
from pyspark.sql import functions as F

import word_records
from conftest import SF_SMALL
from tidepool.operators import aggregates as agg
from tidepool.operators import state
from tidepool.operators.latest import latest_per_key
from tidepool.plans import fixtures
from tidepool.sinks.table import batch_writer, read_latest
from tidepool.sources.streams import rate_cap_options, read_records
from tidepool.streaming import jobs
from tidepool.streaming.state import running_count_stream

IDLE = 300


def split_rows(df, parts, order_col):
    rows = df.orderBy(order_col).collect()
    size = -(-len(rows) // parts)
    return [rows[i * size:(i + 1) * size] for i in range(parts)]


def write_part(df, folder, i, rows):
    df.sparkSession.createDataFrame(rows, df.schema).coalesce(1) \
        .write.parquet(os.path.join(folder, f"part{i}"))
    time.sleep(1.1)  # file order by modification time stays fixed


def write_parts(df, folder, parts, order_col):
    """Write ``df`` sorted by ``order_col`` as ``parts`` files, at least 1 s apart."""
    for i, rows in enumerate(split_rows(df, parts, order_col)):
        write_part(df, folder, i, rows)


def run(query, timeout=180):
    assert query.awaitTermination(timeout), "stream did not finish"
    assert query.exception() is None


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "ts",
                                                                   "event_id")


def _table_form(events):
    counted = state.running_counts(events, "event_type", "ts", "event_id", IDLE)
    return state.state_outputs(counted, "event_type", "ts", IDLE).select(
        "event_type", F.col("at").cast("timestamp").alias("at"), "n", "timed_out")


def test_running_count_stream_equals_table(spark, events, scratch):
    write_parts(events, os.path.join(scratch, "src"), 3, "event_id")
    stream = (spark.readStream.schema(events.schema)
              .options(**rate_cap_options("parquet", files_per_batch=1))
              .parquet(os.path.join(scratch, "src", "part*")))
    out = running_count_stream(stream, "event_type", "ts", "event_id", IDLE)
    q = jobs.start(out, os.path.join(scratch, "ck"), sink="parquet",
                   path=os.path.join(scratch, "out"), available_now=True)
    run(q)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = spark.read.parquet(os.path.join(scratch, "out")).select("event_type", "at", "n",
                                                                   "timed_out")
    want = _table_form(events)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_count_restart_equals_uninterrupted(spark, events, scratch):
    src = os.path.join(scratch, "src")
    first, second = split_rows(events, 2, "event_id")
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")

    def start(path_glob):
        stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
                  .parquet(path_glob))
        return jobs.start(running_count_stream(stream, "event_type", "ts", "event_id", IDLE),
                          ck, sink="parquet", path=out, available_now=True)

    # First run sees only the first file; the restart resumes from the checkpoint.
    write_part(events, src, 0, first)
    run(start(os.path.join(src, "part*")))
    write_part(events, src, 1, second)
    run(start(os.path.join(src, "part*")))
    got = spark.read.parquet(out).select("event_type", "at", "n", "timed_out")
    want = _table_form(events)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_per_batch_word_counts_reconcile(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    recs = word_records.word_records(ev, "event_id").select(
        "event_id", F.encode("record", "UTF-8").alias("value"))
    write_parts(recs, os.path.join(scratch, "src"), 2, "event_id")
    stream = read_records(spark, "parquet", os.path.join(scratch, "src", "part*"),
                          options={"maxFilesPerTrigger": "1"}, schema=recs.schema)
    counts_dir = os.path.join(scratch, "counts")

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(os.path.join(counts_dir, f"batch_id={batch_id}"))

    monitor = jobs.BatchMonitor(jobs.per_batch_word_counts(sink))
    run(jobs.start(stream, os.path.join(scratch, "ck"), foreach_batch=monitor,
                   available_now=True))
    assert [h["n_rows"] for h in monitor.history] == [500, 500]
    assert monitor.total == ev.count()
    counted = agg.word_count(spark.read.parquet(counts_dir).groupBy("word")
                             .agg(F.sum("n").alias("n")).withColumnRenamed("n", "c"), "word")
    per_word = spark.read.parquet(counts_dir).groupBy("word").agg(F.sum("n").alias("n"))
    sent = agg.word_count(word_records.generated_words(ev, "event_id"))
    assert agg.reconcile(sent, per_word).count() == 0
    assert counted.count() == 5


def test_keyed_sink_stream_restart(spark, scratch):
    trades = (fixtures.trades(spark, SF_SMALL, (*fixtures.TRADE_V1, "time"))
              .select("id", "tickerSymbol", "tradeType", "price", "quantity", "time"))
    src = os.path.join(scratch, "src")
    parts = split_rows(trades, 3, "time")
    table = os.path.join(scratch, "table")
    cols = ["id", "tickerSymbol", "tradeType", "price", "quantity", "time"]
    writer = batch_writer(table, cols, ["tickerSymbol"], ["time", "id"])

    def start():
        stream = (spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1)
                  .parquet(os.path.join(src, "part*")))
        return jobs.start(stream, os.path.join(scratch, "ck"),
                          foreach_batch=jobs.BatchMonitor(writer), available_now=True)

    write_part(trades, src, 0, parts[0])
    write_part(trades, src, 1, parts[1])
    run(start())
    write_part(trades, src, 2, parts[2])
    run(start())
    got = read_latest(spark, table, ["tickerSymbol"], ["time", "id"])
    want = latest_per_key(trades, "tickerSymbol", ["time", "id"]).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_windowed_symbol_counts_equal_table(spark, scratch):
    t = fixtures.trade_stream(spark, SF_SMALL).select("symbol", "ts", "event_id")
    write_parts(t, os.path.join(scratch, "src"), 2, "event_id")
    stream = (spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(scratch, "src", "part*")))
    out = jobs.windowed_key_counts(stream, "ts", "symbol", "5 seconds", "0 seconds")
    run(jobs.start(out, os.path.join(scratch, "ck"), sink="parquet",
                   path=os.path.join(scratch, "out"), available_now=True))
    got = spark.read.parquet(os.path.join(scratch, "out"))
    # Windows still open at the end are not emitted in append mode.
    final = t.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    want = (agg.count_per_window(t.withColumn("ts", F.col("ts").cast("timestamp")), "ts",
                                 "symbol", "5 seconds")
            .where(F.col("window_start") + F.expr("INTERVAL 5 SECONDS") <= F.lit(final)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() >= want.count() > 0


def test_windowed_word_counts_equal_table(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    recs = word_records.word_records(ev, "event_id", keep=("ts",)).select("event_id", "ts", "record")
    write_parts(recs, os.path.join(scratch, "src"), 2, "event_id")
    stream = (spark.readStream.schema(recs.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(scratch, "src", "part*")))
    from tidepool.functions import text
    words = text.tokens(stream, "record", "word", keep=("ts",))
    out = jobs.windowed_key_counts(words, "ts", "word", "2 seconds", "0 seconds")
    run(jobs.start(out, os.path.join(scratch, "ck"), sink="parquet",
                   path=os.path.join(scratch, "out"), available_now=True))
    got = spark.read.parquet(os.path.join(scratch, "out"))
    final = ev.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    table_words = text.tokens(recs.withColumn("ts", F.col("ts").cast("timestamp")), "record",
                              "word", keep=("ts",))
    want = (agg.count_per_window(table_words, "ts", "word", "2 seconds")
            .where(F.col("window_start") + F.expr("INTERVAL 2 SECONDS") <= F.lit(final)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_per_batch_max_id_string_order(spark, scratch):
    t = fixtures.trade_stream(spark, SF_SMALL).select("id", "event_id")
    write_parts(t, os.path.join(scratch, "src"), 2, "event_id")
    stream = (spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(scratch, "src", "part*")))
    seen = []
    monitor = jobs.BatchMonitor(jobs.per_batch_max_id("id", lambda df, b: seen.extend(df.collect())))
    run(jobs.start(stream, os.path.join(scratch, "ck"), foreach_batch=monitor,
                   available_now=True))
    rows = sorted(t.collect(), key=lambda r: r.event_id)
    halves = [rows[:500], rows[500:]]
    assert [r.max_id for r in sorted(seen, key=lambda r: r.batch_id)] == \
        [max(r.id for r in h) for h in halves]
    assert seen[0].max_id == "99"  # string order: "99" > "499"


def test_running_count_stream_string_tiebreak(spark, scratch):
    t = (fixtures.trade_stream(spark, SF_SMALL)
         .select("symbol", "ts", F.col("id").alias("tid"), "event_id"))
    write_parts(t, os.path.join(scratch, "src"), 2, "event_id")
    stream = (spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(scratch, "src", "part*")))
    out = running_count_stream(stream, "symbol", "ts", "tid", IDLE)
    run(jobs.start(out, os.path.join(scratch, "ck"), sink="parquet",
                   path=os.path.join(scratch, "out"), available_now=True))
    got = spark.read.parquet(os.path.join(scratch, "out"))
    assert dict(got.dtypes)["tid"] == "string"
    counted = state.running_counts(t, "symbol", "ts", "tid", IDLE)
    want = state.state_outputs(counted, "symbol", "ts", IDLE).select(
        "symbol", F.col("at").cast("timestamp").alias("at"), "n", "timed_out")
    g = got.select("symbol", "at", "n", "timed_out")
    assert g.exceptAll(want).count() == 0 and want.exceptAll(g).count() == 0


def test_processing_time_timeout_fires_without_new_data(spark, scratch):
    import time as _time
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("x\nx\ny\n")
    lines = spark.readStream.format("text").load(src).withColumn("arrived_at",
                                                                 F.current_timestamp())
    rows = lines.withColumn("tie", F.col("value"))  # equal words: order is immaterial
    out = running_count_stream(rows, "value", "arrived_at", "tie", idle_seconds=1,
                               time_mode="ProcessingTime")
    seen = []
    q = jobs.start(out, os.path.join(scratch, "ck"), interval_seconds=0.5,
                   foreach_batch=lambda df, b: seen.extend(df.collect()))
    deadline = _time.time() + 60
    while _time.time() < deadline and sum(r.timed_out for r in seen) < 2:
        _time.sleep(0.5)
    q.stop()
    counts = sorted((r.value, r.n) for r in seen if not r.timed_out)
    timeouts = sorted((r.value, r.n) for r in seen if r.timed_out)
    assert counts == [("x", 1), ("x", 2), ("y", 1)]
    assert timeouts == [("x", 2), ("y", 1)]


def test_console_sink_runs(spark, scratch):
    # The rows are printed by the JVM, outside what the test can capture.
    t = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "event_id")
    write_parts(t, os.path.join(scratch, "src"), 1, "event_id")
    stream = spark.readStream.schema(t.schema).parquet(os.path.join(scratch, "src", "part*"))
    q = jobs.console(stream, os.path.join(scratch, "ck"), rows=3, available_now=True)
    run(q)
    progress = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert sum(p["numInputRows"] for p in progress) == t.count()
    assert "console" in progress[0]["sink"]["description"].lower()


def test_union_of_shard_streams_with_source_time(spark, scratch):
    from tidepool.sources.streams import union_streams
    recs = (spark.read.parquet(f"{SF_SMALL}/events.parquet")
            .select(F.encode("event_type", "UTF-8").alias("value"), "ts", "event_id"))
    halves = split_rows(recs, 2, "event_id")
    for i, rows in enumerate(halves):  # two "shards", one folder each
        write_part(recs, os.path.join(scratch, f"shard{i}"), 0, rows)
    shards = [read_records(spark, "parquet", os.path.join(scratch, f"shard{i}", "part*"),
                           schema=recs.schema, time_col="ts") for i in range(2)]
    merged = union_streams(*shards)
    assert merged.columns == ["value", "arrived_at", "arrival_seq"]
    seen = []
    run(jobs.start(merged, os.path.join(scratch, "ck"), available_now=True,
                   foreach_batch=lambda df, b: seen.extend(df.collect())))
    assert len(seen) == recs.count()  # duplicates across shards would be kept too
    assert min(r.arrived_at for r in seen) is not None


def test_stream_rows_without_time_do_not_fail(spark, scratch):
    import datetime as dt
    rows = [("a", None, 1), ("a", dt.datetime(2024, 1, 1, 0, 0), 2),
            ("a", dt.datetime(2024, 1, 1, 0, 1), 3), ("b", None, 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id bigint")
    write_parts(df, os.path.join(scratch, "src"), 1, "id")
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(scratch, "src", "part*"))
    seen = []
    run(jobs.start(running_count_stream(stream, "k", "ts", "id", IDLE),
                   os.path.join(scratch, "ck"), available_now=True,
                   foreach_batch=lambda d, b: seen.extend(d.collect())))
    got = sorted((r.k, r.id, r.n, r.at is None) for r in seen if not r.timed_out)
    assert got == [("a", 1, 1, True), ("a", 2, 2, False), ("a", 3, 3, False), ("b", 4, 1, True)]


def test_out_of_order_batches_never_move_the_clock_back(spark, scratch):
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    rows = [("k", start + dt.timedelta(seconds=t), i) for i, t in enumerate((100, 300, 150, 560))]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id bigint")
    write_parts(df, os.path.join(scratch, "src"), 4, "id")
    stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(scratch, "src", "part*")))
    seen = []
    q = jobs.start(running_count_stream(stream, "k", "ts", "id", 300, watermark_delay="1 hour"),
                   os.path.join(scratch, "ck"), available_now=True,
                   foreach_batch=lambda d, b: seen.extend(d.collect()))
    run(q)
    assert [(r.id, r.n, r.timed_out) for r in seen] == [(0, 1, False), (1, 2, False), (2, 3, False), (3, 4, False)]
    assert jobs.late_rows(q) == 0


def test_late_rows_are_reported(spark, scratch):
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(seconds=t), i)
            for i, (k, t) in enumerate((("a", 1000), ("a", 2000), ("a", 2500), ("b", 10)))]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id bigint")
    write_parts(df, os.path.join(scratch, "src"), 4, "id")
    stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(scratch, "src", "part*")))
    q = jobs.start(running_count_stream(stream, "k", "ts", "id", 300), os.path.join(scratch, "ck"),
                   available_now=True, sink="parquet", path=os.path.join(scratch, "out"))
    run(q)
    counted = spark.read.parquet(os.path.join(scratch, "out")).where("not timed_out").count()
    assert counted + jobs.late_rows(q) == 4 and jobs.late_rows(q) == 1


def test_arrival_order_counts_every_chunk_of_a_hot_key(spark):
    """Frames of one key are counted in turn, in arrival order, without a gap between them."""
    import pandas as pd
    from tidepool.streaming.keyed import KeyState
    from tidepool.streaming.state import RunningCount
    count, state = RunningCount("id", 300), KeyState(None, None)
    us = [100, 300, 150, 560, 900]
    frames = [pd.DataFrame({"tp_epoch_us": [u * 1_000_000], "id": [i]}) for i, u in enumerate(us)]
    counts, timeouts = [], []
    for f in frames:
        closed, rows = count(("k",), f, state)
        counts += rows["n"].tolist()
        timeouts += closed["n"].tolist()
    assert counts == [1, 2, 3, 4, 1] and timeouts == [4] and state.get() == (1, 900_000_000)


def test_empty_batches_leave_nothing(spark, scratch):
    table = os.path.join(scratch, "t")
    monitor = jobs.BatchMonitor(batch_writer(table, ["a"]))
    empty = spark.createDataFrame([], "a long")
    monitor(empty, 0)
    monitor(spark.range(3).withColumnRenamed("id", "a"), 1)
    monitor(empty, 2)
    assert os.listdir(table) == ["batch_id=1"]
    assert monitor.total == 3 and len(monitor.history) == 1


def jobs_of(spark, call):
    """Number of Spark jobs that ``call`` runs."""
    group = f"counted-{time.time()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        call()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


TRADES = ['{"symbol":"A","trade":"BUY","price":1.5,"quantity":2,"id":"9"}',
          '{"symbol":"B","trade":"BUY","price":2.5,"quantity":2,"id":"10"}',
          '{"symbol":"A","trade":"SELL","price":3.5,"quantity":2,"id":"11"}']


def raw_trades(spark, texts):
    from tidepool.functions import records
    rows = spark.createDataFrame([(t.encode(),) for t in texts], "value binary").select(
        "value", F.current_timestamp().alias("arrived_at"),
        F.struct(F.lit("f").alias("source"), F.lit(0).cast("long").alias("position")).alias("arrival_seq"))
    return records.parse_trades_bytes(rows, "value", "trade", "v2", strict=False)


def test_a_batch_is_one_job(spark, scratch):
    """Rows, rejects, the greatest id and the total come out of the write itself."""
    monitor = jobs.BatchMonitor(lambda df, b: df.write.mode("overwrite").parquet(os.path.join(scratch, f"b{b}")),
                                prepare=jobs.accepted_trades(os.path.join(scratch, "rejects")),
                                extra={"max_id": F.max(F.col("id").cast("string"))})
    assert jobs_of(spark, lambda: monitor(raw_trades(spark, TRADES), 0)) == 1
    assert jobs_of(spark, lambda: monitor(raw_trades(spark, TRADES[:1]), 1)) == 1
    assert [(h["n_rows"], h["total"], h["max_id"]) for h in monitor.history] == [(3, 3, "9"), (1, 4, "9")]
    assert not os.path.exists(os.path.join(scratch, "rejects"))
    # Only a batch with rejected records pays a second one.
    assert jobs_of(spark, lambda: monitor(raw_trades(spark, [*TRADES, "{", "17"]), 2)) == 2
    assert spark.read.parquet(os.path.join(scratch, "rejects", "batch_id=2")).count() == 2
    assert monitor.total == 7


def test_the_total_of_a_result_needs_no_job_of_its_own(spark, scratch):
    monitor = jobs.BatchMonitor(prepare=jobs.accepted_trades(os.path.join(scratch, "rejects")))
    monitor.within(jobs.per_batch_key_counts(
        "symbol", lambda df, b: df.write.mode("overwrite").parquet(os.path.join(scratch, f"b{b}")), monitor.output))
    ran = jobs_of(spark, lambda: monitor(raw_trades(spark, TRADES), 0))
    assert ran <= 2                  # the write; its exchange is a job of its own under adaptive execution
    assert monitor.total == 2 and monitor.history[0]["n_rows"] == 3


def test_an_action_that_runs_nothing_still_has_its_numbers(spark, monkeypatch):
    seen = []
    monitor = jobs.BatchMonitor(lambda df, b: seen.append(b))
    monkeypatch.setattr(jobs.observed, "__defaults__", (1.0,))
    monitor(spark.range(5), 7)
    assert seen == [7] and monitor.total == 5


def test_two_actions_see_the_same_rows(spark, scratch):
    first, second = (os.path.join(scratch, n) for n in ("one", "two"))
    monitor = jobs.BatchMonitor(lambda df, b: df.write.parquet(second))
    monitor.within(lambda df, b: df.write.parquet(first))
    monitor(spark.range(5).withColumn("r", F.rand()), 0)
    assert sorted(map(tuple, spark.read.parquet(first).collect())) == sorted(map(tuple, spark.read.parquet(second).collect()))
    assert monitor.total == 5
