"""Records in shards: framing, offsets per shard, restart, late shards, record cap, watermarks of united shards."""

import datetime as dt
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from test_streaming import run, write_part
from tidepool.plans import jobs as programs
from tidepool.sources import shards
from tidepool.sources.streams import rate_cap_options, read_records, union_streams
from tidepool.streaming import jobs
from tidepool.streaming.state import running_count_stream

BASE = 1_704_067_200_000_000


def put(path, shard, file, names):
    shards.append_records(path, shard, file, [(BASE + i, n.encode()) for i, n in enumerate(names)])


def start(spark, scratch, cap=None, available_now=True):
    options = rate_cap_options("shards", records_per_batch=cap) if cap else {}
    rows = read_records(spark, "shards", f"{scratch}/in", options)
    return jobs.start(rows.select(F.col("value").cast("string").alias("v"), "arrived_at", "arrival_seq"), f"{scratch}/ck",
                      path=f"{scratch}/out", available_now=available_now, interval_seconds=None if available_now else 0.2)


def values(spark, scratch):
    return sorted(r["v"] for r in spark.read.parquet(f"{scratch}/out").collect())


def test_frames_of_any_size_and_a_torn_end(monkeypatch):
    payloads = [b"", b"a\nb", b"x" * 50, b"y" * 7]
    raw = b"".join(shards.HEADER.pack(i, len(p)) + p for i, p in enumerate(payloads))
    for block in (13, 20, 64, 1 << 20):
        monkeypatch.setattr(shards, "_BLOCK", block)
        got = list(shards.frames(io.BytesIO(raw), 0, len(raw)))
        assert [(a, p) for _, a, p in got] == list(enumerate(payloads)) and got[-1][0] == len(raw)
        for cut in range(len(raw)):
            whole = [e for e, _, _ in got if e <= cut]
            assert [e for e, _, _ in shards.frames(io.BytesIO(raw), 0, cut)] == whole
        assert len(list(shards.frames(io.BytesIO(raw), 0, len(raw), most=2, payload=False))) == 2


def test_restart_goes_on_at_each_shards_offset_and_late_shards_are_read(spark, scratch):
    path = f"{scratch}/in"
    put(path, "a", "0001", ["a1", "a2"])
    put(path, "b", "0001", ["b1"])
    run(start(spark, scratch))
    assert values(spark, scratch) == ["a1", "a2", "b1"]
    put(path, "a", "0001", ["a3"])                   # appended to the same file
    put(path, "a", "0002", ["a4"])                   # a next file
    put(path, "c", "0001", ["c1", "c2"])             # a shard found later
    with open(f"{path}/shard=b/0001", "ab") as torn:
        torn.write(shards.HEADER.pack(BASE, 100) + b"only a part")
    run(start(spark, scratch))
    assert values(spark, scratch) == ["a1", "a2", "a3", "a4", "b1", "c1", "c2"]
    run(start(spark, scratch))
    assert len(values(spark, scratch)) == 7
    seen = spark.read.parquet(f"{scratch}/out").where("v = 'a4'").first()
    assert seen["arrival_seq"]["source"] == "a/0002" and seen["arrived_at"] == dt.datetime(2024, 1, 1)


def test_a_query_without_its_progress_file_replays_from_the_checkpoint(spark, scratch):
    """A batch that was planned but not committed is planned again from the checkpoint's own offsets."""
    reader = shards.ShardStreamReader({"path": f"{scratch}/in", "recordsPerShard": "2"})
    put(f"{scratch}/in", "a", "1", [f"v{i}" for i in range(5)])
    first = reader.latestOffset()
    reader.partitions({}, first)
    again = shards.ShardStreamReader({"path": f"{scratch}/in", "recordsPerShard": "2"})
    assert [p.last for p in again.partitions({}, first)] == [tuple(first["a"])]
    second = again.latestOffset()
    rows = [v for p in again.partitions(first, second) for v, *_ in again.read(p)]
    assert rows == [b"v2", b"v3"]
    assert json.load(open(f"{scratch}/in/_progress")) == second


def test_at_most_so_many_records_a_shard_and_none_lost(spark, scratch):
    for s in range(4):
        for part in range(5):
            put(f"{scratch}/in", f"s{s}", f"{part:04d}", [f"{s}-{part}-{i}" for i in range(500)])
    q = start(spark, scratch, cap=700, available_now=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes and max(sizes) <= 4 * 700 and len(sizes) >= 4
    got = values(spark, scratch)
    assert len(got) == 10_000 == len(set(got))


def test_caps_by_file_are_refused_for_shards():
    with pytest.raises(ValueError, match="no cap by files_per_batch"):
        rate_cap_options("shards", files_per_batch=3)
    with pytest.raises(ValueError, match="positive"):
        shards.ShardStreamReader({"path": "/x", "recordsPerShard": "0"})


def test_the_trade_job_reads_shards_into_a_bucket_table(spark, scratch):
    def trade(i, price):
        return f'{{"symbol":"S{i % 2}","trade":"BUY","price":{price},"quantity":1,"id":"{i}"}}'

    put(f"{scratch}/in", "a", "1", [trade(i, 1.0) for i in range(6)])
    put(f"{scratch}/in", "b", "1", [trade(i, 2.0) for i in range(4, 8)])

    def go():
        q = programs.trade_table_stream_job(spark, "shards", f"{scratch}/in", f"{scratch}/ck", f"{scratch}/t",
                                            cap={"records_per_batch": 100}, buckets=4, bytes_per_second=1e7, available_now=True)
        run(q)
        return programs.BucketTable(spark, f"{scratch}/t", ["id"]).read()

    assert go().count() == 8
    put(f"{scratch}/in", "a", "2", [trade(1, 9.0)])
    table = go()
    assert table.count() == 8 and table.where("id = '1'").first()["price"] == 9.0
    assert "Aggregate" not in table._jdf.queryExecution().executedPlan().toString()
    assert len(table.first()["data"]) == 1024


def test_a_slow_shard_loses_no_rows_to_a_fast_one(spark, scratch):
    """One shard is an hour behind the other; with a watermark of its own none of its rows is late."""
    base = dt.datetime(2024, 1, 1)
    schema = "k string, ts timestamp, id bigint"
    fast = [("a", base + dt.timedelta(seconds=3600 + i), i) for i in range(0, 400, 10)]
    slow = [("b", base + dt.timedelta(seconds=i), 1000 + i) for i in range(0, 400, 10)]
    for part in range(4):
        for name, rows in (("fast", fast), ("slow", slow)):
            mine = rows[part * 10:part * 10 + 10]
            write_part(spark.createDataFrame(mine, schema), f"{scratch}/{name}", part, mine)

    def counted(own_watermarks):
        streams = [spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/{n}/part*")
                   for n in ("fast", "slow")]
        union = union_streams(*streams, time_col="ts", watermark_delay="0 seconds") if own_watermarks else union_streams(*streams)
        out = running_count_stream(union, "k", "ts", "id", 300)
        q = jobs.start(out, f"{scratch}/ck{own_watermarks}", path=f"{scratch}/out{own_watermarks}", available_now=True)
        run(q)
        return spark.read.parquet(f"{scratch}/out{own_watermarks}").where("not timed_out").count(), jobs.late_rows(q)

    assert counted(True) == (80, 0)
    n, late = counted(False)
    assert late > 0 and n + late == 80


def test_watermarks_of_shards_need_the_least_policy(spark, scratch):
    os.makedirs(f"{scratch}/in")
    stream = spark.readStream.schema("ts timestamp").parquet(f"{scratch}/in")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError, match="must be min"):
            union_streams(stream, stream, time_col="ts", watermark_delay="1 second")
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
