"""The copy-on-write table: replacing, replaying, dying in between, and the write rate."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tidepool.sinks import buckets as bt

SCHEMA = "id string, part int, v double, at long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain(batches, deletes=()):
    """Keys to rows after the batches, a later row of a key in place of the earlier one."""
    held = {}
    for i, batch in enumerate(batches):
        for key in dict(deletes).get(i, ()):
            held.pop(key, None)
        for r in sorted(batch, key=lambda r: r[3]):
            held[r[:2]] = r
    return sorted(held.values(), key=repr)


def random_batches(seed, n=5):
    rng = random.Random(seed)
    at = iter(range(10_000))
    return [[(rng.choice([None, *(f"k{i}" for i in range(40))]), rng.choice([None, 1, 2]), rng.random(), next(at))
             for _ in range(rng.choice([0, 1, 30, 80]))] for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_later_rows_replace_earlier_ones_also_of_null_keys(spark, scratch, seed):
    batches = random_batches(seed)
    table = bt.BucketTable(spark, f"{scratch}/t", ["id", "part"], buckets=7)
    for i, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, SCHEMA)
        assert table.upsert(frame, i, ["at"])
        assert not table.upsert(frame.withColumn("v", F.lit(-1.0)), i, ["at"])       # replayed: nothing changes
        assert rows_of(table.read()) == plain(batches[:i + 1])
    table.vacuum()
    assert rows_of(table.read()) == plain(batches)
    assert len(table.folder.names("manifest")) <= bt.KEPT_MANIFESTS


def test_deletes(spark, scratch):
    table = bt.BucketTable(spark, f"{scratch}/t", ["id", "part"], buckets=4)
    first = [(f"k{i}", 1, 0.0, i) for i in range(20)]
    table.upsert(spark.createDataFrame(first, SCHEMA), 0, ["at"])
    second, gone = [("k3", 1, 1.0, 50)], [(f"k{i}", 1) for i in range(10)]
    table.upsert(spark.createDataFrame(second, SCHEMA), 1, ["at"], spark.createDataFrame(gone, "id string, part int"))
    assert rows_of(table.read()) == plain([first, second], {1: gone}.items())
    every = [(f"k{i}", 1) for i in range(20)]
    table.upsert(spark.createDataFrame([], SCHEMA), 2, None, spark.createDataFrame(every, "id string, part int"))
    assert table.read().count() == 0 and table.read().columns == ["id", "part", "v", "at"]


def test_a_read_has_no_aggregate_and_a_batch_touches_its_buckets_only(spark, scratch):
    table = bt.BucketTable(spark, f"{scratch}/t", ["id"], buckets=32)
    table.upsert(spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v")), 0)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan and "Join" not in plan
    before = table.manifest()["folders"]
    table.upsert(spark.createDataFrame([("7", 2)], "id string, v int"), 1)
    after = table.manifest()["folders"]
    assert len([b for b in after if after[b] != before[b]]) == 1
    assert table.read().where("id = '7'").first()["v"] == 2 and table.read().count() == 500


def test_dying_between_files_and_manifest_leaves_the_old_table(spark, scratch, monkeypatch):
    table = bt.BucketTable(spark, f"{scratch}/t", ["id", "part"], buckets=4)
    batches = [[("a", 1, 0.0, 1), ("b", 1, 0.0, 2)], [("a", 1, 5.0, 3)]]
    table.upsert(spark.createDataFrame(batches[0], SCHEMA), 0, ["at"])

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(bt.SharedFolder, "put", die)
        with pytest.raises(RuntimeError, match="driver lost"):
            table.upsert(spark.createDataFrame(batches[1], SCHEMA), 1, ["at"])
    again = bt.BucketTable(spark, f"{scratch}/t", ["id", "part"])
    assert rows_of(again.read()) == plain(batches[:1])
    assert len(again.folder.names("data")) == 2
    again.upsert(spark.createDataFrame(batches[1], SCHEMA), 1, ["at"])
    again.vacuum()
    assert rows_of(again.read()) == plain(batches) and len(again.folder.names("data")) == 2


def test_two_writers_of_a_batch_do_not_both_win(spark, scratch):
    folder = bt.SharedFolder(spark, scratch)
    folder.put("manifest/1.json", "first")
    with pytest.raises(RuntimeError, match="two writers"):
        folder.put("manifest/1.json", "second")
    assert folder.read("manifest/1.json") == "first"


def test_other_keys_and_missing_tables_are_refused(spark, scratch):
    table = bt.BucketTable(spark, f"{scratch}/t", ["id"])
    with pytest.raises(ValueError, match="no table yet"):
        table.read()
    table.upsert(spark.createDataFrame([("a", 1, 0.0, 1)], SCHEMA), 0)
    with pytest.raises(ValueError, match="keys are"):
        bt.BucketTable(spark, f"{scratch}/t", ["part"]).read()


def test_token_bucket_follows_its_clock():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = bt.TokenBucket(100, clock=lambda: now[0], sleep=sleep)
    for size in (50, 50, 300, 10):
        bucket.take(size)
    assert now[0] == pytest.approx(410 / 100)
    now[0] += 100
    bucket.take(100)         # saved up to one burst, not more
    bucket.take(100)
    assert now[0] == pytest.approx(4.1 + 100 + 1)
    with pytest.raises(ValueError, match="positive"):
        bt.TokenBucket(0)


def test_the_measured_rate_stays_under_the_limit(spark, scratch):
    frame = spark.range(0, 4000, 1, 1).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), 100).alias("v"))
    frame.write.parquet(f"{scratch}/warm")
    size = sum(len(r["id"]) + len(r["v"]) for r in frame.collect())
    limit = 200_000
    began = time.monotonic()
    bt.throttled(frame, limit).write.parquet(f"{scratch}/slow")
    took = time.monotonic() - began
    assert size / took < limit and took < 30
    assert rows_of(spark.read.parquet(f"{scratch}/slow")) == rows_of(frame)


def test_rate_in_the_table(spark, scratch):
    table = bt.BucketTable(spark, f"{scratch}/t", ["id"], buckets=2)
    frame = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    bt.bucket_writer(table, ["id", "v"], rate=1e6)(frame, 0)
    assert rows_of(table.read()) == rows_of(frame)
    assert os.path.isdir(f"{scratch}/t/manifest")
