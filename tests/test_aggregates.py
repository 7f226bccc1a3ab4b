from pyspark.sql import functions as F

from tidepool.operators import aggregates as agg
from tidepool.operators.latest import latest_per_key


def test_word_count_and_distinct(spark):
    words = spark.createDataFrame([(w,) for w in "a b a c a b".split()] + [("",)], "word string")
    got = {r.word: r.n for r in agg.word_count(words).collect()}
    assert got == {"a": 3, "b": 2, "c": 1, "": 1}
    assert agg.distinct_count(agg.word_count(words)).first().n_distinct == 4


def test_tag_size_nulls_and_utf16(spark):
    rows = [("m1", "u1", "ab"), ("m1", "u1", "c\U0001F600"), ("m1", "u2", None),
            ("m1", "u2", None), ("m2", "u1", None), ("m2", "u1", "xyz")]
    tags = spark.createDataFrame(rows, "movieId string, userId string, tag string")
    got = sorted((r.movieId, r.tagSize) for r in agg.tag_size(tags).collect())
    assert got == [("m1", 0), ("m1", 5), ("m2", 3)]


def test_reconcile_reports_differences_only(spark):
    sent = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "word string, n bigint")
    counted = spark.createDataFrame([("a", 3), ("b", 1), ("d", 4)], "word string, n bigint")
    got = sorted(tuple(r) for r in agg.reconcile(sent, counted).collect())
    assert got == [("b", 2, 1), ("c", 1, 0), ("d", 0, 4)]


def test_window_counts_and_running_total(spark):
    rows = [("2024-01-01 00:00:01", "x", "9"), ("2024-01-01 00:00:03", "x", "10"),
            ("2024-01-01 00:00:04", "y", "2"), ("2024-01-01 00:00:12", "x", "11")]
    df = spark.createDataFrame(rows, "t string, k string, id string") \
        .withColumn("ts", F.to_timestamp_ntz("t"))
    c = sorted((str(r.window_start), r.k, r.n) for r in
               agg.count_per_window(df, "ts", "k", "5 seconds").collect())
    assert c == [("2024-01-01 00:00:00", "x", 2), ("2024-01-01 00:00:00", "y", 1),
                 ("2024-01-01 00:00:10", "x", 1)]
    m = sorted((str(r.window_start), r.max_id) for r in
               agg.max_string_per_window(df, "ts", "id", "10 seconds").collect())
    assert m == [("2024-01-01 00:00:00", "9"), ("2024-01-01 00:00:10", "11")]
    t = sorted((str(r.window_start), r.n_rows, r.running_total) for r in
               agg.batch_running_totals(df, "ts", "10 seconds").collect())
    assert t == [("2024-01-01 00:00:00", 3, 3), ("2024-01-01 00:00:10", 1, 4)]


def test_batch_stats_one_pass(spark):
    df = spark.range(100).repartition(4)
    s = agg.batch_stats(df).first()
    assert (s.n_rows, s.n_partitions) == (100, 4)


def test_latest_per_key_hot_key(spark):
    # One key holds 90% of rows: the answer is still one row per key.
    df = spark.range(10000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
         .otherwise(F.lit("hot")).alias("key"),
        (F.col("id") % 1000).alias("t"), F.col("id").cast("string").alias("rid"),
        (F.col("id") * 2).alias("v"))
    got = {r.key: (r.t, r.rid, r.v) for r in latest_per_key(df, "key", ["t", "rid"]).collect()}
    pdf = df.toPandas().sort_values(["t", "rid"]).groupby("key").tail(1)
    want = {r.key: (r.t, r.rid, r.v) for r in pdf.itertuples()}
    assert got == want
    plan = latest_per_key(df, "key", ["t", "rid"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # map-side combined, not a per-key sort


def test_rows_without_a_time_stay_in_every_window_total(spark):
    """Rows in = rows out: NULL times form one NULL window, in counts, maxima and totals."""
    import datetime as dt
    from tidepool.operators import aggregates as agg
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, 1), "1"), ("a", None, "9"), ("b", None, "10")]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"k string, ts {kind}, id string")
        counts = {(r.window_start, r.k): r.n for r in agg.count_per_window(df, "ts", "k", "5 seconds").collect()}
        assert counts == {(dt.datetime(2024, 1, 1), "a"): 1, (None, "a"): 1, (None, "b"): 1}
        top = {r.window_start: r.max_id for r in agg.max_string_per_window(df, "ts", "id", "5 seconds").collect()}
        assert top == {dt.datetime(2024, 1, 1): "1", None: "9"}
        totals = {r.window_start: (r.n_rows, r.running_total)
                  for r in agg.batch_running_totals(df, "ts", "5 seconds").collect()}
        assert totals == {None: (2, 2), dt.datetime(2024, 1, 1): (1, 3)}
