"""The reference's programs as jobs, end to end on files derived from the driver's tables."""

import csv
import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool import __main__ as cli
from tidepool.functions import records
from tidepool.plans import fixtures, jobs
from tidepool.sinks.table import read_latest
from tidepool.streaming.jobs import BatchMonitor


def java_split(line):
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_word_count_job(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(40)
    texts = [r.text for r in docs.collect()]
    src = os.path.join(scratch, "in.txt")
    with open(src, "w") as f:
        f.write("\n".join(texts) + "\n")
    want = {}
    for t in texts:
        for line in t.split("\n"):
            for w in java_split(line):
                want[w] = want.get(w, 0) + 1
    out = os.path.join(scratch, "out")
    assert jobs.word_count_job(spark, src, out) == len(want)
    got = {r.word: r.n for r in spark.read.parquet(out).collect()}
    assert got == want


def test_tag_size_job(spark, scratch):
    tags = fixtures.tags(spark, SF_SMALL).withColumn("tag", F.regexp_replace("tag", "\n", " "))
    rows = tags.collect()
    src = os.path.join(scratch, "tags.csv")
    with open(src, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["movieId", "userId", "tag"])
        for r in rows:
            w.writerow([r.movieId, r.userId, "" if r.tag is None else r.tag])
    want = {}
    for r in rows:
        size = 0 if r.tag is None else len(r.tag.encode("utf-16-be")) // 2
        want[(r.movieId, r.userId)] = want.get((r.movieId, r.userId), 0) + size
    out = os.path.join(scratch, "out")
    assert jobs.tag_size_job(spark, src, out) >= 0
    assert 1 <= len(glob.glob(os.path.join(out, "part-*.csv"))) <= 10
    got = sorted((r.movieId, int(r.tagSize)) for r in
                 spark.read.option("header", "true").csv(out).collect())
    assert got == sorted((m, n) for (m, _), n in want.items())


def _write_json_parts(spark, folder, df, parts):
    rows = [r.j for r in df.orderBy("id").collect()]
    size = -(-len(rows) // parts)
    for i in range(parts):
        path = os.path.join(folder, f"part{i}.json")
        with open(path, "w") as f:
            f.write("\n".join(rows[i * size:(i + 1) * size]) + "\n")
        time.sleep(1.1)


def test_trade_table_stream_job(spark, scratch):
    t = (fixtures.trade_stream(spark, SF_SMALL)
         .select("symbol", "trade", "price", "quantity", "id"))
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _write_json_parts(spark, src, t.select("id", records.trade_to_json("v2").alias("j")), 2)
    monitor = BatchMonitor()
    q = jobs.trade_table_stream_job(spark, "text", src, os.path.join(scratch, "ck"),
                                    os.path.join(scratch, "table"),
                                    options={"maxFilesPerTrigger": "1"}, version="v2",
                                    available_now=True, monitor=monitor)
    assert q.awaitTermination(180) and q.exception() is None
    assert [h["n_rows"] for h in monitor.history] == [500, 500]
    assert monitor.total == t.count()
    got = read_latest(spark, os.path.join(scratch, "table"), ["id"])
    assert got.count() == t.count()
    assert got.where(F.length("data") != 1024).count() == 0
    back = got.select(*t.columns)
    assert back.exceptAll(t).count() == 0 and t.exceptAll(back).count() == 0


def test_symbol_count_stream_job(spark, scratch):
    t = fixtures.trades(spark, SF_SMALL, spread_out=False)
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _write_json_parts(spark, src, t.select("id", records.trade_to_json("v1").alias("j")), 3)
    out = os.path.join(scratch, "counts")

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    q = jobs.symbol_count_stream_job(spark, "text", src, os.path.join(scratch, "ck"), sink,
                                     options={"maxFilesPerTrigger": "1"}, available_now=True)
    assert q.awaitTermination(180) and q.exception() is None
    per_batch = spark.read.parquet(out)
    assert per_batch.select("batch_id").distinct().count() == 3
    got = {r.tickerSymbol: r.n for r in
           per_batch.groupBy("tickerSymbol").agg(F.sum("n").alias("n")).collect()}
    want = {r.tickerSymbol: r.n for r in
            t.groupBy("tickerSymbol").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_cli_word_count(spark, scratch, capsys):
    from tidepool.__main__ import main
    src = os.path.join(scratch, "in.txt")
    with open(src, "w") as f:
        f.write("a b a\n c  \n")
    main(["word-count", src, os.path.join(scratch, "out")])
    assert capsys.readouterr().out.strip().splitlines()[-1] == "4"  # a, b, '', c


def test_processing_time_job_refuses_available_now(spark):
    import pytest
    ev = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").load()
    with pytest.raises(ValueError):
        jobs.running_count_stream_job(spark, ev, "value", "timestamp", "value", "/unused",
                                      "/unused", available_now=True, time_mode="ProcessingTime")


def _write_lines(path, lines, age_seconds=0):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    at = time.time() - age_seconds
    os.utime(path, (at, at))


def _trade(i, price, symbol="S"):
    return f'{{"symbol":"{symbol}","trade":"BUY","price":{price},"quantity":1,"id":"{i}"}}'


def test_the_last_of_two_writes_in_one_batch_stays(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _write_lines(os.path.join(src, "a.json"), [_trade(1, 10.0), _trade(1, 5.0), _trade(2, 7.0)])
    monitor = BatchMonitor()
    q = jobs.trade_table_stream_job(spark, "text", src, os.path.join(scratch, "ck"), os.path.join(scratch, "t"),
                                    available_now=True, monitor=monitor, cap={"files_per_batch": 5})
    assert q.awaitTermination(180) and q.exception() is None
    got = {r.id: r.price for r in read_latest(spark, os.path.join(scratch, "t"), ["id"]).collect()}
    assert got == {"1": 5.0, "2": 7.0}
    assert monitor.history[0]["max_id"] == "2"


def test_records_before_the_start_are_not_counted_also_after_a_restart(spark, scratch):
    import datetime as dt
    src, ck, table = (os.path.join(scratch, x) for x in ("src", "ck", "t"))
    os.makedirs(src)
    _write_lines(os.path.join(src, "old.json"), [_trade(1, 1.0)], age_seconds=86_400)
    _write_lines(os.path.join(src, "new.json"), [_trade(2, 1.0)], age_seconds=3600)

    def go():
        q = jobs.trade_table_stream_job(spark, "text", src, ck, table, available_now=True,
                                        start=dt.timedelta(hours=5))
        assert q.awaitTermination(180) and q.exception() is None

    go()
    _write_lines(os.path.join(src, "late.json"), [_trade(3, 1.0)], age_seconds=80_000)
    _write_lines(os.path.join(src, "now.json"), [_trade(4, 1.0)])
    go()
    assert {r.id for r in read_latest(spark, table, ["id"]).collect()} == {"2", "4"}


def test_tolerant_job_keeps_rejects(spark, scratch):
    src, ck = os.path.join(scratch, "src"), os.path.join(scratch, "ck")
    os.makedirs(src)
    _write_lines(os.path.join(src, "a.json"), [_trade(1, 1.0), '{"symbol":', "no json", _trade(2, 2.0)])
    monitor = BatchMonitor()
    q = jobs.trade_table_stream_job(spark, "text", src, ck, os.path.join(scratch, "t"), strict=False,
                                    available_now=True, monitor=monitor)
    assert q.awaitTermination(180) and q.exception() is None
    rejects = spark.read.parquet(f"{ck}_rejects")
    assert sorted(bytes(r.value).decode() for r in rejects.collect()) == ["no json", '{"symbol":']
    assert monitor.total + rejects.count() == 4


def test_symbol_job_adds_up_distinct_symbols_and_keeps_the_callers_action(spark, scratch):
    src, seen = os.path.join(scratch, "src"), []
    os.makedirs(src)
    trades = [t.replace('"symbol"', '"tickerSymbol"').replace('"trade"', '"tradeType"')
              for t in (_trade(1, 1.0, "A"), _trade(2, 1.0, "A"), _trade(3, 1.0, "B"))]
    _write_lines(os.path.join(src, "a.json"), trades)
    monitor = BatchMonitor(lambda df, b: seen.append(df.count()))
    q = jobs.symbol_count_stream_job(spark, "text", src, os.path.join(scratch, "ck"), lambda df, b: None,
                                     available_now=True, monitor=monitor)
    assert q.awaitTermination(180) and q.exception() is None
    assert monitor.total == 2 and seen == [3]


def test_main_program_counts_trades_of_two_shards(spark, scratch):
    shards = []
    for i in range(2):
        folder = os.path.join(scratch, f"shard{i}")
        os.makedirs(folder)
        _write_lines(os.path.join(folder, "a.json"), [
            t.replace('"symbol"', '"tickerSymbol"').replace('"trade"', '"tradeType"')
            for t in (_trade(f"{i}1", 1.0, "A"), _trade(f"{i}2", 1.0, "B"))])
        shards.append({"fmt": "text", "path": folder})
    monitor = BatchMonitor()
    q = jobs.trade_running_count_job(spark, shards, os.path.join(scratch, "ck"), os.path.join(scratch, "out"),
                                     available_now=True, time_mode="EventTime", watermark_delay="1 hour",
                                     monitor=monitor)
    assert q.awaitTermination(180) and q.exception() is None
    rows = spark.read.parquet(os.path.join(scratch, "out")).collect()
    assert sorted((r.tickerSymbol, r.n) for r in rows) == [("A", 1), ("A", 2), ("B", 1), ("B", 2)]
    assert monitor.total == 4


def test_running_words_of_lines(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _write_lines(os.path.join(src, "a.txt"), ["a b a", "b a"])
    lines = spark.readStream.text(src)
    q = jobs.word_running_count_job(spark, lines, os.path.join(scratch, "ck"), os.path.join(scratch, "out"),
                                    interval_seconds=0.5)
    out = os.path.join(scratch, "out")
    deadline = time.time() + 60
    while time.time() < deadline and not glob.glob(os.path.join(out, "batch_id=*", "_SUCCESS")):
        time.sleep(0.5)
    q.stop()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.word, r.n) for r in rows) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)]


def test_event_time_needs_a_delay(spark):
    import pytest
    ev = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").load()
    with pytest.raises(ValueError):
        jobs.running_count_stream_job(spark, ev, "value", "timestamp", "value", "/unused", "/unused",
                                      time_mode="EventTime")


@pytest.mark.parametrize("text,want", [
    (None, None), ("latest", "latest"), ("earliest", "earliest"), ("5h", dt.timedelta(hours=5)), ("90s", dt.timedelta(seconds=90)),
    ("2024-01-02T03:04:05+00:00", dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc))])
def test_start_positions_of_the_command_line(text, want):
    assert cli.start_position(text) == want


def test_every_stream_of_the_command_line(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _write_lines(os.path.join(src, "a.json"), [_trade(1, 1.0, "A"), _trade(2, 2.0, "B"), _trade(2, 3.0, "B")])

    def go(job, *more):
        args = cli.parser().parse_args([job, src, os.path.join(scratch, f"ck-{job}"), os.path.join(scratch, f"out-{job}"),
                                        "--available-now", *more])
        q = cli.start(spark, args)
        assert q.awaitTermination(180) and q.exception() is None
        return os.path.join(scratch, f"out-{job}")

    table = jobs.BucketTable(spark, go("table", "--files-per-batch", "1", "--buckets", "4", "--bytes-per-second", "1000000"), ["id"])
    assert sorted((r["id"], r["price"]) for r in table.read().collect()) == [("1", 1.0), ("2", 3.0)]
    symbols = spark.read.parquet(go("batch-symbols", "--version", "v2", "--start", "earliest"))
    assert sorted((r["symbol"], r["n"]) for r in symbols.collect()) == [("A", 1), ("B", 2)]
    assert spark.read.parquet(go("batch-words", "--start", "3650d")).count() == 3
    counts = spark.read.parquet(go("trades", "--version", "v2", "--hot-keys"))
    assert sorted((r["symbol"], r["n"], r["timed_out"]) for r in counts.collect()) == [
        ("A", 1, False), ("B", 1, False), ("B", 2, False)]
    with pytest.raises(ValueError, match="no cap by records_per_batch"):
        go("trades", "--version", "v2", "--records-per-batch", "10")
