"""Command line: ``python -m tidepool JOB ...``.

Tables: ``word-count IN OUT``, ``tag-size SOURCE_CSV TARGET_CSV``. Streams: ``words`` (running
count of words), ``trades`` (running count of symbols), ``table`` (trades to a keyed table, with
intake cap and write rate), ``batch-words`` and ``batch-symbols`` (counts of each micro-batch), each
``SOURCE CHECKPOINT OUT`` with the format, options and start position of the source.
"""

from __future__ import annotations

import argparse
import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidepool.plans import jobs
from tidepool.session import build_session
from tidepool.sources.streams import rate_cap_options, read_socket_lines

STREAMS = {
    "words": "running count of the words of a folder of text files or HOST:PORT",
    "trades": "running count of the symbols of trade records",
    "table": "trade records to a keyed table",
    "batch-words": "words of byte records, counted per micro-batch",
    "batch-symbols": "symbols of trade records, counted per micro-batch",
}
_AGO = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}


def start_position(text: str | None):
    """``earliest``, ``latest``, an ISO instant, or how long ago (``5h``)."""
    if text is None or text in ("earliest", "latest"):
        return text
    ago = re.fullmatch(r"(\d+)([smhd])", text)
    return dt.timedelta(**{_AGO[ago[2]]: int(ago[1])}) if ago else dt.datetime.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidepool")
    sub = out.add_subparsers(dest="job", required=True)
    wc = sub.add_parser("word-count", help="count space-separated words of text files")
    wc.add_argument("input")
    wc.add_argument("output")
    wc.add_argument("--min-partitions", type=int, default=3)
    ts = sub.add_parser("tag-size", help="total tag length per (movie, user) to CSV")
    ts.add_argument("source_csv")
    ts.add_argument("target_csv")
    ts.add_argument("--files", type=int, default=10)
    for name, what in STREAMS.items():
        job = sub.add_parser(name, help=what)
        job.add_argument("source", help="folder, or - for sources that options describe")
        job.add_argument("checkpoint")
        job.add_argument("output")
        job.add_argument("--interval-seconds", type=float, default=10.0 if name == "table" else 5.0)
        job.add_argument("--available-now", action="store_true", help="take what is there and stop")
        if name != "words":
            job.add_argument("--format", default="text")
            job.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
            job.add_argument("--start", type=start_position, metavar="earliest|latest|5h|INSTANT")
            job.add_argument("--records-per-batch", type=int)
            job.add_argument("--files-per-batch", type=int)
        if name in ("words", "trades"):
            job.add_argument("--idle-seconds", type=float, default=300.0)
        if name in ("trades", "table", "batch-symbols"):
            job.add_argument("--version", choices=("v1", "v2"), default="v2" if name == "table" else "v1")
        if name == "trades":
            job.add_argument("--hot-keys", action="store_true", help="count batches in ranges; no task gets a whole key")
        if name == "table":
            job.add_argument("--buckets", type=int, default=64)
            job.add_argument("--bytes-per-second", type=float)
    return out


def _batch_folders(path: str):
    def sink(counts: DataFrame, batch_id: int) -> None:
        counts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return sink


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """The stream that the arguments ask for, started."""
    clock = {"interval_seconds": args.interval_seconds, "available_now": args.available_now}
    if args.job == "words":
        host, _, port = args.source.rpartition(":")
        lines = (read_socket_lines(spark, host, int(port)) if host and port.isdigit()
                 else spark.readStream.text(args.source))
        return jobs.word_running_count_job(spark, lines, args.checkpoint, args.output, idle_seconds=args.idle_seconds, **clock)
    path = None if args.source == "-" else args.source
    options = dict(o.split("=", 1) for o in args.option)
    cap = {k: v for k, v in (("records_per_batch", args.records_per_batch), ("files_per_batch", args.files_per_batch)) if v}
    if args.job == "table":
        return jobs.trade_table_stream_job(
            spark, args.format, path, args.checkpoint, args.output, options, args.version, start=args.start, cap=cap or None,
            buckets=args.buckets, bytes_per_second=args.bytes_per_second, **clock)
    options |= rate_cap_options(args.format, **cap) if cap else {}
    if args.job == "trades":
        return jobs.trade_running_count_job(
            spark, [{"fmt": args.format, "path": path, "options": options}], args.checkpoint, args.output, args.version,
            args.start, idle_seconds=args.idle_seconds, hot_keys=args.hot_keys, **clock)
    sink = _batch_folders(args.output)
    if args.job == "batch-words":
        return jobs.word_count_stream_job(spark, args.format, path, args.checkpoint, sink, options, args.start, **clock)
    return jobs.symbol_count_stream_job(spark, args.format, path, args.checkpoint, sink, options, args.version, args.start,
                                        **clock)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(app_name=f"tidepool-{args.job}")
    if args.job == "word-count":
        print(jobs.word_count_job(spark, args.input, args.output, args.min_partitions))
    elif args.job == "tag-size":
        millis = jobs.tag_size_job(spark, args.source_csv, args.target_csv, args.files)
        print(f"tag sizes written in {millis} ms")
    else:
        start(spark, args).awaitTermination()


if __name__ == "__main__":
    main()
