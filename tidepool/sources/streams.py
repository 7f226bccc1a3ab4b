"""Stream sources.

Every record stream is normalised to ``value BINARY, arrived_at TIMESTAMP,
arrival_seq STRUCT`` so the decoding and counting operators are the same for every source. The
file source is the tested format; Kafka, socket and other formats go
through the same ``(format, options)`` pair.
"""

from __future__ import annotations

import datetime as _dt
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.aggregates import union_all
from tidepool.sources import shards

# Per-batch intake caps by source format.
_RATE_OPTION = {
    "kafka": "maxOffsetsPerTrigger",
    "rate": "rowsPerSecond",
    "rate-micro-batch": "rowsPerBatch",
    "shards": "recordsPerShard",
}
_FILE_FORMATS = {"text", "json", "csv", "parquet", "orc", "binaryFile"}


def rate_cap_options(fmt: str, records_per_batch: int | None = None,
                     files_per_batch: int | None = None,
                     bytes_per_batch: str | None = None) -> dict[str, str]:
    """The option that caps how much one micro-batch takes in.

    A cap the source cannot honour is refused, so no job runs uncapped by mistake.
    """
    asked = {"records_per_batch": records_per_batch, "files_per_batch": files_per_batch,
             "bytes_per_batch": bytes_per_batch}
    names = ({"files_per_batch": "maxFilesPerTrigger", "bytes_per_batch": "maxBytesPerTrigger"}
             if fmt in _FILE_FORMATS else
             {"records_per_batch": _RATE_OPTION[fmt]} if fmt in _RATE_OPTION else {})
    given = {k: v for k, v in asked.items() if v}
    wrong = sorted(given.keys() - names.keys())
    if wrong:
        raise ValueError(f"source {fmt!r} has no cap by {', '.join(wrong)}; it has {sorted(names)}")
    return {names[k]: str(v) for k, v in given.items()}


def read_records(spark: SparkSession, fmt: str, path: str | None = None,
                 options: dict[str, str] | None = None, schema: T.StructType | str | None = None,
                 value_col: str = "value", time_col: str | None = None) -> DataFrame:
    """S3: a stream of byte records as ``value BINARY, arrived_at TIMESTAMP, arrival_seq STRUCT``.

    ``arrived_at`` is ``time_col`` if given, else the time the source keeps (the
    file's modification time, Kafka's timestamp), else the micro-batch time.
    ``arrival_seq`` orders records of one arrival time as the source does: by
    file and position in it, or by Kafka partition and offset; ``in_source_order``
    adds the rows' order inside a file split, batch by batch.
    """
    if fmt == shards.FORMAT:
        spark.dataSource.register(shards.ShardDataSource)
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load(path) if path else reader.load()
    if fmt in _FILE_FORMATS:
        kept_time = F.col("_metadata.file_modification_time")
        seq = F.struct(F.col("_metadata.file_path").alias("source"),
                       F.col("_metadata.file_block_start").alias("position"))
    elif fmt == "kafka":
        kept_time = F.col("timestamp")
        seq = F.struct(F.col("partition").cast("string").alias("source"),
                       F.col("offset").alias("position"))
    elif fmt == shards.FORMAT:
        kept_time = F.col("arrived_at")
        seq = F.struct(F.concat_ws("/", "shard", "file").alias("source"), F.col("position"))
    else:
        kept_time = F.current_timestamp()
        seq = F.struct(F.lit("").alias("source"), F.lit(0).cast("bigint").alias("position"))
    arrived = F.col(time_col).cast("timestamp") if time_col else kept_time
    return raw.select(F.col(value_col).cast("binary").alias("value"), arrived.alias("arrived_at"),
                      seq.alias("arrival_seq"))


def in_source_order(batch: DataFrame) -> DataFrame:
    """One micro-batch with the row number in ``arrival_seq`` (before anything reorders its rows)."""
    return batch.withColumn("arrival_seq", F.struct(
        "arrival_seq.source", "arrival_seq.position", F.monotonically_increasing_id().alias("row")))


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket (``value STRING``); for trials, not for production."""
    return (spark.readStream.format("socket")
            .option("host", host).option("port", str(port)).load())


def parse_host_port(args: list[str], host: str, port: int) -> tuple[str, int]:
    """``sourceHost=`` / ``sourcePort=`` arguments override the defaults."""
    for arg in args:
        if arg.startswith("sourceHost="):
            host = arg.split("=", 1)[1].strip()
        elif arg.startswith("sourcePort="):
            port = int(arg.split("=", 1)[1].strip())
    return host, port


def start_filter(start: str | _dt.datetime, time_col: str = "arrived_at") -> Column:
    """Keep records at or after the start position.

    ``'earliest'`` keeps everything; a datetime keeps records arriving at
    or after it. (``'latest'`` is resolved to a datetime by ``resolve_start``
    so that it stays fixed across restarts.)
    """
    if start == "earliest":
        return F.lit(True)
    if isinstance(start, str):
        raise ValueError("resolve 'latest' with resolve_start first")
    if start.tzinfo is None:
        # A wall-clock literal: compared as is with TIMESTAMP_NTZ columns and
        # read in the session time zone against TIMESTAMP ones.
        literal = F.expr(f"TIMESTAMP_NTZ '{start.isoformat(sep=' ')}'")
    else:
        literal = F.lit(start)
    return F.col(time_col) >= literal


def start_options(fmt: str, start: str | _dt.datetime) -> dict[str, str]:
    """S4 for sources with their own start option (Kafka): pass it through.

    ``'earliest'``/``'latest'`` map to ``startingOffsets``; an instant maps to
    ``startingTimestamp`` in epoch milliseconds. Only used on the first run;
    a restarted query resumes from its checkpointed offsets.
    """
    if fmt != "kafka":
        return {}
    if start in ("earliest", "latest"):
        return {"startingOffsets": str(start)}
    instant = start if start.tzinfo else start.replace(tzinfo=_dt.timezone.utc)
    return {"startingTimestamp": str(int(instant.timestamp() * 1000))}


def resolve_start(spark: SparkSession, checkpoint_location: str,
                  start: str | _dt.datetime | _dt.timedelta) -> str | _dt.datetime:
    """Fix the start position when a query is first created.

    ``'latest'`` means now; a timedelta means now minus it (``AtTimestamp(now
    - 5 h)``). The value is stored next to the query's checkpoint and read
    back on restart, so a restarted query keeps its original start.
    """
    if start == "earliest":
        return start
    marker = f"{checkpoint_location.rstrip('/')}/_start_position"
    try:
        row = spark.read.schema("start string").json(marker).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # anything else is no first run
            raise
        row = None
    if row is not None:
        return _dt.datetime.fromisoformat(row["start"])
    now = _dt.datetime.now(_dt.timezone.utc)  # an instant, whatever the session zone
    resolved = now - start if isinstance(start, _dt.timedelta) else (
        now if start == "latest" else start)
    spark.createDataFrame([(resolved.isoformat(),)], "start string") \
        .coalesce(1).write.mode("overwrite").json(marker)
    return resolved


def union_streams(*streams: DataFrame, time_col: str | None = None, watermark_delay: str | None = None) -> DataFrame:
    """One stream from N shard streams, duplicates kept.

    With ``time_col`` and ``watermark_delay`` every shard has a watermark of its own and the
    united stream the least of them (``multipleWatermarkPolicy``), so a shard that lags
    loses no rows to one that is ahead. A shard without any rows yet holds the watermark back.
    """
    if time_col is not None:
        spark = streams[0].sparkSession
        if spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") != "min":
            raise ValueError("spark.sql.streaming.multipleWatermarkPolicy must be min: with max a slow shard loses rows")
        streams = tuple(s.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark_delay)
                        for s in streams)
    return union_all(*streams)
