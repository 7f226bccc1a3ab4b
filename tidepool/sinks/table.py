"""Keyed table sink for micro-batches.

The reference inserts every trade of a batch into a table whose primary key
makes a later insert replace an earlier row. Here each batch is written once
per ``batch_id`` (a replayed batch overwrites its own folder, so a restart
never duplicates), and the table is read back as the latest row per key.
Stores with native upserts (e.g. the public Cassandra connector) are
reached through ``fmt`` and ``options``, where write throughput limits
(K3) pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.latest import latest_per_key
from tidepool.sinks.buckets import SharedFolder

BATCH_COL = "batch_id"
FILE_FORMATS = ("parquet", "orc", "json", "csv")


def write_batch(batch: DataFrame, batch_id: int, path: str, columns: list[str],
                key_cols: list[str] | None = None, order_cols: list[str] | None = None,
                fmt: str = "parquet", options: dict[str, str] | None = None,
                derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K2: write one batch with the chosen columns (P10).

    With ``key_cols`` and ``order_cols`` only the last row per key of the
    batch is kept (what the upsert would leave); order columns need not be
    written. ``derive`` adds columns after that reduction (e.g. a payload
    computed from the key). File formats write to ``<path>/batch_id=<id>`` in
    overwrite mode, idempotent per batch; other formats append through the
    store's own key.
    """
    rows = batch
    if key_cols and order_cols:
        wanted = list(dict.fromkeys([*columns, *order_cols]))
        rows = latest_per_key(rows.select(*wanted), key_cols, order_cols, wanted)
    rows = rows.select(*columns)
    if derive is not None:
        rows = derive(rows)
    writer = rows.write.options(**({"header": "true"} if fmt == "csv" else {}) | (options or {}))
    if fmt in FILE_FORMATS:
        writer.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/{BATCH_COL}={batch_id}")
    else:
        writer.format(fmt).mode("append").save()


def batch_writer(path: str, columns: list[str], key_cols: list[str] | None = None,
                 order_cols: list[str] | None = None, fmt: str = "parquet",
                 options: dict[str, str] | None = None,
                 derive: Callable[[DataFrame], DataFrame] | None = None,
                 snapshot_path: str | None = None, compact_every: int | None = None
                 ) -> Callable[[DataFrame, int], None]:
    """K2 as a ``foreachBatch`` action (wrap it in ``BatchMonitor`` to skip empty batches).

    With ``compact_every`` a snapshot of the table is written to
    ``snapshot_path`` after every so many batches, which bounds what a read
    has to merge.
    """
    if compact_every and not (snapshot_path and key_cols and fmt == "parquet"):
        raise ValueError("compaction needs a snapshot_path, key columns and the parquet format")

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, columns, key_cols, order_cols, fmt, options, derive)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, snapshot_path, key_cols)

    def discard(spark: SparkSession, batch_id: int) -> None:
        """Take back the folder of a batch that turned out to have no rows."""
        if fmt in FILE_FORMATS:
            SharedFolder(spark, path).remove(f"{BATCH_COL}={batch_id}")

    run.discard = discard
    return run


SNAPSHOT_COL = "upto"


def _latest_with_batch(df: DataFrame, key_cols: list[str],
                       order_cols: list[str] | None) -> DataFrame:
    cols = [c for c in df.columns if c != BATCH_COL]
    order = [BATCH_COL] + list(order_cols or [])
    return latest_per_key(df, key_cols, order, cols + [BATCH_COL])


def _last_partition(df: DataFrame, column: str) -> int | None:
    """Greatest value of a folder column, from the file listing (no file is opened)."""
    found = [int(v) for f in df.inputFiles() for v in re.findall(rf"/{column}=(\d+)/", f)]
    return max(found, default=None)


def _read(spark: SparkSession, path: str, fmt: str, schema: str | None) -> DataFrame:
    """The written batches; formats without types of their own need a schema."""
    reader = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        if schema is None:
            raise ValueError(f"{fmt} keeps no column types: give the table's schema")
        reader = reader.schema(f"{schema}, {BATCH_COL} int").option("header", "true")
    elif fmt not in FILE_FORMATS:
        raise ValueError(f"read {fmt!r} tables through their own store")
    return reader.load(path)


def _snapshots(spark: SparkSession, snapshot_path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(snapshot_path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None  # no snapshot yet
        raise


def read_latest(spark: SparkSession, path: str, key_cols: list[str],
                order_cols: list[str] | None = None, fmt: str = "parquet",
                snapshot_path: str | None = None, schema: str | None = None) -> DataFrame:
    """The table as an upserting store holds it: the last written row per key.

    Later batches win; inside a batch ``order_cols`` decide. With a
    ``snapshot_path`` written by ``compact``, only the newest snapshot and
    the batches after it are read (both cut by partition pruning). CSV and
    JSON tables need the ``schema`` they were written with.
    """
    df = _read(spark, path, fmt, schema)
    cols = [c for c in df.columns if c != BATCH_COL]
    snaps = _snapshots(spark, snapshot_path) if snapshot_path else None
    upto = _last_partition(snaps, SNAPSHOT_COL) if snaps is not None else None
    if upto is not None:
        snap = snaps.where(F.col(SNAPSHOT_COL) == upto).drop(SNAPSHOT_COL)
        df = snap.unionByName(df.where(F.col(BATCH_COL) > upto))
    return _latest_with_batch(df, key_cols, order_cols).select(*cols)


def compact(spark: SparkSession, path: str, snapshot_path: str, key_cols: list[str],
            order_cols: list[str] | None = None, fmt: str = "parquet",
            schema: str | None = None) -> int | None:
    """Write the latest row per key over all batches so far as a new snapshot.

    The snapshot goes to ``<snapshot_path>/upto=<last batch id>``, a new
    folder each time (nothing is overwritten, so readers never see a partial
    table); rows keep the batch id that wrote them. Returns that batch id.
    """
    df = _read(spark, path, fmt, schema)
    upto = _last_partition(df, BATCH_COL)
    if upto is None:
        return None
    snaps = _snapshots(spark, snapshot_path)
    previous = _last_partition(snaps, SNAPSHOT_COL) if snaps is not None else None
    if previous is not None and previous >= upto:
        return previous  # nothing written since the last snapshot
    base = df if previous is None else (
        snaps.where(F.col(SNAPSHOT_COL) == previous)
        .drop(SNAPSHOT_COL).unionByName(df.where(F.col(BATCH_COL) > previous)))
    current = _latest_with_batch(base.where(F.col(BATCH_COL) <= upto), key_cols, order_cols)
    current.write.mode("error").parquet(f"{snapshot_path.rstrip('/')}/{SNAPSHOT_COL}={upto}")
    return upto
