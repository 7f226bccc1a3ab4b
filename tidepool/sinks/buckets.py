"""A keyed table as copy-on-write buckets, and a write rate limit (K2, K3).

An insert with a known key replaces the row, as the reference's store does. Keys are
hashed into a fixed number of buckets; a small manifest names the folder that holds each
bucket's current rows. A batch reads and writes only the buckets it touches, into a new
folder, and then puts the next manifest in place by a rename, so readers see the
table before or after a batch and never in between. Every bucket holds one row per key:
a read is a plain scan of the named folders, without any reduction.

Recovery: a batch that died before its rename leaves the old table and some files no
manifest names (``vacuum`` removes them); a batch that is replayed after its rename finds
its number in the manifest and changes nothing. One writer at a time, as a stream is.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.operators.latest import latest_per_key

BUCKET_COL = "tp_bucket"
KEPT_MANIFESTS = 3


class SharedFolder:
    """The few file operations a manifest needs, in any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.root = path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write ``name`` in one step: it is not there, or it is whole."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.fs.create(self._path(draft))
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(self._path(draft), self._path(name)):
            raise RuntimeError(f"{self.root}/{name} is already there: two writers?")

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class BucketTable:
    """An upserting table of ``key_cols`` below ``path``; ``buckets`` is fixed by the first batch."""

    def __init__(self, spark: SparkSession, path: str, key_cols: list[str], buckets: int = 64):
        self.spark, self.path, self.key_cols, self.buckets = spark, path.rstrip("/"), list(key_cols), buckets
        self.folder = SharedFolder(spark, self.path)

    def manifest(self) -> dict | None:
        """The newest manifest: batch_id, schema, buckets, key_cols and the folder of each bucket that has rows."""
        done = [n for n in self.folder.names("manifest") if n.endswith(".json")]
        found = json.loads(self.folder.read(f"manifest/{done[-1]}")) if done else None
        if found and found["key_cols"] != self.key_cols:
            raise ValueError(f"the table's keys are {found['key_cols']}")
        return found

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key_cols), F.lit(buckets)).cast("int")

    def _rows(self, manifest: dict, wanted: set[int] | None = None) -> DataFrame | None:
        schema = StructType.fromJson(manifest["schema"])
        places = [f"{self.path}/data/{folder}/{BUCKET_COL}={b}" for b, folder in manifest["folders"].items()
                  if wanted is None or int(b) in wanted]
        return self.spark.read.schema(schema).parquet(*places) if places else None

    def read(self) -> DataFrame:
        """The table: one row per key."""
        manifest = self.manifest()
        if manifest is None:
            raise ValueError(f"{self.path} holds no table yet")
        rows = self._rows(manifest)
        schema = StructType.fromJson(manifest["schema"])
        return rows if rows is not None else self.spark.createDataFrame([], schema)

    def upsert(self, batch: DataFrame, batch_id: int, order_cols: list[str] | None = None,
               deletes: DataFrame | None = None, rate: float | None = None, extra: dict | None = None) -> bool:
        """Put the rows of ``batch`` in place of those with equal keys; False for a batch already applied.

        Of rows with equal keys the last by ``order_cols`` stays (without them any one).
        ``deletes`` holds keys whose rows go; a key in both is put. ``rate`` limits each task's bytes a second;
        ``extra`` is kept in the manifest.
        """
        before = self.manifest()
        if before is not None and before["batch_id"] >= batch_id:
            return False
        buckets = before["buckets"] if before else self.buckets
        schema = StructType.fromJson(before["schema"]) if before else batch.schema
        columns = [f.name for f in schema.fields]
        rows = latest_per_key(batch, self.key_cols, order_cols or self.key_cols, columns)
        rows = rows.select(columns).withColumn(BUCKET_COL, self._bucket(buckets)).persist()
        try:
            gone = deletes.select(*self.key_cols).withColumn(BUCKET_COL, self._bucket(buckets)) if deletes is not None else None
            changed = rows.select(BUCKET_COL) if gone is None else rows.select(BUCKET_COL).union(gone.select(BUCKET_COL))
            touched = {r[0] for r in changed.distinct().collect()}       # at most ``buckets`` numbers
            folders = dict(before["folders"]) if before else {}
            if touched:
                kept = self._rows(before, touched) if before else None
                merged = rows
                if kept is not None:
                    kept = kept.withColumn(BUCKET_COL, self._bucket(buckets))
                    for other in (rows, gone):
                        if other is not None:
                            kept = self._without(kept, other)
                    merged = kept.unionByName(rows)
                folder = f"batch={batch_id:012d}-{uuid.uuid4().hex[:8]}"
                # One task a bucket, so a bucket is one file; its size is the table's over the number of buckets.
                out = merged.repartition(min(len(touched), buckets), BUCKET_COL)
                out = throttled(out, rate) if rate else out
                out.write.partitionBy(BUCKET_COL).parquet(f"{self.path}/data/{folder}")
                written = {int(n.split("=")[1]) for n in self.folder.names(f"data/{folder}") if n.startswith(BUCKET_COL)}
                for b in touched:
                    folders.pop(str(b), None)
                folders |= {str(b): folder for b in written}
            self.folder.put(f"manifest/{batch_id:012d}.json", json.dumps((extra or {}) | {
                "batch_id": batch_id, "schema": schema.jsonValue(), "buckets": buckets, "key_cols": self.key_cols,
                "folders": folders}))
        finally:
            rows.unpersist()
        return True

    def _without(self, kept: DataFrame, other: DataFrame) -> DataFrame:
        keys = other.select(*(F.col(k).alias(f"tp_{k}") for k in self.key_cols))
        same = [F.col(k).eqNullSafe(F.col(f"tp_{k}")) for k in self.key_cols]
        return kept.join(keys, same, "left_anti")

    def vacuum(self) -> None:
        """Remove old manifests and the folders that no kept manifest names."""
        done = [n for n in self.folder.names("manifest") if n.endswith(".json")]
        kept = [json.loads(self.folder.read(f"manifest/{n}")) for n in done[-KEPT_MANIFESTS:]]
        named = {folder for m in kept for folder in m["folders"].values()}
        for name in set(self.folder.names("manifest")) - set(done[-KEPT_MANIFESTS:]):
            self.folder.remove(f"manifest/{name}")
        for name in set(self.folder.names("data")) - named:
            self.folder.remove(f"data/{name}")


def bucket_writer(table: BucketTable, columns: list[str], order_cols: list[str] | None = None,
                  derive: Callable[[DataFrame], DataFrame] | None = None, rate: float | None = None,
                  vacuum_every: int = 100) -> Callable[[DataFrame, int], None]:
    """K2 + K3 as a ``foreachBatch`` action: the chosen columns (P10) of each batch are put into ``table``.

    ``derive`` adds columns to the last row of each key; ``order_cols`` need not be written.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        wanted = list(dict.fromkeys([*columns, *(order_cols or [])]))
        rows = batch.select(*wanted)
        if order_cols:
            rows = latest_per_key(rows, table.key_cols, order_cols, wanted)
        rows = rows.select(*columns)
        table.upsert(derive(rows) if derive else rows, batch_id, rate=rate)
        if (batch_id + 1) % vacuum_every == 0:
            table.vacuum()
    return run


class TokenBucket:
    """Bytes that may pass: ``rate`` a second, at most ``burst`` at once."""

    def __init__(self, rate: float, burst: float | None = None, clock: Callable[[], float] = time.monotonic,
                 sleep: Callable[[float], None] = time.sleep):
        if rate <= 0:
            raise ValueError("the rate must be positive")
        self.rate, self.burst, self.clock, self.sleep = rate, burst or rate, clock, sleep
        self.tokens, self.at = 0.0, clock()

    def take(self, size: float) -> None:
        """Wait until ``size`` bytes may pass; more than ``burst`` pass as a debt that is waited for."""
        now = self.clock()
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at = now
        self.tokens -= size
        if self.tokens < 0:
            self.sleep(-self.tokens / self.rate)


def throttled(df: DataFrame, bytes_per_second: float, burst: float | None = None) -> DataFrame:
    """K3: the same rows, each task passing at most so many bytes (as Arrow columns) a second.

    Put it right before the write. Batches are cut to at most a second's worth, so the
    sink sees a steady flow; a row larger than that waits for itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TokenBucket(bytes_per_second, burst)
        for batch in batches:
            per_row = max(1.0, batch.nbytes / max(1, batch.num_rows))
            step = max(1, int(bucket.burst / per_row))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                bucket.take(part.nbytes)
                yield part

    return df.mapInArrow(run, df.schema)
