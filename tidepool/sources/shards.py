"""A stream of byte records in shards, with one offset per shard.

A shard is a folder ``shard=<name>`` of append-only files, read in order of their names; a
record is a frame of eight bytes of arrival time (microseconds since 1970), four bytes of
length (both big-endian) and the payload. A frame whose end is not written yet is not there
yet. Shards that appear while a query runs are read from their first record on.

The offset of a micro-batch names, for every shard, the file and position behind its last
record; Spark keeps it in the checkpoint, so a restarted query goes on where each shard
stood. ``recordsPerShard`` admits at most so many records a shard to a batch, the rest
waits for the next. The offsets handed out so far are also kept in the file ``progress``
(by default ``_progress`` below the path; one file a query), because Spark does not tell a
Python source where a restarted query stands before it asks for the next end.

``path`` is a folder that driver and executors see, or a URI that pyarrow can open. Use it
by ``spark.dataSource.register(ShardDataSource)`` and the format ``shards``; an
``availableNow`` query takes one batch.
"""

from __future__ import annotations

import datetime as dt
import json
import struct
from collections.abc import Iterator

from pyarrow import fs as afs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "shards"
HEADER = struct.Struct(">qI")
SCHEMA = "value binary, arrived_at timestamp, shard string, file string, position bigint"
_BLOCK = 1 << 20


def file_system(path: str) -> tuple[afs.FileSystem, str]:
    return afs.FileSystem.from_uri(path) if "://" in path else (afs.LocalFileSystem(), path)


def append_records(path: str, shard: str, file: str, records: list[tuple[int, bytes]]) -> None:
    """Append (arrival microseconds, payload) records to a file of a shard."""
    files, root = file_system(path)
    folder = f"{root.rstrip('/')}/shard={shard}"
    files.create_dir(folder)
    with files.open_append_stream(f"{folder}/{file}") as out:
        out.write(b"".join(HEADER.pack(at, len(value)) + value for at, value in records))


def frames(stream: afs.FileSystem, position: int, size: int, most: int | None = None,
           payload: bool = True) -> Iterator[tuple[int, int, bytes | None]]:
    """(end position, arrival, payload) of the whole frames from ``position`` on, up to ``size`` bytes of the file."""
    taken = 0
    while position + HEADER.size <= size and (most is None or taken < most):
        stream.seek(position)
        block = stream.read(min(_BLOCK, size - position))
        at = 0
        while at + HEADER.size <= len(block) and (most is None or taken < most):
            arrived, length = HEADER.unpack_from(block, at)
            end = at + HEADER.size + length
            if position + end > size:
                return                     # not written to its end yet
            if end > len(block):
                break
            taken += 1
            yield position + end, arrived, bytes(block[at + HEADER.size:end]) if payload else None
            at = end
        if at == 0:                        # a frame longer than a block
            stream.seek(position)
            arrived, length = HEADER.unpack(stream.read(HEADER.size))
            at = HEADER.size + length
            taken += 1
            yield position + at, arrived, stream.read(length) if payload else None
        position += at


class ShardDataSource(DataSource):
    """Options: path, recordsPerShard (none: all there is), progress."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ShardStreamReader:
        return ShardStreamReader(dict(self.options))


class ShardRange(InputPartition):
    """Records of a shard behind ``first`` up to ``last``, each a file and a position in it."""

    def __init__(self, shard: str, first: tuple[str, int], last: tuple[str, int]):
        self.shard, self.first, self.last = shard, first, last


class ShardStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        lower = {k.lower(): v for k, v in options.items()}
        self.path = lower["path"].rstrip("/")
        self.most = int(lower["recordspershard"]) if "recordspershard" in lower else None
        if self.most is not None and self.most < 1:
            raise ValueError("recordsPerShard must be positive")
        self.progress = lower.get("progress", f"{self.path}/_progress")
        self.at: dict[str, list] | None = None

    def initialOffset(self) -> dict:
        return {}

    def _files(self, shard: str, since: str = "") -> list[tuple[str, int]]:
        """(name, bytes) of the shard's files from ``since`` on."""
        files, root = file_system(self.path)
        found = files.get_file_info(afs.FileSelector(f"{root}/shard={shard}"))
        return sorted((f.base_name, f.size) for f in found if f.type == afs.FileType.File and f.base_name >= since)

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._saved()
        files, root = file_system(self.path)
        names = sorted(f.base_name.removeprefix("shard=") for f in files.get_file_info(afs.FileSelector(root, allow_not_found=True))
                       if f.type == afs.FileType.Directory and f.base_name.startswith("shard="))
        ends = dict(self.at)
        for shard in names:
            file, position = ends.get(shard, ["", 0])
            left = self.most
            for name, size in self._files(shard, file):
                if left == 0:
                    break
                begin = position if name == file else 0
                end, n = begin, 0
                with files.open_input_file(f"{root}/shard={shard}/{name}") as stream:
                    for end, _, _ in frames(stream, begin, size, left, payload=False):
                        n += 1
                left = None if left is None else left - n
                if n:
                    ends[shard] = [name, end]
        self.at = ends
        return ends

    def _saved(self) -> dict[str, list]:
        files, name = file_system(self.progress)
        if files.get_file_info(name).type == afs.FileType.NotFound:
            return {}
        with files.open_input_stream(name) as stream:
            return json.loads(stream.read())

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # The batch's end is where a query that starts again will ask for more.
        files, name = file_system(self.progress)
        with files.open_output_stream(f"{name}.draft") as stream:
            stream.write(json.dumps(end).encode())
        files.move(f"{name}.draft", name)
        if self.at is None:
            self.at = dict(end)
        return [ShardRange(shard, tuple(start.get(shard, ("", 0))), tuple(last)) for shard, last in sorted(end.items())
                if list(start.get(shard, ("", 0))) != list(last)]

    def read(self, partition: ShardRange) -> Iterator[tuple]:
        files, root = file_system(self.path)
        (first, begin), (last, stop) = partition.first, partition.last
        for name, size in self._files(partition.shard, first):
            if name > last:
                break
            with files.open_input_file(f"{root}/shard={partition.shard}/{name}") as stream:
                position = begin if name == first else 0
                for end, arrived, value in frames(stream, position, stop if name == last else size):
                    at = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=arrived)
                    yield value, at, partition.shard, name, end

    def commit(self, end: dict) -> None:
        pass
