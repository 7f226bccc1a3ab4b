"""Token-id files of directly addressable codes (DACs).

A segment is a run of documents in id order. Its ids are cut into chunks of ``b``
bits: level 0 holds the lowest chunk of every id, level k the next chunk of those
that need it. Beside each level lies a bitmap (does the id go on?) with a rank
directory (ones before each block of 512 bits), so id ``i`` is read by following
its chunk, its bit and its rank from level to level, without decoding a block.
``b`` is 4, 8 or 16, whichever makes the segment smallest.

Files: executors share no folder that plain file calls reach, so a segment is the
binary column of a Parquet row and Spark's writer commits it (a lost executor's task
is run again, half-written files never count). Rows lie in ascending doc_id order
within and across files. ``start`` (ids of all documents before) comes from sums per
file and segment, never from one pass over all rows.

Defined cases: a null text encodes like an empty one (the end id alone); a null
doc_id sorts first; rows with one id follow each other in the order of their text's
hash; ids up to 2**32 - 1 are stored; an empty table gives no segments.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepool.llm.bpe import byte_letters, refuse_others
from tidepool.llm.common import shared_path, text_key
from tidepool.llm.pieces import PieceCache

MAGIC = b"DAC1"
HEAD = struct.Struct("<4sBBxxQQ")       # magic, chunk bits, levels, ids, documents
LEVEL = struct.Struct("<QQQ")           # bytes of chunks, bitmap and directory
RANK_BITS = 512
SEGMENT_IDS = 1 << 19                   # a segment is closed at the document that reaches this
PARTITION_BYTES = 16 << 20              # text of one file
SCHEMA = "part int, seq int, n_ids long, n_docs long, segment binary"


def _pack(chunks: np.ndarray, bits: int) -> bytes:
    if bits == 4:
        even = np.append(chunks, 0)[:len(chunks) + len(chunks) % 2].astype(np.uint8)
        return (even[0::2] | (even[1::2] << 4)).astype(np.uint8).tobytes()
    return chunks.astype(f"<u{bits // 8}").tobytes()


def _levels(ids: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(chunks, goes on) of each level."""
    out, rest, step = [], ids.astype(np.uint32), np.uint32(bits)
    low = np.uint32((1 << bits) - 1)
    while True:
        beyond = (rest >> step) if bits < 32 else np.zeros_like(rest)
        on = beyond > 0
        out.append((rest & low, on))
        if not on.any():
            return out
        rest = beyond[on]


def _size(ids: np.ndarray, bits: int) -> int:
    """Bits of the chunks and bitmaps with this chunk width."""
    total, rest = 0, ids.astype(np.uint32)
    while len(rest):
        total += len(rest) * (bits + 1)
        rest = rest >> np.uint32(bits)
        rest = rest[rest > 0]
    return total


def write_segment(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one segment: header, document table, levels."""
    bits = min((4, 8, 16), key=lambda b: _size(ids, b))
    levels = _levels(ids, bits)
    parts = [b"", doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes()]
    for chunks, on in levels:
        packed, bitmap = _pack(chunks, bits), np.packbits(on, bitorder="little")
        ones = np.bitwise_count(np.append(bitmap, np.zeros(-len(bitmap) % (RANK_BITS // 8), np.uint8)))
        block = ones.reshape(-1, RANK_BITS // 8).sum(1, dtype=np.uint64)
        ranks = np.concatenate(([0], np.cumsum(block)))[:-1].astype("<u4")
        parts += [LEVEL.pack(len(packed), len(bitmap), ranks.nbytes), packed, bitmap.tobytes(), ranks.tobytes()]
    parts[0] = HEAD.pack(MAGIC, bits, len(levels), len(ids), len(counts))
    return b"".join(parts)


class Segment:
    """Random access to one segment's ids."""

    def __init__(self, raw: bytes):
        magic, self.bits, levels, self.n, docs = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a DAC segment")
        at = HEAD.size
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        self.counts = np.frombuffer(raw, "<u4", docs, at + 8 * docs)
        at += 12 * docs
        self.levels = []
        for _ in range(levels):
            chunk, bitmap, ranks = LEVEL.unpack_from(raw, at)
            at += LEVEL.size
            self.levels.append((raw[at:at + chunk], np.frombuffer(raw, np.uint8, bitmap, at + chunk),
                                np.frombuffer(raw, "<u4", ranks // 4, at + chunk + bitmap)))
            at += chunk + bitmap + ranks

    def _chunk(self, level: int, i: int) -> int:
        raw = self.levels[level][0]
        if self.bits == 4:
            return raw[i >> 1] >> 4 * (i & 1) & 15
        width = self.bits // 8
        return int.from_bytes(raw[i * width:(i + 1) * width], "little")

    def id_at(self, i: int) -> int:
        """Id ``i`` alone: one chunk, one bit and one rank a level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for level, (_, bitmap, ranks) in enumerate(self.levels):
            value |= self._chunk(level, i) << shift
            shift += self.bits
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * RANK_BITS // 8
            before = int(np.bitwise_count(bitmap[first:i >> 3]).sum())
            i = int(ranks[block]) + before + (int(bitmap[i >> 3]) & (1 << (i & 7)) - 1).bit_count()
        return value

    def ids(self) -> np.ndarray:
        """All ids (uint32), level by level."""
        out, at, shift = np.zeros(self.n, np.uint32), np.arange(self.n), 0
        for raw, bitmap, _ in self.levels:
            if self.bits == 4:
                pairs = np.frombuffer(raw, np.uint8)
                chunks = np.stack((pairs & 15, pairs >> 4), 1).ravel()[:len(at)]
            else:
                chunks = np.frombuffer(raw, f"<u{self.bits // 8}")
            out[at] |= chunks.astype(np.uint32) << np.uint32(shift)
            at = at[np.unpackbits(bitmap, bitorder="little", count=len(at)).astype(bool)]
            shift += self.bits
        return out


@lru_cache(maxsize=2)
def library(path: str) -> PieceCache:
    """The tokenizers library behind the piece cache, without truncation and padding; once per worker."""
    with open(path, encoding="utf-8") as f:
        refuse_others(json.load(f), path)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())

    def encode_many(texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in found]

    # The file's byte-level step turns a word's bytes to letters; its model takes the word from there.
    model, letters = tokenizer.model, byte_letters()

    def encode_words(words: list[str]) -> list[bytes]:
        ids, last = [], []
        for word in "\n".join(words).encode().decode("latin-1").translate(letters).split(letters[ord("\n")]):
            ids += [t.id for t in model.tokenize(word)]
            last.append(4 * len(ids))
        raw = np.array(ids, np.int32).tobytes()
        return [raw[a:b] for a, b in zip([0, *last[:-1]], last, strict=True)] if words else []

    return PieceCache(encode_many, added, encode_words=encode_words)


def write_dac(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Encode ``docs`` and write segments (part, seq, n_ids, n_docs, segment) below ``path``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(1, -(-total // PARTITION_BYTES), min(spread, total >> 20))
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), text_key(text).alias("k"))
               .repartitionByRange(files, "doc_id", "k").sortWithinPartitions("doc_id", "k")
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = library(tokenizer)
        ids, sizes, doc_ids, held, seq, part = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            counts, flat = np.concatenate(sizes), np.concatenate(ids).view(np.uint32)
            raw = write_segment(np.concatenate(doc_ids), counts, flat)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_ids": pa.array([len(flat)], pa.int64()), "n_docs": pa.array([len(counts)], pa.int64()),
                "segment": pa.array([raw], pa.binary())})

        for batch in batches:
            known, at = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(), 0
            for found, counts in cache.chunks(batch.column("text")):
                part = batch.column("part")[0].as_py()
                found, counts = np.insert(found, np.cumsum(counts), end_id), counts + 1
                while len(counts):
                    # Up to the document that fills the segment, or all that there are.
                    n = int(np.searchsorted(np.cumsum(counts), SEGMENT_IDS - held)) + 1
                    taken, full = counts[:n], n <= len(counts)
                    size = int(taken.sum())
                    ids.append(found[:size])
                    sizes.append(taken)
                    doc_ids.append(known[at:at + len(taken)])
                    held, at, found, counts = held + size, at + len(taken), found[size:], counts[n:]
                    if full:
                        yield close()
                        ids, sizes, doc_ids, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield close()

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def read_dac(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files below ``path``."""
    files = spark.read.schema(SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = Segment(batch.column("segment")[i].as_py())
                raw, last = one.ids().astype("<u4"), np.cumsum(one.counts, dtype=np.int64)
                first = last - one.counts
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                none = one.doc_ids == np.iinfo(np.int64).min
                n = len(last)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                    "seq": pa.array(np.full(n, batch.column("seq")[i].as_py(), np.int32)),
                    "doc_id": pa.array(one.doc_ids, mask=none), "inside": pa.array(first),
                    "n_tokens": pa.array(one.counts.astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64())})

    docs = files.select("part", "seq", "segment").mapInArrow(
        run, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(segment_starts(files), ["part", "seq"]).select(
        "doc_id", (F.col("first_id") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def segment_starts(files: DataFrame) -> DataFrame:
    """(part, seq, first_id): ids before each segment, from sums per file and then per segment."""
    sizes = files.select("part", "seq", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
            .select("part", "seq", (F.col("before") + F.col("within")).alias("first_id")))


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as DAC files below ``path`` (default: a new shared folder) and read them back."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "dac")
    write_dac(docs, path, tokenizer, end_id)
    return read_dac(spark, path)
