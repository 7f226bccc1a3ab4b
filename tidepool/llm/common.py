"""Helpers shared by the operators: tables in the shared folder, words as arrays.

``words_of`` and ``word_hashes`` work on the UTF-8 buffer of an Arrow text
column, so a batch of texts is split and hashed without a Python object per
word. Text separators are the bytes ``\\x20 \\x09-\\x0D`` throughout, which
never occur inside a multi-byte UTF-8 character.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.session import checkpoint_root

CHUNK_BYTES = 1 << 20

# Keys that hold more than this share of the rows are answered from a broadcast
# table; at most 1 / HOT_SHARE keys can, which bounds its size.
HOT_SHARE = 0.001

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[ord("A"):ord("Z") + 1] += 32

# Odd multipliers of the two rolling hashes (bytes of a word, words of a window).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def answer_by_key(rows: DataFrame, facts: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined with ``facts``, which has one row per ``key`` and the key's rows in ``size``.

    Keys above HOT_SHARE of all rows meet a broadcast table of at most 1 / HOT_SHARE
    rows, the others a sort-merge join: no task gets all rows of a hot key.
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    is_hot = F.col(size) > total * HOT_SHARE
    answers = [c for c in facts.columns if c != key]
    columns = [*rows.columns, *answers]
    first = rows.join(F.broadcast(facts.where(is_hot)), key, "left")
    rest = first.where(F.col(size).isNull()).drop(*answers).join(facts.where(~is_hot).hint("merge"), key)
    return first.where(F.col(size).isNotNull()).select(columns).unionByName(rest.select(columns))


def text_key(text: Column) -> Column:
    """With the id, tells rows apart; a null text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def one_of_each(docs: DataFrame, keys: dict[str, Column], kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are in ``kept`` (columns of the same names); one of rows that agree in all.

    The row travels as one struct, so its columns may have any names.
    """
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *(c.alias(k) for k, c in keys.items()))
    marks = kept.select(*(F.col(k).alias(f"kept_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"kept_{k}")) for k in keys]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    return (keyed.join(marks, same, "left_semi").withColumn("nth", nth).where("nth = 1").select("row.*"))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id and text_key are in ``kept``; one of rows that agree in both."""
    return one_of_each(docs, {"doc_id": F.col(id_col), "text_key": text_key(F.col(text_col))}, kept)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``(first, last, bytes, offsets)`` of about ``most`` bytes, whole texts each."""
    data, at = text_buffer(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, last, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def words_of(data: np.ndarray, at: np.ndarray,
             separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of all words, and each text's first word index."""
    inside = ~separator[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = at[(at > 0) & (at < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, at)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``n`` of them.

    A worker keeps one pair of arrays a base, up to the size that blocks of texts need.
    """
    if len(_POWERS.get(base, ((),))[0]) >= n:
        return _POWERS[base]
    size = -(-n // 65536) * 65536
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    found = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    if size <= 4 * CHUNK_BYTES:
        _POWERS[base] = found
    return found


def rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hashes (modulo 2**64) of ``values[start:end]``, mixed; equal spans hash alike."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[:len(values)], dtype=np.uint64, out=total[1:])
    return mix64((total[end] - total[start]) * down[start])


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return rolling(data.astype(np.uint64) + np.uint64(1), start, end, BYTE_BASE)


def window_starts(first: np.ndarray, words: int) -> np.ndarray:
    """Index of the first word of every window of ``words`` words inside one text."""
    n = np.maximum(np.diff(first) - words + 1, 0)
    ahead = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return np.arange(int(n.sum())) + ahead


def join_words(data: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray,
               kept: np.ndarray) -> pa.StringArray:
    """Each text's ``kept`` words with one space between them."""
    edge = np.zeros(len(data) + 1, np.int8)
    np.add.at(edge, start[kept], 1)
    np.add.at(edge, end[kept], -1)
    keep = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))[kept]
    followed = np.flatnonzero(text[1:] == text[:-1])
    gap = end[kept][followed]
    out = data.copy()
    out[gap] = 0x20
    keep[gap] = True
    size = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=size[1:])
    offsets = size[at].astype(np.int32)
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(out[keep]))
