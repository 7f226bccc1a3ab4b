"""Substring dedup: remove what repeated windows of fixed length cover.

Every window of ``window`` consecutive words gets two independent Rabin-Karp
hashes: one names the group that counts it, the other, of 64 bits, is counted
there. Two different windows are mistaken for each other only if both agree, so
the chance falls as the number of groups grows with the data (about 1e-5 for any
of 1e8 windows in 64 groups).

Rows that repeat wholly (id and text) travel once with their number: each batch of the
scan keeps one of them before the shuffle, and what batches have in common is summed behind
it, row by row, before a block is put together. So a block has every row once, however
often it repeats.

The texts are dealt into blocks of about ``BLOCK_BYTES`` by a hash of the row. A
block sends each group the hashes that fall to it as one packed array, each
distinct hash once, so a window that a third of all texts share costs 8 bytes a
block. A group answers each block with one bit a hash: it occurs elsewhere. The
block, read again from the same shuffle, hashes its windows again, in the same
order, merges the covered words into maximal intervals and cuts them out. What
crosses the network is the texts, 8 bytes a window and one bit back.

Defined cases: a null text has no words; texts shorter than a window lose nothing;
windows are judged on the input, so all copies of a passage go; of rows that repeat
wholly every one loses its windows; an empty table gives no rows. Only the id and
the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import (
    WORD_BASE,
    join_words,
    rolling,
    text_buffer,
    text_key,
    window_starts,
    word_hashes,
    words_of,
)

GROUP_BASE = 0xA24BAED4963EE407
BLOCK_BYTES = 2 << 20      # text of one block: bounds a task's memory
GROUP_BYTES = 12 << 20     # text whose windows one group counts (about 2 million)
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


class Windows:
    """A block's texts in a fixed order, and the distinct hashes of their windows by group."""

    def __init__(self, rows: pa.Table, window: int, groups: int):
        self.rows = rows.sort_by([("doc_id", "ascending"), ("text_key", "ascending")])
        times = np.asarray(self.rows.column("n"))
        self.data, self.at = text_buffer(self.rows.column("text"))
        self.start, self.end, self.first = words_of(self.data, self.at)
        words = word_hashes(self.data, self.start, self.end)
        self.word = window_starts(self.first, window)
        value = rolling(words, self.word, self.word + window, WORD_BASE)
        group = (rolling(words, self.word, self.word + window, GROUP_BASE) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((value, group))
        value, group = value[order], group[order]
        new = np.ones(len(order), bool)
        new[1:] = (value[1:] != value[:-1]) | (group[1:] != group[:-1])
        self.order, self.place = order, np.cumsum(new) - 1
        self.value, self.group = value[new], group[new]
        text_of = np.repeat(np.arange(len(times)), np.diff(self.first))
        self.twice = np.bincount(self.place, times[text_of[self.word[order]]], len(self.value)) > 1

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """(group, bounds): the groups with hashes here, and where theirs lie in ``value``."""
        found, first = np.unique(self.group, return_index=True)
        return found, np.concatenate((first, [len(self.group)]))

    def removed(self, elsewhere: np.ndarray, window: int) -> np.ndarray:
        """Per word: a window that occurs twice covers it. ``elsewhere``: per distinct hash."""
        repeated = np.zeros(len(self.order), bool)
        repeated[self.order] = (elsewhere | self.twice)[self.place]
        edge = np.zeros(len(self.start) + 1, np.int32)
        at = self.word[repeated]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
        return np.cumsum(edge[:-1]) > 0


def repeated_in_group(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Per part, which of its hashes occur in another part (a part has each hash once)."""
    whole = np.sort(np.concatenate(parts))
    twice = whole[1:][whole[1:] == whole[:-1]]
    if not len(twice):
        return [np.zeros(len(p), bool) for p in parts]
    twice = np.unique(twice)
    return [twice[np.minimum(np.searchsorted(twice, p), len(twice) - 1)] == p for p in parts]


def once_a_batch(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_key, ...) with ``n``, their number: of rows of a batch that agree in both one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.Table.from_batches([batch]).append_column("at", pa.array(np.arange(batch.num_rows)))
            found = whole.select(["doc_id", "text_key", "at"]).group_by(["doc_id", "text_key"]).aggregate(
                [("at", "min"), ("at", "count")])
            kept = batch if len(found) == len(whole) else batch.take(found.column("at_min").combine_chunks())
            n = found.column("at_count").combine_chunks() if len(found) < len(whole) else pa.array(
                np.ones(len(whole), np.int64))
            yield pa.RecordBatch.from_arrays([*kept.columns, n], [*kept.schema.names, "n"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, n long")


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word intervals cut out, last exclusive) and kept (the rest)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-total // block_bytes))
    groups = max(1, -(-total // group_bytes), min(spread, total >> 20))
    key = F.xxhash64(F.col(id_col), text)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), text_key(text).alias("text_key"),
                       F.pmod(key, F.lit(blocks)).alias("block"))
    # The shuffle by block also serves the sum, which then only streams, and both groupings below.
    rows = (once_a_batch(rows).repartition("block").groupBy("block", "doc_id", "text_key", "text")
            .agg(F.sum("n").alias("n")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def send(table: pa.Table) -> pa.Table:
        own = Windows(table, window, groups)
        found, bounds = own.packed()
        return pa.table({
            "group": pa.array(found, pa.int64()),
            "block": pa.array(np.repeat(table.column("block")[0].as_py(), len(found)), pa.int64()),
            "hashes": pa.array([own.value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                               pa.binary())})

    def count(table: pa.Table) -> pa.Table:
        flags = repeated_in_group([np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")])
        answered = table.filter(pa.array([f.any() for f in flags], pa.bool_()))
        return pa.table({
            "block": answered.column("block"), "group": answered.column("group"),
            "bits": pa.array([np.packbits(f).tobytes() for f in flags if f.any()], pa.binary())})

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Windows(table, window, groups)
        found, bounds = own.packed()
        elsewhere = np.zeros(len(own.value), bool)
        for group, bits in zip(answers.column("group").to_pylist(), answers.column("bits").to_pylist(), strict=True):
            i = int(np.searchsorted(found, group))
            n = bounds[i + 1] - bounds[i]
            elsewhere[bounds[i]:bounds[i + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
        gone = own.removed(elsewhere, window)
        sums = np.concatenate(([0], np.cumsum(gone)))
        # Interval ends, also at the edges of texts.
        text_of = np.repeat(np.arange(len(own.at) - 1), np.diff(own.first))
        apart = np.ones(len(gone) + 1, bool)
        apart[1:-1] = text_of[1:] != text_of[:-1]
        opens = np.flatnonzero(gone & (apart[:-1] | ~np.concatenate(([False], gone[:-1]))))
        closes = np.flatnonzero(gone & (apart[1:] | ~np.concatenate((gone[1:], [False])))) + 1
        base = own.first[:-1][text_of[opens]] if len(opens) else opens
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(opens, own.first).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array((opens - base).astype(np.int32)),
                                        pa.array((closes - base).astype(np.int32))], ["first", "last"]))
        return pa.table({
            "doc_id": own.rows.column("doc_id"), "n_words": pa.array(np.diff(own.first).astype(np.int64)),
            "n_removed": pa.array((sums[own.first[1:]] - sums[own.first[:-1]]).astype(np.int64)), "spans": spans,
            "kept": join_words(own.data, own.at, own.start, own.end, own.first, ~gone), "n": own.rows.column("n")})

    by_block = rows.groupBy("block")
    sent = by_block.applyInArrow(send, "group long, block long, hashes binary")
    answers = sent.groupBy("group").applyInArrow(count, "block long, group long, bits binary")
    found = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept string, n long")
    # One row for each that came.
    return (found.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
            .drop("n", "nth"))
