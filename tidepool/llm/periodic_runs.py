"""Periodic runs of words and their collapse, by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``SHORTEST`` words and two periods long, that cannot be extended. For each text:

1. Suffix ranks by doubling: after step k, suffixes that agree in 2**k words share a rank,
   the place of their group in the suffix array; only groups of several are sorted again.
   Ranks are kept for each step: they compare two blocks of 2**k words in one look, so
   the longest common extension of two places takes one look a step.
2. Dyadic blocks: for every k, the blocks of 2**k words at multiples of 2**k. A run of
   length L holds, in its first L - q words, a block with 2**(k+2) > q, so the block occurs
   again q words on, in one of the four windows of 2**k places behind it.
3. A wavelet matrix over the suffix array answers range successors: the occurrences of a
   block (one interval of the array) in a window. They form an arithmetic progression,
   known from its first two terms and their number.
4. Candidate periods are the distances to these occurrences. A progression of three or
   more says that the block has its difference as a period: the terms in the same periodic
   stretch stand for that period alone, the others are candidates of their own.
5. Both extensions of each candidate give a run; of equal stretches the smallest period stays.

Texts are handled in chunks of whole texts, as arrays, with no object per word; memory is
about 250 bytes a word of the longest text. Words are compared by 64-bit hashes.

``collapse_runs`` keeps the first period of every run and drops the words behind it.

Defined cases: a null or empty text has no words and no run and collapses to an empty
text; repeated rows each give their row; an empty table gives an empty result; columns
other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import join_words, text_chunks, word_hashes, words_of

SHORTEST = 12      # words
WINDOWS = 4        # windows of a block's length that are searched behind it


class Suffixes:
    """Suffix ranks of several texts at all doubling steps; equal ranks only inside one text."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n = len(words)
        self.array = np.argsort(words, kind="stable")      # equal words stay in order of their texts
        key, owner = words[self.array], text[self.array]
        fresh = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))[:n]
        slots = np.arange(n)
        head = slots[fresh][np.cumsum(fresh) - 1]
        rank = np.empty(n + 1, np.int64)
        rank[self.array] = head
        rank[n] = -1
        self.ranks, self.sizes, self.slots = [], [], []
        end = np.searchsorted(text, text, "right")      # the place behind the last word of each word's text
        step = 1
        while True:
            size = np.bincount(rank[:n], minlength=n)
            slots = np.flatnonzero(size[rank[self.array]] > 1)
            if not len(slots):
                break
            self.ranks.append(rank)
            self.sizes.append(size)
            self.slots.append(slots)
            at = self.array[slots]
            after = at + step
            second = np.where(after < end[at], rank[np.minimum(after, n)], -1)
            key = rank[at] * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            self.array[slots] = at
            fresh = np.append(True, key[1:] != key[:-1])
            rank = rank.copy()
            rank[at] = slots[fresh][np.cumsum(fresh) - 1]
            step *= 2

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and from ``b > a`` on."""
        a, b = a.copy(), b.copy()
        begun = b.copy()
        last = len(self.array)
        for k in range(len(self.ranks) - 1, -1, -1):
            same = (self.ranks[k][a] == self.ranks[k][b]) & (b < last)
            a[same] += 1 << k
            b[same] += 1 << k
        return b - begun

    def behind(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Words that agree before ``a`` and before ``b > a``, none before ``begin``."""
        a, b = a.copy(), b.copy()
        begun = b.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            size = 1 << k
            room = a - size >= begin
            same = room & (self.ranks[k][np.where(room, a - size, 0)] == self.ranks[k][np.where(room, b - size, 0)])
            a[same] -= size
            b[same] -= size
        return begun - b


class WaveletMatrix:
    """Counts and order statistics of any interval of an array of distinct numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~one], values[one]))

    def below(self, first: np.ndarray, last: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of ``values[first:last]`` are less than ``x``."""
        count = np.zeros(len(x), np.int64)
        for level, before in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = before[first], before[last]
            count += np.where(one, b - a, 0)
            first, last = np.where(one, before[-1] + first - a, a), np.where(one, before[-1] + last - b, b)
        return count

    def nth(self, first: np.ndarray, last: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest (from 0) of ``values[first:last]``."""
        out, k = np.zeros(len(k), np.int64), k.copy()
        for before in self.zeros:
            a, b = before[first], before[last]
            one = k >= b - a
            out = out * 2 + one
            k -= np.where(one, b - a, 0)
            first, last = np.where(one, before[-1] + first - a, a), np.where(one, before[-1] + last - b, b)
        return out


def candidates(suffixes: Suffixes, text: np.ndarray, first: np.ndarray, lowest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all blocks that occur again behind themselves, for one block size at a time."""
    if len(suffixes.ranks) <= lowest:
        return
    slots = suffixes.slots[lowest]
    places = np.sort(suffixes.array[slots])                # words that begin a repeated block
    matrix = WaveletMatrix(np.searchsorted(places, suffixes.array[slots]))
    slot_of = np.zeros(len(suffixes.array) + 1, np.int64)  # place in the suffix array -> place in the matrix
    slot_of[slots] = np.arange(len(slots))
    for k in range(lowest, len(suffixes.ranks)):
        size, rank, count = 1 << k, suffixes.ranks[k], suffixes.sizes[k]
        block = places[(places - first[text[places]]) % size == 0]
        block = block[count[rank[block]] > 1]
        low = slot_of[rank[block]]
        high = low + count[rank[block]]
        edge = [matrix.below(low, high, np.searchsorted(places, block + 1 + j * size)) for j in (0, WINDOWS)]
        some = edge[1] > edge[0]
        block, low, high, before = block[some], low[some], high[some], edge[0][some]
        for j in range(WINDOWS):
            if not len(block):
                break
            until = matrix.below(low, high, np.searchsorted(places, block + 1 + (j + 1) * size))
            found = np.flatnonzero(until > before)
            at, a, b, n = block[found], low[found], high[found], (until - before)[found]
            next_one = places[matrix.nth(a, b, before[found])]
            yield at, next_one - at
            more = np.flatnonzero(n > 1)
            at, n, next_one = at[more], n[more], next_one[more]
            gap = places[matrix.nth(a[more], b[more], before[found][more] + 1)] - next_one
            pair = n == 2
            yield at[pair], (next_one + gap - at)[pair]
            at, n, next_one, gap = at[~pair], n[~pair], next_one[~pair], gap[~pair]
            if len(at):
                yield at, gap
                stretch = at + gap + suffixes.ahead(at, at + gap)       # where the stretch of period ``gap`` ends
                inside = np.clip((stretch - size - next_one) // gap + 1, 0, n) * ((next_one - at) % gap == 0)
                left = n - inside
                nth = np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left) + np.repeat(inside, left)
                yield np.repeat(at, left), np.repeat(next_one - at, left) + nth * np.repeat(gap, left)
            before = until


def runs_of(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start, period.

    ``words`` are word hashes, ``first`` the first word of each text and the end.
    """
    none = np.zeros((0, 4), np.int64)
    if len(words) < shortest:
        return none
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    suffixes = Suffixes(words, text)
    lowest = max(0, ((shortest + 1) // 2 + 1).bit_length() - 2)
    found = [none]
    for at, period in candidates(suffixes, text, first, lowest):
        other = at + period
        start = at - suffixes.behind(at, other, first[text[at]])
        length = other + suffixes.ahead(at, other) - start
        good = length >= np.maximum(shortest, 2 * period)
        found.append(np.stack((text[at], start - first[text[at]], length, period), axis=1)[good])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.append(True, (runs[1:, :3] != runs[:-1, :3]).any(axis=1))[:len(runs)]
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) by start, and the collapsed text of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in text_chunks(batch.column("text")):
                start, end, first = words_of(data, at)
                found = runs_of(word_hashes(data, start, end), first, shortest)
                begin = first[found[:, 0]] + found[:, 1]
                edge = np.zeros(len(start) + 1, np.int64)
                np.add.at(edge, begin + found[:, 3], 1)
                np.add.at(edge, begin + found[:, 2], -1)
                kept = np.cumsum(edge[:-1]) == 0
                offsets = np.searchsorted(found[:, 0], np.arange(b - a + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], pa.array(np.diff(first)), pa.ListArray.from_arrays(offsets, runs),
                     join_words(data, at, start, end, first, kept)], ["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                                "collapsed string")
