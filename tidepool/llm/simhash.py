"""SimHash near-dedup: fingerprints, multi-index hashing, connected components.

Fingerprint: A-Z folded, words between the separators, shingles of ``shingle``
words joined by one space (repeats count; fewer words: the whole sequence), XXH64
with seed 42 of each, majority per bit. It is computed on Arrow batches.

Links (``links``): copies first collapse to distinct fingerprints. Two fingerprints
within 3 bits differ by at most one bit in one of their two 32-bit segments, so each
segment's values are a table and its Hamming ball of radius 1 is enumerated against
it; matches are verified on all 64 bits. Of two segment values one bit apart only the
one without the bit probes, so a fingerprint costs 34 probes on average.

A segment value that many fingerprints share (one template with small edits) would
give all pairs of its bucket. Buckets above ``BUCKET`` fingerprints are instead cut
into blocks, and every pair of blocks is compared in one task that returns a spanning
forest of the links it finds: at most as many edges as fingerprints, same components.
Pairs of blocks grow with the square of a bucket, so one above ``HUGE`` fingerprints is
first split by further segments: the other half has at most 3 bits of difference, so one
of its two 16-bit quarters has at most one, and a probe enumerates the balls of radius 1
of both. What then shares a table entry agrees in 48 bits: 65,536 fingerprints at most.

Components: every node moves to its first neighbour in an order drawn anew each round
and the edges are contracted, each round written to the shared folder, until no edge
is left.

Defined cases: a null text is empty and has fingerprint zero, like a text without
words; it links like any other. Repeated rows share their component. A null doc_id
takes part but names a component only if all its ids are null (component_id null).
An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import (
    LOWER_ASCII,
    SEPARATOR,
    answer_by_key,
    keep_rows,
    materialize,
    text_chunks,
    text_key,
    words_of,
)

SEED = 42
SEGMENTS = (0, 32)         # first bit of each 32-bit segment
LOW_HALF = 0xFFFFFFFF
LANES = np.uint64(0x0101010101010101)
BUCKET = 200               # fingerprints; larger buckets are compared block by block
HUGE = 1 << 15             # fingerprints; larger buckets are split by two further segments
BLOCK = 4096               # fingerprints of one side of a comparison
SLICE = 256                # rows of the matrix of distances computed at once


def _joined(data: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them, their spans there, and each text's first word."""
    folded = LOWER_ASCII[data]
    start, end, first = words_of(folded, at)
    keep = ~SEPARATOR[folded]
    after = end[end < len(data)]
    after = after[~keep[after]]
    folded[after] = 0x20
    keep[after] = True
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return folded[keep].tobytes(), place[start], place[end], first


def fingerprints_of(data: np.ndarray, at: np.ndarray, shingle: int = 3) -> np.ndarray:
    """uint64 fingerprint of each text of one chunk."""
    joined, start, end, first = _joined(data, at)
    words = np.diff(first)
    n = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    total = int(n.sum())
    out = np.zeros(len(words), np.uint64)
    if not total:
        return out
    firsts = np.concatenate(([0], np.cumsum(n)))
    word = np.arange(total) + np.repeat(first[:-1] - firsts[:-1], n)
    last = word + np.repeat(np.minimum(words, shingle) - 1, n)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start[word].tolist(), end[last].tolist(), strict=True)),
                    np.uint64, total)
    full = np.flatnonzero(n)
    # Sums of up to 255 rows fit a byte lane, so each text is summed in such pieces.
    pieces = -(-n[full] // 255)
    piece_at = np.concatenate(([0], np.cumsum(pieces)))[:-1]
    bounds = np.repeat(firsts[full], pieces) + 255 * (np.arange(int(pieces.sum())) - np.repeat(piece_at, pieces))
    counts = np.empty((len(full), 64), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & LANES, bounds).astype("<u8")
        counts[:, bit::8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), piece_at, axis=0)
    bits = (2 * counts > n[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key and fp (the 64 bits as a signed long) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       text_key(F.col(text_col)).alias("text_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprints_of(data, at, shingle) for _, _, data, at in text_chunks(batch.column("text"))]
            fp = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(fp)],
                                             ["doc_id", "text_key", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def _buckets(distinct: DataFrame) -> DataFrame:
    """(bucket, fp): each fingerprint under the value of each segment."""
    return distinct.select("fp", F.explode(F.array(*[_bucket(i, _value(s)) for i, s in enumerate(SEGMENTS)]))
                           .alias("bucket"))


def _value(shift: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND(LOW_HALF)


def _bucket(segment: int, value: Column) -> Column:
    return value.bitwiseOR(segment << 32)


def _probes(distinct: DataFrame) -> DataFrame:
    """(bucket, fp): the Hamming ball of each segment value, upwards only."""
    def ball(segment: int, shift: int) -> Column:
        ups = F.filter(F.array(*[F.lit(1 << b).cast("long") for b in range(32)]),
                       lambda bit: _value(shift).bitwiseAND(bit) == 0)
        return F.concat(F.array(_bucket(segment, _value(shift))),
                        F.transform(ups, lambda bit: _bucket(segment, _value(shift)).bitwiseOR(bit)))

    return distinct.select("fp", F.explode(F.concat(*[ball(i, s) for i, s in enumerate(SEGMENTS)])).alias("bucket"))


def _near(a: Column, b: Column, bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= bits


def star_edges(sources: np.ndarray, members: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) joining what the links between two blocks connect: a star per component."""
    near = np.empty((len(sources), len(members)), bool)
    for i in range(0, len(sources), SLICE):
        near[i:i + SLICE] = np.bitwise_count(sources[i:i + SLICE, None] ^ members[None, :]) <= bits
    touched_s, touched_m = near.any(1), near.any(0)
    nodes = np.unique(np.concatenate((sources[touched_s], members[touched_m])))
    if not len(nodes):
        return nodes, nodes
    near = near[touched_s][:, touched_m]
    at_s, at_m = np.searchsorted(nodes, sources[touched_s]), np.searchsorted(nodes, members[touched_m])
    label = np.arange(len(nodes), dtype=np.int32)
    none = np.int32(len(nodes))
    while True:
        was = label.copy()
        for i in range(0, len(near), SLICE):
            low = np.where(near[i:i + SLICE], label[at_m][None, :], none).min(1)
            np.minimum.at(label, at_s[i:i + SLICE], low)
        for i in range(0, len(near), SLICE):
            low = np.where(near[i:i + SLICE], label[at_s[i:i + SLICE]][:, None], none).min(0)
            np.minimum.at(label, at_m, low)
        if (was == label).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def _block_pairs(probes: DataFrame, table: DataFrame, large: DataFrame, block: int) -> DataFrame:
    """(sources, members): every pair of blocks of a large bucket's probes and fingerprints, about ``block`` each."""
    def blocks(rows: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
        spread = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / block)).alias("at")
        hits = rows.join(sizes, "bucket").select("bucket", spread, "fp")
        return hits.groupBy("bucket", "at").agg(F.collect_list("fp").alias(name)).drop("at")

    # Probes also come from up to 32 neighbour buckets, so they are counted by themselves.
    probing = materialize(probes.join(large.select("bucket"), "bucket").groupBy("bucket")
                          .agg(F.count(F.lit(1)).alias("n")), "large-probes")
    return (blocks(probes, probing, "sources").join(blocks(table, large, "members"), "bucket")
            .select("sources", "members"))


def _block_edges(probes: DataFrame, table: DataFrame, large: DataFrame, bits: int, block: int) -> DataFrame:
    """Edges from probes of large buckets: each pair of blocks is compared in one call."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for pair in zip(part["sources"], part["members"], strict=True):
                a, b = star_edges(*(np.asarray(x, np.int64).view(np.uint64) for x in pair), bits)
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    pairs = _block_pairs(probes, table, large, block)
    n = int(probes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n).mapInPandas(run, "a long, b long")


def _other_half(bucket: Column) -> Column:
    """The 32 bits of ``fp`` that the bucket's segment does not hold."""
    return F.when(F.shiftright(bucket, 32) == 0, F.shiftrightunsigned("fp", 32)).otherwise(
        F.col("fp").bitwiseAND(LOW_HALF))


def _quarters(rows: DataFrame, huge: DataFrame, ball: bool) -> DataFrame:
    """(bucket, fp): rows of huge buckets under either 16-bit quarter of their other half.

    With ``ball`` also under each value one bit away. The new bucket is the old one (33 bits),
    the quarter's number and its value.
    """
    bucket = F.col("bucket")
    flips = F.array(*[F.lit(x).cast("long") for x in (0, *(1 << b for b in range(16)))]) if ball else F.array(
        F.lit(0).cast("long"))

    def under(quarter: int) -> Column:
        value = F.shiftrightunsigned(_other_half(bucket), 16 * quarter).bitwiseAND(0xFFFF)
        place = bucket.bitwiseOR(F.lit(quarter << 33).cast("long"))
        return F.transform(flips, lambda x: place.bitwiseOR(F.shiftleft(value.bitwiseXOR(x), 34)))

    return (rows.join(huge.select("bucket"), "bucket")
            .select("fp", F.explode(F.concat(under(0), under(1))).alias("bucket")))


def _linked(probes: DataFrame, table: DataFrame, bits: int, bucket: int, huge: int | None, block: int) -> DataFrame:
    """Edges (a, b) of the components of all links between probes and table rows of one bucket.

    ``huge``: None where buckets are bounded by themselves.
    """
    large = materialize(table.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket),
                        "large-buckets")
    sizes = large.agg(F.count(F.lit(1)), F.max("n")).first()
    small = table.join(large.select("bucket"), "bucket", "left_anti") if sizes[0] else table
    a, b = F.col("p.fp"), F.col("t.fp")
    found = (probes.alias("p").join(small.alias("t"), "bucket").where(_near(a, b, bits) & (a != b))
             .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))
    if sizes[0] and huge is not None and sizes[1] > huge:
        split = large.where(F.col("n") > huge)
        quarters = materialize(_quarters(table, split, ball=False), "quarters")
        found = found.unionByName(_linked(_quarters(probes, split, ball=True), quarters, bits, bucket, None, block))
        large = large.where(F.col("n") <= huge)
    if sizes[0]:
        found = found.unionByName(_block_edges(probes, table, large, bits, block).where("a <> b"))
    return found


def links(distinct: DataFrame, bits: int = 3, bucket: int = BUCKET, huge: int = HUGE, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose components are those of all links between fingerprints.

    ``distinct`` has one row per fp and is read several times: pass a written table.
    The segments allow up to 3 bits (2 segments, radius 1).
    """
    if not 0 <= bits <= 3:
        raise ValueError("two segments with radius 1 find distances up to 3")
    return _linked(_probes(distinct), _buckets(distinct), bits, bucket, huge, block).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Each round every node moves to whichever of itself and its neighbours comes first
    in an order drawn anew by hash, edges are rewritten to where their ends moved, and
    loops and repeats go. The fresh order makes the edges shrink by a constant factor a
    round on average, also along chains of growing ids. Rounds are written to the
    shared folder.
    """
    edges = materialize(edges.select("a", "b"), "edges")
    moved, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        turn += 1

        def place(node: str, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(node, F.lit(turn)).alias("at"), F.col(node).alias("node"))

        first = both.groupBy("a").agg(F.min(place("b")).alias("best"))
        moves = materialize(first.select(F.col("a").alias("node"), F.least(place("a"), F.col("best"))
                                         .getField("node").alias("to")), "moves")
        if moved is None:
            moved = moves.select("node", F.col("to").alias("at"))
        else:
            moved = (moved.join(moves.select(F.col("node").alias("at"), "to"), "at", "left")
                     .select("node", F.coalesce("to", "at").alias("at")))
        moved = materialize(moved, "moved")
        at_a = moves.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        at_b = moves.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        edges = materialize(edges.join(at_a, "a").join(at_b, "b").where("new_a <> new_b")
                            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
                            .distinct(), "edges")
    if moved is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    smallest = moved.groupBy("at").agg(F.min("node").alias("root"))
    return moved.join(smallest, "at").select("node", "root")


def simhash_groups(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, text_key, fp, root (the component's smallest fingerprint) and component_id (smallest doc_id reachable)."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    sizes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size")),
                        "distinct-fingerprints")
    roots = components(links(sizes.select("fp"), bits))
    placed = (sizes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = materialize(placed.join(named, "root").select("fp", "root", "component_id", "size"), "components")
    return answer_by_key(rows, facts, "fp", "size")


def drop_near_copies(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns: the smallest doc_id's, a null one last.

    Of rows with that id the one with the smallest text_key stays, of rows that agree in both one.
    """
    groups = simhash_groups(docs, shingle, bits, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("kept")
    kept = groups.groupBy("root").agg(first).select("kept.doc_id", "kept.text_key")
    return keep_rows(docs, kept, id_col, text_col)
