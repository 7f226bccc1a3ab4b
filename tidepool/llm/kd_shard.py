"""Sharding by a k-d tree over document metadata.

Dimensions: text bytes (log scale), source, lang and doc_id. A node that must
become k shards is cut, along its widest dimension, at the weighted quantile
floor(k/2)/k of its bytes (the weighted median when k is even), until every leaf
is one shard of the target size. Quantiles come from histograms that Spark sums
(``BINS`` bins a node), refined inside the bin that holds the cut until that bin
is negligible or a single key. Nodes, histograms and cuts are tables: rows are joined
with the nodes of a level (at most one row a shard, broadcast), and nothing of them
reaches the driver.

A cut compares one 63-bit key: 31 bits of the value and 32 bits that break ties.
Equal texts share their key and so their shard, up to ``GROUP_SHARE`` of a shard's
bytes; the rows of a larger group are keyed one by one, since keeping them
together would make sizes unequal. Law: ``bytes`` (sizes near equal).

Defined cases: a null text has 0 bytes and counts as equal to the empty text; null
metadata takes the lowest place of its dimension; rows that repeat wholly have equal
keys if their group is small and fall in any order within a shard; an empty table
gives no rows; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import materialize

ROW_OVERHEAD = 16
BINS = 2048
CUT_TOLERANCE = 0.0005     # of a shard's bytes: a bin this light needs no refining
GROUP_SHARE = 0.05         # of a shard's bytes: larger groups of equal texts are split
SLOT_ROWS = 100_000        # rows numbered in one task
LEVELS = (1 << 31) - 1
DIMENSIONS = ("k_size", "k_source", "k_lang", "k_id")


def _level(value: Column, low: float, high: float) -> Column:
    """0 .. LEVELS: the place of ``value`` between ``low`` and ``high`` (null: 0)."""
    span = (high - low) or 1.0
    part = (value.cast("double") - F.lit(float(low))) / F.lit(float(span))
    return F.coalesce((F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)) * LEVELS).cast("long"), F.lit(0))


def points(docs: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """Narrow rows (doc_id, size, text_crc32 and one key per dimension), and the bytes in all."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = materialize(docs.select(
        "doc_id", F.octet_length(raw).cast("long").alias("n"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("text_key"),
        F.crc32(F.col("source").cast("binary")).alias("source_at"),
        F.crc32(F.col("lang").cast("binary")).alias("lang_at"),
    ).withColumn("size", F.col("n") + ROW_OVERHEAD), "points")
    seen = narrow.agg(F.sum("size"), F.max("n"), F.min("doc_id"), F.max("doc_id")).first()
    total = seen[0] or 0
    levels = narrow.select("doc_id", "size", "text_crc32", "text_key", F.struct(
        _level(F.log2(F.col("n") + 1), 0.0, math.log2((seen[1] or 0) + 1)).alias("size"),
        _level(F.col("source_at"), 0, 2 ** 32).alias("source"),
        _level(F.col("lang_at"), 0, 2 ** 32).alias("lang"),
        _level(F.col("doc_id"), seen[2] or 0, seen[3] or 0).alias("id")).alias("at"))

    most = GROUP_SHARE * total / shards
    groups = levels.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        F.min(F.struct("doc_id", "at")).alias("first"))
    groups = materialize(groups.where("rows > 1"), "text-groups")
    # At most total / most groups are that large: the broadcast side is bounded by 20 rows a shard.
    large = groups.where(F.col("bytes") > most).select("text_key", F.lit(True).alias("is_large"))
    tagged = levels.join(F.broadcast(large), "text_key", "left")
    alone = F.xxhash64("doc_id", "text_key")
    tagged = tagged.withColumn("join_key", F.when(F.col("is_large"), alone).otherwise(F.col("text_key")))
    small = groups.where(F.col("bytes") <= most).select(
        F.col("text_key").alias("join_key"), F.col("first.at").alias("shared"))
    keyed = tagged.join(small, "join_key", "left")
    place = F.coalesce(F.when(F.col("is_large").isNull(), F.col("shared")), F.col("at"))
    keyed = keyed.withColumn("place", place).withColumn("tie", F.col("join_key").bitwiseAND(0xFFFFFFFF))

    def key(dimension: str) -> Column:
        return F.shiftleft(F.col(f"place.{dimension}"), 32).bitwiseOR(F.col("tie"))

    keyed = keyed.select("doc_id", "size", "text_crc32", key("size").alias("k_size"), key("source").alias("k_source"),
                         key("lang").alias("k_lang"), key("id").alias("k_id"))
    return materialize(keyed, "keyed-points"), total


def _root(keyed: DataFrame, shards: int) -> DataFrame:
    """The tree's table with its first row: a node becomes ``shards`` shards, numbered from ``node``."""
    return keyed.sparkSession.createDataFrame([(0, shards)], "node long, shards long")


def _with(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of the given nodes, with the nodes' columns; there are at most as many nodes as shards."""
    return rows.join(F.broadcast(nodes), "node")


def _widest(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node with rows: its widest dimension, the key range there and the bytes that go left."""
    ends = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
    seen = _with(rows, nodes).groupBy("node", "shards").agg(F.sum("size").alias("bytes"), *ends)

    def span(d: str) -> Column:
        return F.shiftright(f"high_{d}", 32) - F.shiftright(f"low_{d}", 32)

    # Ties: the id, then the first dimension of the list.
    best = F.array_max(F.array(*[F.struct(
        span(d).alias("span"), F.lit(len(DIMENSIONS) if d == "k_id" else -i).alias("order"),
        F.lit(d).alias("dimension"), F.col(f"low_{d}").alias("low"), F.col(f"high_{d}").alias("high"))
        for i, d in enumerate(DIMENSIONS)]))
    goal = F.col("bytes") * F.floor(F.col("shards") / 2) / F.col("shards")
    return (seen.withColumn("best", best)
            .select("node", "best.dimension", "best.low", "best.high", F.lit(0).cast("long").alias("before"),
                    goal.alias("goal")))


def _key_of(dimension: Column) -> Column:
    return F.coalesce(*[F.when(dimension == d, F.col(d)) for d in DIMENSIONS])


def _refined(rows: DataFrame, nodes: DataFrame, tolerance: float) -> DataFrame:
    """``nodes`` with the bin that holds the cut as the new range, or with the ``cut`` itself.

    A histogram has at most BINS bins a node; its running sums are taken node by node, and
    the bin where they reach the goal is the one row that is left of them.
    """
    key = _key_of(F.col("dimension"))
    # As doubles: the whole range has 63 bits. Bins stay ranges of keys in ascending order.
    width = F.ceil(((F.col("high") - F.col("low")).cast("double") + 1) / F.lit(BINS))
    inside = _with(rows, nodes).withColumn("key", key).where("key between low and high")
    bins = (inside.withColumn("bin", F.floor((F.col("key") - F.col("low")) / width))
            .groupBy("node", "dimension", "before", "goal", "bin")
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("first"), F.max("key").alias("last")))
    sums = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = bins.withColumn("upto", F.col("before") + F.sum("bytes").over(sums))
    # The first bin that reaches the goal, or the last of all if rounding leaves none.
    short = F.col("upto") < F.col("goal")
    chosen = reached.groupBy("node", "dimension", "goal").agg(F.min_by(
        F.struct("bytes", "first", "last", "upto"),
        F.struct(short, F.when(short, -F.col("bin")).otherwise(F.col("bin")))).alias("b"))
    before = F.col("b.upto") - F.col("b.bytes")
    small = (F.col("b.first") == F.col("b.last")) | (F.col("b.bytes") <= tolerance)
    takes = F.col("goal") - before >= F.col("b.bytes") / 2
    cut = F.when(small, F.when(takes, F.col("b.last")).otherwise(F.col("b.first") - 1))
    return chosen.select("node", "dimension", F.col("b.first").alias("low"), F.col("b.last").alias("high"),
                         before.alias("before"), "goal", cut.alias("cut"))


def _cuts(rows: DataFrame, nodes: DataFrame, tolerance: float) -> DataFrame:
    """(node, dimension, cut) of every node with rows: the key up to which they go left."""
    found, state = None, materialize(_widest(rows, nodes), "kd-nodes")
    while not state.isEmpty():
        turn = materialize(_refined(rows, state, tolerance), "kd-cuts")
        done = turn.where("cut is not null").select("node", "dimension", "cut")
        found = done if found is None else found.unionByName(done)
        state = turn.where("cut is null").drop("cut")
    return found if found is not None else state.select("node", "dimension", F.col("low").alias("cut"))


def kd_tree(keyed: DataFrame, total: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """Cut level by level until each leaf is one shard: the rows with their ``node``, and the tree.

    The tree is a table (node, shards, dimension, cut) of the nodes that were cut. Nodes,
    histograms and cuts stay tables: a plan is as small for 100,000 shards as for 40. The rows
    with their new nodes are written to the shared folder after each of the log2(shards) levels.
    """
    rows = keyed.withColumn("node", F.lit(0).cast("long"))
    nodes = _root(keyed, shards)
    tree = nodes.where("false").selectExpr("node", "shards", "'' as dimension", "node as cut")
    more = shards > 1 and total > 0
    while more:
        cuts = nodes.join(_cuts(rows, nodes, CUT_TOLERANCE * total / shards), "node")
        cuts = materialize(cuts.select("node", "shards", "dimension", "cut"), "kd-tree")
        half = F.floor(F.col("shards") / 2)
        goes_right = _key_of(F.col("dimension")) > F.col("cut")
        moved = F.when(goes_right, F.col("node") + half).otherwise(F.col("node"))
        rows = materialize(rows.join(F.broadcast(cuts), "node", "left").select(
            *keyed.columns, F.coalesce(moved, F.col("node")).alias("node")), "kd-level")
        tree = tree.unionByName(cuts)
        parts = F.explode(F.array(F.struct("node", half.alias("shards")),
                                  F.struct((F.col("node") + half).alias("node"), (F.col("shards") - half).alias("shards"))))
        nodes = cuts.select(parts.alias("part")).select("part.*").where("shards > 1")
        more = not nodes.isEmpty()
    return rows, tree


def with_slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is dealt into slices of about ``SLOT_ROWS`` rows; a row's slot is its
    place in its slice plus the rows of the slices before, so no task numbers a shard.
    """
    most = rows.groupBy("shard").count().agg(F.max("count")).scalar()
    slices = F.greatest(F.lit(1), F.ceil(most / F.lit(SLOT_ROWS)))
    sliced = rows.withColumn("slice", F.coalesce(F.pmod(F.xxhash64("doc_id", "text_crc32"), slices), F.lit(0)))
    counts = sliced.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32"))
    return (sliced.withColumn("place", place).join(offsets, ["shard", "slice"])
            .withColumn("slot", (F.col("before") + F.col("place") - 1).cast("long")).drop("slice", "place", "before"))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    ``target_bytes`` gives the shards' size, ``shards`` their number instead. Reads
    doc_id, text, source and lang.
    """
    if shards is None:
        bytes_all = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + ROW_OVERHEAD)).first()[0] or 0
        shards = max(1, -(-bytes_all // target_bytes))
    keyed, total = points(docs, shards)
    rows, _ = kd_tree(keyed, total, shards)
    return with_slots(rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard")))
