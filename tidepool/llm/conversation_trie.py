"""Conversation prefix trie with subtree totals by centroid decomposition.

Nodes: turns are numbered inside their conversation and every prefix gets a 128-bit key,
two polynomial hashes of SHA-256 halves of its turns. Both are running sums: rows are
range-partitioned by (conversation, place), summed inside each range, and the one
conversation that a range shares with those before it is mended from one carried row a
range (``in_order``), so a conversation with a third of all turns fills many tasks. Rows
of one key are a node, named (smallest member, depth).

Rollup: the parent-edge forest is split again and again. In a component the nodes with more
than half its mass (rows of members below them) are a path from the top; its last node is
the centroid, whose removal leaves parts of at most half the mass. What hangs below the
centroid is added up once for each component, and that total is added to the nodes between
centroid and top, so a node takes part in one sum a level and levels grow with the
logarithm of the mass, however deep the tree. Components above ``BOUND`` nodes are
split by Spark, all at once, level by level, each level written to the shared folder; the
others go whole to a task that splits them the same way in memory.

Whether a node lies below the centroid, and below which of its children, is looked up in
the paths (conversation, depth -> node), once for each conversation and component. Facts
of a component, conversation or node reach its rows by ``answer_by_key``, hot ones
broadcast. The digest of the conversations that end at a node is read from pieces of
``PIECE`` ids in order, so the node where a third of all conversations end sends a few
long strings to its task.

Defined cases: a null turn comes first, turns of equal number are ordered by the SHA-256
of role and text; a null role or text is empty; rows without a conv_id belong to no
conversation and are left out; a repeated row is a turn of its own; an empty table has no
node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import answer_by_key, materialize, powers

BOUND = 1000                                       # nodes of a component that one task splits
PIECE = 4096                                       # ids of a string of conversations that end at a node
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)   # odd multipliers of the two prefix hashes
NO_KEY = bytes(16)                                 # key of the empty prefix
VALUES = ("n_leaves", "saved_tokens")


def turn_keys(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """conv_id, place (turn number), turn_key (16 bytes of role and text) and n_bytes of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("place"),
        F.unhex(F.substring(whole, 1, 32)).alias("turn_key"), F.octet_length(text).cast("long").alias("n_bytes"))


def _running(conv: np.ndarray, lanes: np.ndarray, last: tuple[int, int, list[int]]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(depth, prefix sums of both lanes) of a batch of rows in order, going on from ``last``."""
    n = len(conv)
    begins = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
    depth = np.arange(n) - begins[group] + 1
    sums = np.empty((2, n), np.uint64)
    for lane, base in enumerate(BASES):
        up, _ = powers(base, n + 1)
        whole = np.concatenate(([np.uint64(0)], np.cumsum(lanes[lane] * up[depth], dtype=np.uint64)))
        sums[lane] = whole[1:] - whole[begins][group]
    if conv[0] == last[0]:
        end = begins[1] if len(begins) > 1 else n
        for lane, base in enumerate(BASES):
            shift = np.uint64(pow(base, last[1], 1 << 64))
            sums[lane, :end] = sums[lane, :end] * shift + np.uint64(last[2][lane])
        depth[:end] += last[1]
    return depth, sums, (int(conv[-1]), int(depth[-1]), [int(sums[0, -1]), int(sums[1, -1])])


def _key_column(sums: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(sums.T).astype("<u8").tobytes()
    offsets = np.arange(0, 16 * sums.shape[1] + 1, 16, dtype=np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), sums.shape[1], [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _lanes(keys: pa.Array) -> np.ndarray:
    raw = b"".join(keys.to_pylist())
    return np.frombuffer(raw, "<u8").reshape(-1, 2).T.astype(np.uint64)


def in_order(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), prefix (key of the turns up to this one), turn_key, n_bytes, by ``place`` in each conversation."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), (None, 0, [0, 0])
        for batch in batches:
            if batch.num_rows:
                conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
                depth, sums, last = _running(conv, _lanes(batch.column("turn_key")), last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id"), pa.array(np.full(len(conv), part)), pa.array(depth), _key_column(sums),
                     batch.column("turn_key"), batch.column("n_bytes")],
                    ["conv_id", "part", "depth", "prefix", "turn_key", "n_bytes"])

    order = ["conv_id", "place", "turn_key"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn_key", "n_bytes")
    local = materialize(ranged.mapInArrow(scan, "conv_id long, part long, depth long, prefix binary, turn_key binary, "
                                                "n_bytes long"), "turns")
    # Conversations are in order over the ranges, so each range shares at most one with those before it.
    edges = local.groupBy("part").agg(
        F.min(F.struct("conv_id", (-F.col("depth")).alias("depth"), "prefix")).alias("first"),
        F.max(F.struct("conv_id", "depth", "prefix")).alias("last")).orderBy("part").collect()
    carried, last = {}, (None, 0, [0, 0])
    for edge in edges:
        first = edge["first"]
        if first["conv_id"] == last[0]:
            carried[edge["part"]] = last
        for end, depth in ((first, -first["depth"]), (edge["last"], edge["last"]["depth"])):
            sums = np.frombuffer(end["prefix"], "<u8").tolist()
            if end["conv_id"] != last[0]:
                last = (end["conv_id"], depth, sums)
            elif end is first:
                last = (last[0], last[1] + depth, [
                    (s * pow(base, last[1], 1 << 64) + b) % (1 << 64) for s, b, base in zip(sums, last[2], BASES, strict=True)])
    sent = turns.sparkSession.sparkContext.broadcast(carried)      # at most one entry a range

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, depth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "part", "depth"))
            sums, depth = _lanes(batch.column("prefix")).copy(), depth.copy()
            for p in np.unique(part).tolist():
                if p in sent.value:
                    owner, before, base_sums = sent.value[p]
                    rows = (part == p) & (conv == owner)
                    for lane, base in enumerate(BASES):
                        shift = np.uint64(pow(base, before, 1 << 64))
                        sums[lane, rows] = sums[lane, rows] * shift + np.uint64(base_sums[lane])
                    depth[rows] += before
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(depth), _key_column(sums), batch.column("turn_key"), batch.column("n_bytes")],
                ["conv_id", "depth", "prefix", "turn_key", "n_bytes"])

    return local.mapInArrow(mend, "conv_id long, depth long, prefix binary, turn_key binary, n_bytes long")


def rebuilt(numbered: DataFrame, most: int = 8, every: int = 5) -> tuple[DataFrame, DataFrame]:
    """(turns, members): each conversation c with its first h turns from conversation c - c % ``every``.

    h = crc32(c) % (``most`` + 1); c's own turns from its h-th on follow. Members are all
    conversations, also those left without a turn.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    own = F.col("conv_id") % every == 0
    members = materialize(numbered.select("conv_id").distinct(), "members")
    heads = numbered.where(own & (F.col("depth") <= most)).select(
        F.col("conv_id").alias("base"), F.col("depth").alias("place"), "turn_key", "n_bytes")
    grafted = (members.where(~own).select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
               .join(heads, "base").where(F.col("place") <= F.col("h")).select("conv_id", "place", "turn_key", "n_bytes"))
    tails = numbered.where(own | (F.col("depth") > h)).select(
        "conv_id", (F.col("depth") + most).alias("place"), "turn_key", "n_bytes")
    return grafted.unionByName(tails), members


def split_in_memory(depths: list[int], parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree totals of each value by centroid decomposition; nodes by depth, ``parents`` -1 at the top."""
    n = len(depths)
    totals = [[0] * n for _ in values]
    top_of, parent = [0] * n, parents
    size, below = [0] * n, [list(v) for v in values]
    stack = [list(range(n))] if n else []
    while stack:
        nodes = stack.pop()
        if len(nodes) == 1:
            x = nodes[0]
            for t, v in zip(totals, values, strict=True):
                t[x] += v[x]
            continue
        top = nodes[0]
        for x in nodes:
            size[x] = 1
        for b, v in zip(below, values, strict=True):
            for x in nodes:
                b[x] = v[x]
        centroid = top
        for x in reversed(nodes):
            if x != top:
                size[parent[x]] += size[x]
                for b in below:
                    b[parent[x]] += b[x]
        for x in nodes:
            if 2 * size[x] > len(nodes):
                centroid = x                    # nodes come by depth: the last one is the deepest
        for t, b in zip(totals, below, strict=True):
            t[centroid] += b[centroid]
        x = centroid
        while x != top:
            x = parent[x]
            for t, b in zip(totals, below, strict=True):
                t[x] += b[centroid]
        parts: dict[int, list[int]] = {}
        top_of[top] = top
        for x in nodes:
            if x == centroid:
                top_of[x] = -1
                continue
            if x != top:
                up = top_of[parent[x]]
                top_of[x] = x if up == -1 else up
            parts.setdefault(top_of[x], []).append(x)
        stack.extend(parts.values())
    return totals


def finish_small(small: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """Totals of nodes whose whole component is among the rows; a component is held by one task, in turn."""
    columns = ["conv_id", "depth", *values]
    kinds = {f.name: f.dataType.simpleString() for f in small.schema.fields}

    def one(rows: list[tuple]) -> Iterator[tuple]:
        at = {r[:2]: i for i, r in enumerate(rows)}
        parents = [at.get((r[2], r[1] - 1), -1) for r in rows]
        totals = split_in_memory([r[1] for r in rows], parents, [[r[3 + j] for r in rows] for j in range(len(values))])
        for i, r in enumerate(rows):
            yield (*r[:2], *(t[i] + r[3 + len(values) + j] for j, t in enumerate(totals)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            out = []
            comps = zip(batch.column("top_conv").to_pylist(), batch.column("top_depth").to_pylist(), strict=True)
            rows = zip(*(batch.column(c).to_pylist() for c in
                         ("conv_id", "depth", "parent_conv", *values, *(f"acc_{v}" for v in values))), strict=True)
            for comp, row in zip(comps, rows, strict=True):
                if comp != last:
                    out.extend(one(held))
                    held, last = [], comp
                held.append(row)
            yield arrow(out)
        yield arrow(list(one(held)))

    def arrow(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(len(columns))], columns)

    ordered = (small.select("conv_id", "depth", "parent_conv", *values, *(f"acc_{v}" for v in values),
                            F.col("comp.conv_id").alias("top_conv"), F.col("comp.depth").alias("top_depth"))
               .repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth", "depth"))
    return ordered.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def rollup(nodes: DataFrame, paths: DataFrame, values: tuple[str, ...] = VALUES, bound: int = BOUND) -> DataFrame:
    """conv_id, depth and each value added up over the node's subtree.

    ``nodes``: conv_id, depth, parent_conv (null at the top), mass and ``values``; ``mass`` is
    that of the node and all below it. ``paths``: conv_id, depth, owner of every prefix.
    """
    top = nodes.where("parent_conv IS NULL").select(F.struct("conv_id", "depth")).scalar()
    level = nodes.select("conv_id", "depth", "parent_conv", "mass", *values,
                         *(F.lit(0).cast("long").alias(f"acc_{v}") for v in values), top.alias("comp"))
    done, small = [], []
    accs = [f"acc_{v}" for v in values]
    while True:
        level = materialize(level, "trie-level")
        columns = level.columns
        sizes = level.groupBy("comp").agg(F.count(F.lit(1)).alias("comp_size"), F.max("mass").alias("comp_mass"))
        sized = materialize(answer_by_key(level, materialize(sizes, "trie-sizes"), "comp", "comp_size"), "trie-sized")
        small.append(sized.where(F.col("comp_size") <= bound).select(columns))
        big = sized.where(F.col("comp_size") > bound)
        if big.isEmpty():
            break
        heavy = 2 * F.col("mass") > F.col("comp_mass")
        centroids = materialize(big.where(heavy).groupBy("comp").agg(
            F.max_by(F.struct("conv_id", "depth", "mass", *values, *accs), "depth").alias("x"),
            F.first("comp_size").alias("x_size")), "trie-centroids")
        known = answer_by_key(big, centroids, "comp", "x_size").withColumn(
            "is_x", (F.col("conv_id") == F.col("x.conv_id")) & (F.col("depth") == F.col("x.depth")))
        known = materialize(known.where(~F.col("is_x")).drop("is_x", "x_size"), "trie-known")
        # Below the centroid or beside it: where the conversation's path stands at the centroid's depth, and one deeper.
        deeper = F.col("depth") > F.col("x.depth")
        seg = F.struct("comp", "conv_id")
        asked = known.where(deeper).groupBy("comp", "conv_id").agg(
            F.first("x.conv_id").alias("x_conv"), F.first("x.depth").alias("x_depth"), F.count(F.lit(1)).alias("seg_size"))
        steps = asked.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
            "at_depth", F.col("x_depth") + F.col("step"))
        places = paths.select(F.col("conv_id").alias("path_conv"), F.col("depth").alias("path_depth"), "owner")
        found = steps.join(places, (F.col("conv_id") == F.col("path_conv")) & (F.col("at_depth") == F.col("path_depth")))
        told = found.groupBy("comp", "conv_id").agg(
            F.first("x_conv").alias("x_conv"), F.first("x_depth").alias("x_depth"), F.first("seg_size").alias("seg_size"),
            F.max(F.when(F.col("step") == 0, F.col("owner"))).alias("there"),
            F.max(F.when(F.col("step") == 1, F.col("owner"))).alias("child"))
        child = F.when(F.col("there") == F.col("x_conv"),
                       F.struct(F.col("child").alias("conv_id"), (F.col("x_depth") + 1).alias("depth")))
        told = materialize(told.select(seg.alias("seg"), child.alias("child"), "seg_size"), "trie-sides")
        sides = materialize(answer_by_key(known.where(deeper).withColumn("seg", seg), told, "seg", "seg_size")
                            .select(*known.columns, "child"), "trie-sided")
        under = sides.where("child IS NOT NULL")
        hung = under.groupBy("comp").agg(*(F.sum(v).alias(f"hung_{v}") for v in values))
        totals = centroids.join(hung, "comp", "left").select(
            "comp", "x", "x_size", *((F.col(f"x.{v}") + F.coalesce(f"hung_{v}", F.lit(0))).alias(f"sub_{v}") for v in values))
        totals = materialize(totals, "trie-totals")
        done.append(totals.select("x.conv_id", "x.depth", *((F.col(f"sub_{v}") + F.col(f"x.acc_{v}")).alias(v) for v in values)))
        above = heavy & (F.col("depth") < F.col("x.depth"))
        lifted = answer_by_key(known.where(above), totals.drop("x"), "comp", "x_size")
        for v in values:
            lifted = lifted.withColumn(f"acc_{v}", F.col(f"acc_{v}") + F.col(f"sub_{v}"))
        lifted = lifted.withColumn("mass", F.col("mass") - F.col("x.mass"))
        level = (under.withColumn("comp", F.col("child")).select(columns)
                 .unionByName(lifted.select(columns))
                 .unionByName(known.where(~deeper & ~above).select(columns))
                 .unionByName(sides.where("child IS NULL").select(columns)))
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    out = finish_small(rest, values)
    for more in done:
        out = out.unionByName(more)
    return out


def ends_digests(ends: DataFrame) -> DataFrame:
    """owner, depth and the SHA-256 of the comma-joined conv_ids of each group, in numerical order."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, depth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "depth"))
            text = pc.cast(batch.column("conv_id"), pa.string()).to_pylist()
            cuts = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])))
            out = [(int(owner[i]), int(depth[i]), j, min(j + PIECE, b)) for i, b in
                   zip(cuts, np.append(cuts[1:], len(owner)), strict=True) for j in range(i, b, PIECE)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 batch.column("conv_id").take(pa.array([o[2] for o in out], pa.int64())),
                 pa.array([",".join(text[a:b]) for _, _, a, b in out], pa.string())], ["owner", "depth", "conv_id", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ids")), strict=True):
                if (owner, depth) == last:
                    state.update(b"," + ids.encode())
                else:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = (owner, depth), hashlib.sha256(ids.encode())
            yield arrow(out)
        if last is not None:
            yield arrow([(*last, state.hexdigest())])

    def arrow(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                                          ["owner", "depth", "ends_sha256"])

    order = ["owner", "depth", "conv_id"]
    strings = (ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
               .mapInArrow(pieces, "owner long, depth long, conv_id long, ids string"))
    return (strings.repartition("owner", "depth").sortWithinPartitions(*order)
            .mapInArrow(digests, "owner long, depth long, ends_sha256 string"))


def trie(turns: DataFrame, members: DataFrame, bound: int = BOUND) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, place, turn_key, n_bytes); ``members`` holds all conv_ids."""
    root = members.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(NO_KEY).alias("prefix"),
                          F.lit(0).cast("long").alias("n_bytes"))
    prefixes = materialize(in_order(turns).drop("turn_key").unionByName(root), "prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("depth").alias("turns"), F.count(F.lit(1)).alias("n_rows"))
    prefixes = materialize(answer_by_key(prefixes, materialize(lengths, "lengths"), "conv_id", "n_rows"), "prefixes-left")
    left = F.col("turns") - F.col("depth") + 1
    keyed = materialize(prefixes.groupBy("prefix").agg(
        F.min("conv_id").alias("owner"), F.max("depth").alias("node_depth"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(left).alias("mass"), F.max("n_bytes").alias("last_bytes")), "nodes")
    paths = answer_by_key(prefixes.select("prefix", "conv_id", "depth", left.alias("left")),
                          keyed.select("prefix", "owner", "n_convs"), "prefix", "n_convs")
    paths = materialize(paths.select("conv_id", "depth", "left", "owner"), "paths")
    up = paths.select(F.col("conv_id").alias("own"), (F.col("depth") + 1).alias("node_depth"), F.col("owner").alias("parent_conv"))
    nodes = keyed.drop("prefix").withColumn("own", F.col("owner")).join(up, ["own", "node_depth"], "left")
    nodes = materialize(nodes.select(F.col("owner").alias("conv_id"), F.col("node_depth").alias("depth"), "parent_conv",
                                     "n_convs", "mass", "last_bytes"), "nodes-parents")
    children = nodes.where("parent_conv IS NOT NULL").groupBy(F.col("parent_conv").alias("conv_id"),
                                                              (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialize(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
                        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("last_bytes")), "nodes-children")
    totals = rollup(nodes, paths.select("conv_id", "depth", "owner"), VALUES, bound)
    ended = ends_digests(paths.where(F.col("left") == 1)).withColumnRenamed("owner", "conv_id")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.drop(*VALUES).join(totals, ["conv_id", "depth"]).join(ended, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", "parent_conv", "n_convs", "n_children", *VALUES,
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, bound: int = BOUND, **columns: str) -> DataFrame:
    """The prefix trie of ``conversations`` as they are."""
    keys = turn_keys(conversations, **columns)
    return trie(keys, keys.select("conv_id").distinct(), bound)
