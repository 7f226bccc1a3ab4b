import zlib

import pandas as pd
import pytest

from conftest import SF_ORACLE
from llm_helpers import EDGE_ROWS, edge_docs, no_docs  # noqa: F401
from tidepool.llm import kd_shard
from tidepool.llm.queries import op4_kd_shards


def check(got: pd.DataFrame, shards: int):
    assert got["shard"].between(0, shards - 1).all()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").toPandas()
    got = op4_kd_shards(spark, SF_ORACLE).toPandas()
    check(got, 40)
    raw = docs.set_index("doc_id")["text"].map(lambda t: (t or "").encode())
    want = got["doc_id"].map(raw)
    assert (got["size"] == want.map(len) + 16).all()
    assert (got["text_crc32"] == want.map(zlib.crc32)).all()
    by_shard = got.groupby("shard")["size"].sum()
    assert len(by_shard) == 40
    assert by_shard.max() - by_shard.min() <= got["size"].max()
    assert got["grown_shard"].isna().all() and set(got["law"]) == {"bytes"}


def test_near_equal_with_a_hot_text_and_a_hot_source(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i} " + "x" * (i % 50), "en", "big" if i % 2 else "other")
            for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_shard.kd_shards(docs, shards=7).toPandas()
    check(got, 7)
    by_shard = got.groupby("shard")["size"].sum()
    assert by_shard.max() / by_shard.min() < 1.02


def test_small_groups_stay_whole(spark):
    rows = [(i, f"group {i // 2} " + "y" * 40, f"l{i % 3}", f"s{i % 5}") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_shard.kd_shards(docs, shards=5).toPandas()
    assert (got.groupby("text_crc32")["shard"].nunique() == 1).all()
    by_shard = got.groupby("shard")["size"].sum()
    assert by_shard.max() / by_shard.min() < 1.05


def test_target_bytes(spark, edge_docs):
    total = sum(len((r[1] or "").encode()) + 16 for r in EDGE_ROWS)
    got = kd_shard.kd_shards(edge_docs, target_bytes=total // 3 + 1).toPandas()
    check(got, 3)
    assert len(got) == len(EDGE_ROWS)


@pytest.mark.parametrize("shards", [1, 40])
def test_edges(spark, edge_docs, no_docs, shards):
    got = kd_shard.kd_shards(edge_docs, shards=shards).toPandas()
    check(got, shards)
    assert len(got) == len(EDGE_ROWS)
    assert kd_shard.kd_shards(no_docs, shards=shards).count() == 0


def test_slots_in_slices(spark, monkeypatch):
    monkeypatch.setattr(kd_shard, "SLOT_ROWS", 10)
    rows = spark.range(1000).selectExpr("id as doc_id", "id % 7 as text_crc32", "cast(id % 3 as int) as shard")
    check(kd_shard.with_slots(rows).toPandas(), 3)


def test_the_tree_is_that_of_a_plain_kd_tree(spark):
    """At every node: the widest dimension, and a cut at its weighted quantile up to the tolerance."""
    docs, shards = spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), 12
    keyed, total = kd_shard.points(docs, shards)
    placed, tree = kd_shard.kd_tree(keyed, total, shards)
    tree = {(r["node"], r["shards"]): r for r in tree.collect()}
    tolerance = kd_shard.CUT_TOLERANCE * total / shards
    cuts = []

    def visit(first, size, part):
        if size == 1:
            assert set(part["node"]) <= {first} and (first, size) not in tree
            return
        dimension, cut = tree[first, size]["dimension"], tree[first, size]["cut"]
        spans = {d: (part[d].max() >> 32) - (part[d].min() >> 32) for d in kd_shard.DIMENSIONS}
        assert spans[dimension] == max(spans.values())
        left = part[part[dimension] <= cut]
        goal = part["size"].sum() * (size // 2) / size
        running = part.groupby(dimension)["size"].sum().sort_index().cumsum()
        best = (running - goal).abs().min()
        assert abs(left["size"].sum() - goal) <= best + tolerance
        cuts.append(dimension)
        visit(first, size // 2, left)
        visit(first + size // 2, size - size // 2, part[part[dimension] > cut])

    visit(0, shards, placed.toPandas())
    assert len(cuts) == shards - 1 == len(tree) and len(set(cuts)) > 1


def test_many_shards_keep_a_small_plan(spark):
    """A level's plan does not grow with its nodes."""
    rows = [(i, "z" * (i % 90), f"l{i % 3}", f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    keyed, total = kd_shard.points(docs, 300)
    sizes = []
    for n in (4, 300):
        nodes = spark.range(n).selectExpr("id as node", "2L as shards")
        level = keyed.selectExpr("*", f"pmod(doc_id, {n}) as node")
        plan = kd_shard._widest(level, nodes)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.splitlines()))
        assert kd_shard._cuts(level, nodes, 0.0).count() == n
    assert sizes[0] == sizes[1]
    got = kd_shard.kd_shards(docs, shards=300).toPandas()
    check(got, 300)
    by_shard = got.groupby("shard")["size"].sum()
    assert by_shard.max() - by_shard.min() <= 3 * (90 + 16)
