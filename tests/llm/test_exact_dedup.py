import hashlib
import re

import pytest

from llm_helpers import EDGE_ROWS, edge_docs, no_docs  # noqa: F401
from tidepool.llm import exact_dedup


def normal(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(normal(r[1]), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    return {t: (min(g)[3], len(g)) for t, g in groups.items()}


def test_edges(spark, edge_docs):
    got = exact_dedup.exact_dedup(edge_docs, exact_dedup.fresh_index(spark), "edges").collect()
    want = expected(EDGE_ROWS)
    by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in want.items()}
    assert len(got) == len(EDGE_ROWS)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by_digest[bytes(r["digest"])]
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(want) == len({bytes(r["digest"]) for r in kept})


def test_empty(spark, no_docs):
    index = exact_dedup.fresh_index(spark)
    assert exact_dedup.exact_dedup(no_docs, index, "none").count() == 0
    assert exact_dedup.drop_copies(no_docs, exact_dedup.fresh_index(spark), "none").count() == 0
    assert index.read().count() == 0


def test_rows_that_stay(spark, edge_docs):
    got = exact_dedup.drop_copies(edge_docs, exact_dedup.fresh_index(spark), "edges")
    assert got.columns == edge_docs.columns
    rows = got.collect()
    assert sorted(normal(r["text"]) for r in rows) == sorted(expected(EDGE_ROWS))
    assert {r["row"] for r in rows} == {"y"}


def test_later_batches_meet_the_index(spark):
    index = exact_dedup.fresh_index(spark, buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    exact_dedup.exact_dedup(frame([(1, "a b"), (2, "ab"), (3, "c")]), index, "first").collect()
    second = frame([(4, "a  b"), (5, "d"), (6, " d "), (7, "c")])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"])
           for r in exact_dedup.exact_dedup(second, index, "second").collect()}
    assert got == {4: (None, 1, False), 5: (6, 2, False), 6: (6, 2, True), 7: (None, 1, False)}
    assert index.read().count() == 3
    index.compact()
    assert index.read().count() == 3
    third = exact_dedup.exact_dedup(frame([(8, "d"), (9, "e")]), index, "third").where("kept").collect()
    assert [r["doc_id"] for r in third] == [9]


def test_index_side_needs_no_shuffle(spark):
    index = exact_dedup.fresh_index(spark, buckets=8)
    batch = exact_dedup.representatives(exact_dedup.digests(
        spark.createDataFrame([(1, "a")], "doc_id long, text string")))
    index.append(batch, "0")
    plan = index.new_of(batch, "1")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


def test_plan_has_no_python(spark, edge_docs):
    plan = exact_dedup.exact_dedup(edge_docs, exact_dedup.fresh_index(spark), "edges")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def answers(df):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect())


def test_a_batch_run_again_gives_the_same_answer(spark):
    """Before its append, after it, and after an append that wrote a part of its rows."""
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = exact_dedup.fresh_index(spark, buckets=4)
    exact_dedup.exact_dedup(frame([(1, "a")]), index, "first").collect()
    second = frame([(2, "a"), (3, "b"), (4, "b "), (5, "c")])
    want = [(2, None, 1, False), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True)]
    for _ in range(2):
        assert answers(exact_dedup.exact_dedup(second, index, "second")) == want
        assert index.read().count() == 3
    half = exact_dedup.fresh_index(spark, buckets=4)
    exact_dedup.exact_dedup(frame([(1, "a")]), half, "first").collect()
    rows = index.read().where("batch = 'second'").limit(1)
    half._write(rows.select(half.read().columns), half.name, half.path)
    assert answers(exact_dedup.exact_dedup(second, half, "second")) == want
    assert half.read().count() == 3


def test_batch_names_are_checked(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = exact_dedup.fresh_index(spark, buckets=2)
    exact_dedup.exact_dedup(frame([(1, "a")]), index, "one").collect()
    for name in (None, ""):
        with pytest.raises(ValueError, match="name"):
            exact_dedup.exact_dedup(frame([(1, "a")]), index, name)
    with pytest.raises(ValueError, match="taken"):
        exact_dedup.exact_dedup(frame([(2, "b")]), index, "one")


def test_a_first_batch_is_joined_with_the_empty_index(spark):
    index = exact_dedup.fresh_index(spark, buckets=4)
    groups = exact_dedup.representatives(exact_dedup.digests(spark.createDataFrame([(1, "a")], "doc_id long, text string")))
    index.create(groups)
    assert index.read().count() == 0
    assert "LeftAnti" in index.new_of(groups, "x")._jdf.queryExecution().optimizedPlan().toString()
