import math

import pytest
from pyspark.sql import functions as F

from llm_helpers import EDGE_ROWS, edge_docs, no_docs, sorted_rows, words  # noqa: F401
from tidepool.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets of sources in order: the excess of capped ones is shared again until none is above."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        above = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not above:
            return out | {s: level * w[s] for s in open_}
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def checked(rows, got):
    """Every promise of the mix that rows (doc_id, text, source) allow to check."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = plain_targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"], str(r["source"])) for r in got) == sorted(
        (str(i), len(words(t)), str(s)) for i, t, s in rows)
    for source, target in want.items():
        own = [r for r in got if r["source"] == source]
        assert all(r["target"] == pytest.approx(target) and r["source_size"] == sizes[source] for r in own)
        whole = math.floor(target / sizes[source]) if sizes[source] else 0
        assert all(whole <= r["copies"] <= min(2, whole + 1) and r["taken"] == r["copies"] * r["size"] for r in own)
        left = [r["size"] for r in own if r["copies"] == whole and r["size"]]
        off = abs(sum(r["taken"] for r in own) - target)
        assert off <= max(left, default=0) / 2 + 1e-6, (source, off)
    return want


def test_edges(spark, edge_docs, no_docs):
    rows = [(r[0], r[1], r[3]) for r in EDGE_ROWS]
    got = mixing.mix(edge_docs).collect()
    checked(rows, got)
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(no_docs).columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]
    assert {r["taken"] for r in got if not r["size"]} == {0}


def test_hot_source_over_many_ranges(spark):
    """One source holds most rows and is summed over several ranges; another is too small for its share."""
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.array_join(F.array_repeat(F.lit("w"), (F.hash("id") % 40 + 40).cast("int")), " ").alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 == 0, "small").otherwise(F.lit(None)).alias("source"))
    plain = [tuple(r) for r in rows.collect()]
    got = mixing.mix(rows).collect()
    want = checked(plain, got)
    for source, target in want.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == source) - target) <= 1
    again = mixing.mix(rows.repartition(13, F.rand(5)))
    assert sorted(map(tuple, got), key=repr) == sorted_rows(again)


def test_rows_that_agree_are_taken_one_by_one(spark):
    rows = [(None, "a b c", "x")] * 300 + [(1, "a b c", "x")] * 300 + [(i, "a b", "y") for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = checked(rows, got)
    assert abs(sum(r["taken"] for r in got if r["source"] == "x") - want["x"]) <= 1.5


def test_long_documents_are_likelier_and_shares_follow_the_rates(spark):
    """Inclusion of a class of b-bit sizes is near min(1, c * b), as Pareto sampling promises."""
    rows = spark.range(8000).select(
        F.col("id").alias("doc_id"), F.array_join(F.array_repeat(F.lit("w"), F.when(F.col("id") % 2 == 0, 3).otherwise(200)), " ")
        .alias("text"), F.when(F.col("id") % 4 < 2, "a").otherwise("b").alias("source"))
    got = mixing.mix(rows).where("source = 'b'").collect()
    whole = min(r["copies"] for r in got)
    short = [r["copies"] - whole for r in got if r["size"] == 3]
    long = [r["copies"] - whole for r in got if r["size"] == 200]
    extra = got[0]["target"] - whole * got[0]["source_size"]
    c = extra / (3 * len(short) * 2 + 200 * len(long) * 8)
    assert sum(short) / len(short) == pytest.approx(min(1, 2 * c), abs=0.05)
    assert sum(long) / len(long) == pytest.approx(min(1, 8 * c), abs=0.05)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, None: 30}, {"": 5, "a": 0, "b": 7, "z": 90},
                                   {"only": 12}])
def test_targets(spark, sizes):
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sized).collect()}
    assert got == {s: pytest.approx(t) for s, t in plain_targets(sizes).items()}


def test_no_python_in_the_plan(spark, edge_docs):
    plan = mixing.mix(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ScalaUDF" not in plan
