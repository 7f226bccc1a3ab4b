import hashlib
import random

import pytest

from conftest import SF_SMALL
from llm_helpers import EDGE_ROWS, edge_docs, no_docs, repeats_removed  # noqa: F401
from tidepool.llm import substring_dedup
from tidepool.llm.queries import op5_substring_dedup


def compare(df, rows, window, **more):
    got = substring_dedup.remove_repeats(df, window=window, **more).collect()
    want = repeats_removed([t for _, t in rows], window)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == sorted(
        (str(i), *w) for (i, _), w in zip(rows, want, strict=True))
    for r in got:
        assert sum(s["last"] - s["first"] for s in r["spans"]) == r["n_removed"]
        assert all(a["last"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


@pytest.mark.parametrize("window", [1, 3, 35])
def test_edges(spark, edge_docs, window):
    compare(edge_docs, [(r[0], r[1]) for r in EDGE_ROWS], window)


def test_empty(spark, no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_over_many_blocks(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(20)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"), rows, 8, block_bytes=200, group_bytes=300)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = repeats_removed([r["text"] for r in docs], 35)
    got = {tuple(r) for r in op5_substring_dedup(spark, SF_SMALL).collect()}
    assert got == {(d["doc_id"], n, gone, hashlib.sha256(kept.encode()).hexdigest())
                   for d, (n, gone, kept) in zip(docs, want, strict=True)}


def test_rows_that_repeat_wholly_travel_once(spark, monkeypatch):
    """2,000 equal rows: the block that has them gets one row with their number."""
    text = " ".join(f"w{i % 40}" for i in range(60))
    rows = [(1, text)] * 2000 + [(None, text)] * 3 + [(2, "left " + text), (3, "a b c")] + [(4, "d e f g h")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    compare(df, rows, 5)
    batches = substring_dedup.once_a_batch(df.selectExpr("doc_id", "text", "xxhash64(text) as text_key"))
    sent = batches.collect()
    assert len(sent) <= 4 * 5 and sum(r["n"] for r in sent) == len(rows)


def test_the_sum_needs_no_shuffle_of_its_own(spark):
    """Texts cross the network once: one exchange by block, read by both groupings."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = substring_dedup.remove_repeats(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    by_text = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "text" in x]
    assert not by_text, by_text
