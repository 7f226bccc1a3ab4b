import random
import re

import pytest

from conftest import SF_ORACLE
from llm_helpers import EDGE_ROWS, edge_docs, no_docs  # noqa: F401
from tidepool.llm import decontaminate as dec
from tidepool.llm.queries import op9_decontaminate


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def share(part, doc):
    w, d = tokens(part), tokens(doc)
    n = min(5, len(w))
    if not n:
        return 1.0
    found = {tuple(d[i:i + n]) for i in range(len(d) - n + 1)}
    wanted = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    return len(wanted & found) / len(wanted)


def leaks(docs, items):
    """Items whose question and answer both stand in a document, without any index."""
    out = set()
    for doc_id, text in docs:
        for item_id, item in items:
            if tokens(item):
                question, answer = dec.question_and_answer(item)
                if share(question, text) >= 0.8 and share(answer, text) >= 0.8:
                    out.add((doc_id, item_id))
    return out


def test_query_finds_what_brute_force_finds(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in op9_decontaminate(spark, SF_ORACLE).collect()}
    assert got == leaks(docs, items) and len(got) > 10


def vocabulary(rng, n):
    return [f"w{rng.randrange(n)}" for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_wand_retrieves_all_above_the_threshold(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randint(5, 30)))) for i in range(70)]
    index = dec.Index(items)
    text = " ".join(rng.choices([f"w{k}" for k in range(60)], k=400))
    words = dec.words_of_text(text)
    import numpy as np
    for threshold in (0.3, 0.5, 0.7):
        got = index.retrieve(words, np.array([0, len(words)]), threshold)
        want = {}
        for a in range(0, max(1, len(words) - dec.STRIDE), dec.STRIDE):
            terms = set(np.searchsorted(index.terms, [w for w in words[a:a + 2 * dec.STRIDE] if w in index.terms]))
            for b in range(index.blocks):
                scores = {}
                for t, postings in index.postings[b].items():
                    for piece, w in postings:
                        if t in terms:
                            scores[piece] = scores.get(piece, 0) + w
                for piece, s in scores.items():
                    if s >= threshold - 1e-6:
                        key = (0, int(index.item_of[piece]))
                        want[key] = max(want.get(key, 0), s)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


ITEM = "What is the large blue thing above us called. It is the sky of course my friend."
ITEMS = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "too short"), (5, "One single sentence of seven words here"),
         (6, " ".join(f"long{i}" for i in range(200)))]
BENCH = "item_id long, text string, doc_id long"


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(*i, 1) for i in ITEMS], BENCH)
    rows = [(1, "x " * 300 + ITEM.upper() + " y" * 100), (2, ITEM.split(".")[0]), (3, "one single sentence of seven words here!"),
            (4, None), (5, " ".join(f"long{i}" for i in range(200))), (5, " ".join(f"long{i}" for i in range(200))),
            (6, "too short"), (7, "It is the sky of course my friend")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in dec.contaminated(docs, bench).collect())
    assert got == [(1, 1), (1, 1), (3, 5), (5, 6), (5, 6), (6, 4)]
    assert sorted(r["doc_id"] for r in dec.drop_contaminated(docs, bench).collect()) == [2, 4, 7]
    assert dec.contaminated(no_docs, bench).count() == 0
    assert dec.contaminated(edge_docs, bench.limit(0)).count() == 0
    kept = dec.drop_contaminated(edge_docs, bench)
    assert kept.columns == edge_docs.columns and kept.count() == len(EDGE_ROWS)


def test_several_indexes_give_the_same(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where("doc_id < 300")
    whole = {tuple(r)[:2]: tuple(r)[2:] for r in dec.contaminated(docs, bench).collect()}
    monkeypatch.setattr(dec, "INDEX_WORDS", 500)
    assert len(list(dec.indexes(bench))) > 2
    got = {tuple(r)[:2]: tuple(r)[2:] for r in dec.contaminated(docs, bench).collect()}
    assert got.keys() == whole.keys() and whole
    assert all(got[k] == pytest.approx(whole[k]) for k in whole)      # scores do not depend on the dealing


def test_short_answers_retrieve_nothing_alone_and_torn_items_are_measured():
    """Of items scattered over a text in stretches of ever fewer words, recall against brute force."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(30)]
    items = [(i, " ".join(f"i{i}w{k}" for k in range(30)) + ". " + " ".join(rng.choices(common, k=2)) + ".") for i in range(40)]
    index = dec.Index(items)
    text = " ".join(rng.choices(common, k=2000))
    words = dec.words_of_text(text)
    import numpy as np
    assert index.retrieve(words, np.array([0, len(words)]), dec.THRESHOLD) == {}
    recall = {}
    for stretch in (30, 18, 12):
        found = want = 0
        for i, item in items:
            w = item.split()
            torn = " ".join(" ".join([*w[a:a + stretch], *rng.choices(common, k=200)]) for a in range(0, len(w), stretch))
            if share(item.split(". ")[0], torn) >= 0.8 and share(item.split(". ")[1], torn) >= 0.8:
                words = dec.words_of_text(torn)
                want += 1
                found += (0, i) in {h[:2] for h in index.hits(words, np.array([0, len(words)]))}
        recall[stretch] = found / want if want else None
    assert recall[30] == 1.0 and recall[18] in (None, 1.0)


def test_items_under_five_words_match_as_they_are():
    import numpy as np
    index = dec.Index([(1, "too short"), (2, "Yes."), (3, "four words are here"), (4, " . ")])
    for text, want in (("it is too short now", {0}), ("short too", set()), ("yes", {1}), ("four words here are", set()),
                       ("now four words are here", {2})):
        words = dec.words_of_text(text)
        assert {h[1] for h in index.hits(words, np.array([0, len(words)]))} == want


@pytest.mark.parametrize("gap", [0, 200, 1000])
def test_question_and_answer_apart_are_found(spark, gap):
    def named(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    parts = [(named(f"q{i}x", 20) + ".", named(f"a{i}x", n) + ".") for i, n in enumerate((20, 20, 30, 3))]
    bench = [(i, f"{q} {a}") for i, (q, a) in enumerate(parts)]
    docs = [(i, f"{named('before', 70)} {q} {named('between', gap)} {a} {named('after', 70)}")
            for i, (q, a) in enumerate(parts)] + [(9, f"{parts[0][0]} {named('between', 200)} {parts[1][1]}")]
    bench_rows = spark.createDataFrame(bench, "item_id long, text string")
    doc_rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dec.contaminated(doc_rows, bench_rows).collect()}
    assert got == leaks(docs, bench) == {(i, i) for i in range(4)}
    assert [r["doc_id"] for r in dec.drop_contaminated(doc_rows, bench_rows).collect()] == [9]


def test_block_maxima_of_a_long_text_are_summed_in_slices(monkeypatch):
    import tracemalloc

    import numpy as np
    rng = random.Random(3)
    index = dec.Index([(i, " ".join(rng.choices([f"w{k}" for k in range(3000)], k=60))) for i in range(600)])
    words = dec.words_of_text(" ".join(rng.choices([f"w{k}" for k in range(3000)], k=200_000)) + " " + index.items[7][1])
    first = np.array([0, len(words)])
    tracemalloc.start()
    got = index.retrieve(words, first, 0.6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (0, 7) in got and peak < 120 << 20
    for keys in (1, 1000, 1 << 40):
        monkeypatch.setattr(dec, "SUM_KEYS", keys)
        assert index.retrieve(words, first, 0.6) == got
