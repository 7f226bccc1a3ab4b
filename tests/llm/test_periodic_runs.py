import hashlib
import random
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from llm_helpers import EDGE_ROWS, edge_docs, no_docs, words  # noqa: F401
from tidepool.llm import periodic_runs as pr
from tidepool.llm.queries import op12_periodic_runs


def plain_runs(w, shortest=12):
    """(start, length, period) of all runs, trying every period at every place."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(shortest, 2 * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((i, n, q) for (i, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def some_words(rng, n):
    """Random, Fibonacci, repeating and nearly doubling sequences over few words."""
    kind = rng.randrange(4)
    out = [0] if kind == 1 else []
    if kind == 0:
        return [rng.randint(0, rng.choice([1, 2, 3, 9])) for _ in range(n)]
    if kind == 1:
        out, longer = [0], [0, 1]
        while len(longer) < n:
            out, longer = longer, longer + out
        return longer[:n]
    while len(out) < n:
        if kind == 2:
            out += [rng.randint(0, 2) for _ in range(rng.randint(1, 9))] * rng.randint(1, 6)
        else:
            out = out + out + [rng.randint(0, 1) for _ in range(rng.randint(0, 2) or not out)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        shortest = rng.choice([2, 3, 5, 6, 7, 8, 12, 12, 13])
        texts = [some_words(rng, rng.randint(0, 90)) for _ in range(rng.randint(1, 6))]
        flat = np.array([x for w in texts for x in w], np.uint64)
        first = np.concatenate(([0], np.cumsum([len(w) for w in texts]))).astype(np.int64)
        want = [(i, *run) for i, w in enumerate(texts) for run in plain_runs(w, shortest)]
        assert list(map(tuple, pr.runs_of(flat, first, shortest).tolist())) == want


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        matrix = pr.WaveletMatrix(values)
        a = rng.integers(0, n, 200)
        b = rng.integers(a + 1, n + 1)
        x = rng.integers(0, n + 1, 200)
        below = matrix.below(a, b, x)
        assert below.tolist() == [int((values[i:j] < v).sum()) for i, j, v in zip(a, b, x, strict=True)]
        k = rng.integers(0, b - a)
        assert matrix.nth(a, b, k).tolist() == [int(np.sort(values[i:j])[m]) for i, j, m in zip(a, b, k, strict=True)]


def test_a_long_text_of_one_word_has_one_run():
    flat = np.zeros(200_000, np.uint64)
    assert pr.runs_of(flat, np.array([0, 200_000])).tolist() == [[0, 0, 200_000, 1]]


def test_edges(spark, edge_docs, no_docs):
    got = pr.collapse_runs(edge_docs).collect()
    assert len(got) == len(EDGE_ROWS)
    want = set()
    for r in EDGE_ROWS:
        w = words(r[1])
        runs = plain_runs(w) if len(w) < 1000 else []
        want.add((r[0], len(w), tuple(runs), collapsed(w, runs)))
    assert {(r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got} == want
    assert {len(r["runs"]) for r in got if r["doc_id"] in (14, 15)} == {1}
    assert pr.collapse_runs(no_docs).count() == 0


def test_query_is_what_brute_force_gives(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        w, h = words(text), zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = plain_runs(w)
        planted += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[doc_id]
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted > 10


def test_query_edges(spark, edge_docs, scratch):
    edge_docs.write.parquet(f"{scratch}/documents.parquet")
    got = op12_periodic_runs(spark, scratch).collect()
    assert len(got) == len(EDGE_ROWS)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["runs_sha256"] == r["collapsed_sha256"] == empty and r["start"] is None for r in got if r["doc_id"] in (1, 2, 3))
