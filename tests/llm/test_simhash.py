import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from llm_helpers import EDGE_ROWS, LONG, components, edge_docs, fingerprint, no_docs  # noqa: F401
from tidepool.llm import simhash
from tidepool.llm.common import materialize, text_buffer
from tidepool.llm.queries import op10_simhash


def test_fingerprints():
    texts = [r[1] for r in EDGE_ROWS] + [LONG[:5000].upper(), "A\tb\nc d " * 300]
    got = simhash.fingerprints_of(*text_buffer(pa.array(texts)))
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]


def near(values, bits):
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= bits]


def roots_of(spark, values, bits, **more):
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), bits, **more)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    return {v: roots.get(s[0], s[0]) for v, s in zip(values, signed, strict=True)}


def clustered(seed, n=150):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(5)] + [0, 2 ** 64 - 1]
    values = set(centres)
    while len(values) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(1, 6)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    return sorted(values)


@pytest.mark.parametrize("bits, bucket", [(3, 200), (3, 4), (0, 200)])
def test_links_find_every_component(spark, bits, bucket):
    values = clustered(bits)
    got = roots_of(spark, values, bits, bucket=bucket)
    want = components(values, near(values, bits))
    groups = lambda m: sorted(sorted(v for v in m if m[v] == r) for r in set(m.values()))
    assert groups(got) == groups(want)


@pytest.mark.parametrize("seed", [5, 6])
def test_huge_buckets_are_split_by_further_segments(spark, monkeypatch, seed):
    """One low half beside its neighbours, high halves in clusters: no pair of blocks sees a whole bucket."""
    rng = random.Random(seed)
    values = set()
    for centre in (rng.getrandbits(32) for _ in range(4)):
        while len(values) % 60 < 59:
            high, low = centre, 77
            for _ in range(rng.randint(0, 5)):
                high ^= 1 << rng.randrange(32)
            if rng.random() < 0.2:
                low ^= 1 << rng.randrange(32)
            values.add(high << 32 | low)
        values.add(centre << 32 | 77 ^ 1 << 40)
    values = sorted(values)
    seen = []
    plain = simhash._block_pairs
    monkeypatch.setattr(simhash, "_block_pairs", lambda *a: (seen.append(plain(*a)), seen[-1])[1])
    got = roots_of(spark, values, 3, bucket=4, huge=40, block=16)
    want = components(values, near(values, 3))
    groups = lambda m: sorted(sorted(v for v in m if m[v] == r) for r in set(m.values()))
    assert groups(got) == groups(want)
    compared = [len(p["sources"]) * len(p["members"]) for pairs in seen for p in pairs.collect()]
    assert len(seen) == 2 and sum(compared) < len(values) ** 2


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 4)


def test_star_edges():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 64, 12).astype(np.uint64))
    b = np.unique(rng.integers(0, 4096, 40).astype(np.uint64))
    x, y = simhash.star_edges(a, b, 1)
    nodes = sorted({*a.tolist(), *b.tolist()})
    true = [(i, j) for i in a.tolist() for j in b.tolist() if (i ^ j).bit_count() <= 1]
    assert components(nodes, zip(x.tolist(), y.tolist(), strict=True)) == components(nodes, true)


def test_long_chain(spark, monkeypatch):
    """Ids that grow along a chain: far fewer rounds than links."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(80)] + [(500, 400), (500, 300)], "a long, b long")
    rounds = []
    monkeypatch.setattr(simhash, "materialize", lambda df, name: (rounds.append(name), materialize(df, name))[1])
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert {got[i] for i in range(81)} == {0} and got[500] == got[400] == 300
    assert rounds.count("moves") < 20


def expected(rows):
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(fingerprint(text), []).append(doc_id)
    values = list(ids)
    root = components(values, near(values, 3))
    out = {}
    for v in values:
        members = [i for w in values if root[w] == root[v] for i in ids[w] if i is not None]
        out[v] = min(members) if members else None
    return sorted((str(i), f"{fingerprint(t):016x}", out[fingerprint(t)]) for i, t in rows)


def test_edges(spark, edge_docs, no_docs):
    got = simhash.simhash_groups(edge_docs).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0'))", "component_id")
    assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == expected([(r[0], r[1]) for r in EDGE_ROWS])
    assert simhash.simhash_groups(no_docs).count() == 0
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_one_of_each_group_stays(spark, edge_docs):
    got = simhash.drop_near_copies(edge_docs)
    assert got.columns == edge_docs.columns
    named = expected([(r[0], r[1]) for r in EDGE_ROWS])
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(
        {str(c) for _, _, c in named if c is not None} | {i for i, _, c in named if c is None})


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((str(r[0]), r[1], r[2]) for r in op10_simhash(spark, SF_SMALL).collect())
    assert got == expected([tuple(r) for r in docs])


def test_probes_of_a_small_bucket_beside_a_large_one_are_dealt_into_blocks(spark):
    from pyspark.sql import functions as F
    values = [(i << 32,) for i in range(400)] + [(i << 32 | 1,) for i in range(5)]
    distinct = materialize(spark.createDataFrame(values, "fp long"), "values")
    table = simhash._buckets(distinct)
    large = table.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 4 and bucket < 2")
    pairs = simhash._block_pairs(simhash._probes(distinct), table, large, 32).collect()
    assert max(max(len(p["sources"]), len(p["members"])) for p in pairs) < 100
    met = {(a, b) for p in pairs for a in p["sources"] for b in p["members"]}
    assert {(a, b) for (a,) in values for (b,) in values if b & 1} <= met
    assert {(a, b) for (a,) in values for (b,) in values if not a & 1 and not b & 1} <= met


def test_one_row_stays_where_ids_are_null_or_equal(spark):
    base = " ".join(f"w{i}" for i in range(200))
    near = [base, base + " end", "start " + base]
    assert len({fingerprint(t) for t in near}) > 1
    rows = [(None, t, "nulls") for t in near] + [(7, t.replace("w", "v"), "equal") for t in near]
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, group string"), bits=3).collect()
    plain = {t: fingerprint(t) for _, t, _ in rows}
    for group in ("nulls", "equal"):
        fps = sorted({plain[t] for _, t, g in rows if g == group})
        near_pairs = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
        assert len([r for r in got if r["group"] == group]) == len(set(components(fps, near_pairs).values()))
