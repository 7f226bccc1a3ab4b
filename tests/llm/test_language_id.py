import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_ORACLE
from llm_helpers import edge_docs, no_docs  # noqa: F401
from tidepool.llm import language_id as lid
from tidepool.llm.common import text_buffer
from tidepool.llm.queries import op3_language_id

import pyarrow as pa

TEXTS = {"en": ["the cat sat on the mat", "The dog; and the cat"], "de": ["der Hund und die Katze", "das ist der Hund"]}


def grams_of(text):
    found, first = lid.symbol_runs(*text_buffer(pa.array([text])))
    return found.tolist()


def brute_model(texts):
    """Probability of a symbol after a context, by recursion over the counts."""
    counts = Counter()
    for t in texts:
        s = [0] * (lid.ORDER - 1) + grams_of(t)
        counts.update(tuple(s[i:i + lid.ORDER]) for i in range(len(s) - lid.ORDER + 1))
    tables = [counts]
    for _ in range(lid.ORDER - 1):
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables = tables[::-1]
    by_context = []
    for table in tables:
        sums, types = defaultdict(int), defaultdict(int)
        for g, n in table.items():
            sums[g[:-1]] += n
            types[g[:-1]] += 1
        ones, twos = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        by_context.append((sums, types, min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))))

    def p(gram):
        if not gram:
            return 1 / lid.SYMBOLS
        sums, types, cut = by_context[len(gram) - 1]
        h = gram[:-1]
        if h not in sums:
            return p(gram[1:])
        return max(tables[len(gram) - 1][gram] - cut, 0) / sums[h] + cut * types[h] / sums[h] * p(gram[1:])

    return p


def small_model():
    langs = sorted(TEXTS)
    keys, counts = [], []
    for lang in langs:
        found, first = lid.symbol_runs(*text_buffer(pa.array(TEXTS[lang])))
        k, n = np.unique(lid.gram_keys(found, first), return_counts=True)
        keys.append(k)
        counts.append(n)
    return lid.build(langs, keys, counts)


@pytest.mark.parametrize("text", ["the cat", "die Maus", "q", "das Haus 12 the", "zzz üüü"])
def test_cross_entropy_equals_recursion(text):
    model = small_model()
    got = lid.cross_entropies(model, *lid.symbol_runs(*text_buffer(pa.array([text]))))[0]
    s = [0] * (lid.ORDER - 1) + grams_of(text)
    for j, lang in enumerate(model.languages):
        p = brute_model(TEXTS[lang])
        logs = [math.log(p(tuple(s[i:i + lid.ORDER]))) for i in range(len(s) - lid.ORDER + 1)]
        assert got[j] == pytest.approx(-sum(logs) / len(logs), rel=1e-4)


def test_probabilities_sum_to_one():
    p = brute_model(TEXTS["en"])
    context = tuple(grams_of("the")[-4:])
    assert sum(p((*context, c)) for c in range(lid.SYMBOLS)) == pytest.approx(1)


def test_symbols():
    assert grams_of("Ab, c") == [ord("a"), ord("b"), 0, ord("c")]
    assert grams_of("12 !? ") == [] and grams_of("") == []


def test_counts_on_spark(spark):
    rows = [(t, lang) for lang, ts in TEXTS.items() for t in ts] * 3 + [(None, "en"), ("abc", None), ("", "en")]
    got = {(r["lang"], r["gram"]): r["n"]
           for r in lid.gram_counts(spark.createDataFrame(rows, "text string, lang string")).collect()}
    want = Counter()
    for lang, ts in TEXTS.items():
        found, first = lid.symbol_runs(*text_buffer(pa.array(ts * 3)))
        want.update((lang, int(k)) for k in lid.gram_keys(found, first))
    assert got == dict(want)


def test_edges(spark, edge_docs, no_docs):
    got = {r["doc_id"]: r for r in lid.identify(edge_docs, lid.fit(edge_docs)).where("doc_id < 13").collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0.0 and got[i]["rejected"] for i in (1, 2, 3, 4))
    assert got[12]["lang_pred"] in ("en", "de") and 0 <= got[12]["score"] <= 1
    assert lid.identify(edge_docs, lid.fit(edge_docs)).count() == edge_docs.count()
    assert lid.fit(no_docs) is None
    assert lid.identify(no_docs, small_model()).count() == 0
    assert {r["lang_pred"] for r in lid.identify(edge_docs, None).collect()} == {"und"}


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    got = op3_language_id(spark, SF_ORACLE).join(truth, "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["rejected"].mean() < 0.1


def test_other_alphabet_is_rejected(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = lid.fit(docs)
    odd = spark.createDataFrame([(1, "Привет как дела сегодня хорошо"), (2, "zzxq wkj vvq")], "doc_id long, text string")
    assert all(r["rejected"] for r in lid.identify(odd, model).collect())


@pytest.mark.parametrize("slice_bytes, resident", [(lid.SLICE_BYTES, lid.RESIDENT_BYTES), (1 << 21, 0)])
def test_every_gram_of_a_large_corpus_is_kept(spark, monkeypatch, slice_bytes, resident):
    monkeypatch.setattr(lid, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(lid, "RESIDENT_BYTES", resident)
    rng = np.random.default_rng(1)
    texts = {lang: ["".join(map(chr, rng.choice(np.arange(97, 123), 60_000, p=p))) for _ in range(5)]
             for lang, p in (("aa", None), ("bb", np.arange(1, 27) / 351))}
    aside = {r["id"]: r["aside"] for r in spark.range(200).selectExpr(
        "id", "pmod(xxhash64(id), 1073741824) < 107374182 as aside").collect()}
    counted_ids = iter(i for i, x in aside.items() if not x)
    rows = [(next(counted_ids), t, lang) for lang, ts in texts.items() for t in ts]
    other = (next(i for i, x in aside.items() if x), rows[0][1], "aa")
    model = lid.fit(spark.createDataFrame([*rows, other], "doc_id long, text string, lang string"))
    counted = [np.unique(lid.gram_keys(*lid.symbol_runs(*text_buffer(pa.array(ts)))), return_counts=True)
               for ts in texts.values()]
    want = lid.build(sorted(texts), [k for k, _ in counted], [n for _, n in counted])
    assert sum(len(k) for k, _ in counted) > 400_000
    for got, table in zip((*model.grams, *model.contexts), (*want.grams, *want.contexts), strict=True):
        parts = [s.load() for s in got]
        assert np.array_equal(np.concatenate([t.keys for t in parts]), table[0].table.keys)
        assert np.allclose(np.concatenate([t.values for t in parts]), table[0].table.values, atol=1e-4)
    assert (len(model.grams[-1]) > 3 and not model.grams[-1][0].resident) == (resident == 0)
    docs = [(i, t[:3000] + "unseen words") for i, (_, t, _) in enumerate(rows)]
    found = lid.identify(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()
    h = lid.cross_entropies(want, *lid.symbol_runs(*text_buffer(pa.array([t for _, t in docs])))).min(1)
    assert len(found) == len(docs)
    assert all(r["entropy"] == pytest.approx(h[r["doc_id"]], rel=1e-4) for r in found)
