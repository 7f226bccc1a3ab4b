import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from llm_helpers import EDGE_ROWS, edge_docs, no_docs  # noqa: F401
from tidepool.llm import toxicity
from tidepool.llm.queries import op6_toxicity


def labelled(spark, n=240):
    bad = ["idiot", "scum", "moron"]
    rows = [(i, " ".join([f"w{i * 7 % 41}", f"v{i * 3 % 29}", "the", bad[i % 3] if i % 4 == 0 else "friend",
                          f"u{i % 13}"]), "en" if i % 2 else "de") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(*labelled(spark))


def test_separates_and_keeps_columns(spark, model):
    docs, labels = labelled(spark)
    got = toxicity.score(docs, model).join(labels.withColumnRenamed("toxic", "truth"), "doc_id").toPandas()
    assert ((got["score"] >= 0.5) == (got["truth"] == 1)).mean() > 0.98
    clean = toxicity.score(docs, model, keep_clean=True)
    assert clean.columns == docs.columns
    assert clean.count() == (~got["toxic"]).sum()


def test_score_ignores_language(spark, model):
    rows = [(i, "you idiot", lang) for i, lang in enumerate(["en", "de", None, "xx"])]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert len({r["score"] for r in got}) == 1


def test_edges(spark, edge_docs, no_docs, model):
    got = toxicity.score(edge_docs, model)
    assert got.columns == [*(c for c in edge_docs.columns if c != "score"), "score", "toxic"]
    rows = got.collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1
    assert toxicity.score(no_docs, model).count() == 0


@pytest.mark.parametrize("label", [None, 0, 1])
def test_without_both_labels(spark, edge_docs, label):
    labels = spark.createDataFrame([] if label is None else [(5, label), (6, label)], "doc_id long, toxic int")
    got = toxicity.score(edge_docs, toxicity.fit(edge_docs, labels)).collect()
    assert all(abs(r["score"] - (label or 0)) < 1e-9 for r in got)


def test_numeric_gradients():
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(0, 1, (toxicity.PADDING + 1, toxicity.WIDTH)),
                           [rng.normal(0, 1, (s * toxicity.WIDTH, toxicity.FILTERS)) for s in toxicity.SPANS],
                           [rng.normal(0, 1, toxicity.FILTERS) for _ in toxicity.SPANS],
                           rng.normal(0, 1, 3 * toxicity.FILTERS), 0.3, 1.0, 0.0, {None: 0.5})
    model.embedding[toxicity.PADDING] = 0
    words = rng.integers(0, 2 * toxicity.BUCKETS, (9, 2)).astype(np.int32)
    words, first = toxicity.padded(words, np.array([0, 4, 4, 9]))
    labels, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss(m):
        p = toxicity.sigmoid(m.logits(words, first))
        return -(weight * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).mean()

    grads, touched, rows = toxicity._gradients(model, words, first, labels, weight)
    step = 1e-5
    for params, grad in [(model.filters[1], grads[1] - toxicity.DECAY * model.filters[1]),
                         (model.biases[2], grads[5]), (model.weights, grads[6])]:
        at = tuple(rng.integers(0, n) for n in params.shape)
        params[at] += step
        up = loss(model)
        params[at] -= 2 * step
        down = loss(model)
        params[at] += step
        assert (up - down) / (2 * step) == pytest.approx(grad[at], rel=1e-2, abs=1e-6)
    known = np.flatnonzero(touched != toxicity.PADDING)
    row = int(known[np.abs(rows[known]).sum(1).argmax()])
    model.embedding[touched[row], 0] += step
    up = loss(model)
    model.embedding[touched[row], 0] -= 2 * step
    assert (up - loss(model)) / (2 * step) == pytest.approx(rows[row, 0], rel=1e-2, abs=1e-6)


def test_held_out_documents(spark):
    truth = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").select("doc_id", "toxic")
    got = op6_toxicity(spark, SF_ORACLE).drop("toxic").join(truth, "doc_id").where("held_out").toPandas()
    clean, toxic = got[got["toxic"] == 0], got[got["toxic"] == 1]
    assert clean["predicted"].mean() < 0.05
    assert toxic["score"].mean() > 3 * clean["score"].mean()


def test_the_word_bound_is_a_draw_by_hash_that_keeps_both_labels(spark, monkeypatch):
    """Long texts of one label come first in the files; both labels and late ids are still learned from."""
    monkeypatch.setattr(toxicity, "TRAIN_WORDS", 4000)
    rows = [(i, ("bad " if i < 200 else "good ") * 100, "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartitionByRange(4, "doc_id")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id long, toxic int")
    texts, marks, _ = toxicity.training_sample(docs, labels)
    assert sorted(marks.tolist()) == [0] * 20 + [1] * 20
    assert sum(len(t) for t in texts) <= 4000
    longer = docs.union(spark.createDataFrame([(1000, "bad " * 5000, "en")], docs.schema))
    more = labels.union(spark.createDataFrame([(1000, 1)], labels.schema))
    assert max(len(t) for t in toxicity.training_sample(longer, more)[0]) == 100


def test_repeated_labels_count_as_often_as_they_occur(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, "c", "en"), (None, "d", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 0), (3, None)], "doc_id long, toxic int")
    texts, marks, _ = toxicity.training_sample(docs, labels)
    assert sorted((len(t), y) for t, y in zip(texts, marks.tolist(), strict=True)) == [(1, 0), (2, 1), (2, 1)]


def plain_bucket(data):
    """Polynomial hash modulo 2**64 of the bytes, mixed, modulo the number of buckets."""
    h = sum((b + 1) * pow(toxicity.BYTE_BASE, i, 1 << 64) for i, b in enumerate(data)) % (1 << 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        h = (h ^ h >> shift) * factor % (1 << 64)
    return h % toxicity.BUCKETS


def plain_score(model, text):
    """Words, their vectors, every filter at every window, the largest answer, the logistic layer: one by one."""
    import re
    folded = re.sub(b"[A-Z]", lambda m: m[0].lower(), text.encode())
    vectors = [model.embedding[plain_bucket(w)] + model.embedding[toxicity.BUCKETS + plain_bucket(w[:toxicity.BEGINNING])]
               for w in re.findall(rb"[0-9a-z\x80-\xff]+", folded)]
    windows = max(1, len(vectors))
    vectors += [2 * model.embedding[toxicity.PADDING]] * (windows - len(vectors) + toxicity.SPANS[-1] - 1)
    pooled = []
    for span, filters, biases in zip(toxicity.SPANS, model.filters, model.biases, strict=True):
        for f in range(toxicity.FILTERS):
            answers = [np.concatenate(vectors[i:i + span]) @ filters[:, f] for i in range(windows)]
            pooled.append(max(0.0, max(answers) + biases[f]))
    logit = np.dot(pooled, model.weights) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.scale * logit + model.shift, -30, 30)))


def test_scores_are_those_of_a_plain_forward_pass(model):
    texts = ["", "you idiot", "the friend of w7 v3 u1", "Ä scum!! é", "moron " * 50 + "x", "a"]
    data = "".join(texts).encode()
    at = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = model.scores(*toxicity.padded(*toxicity.bucket_words(np.frombuffer(data, np.uint8), at)))
    assert got == pytest.approx([plain_score(model, t) for t in texts], abs=1e-4)


def test_thresholds_by_language_are_of_best_f1(monkeypatch):
    monkeypatch.setattr(toxicity, "LANGUAGE_TEXTS", 20)
    rng = np.random.default_rng(2)
    languages = ["en"] * 200 + ["de"] * 200 + ["xx"] * 10 + [None] * 10
    labels = rng.integers(0, 2, len(languages))
    # German scores are shifted, so one threshold for all would serve neither language.
    scores = np.clip(0.3 + 0.2 * labels + rng.normal(0, 0.08, len(labels)) + 0.3 * np.array([x == "de" for x in languages]), 0, 1)
    found = toxicity._thresholds(scores, labels, languages)
    assert set(found) == {None, "en", "de"} and found["de"] - found["en"] > 0.15

    def f1(mask, limit):
        hit = (scores[mask] >= limit) & (labels[mask] == 1)
        return 2 * hit.sum() / ((scores[mask] >= limit).sum() + labels[mask].sum())

    for language, limit in found.items():
        mask = np.array([language is None or x == language for x in languages])
        assert f1(mask, limit) == pytest.approx(max(f1(mask, s) for s in scores[mask]))


def test_all_labelled_texts_are_learned_from(spark, monkeypatch):
    """A word of a few texts is known although it is rarer than any sample would show; groups and reruns agree."""
    for name, value in (("TRAIN_TEXTS", 20), ("TRAIN_WORDS", 400), ("GROUP_TEXTS", 50), ("EPOCHS", 2), ("LEAST_STEPS", 60)):
        monkeypatch.setattr(toxicity, name, value, raising=False)
    docs, labels = labelled(spark, 400)
    rare = docs.withColumn("text", F.when(F.col("doc_id") % 80 == 8, F.concat("text", F.lit(" rare")))
                           .otherwise(F.col("text")))
    model = toxicity.fit(rare, labels)
    assert model.embedding[plain_bucket(b"rare")].any()
    again = toxicity.fit(rare.repartition(7, "text"), labels)
    assert (model.embedding == again.embedding).all() and (model.weights == again.weights).all()
    assert model[4:] == again[4:]
    got = toxicity.score(docs, model).join(labels.withColumnRenamed("toxic", "truth"), "doc_id").toPandas()
    assert ((got["score"] >= 0.5) == (got["truth"] == 1)).mean() > 0.98


def test_groups_hold_every_labelled_row_once(spark, monkeypatch):
    """Repeated labels and many equal rows included; a group that outgrows its bound becomes several."""
    monkeypatch.setattr(toxicity, "GROUP_TEXTS", 10)
    docs = spark.createDataFrame([(1, "a b", "en")] * 50 + [(2, "c", None), (3, None, "de")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled_texts(docs, labels).withColumn("held", F.lit(None).cast("boolean"))
    dealt = toxicity._dealt(rows, 2)
    assert sorted(str(r["lang"]) for r in dealt.collect()) == ["None"] * 2 + ["de"] + ["en"] * 50
    groups = list(toxicity._read_groups(iter(dealt.toArrow().to_batches())))
    assert len({g.key for g in groups}) == len(groups) and max(len(g.texts) for g in groups) <= 20
    found = sorted((len(t), y) for g in groups for t, y in zip(g.texts, g.labels.tolist(), strict=True))
    assert found == sorted([(2, 1)] * 50 + [(1, 0)] * 2 + [(0, 1)])


def test_thresholds_of_a_table_are_those_in_memory(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LANGUAGE_TEXTS", 20)
    rng = np.random.default_rng(3)
    languages = ["en"] * 200 + ["de"] * 200 + ["xx"] * 10 + [None] * 10 + [""] * 10
    labels = rng.integers(0, 2, len(languages))
    scores = np.round(np.clip(0.3 + 0.2 * labels + rng.normal(0, 0.08, len(labels)), 0, 1), 3)
    rows = [(x, y, s) for x, y, s in zip(languages, labels.tolist(), scores.tolist(), strict=True)]
    found = toxicity.thresholds(spark.createDataFrame(rows, "lang string, label long, score double").repartition(5))
    plain = toxicity._thresholds(scores, labels, languages)
    assert found.keys() == plain.keys() and all(found[k] == pytest.approx(plain[k]) for k in plain)
