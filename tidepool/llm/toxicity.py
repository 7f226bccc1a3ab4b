"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words (runs of letters and digits, A-Z folded) are hashed into ``BUCKETS`` rows of an
embedding table, their first ``BEGINNING`` bytes into as many others, and a word is the
sum of both rows, so unseen forms of a known stem are not lost. Filters of several
widths slide over a text, each keeps its largest response (max pooling), and a logistic
layer scores them.

All labelled texts are learned from. They are dealt by a hash into groups of about
``GROUP_TEXTS`` texts or ``GROUP_BYTES`` bytes, whose word buckets lie together in one file.
In each of ``EPOCHS`` rounds every group trains the model of the round before on all of its texts, in
numpy inside the task that reads it, and the next model is that one plus the mean of the
groups' changes (of an embedding row: of the groups that moved it); a single group makes
all passes in one round. Changes are summed as whole numbers, so reruns agree. Gradients
flow only through the windows that won the pooling. ``CALIBRATION_SHARE`` of the texts,
drawn by a hash, is held back from this; all of it scales the logits (Platt) and sets each
language's threshold, both from sums over tables. If the texts of either part are
all of one label, all texts serve as both.

Scoring maps over whole texts of all rows with the trained arrays (2 MB, fixed by the
parameters) in a broadcast variable; words are split and hashed as arrays. The
score reads the text alone; the language chooses only the threshold of ``toxic``.

Defined cases: a null text is empty; a text without words is one padding window and
gets that window's score; labels without a document and documents without a label are
not learned from; repeated labelled rows count as often as they occur; a null or
unknown language takes the threshold for all; without texts of both labels every
score is within 1e-9 of the label there is (of 0 without labels); an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.llm.common import BYTE_BASE, LOWER_ASCII, materialize, rolling, text_chunks, words_of

BUCKETS = 1 << 15
PADDING = 2 * BUCKETS
BEGINNING = 4              # bytes
WIDTH, FILTERS, SPANS = 8, 8, (1, 2, 3)
GROUP_TEXTS = 10_000
GROUP_BYTES = 32 << 20
TRAIN_TEXTS = 5_000        # per label, of ``training_sample``
TRAIN_WORDS = 8_000_000
EPOCHS, BATCH, RATE, DECAY = 4, 64, 0.01, 1e-4
LEAST_STEPS = 300
MIN_TEXTS = 3              # training texts a bucket needs to count
NOISE = 0.02
CALIBRATION_SHARE = 0.2
LANGUAGE_TEXTS = 50        # held-back texts of each label that a language needs for its own threshold

PLACES = 1 << 32           # changes are summed in whole multiples of 1 / PLACES

_OTHERS = np.ones(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _OTHERS[ord(_first):ord(_last) + 1] = False
_OTHERS[0x80:] = False     # every byte of a multi-byte character


class Model(NamedTuple):
    embedding: np.ndarray              # (2 * BUCKETS + 1, WIDTH): words, beginnings, padding
    filters: list[np.ndarray]          # per span (span * WIDTH, FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    scale: float
    shift: float
    thresholds: dict[str | None, float]

    def logits(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Raw logit of each text; texts as in ``padded``."""
        pooled = [np.maximum.reduceat(r, bounds(first))[::2] for r in responses(self, words)]
        biases = np.concatenate(self.biases)
        return np.maximum(np.stack(pooled, 1) + biases, 0) @ self.weights + self.bias

    def scores(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * self.logits(words, first).astype(np.float64) + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def bucket_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of each word and of its first bytes, first word of each text)."""
    folded = LOWER_ASCII[data]
    start, end, first = words_of(folded, at, _OTHERS)
    values, size = folded.astype(np.uint64) + np.uint64(1), np.uint64(BUCKETS)
    out = np.empty((len(start), 2), np.int32)
    out[:, 0] = rolling(values, start, end, BYTE_BASE) % size
    out[:, 1] = rolling(values, start, np.minimum(end, start + BEGINNING), BYTE_BASE) % size + size
    return out, first


def padded(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with padding behind them: a window starts at every word (one if there is none)."""
    n = np.maximum(np.diff(first), 1) + SPANS[-1] - 1
    out = np.full((int(n.sum()), 2), PADDING, np.int32)
    begin = np.concatenate(([0], np.cumsum(n)))
    ahead = np.repeat(begin[:-1] - first[:-1], np.diff(first))
    out[np.arange(len(words)) + ahead] = words
    return out, begin


def bounds(first: np.ndarray) -> np.ndarray:
    """Where the windows of each text start and end, alternately (for ``reduceat``)."""
    return np.stack((first[:-1], first[1:] - (SPANS[-1] - 1)), 1).ravel()


def responses(model: Model, words: np.ndarray) -> Iterator[np.ndarray]:
    """What each filter answers at each window, filter by filter (biases not added)."""
    one, two = np.ascontiguousarray(words[:, 0]), np.ascontiguousarray(words[:, 1])
    for span, filters in zip(SPANS, model.filters, strict=True):
        # A filter's answer is a sum of one number per word and place: look it up instead of multiplying.
        tables = [np.ascontiguousarray((model.embedding @ filters[k * WIDTH:(k + 1) * WIDTH]).T) for k in range(span)]
        for f in range(FILTERS):
            out = tables[0][f][one] + tables[0][f][two]
            for k in range(1, span):
                out[:-k] += (tables[k][f][one] + tables[k][f][two])[k:]
            yield out


def _blank(rng: np.random.Generator) -> Model:
    return Model(np.zeros((PADDING + 1, WIDTH), np.float32),
                 [rng.normal(0, 0.4, (s * WIDTH, FILTERS)).astype(np.float32) for s in SPANS],
                 [np.zeros(FILTERS, np.float32) for _ in SPANS],
                 rng.normal(0, 0.3, len(SPANS) * FILTERS).astype(np.float32), 0.0, 1.0, 0.0, {None: 0.5})


def _started(model: Model, all_of: np.ndarray, hits: np.ndarray, n1: int, n0: int, rng: np.random.Generator) -> Model:
    """Embedding rows of buckets that at least MIN_TEXTS texts have; all others stay zero, that is neutral.

    ``all_of`` texts have a bucket, ``hits`` of them with label 1; ``n1`` and ``n0`` texts have each label.
    The first place of a row starts from how unevenly the labels share the bucket
    (log odds over their standard error), the others are small noise.
    """
    other = all_of - hits
    odds = np.log((hits + 0.5) / (n1 - hits + 0.5)) - np.log((other + 0.5) / (n0 - other + 0.5))
    error = np.sqrt(1 / (hits + 0.5) + 1 / (n1 - hits + 0.5) + 1 / (other + 0.5) + 1 / (n0 - other + 0.5))
    rows = rng.normal(0, NOISE, model.embedding.shape)
    rows[:, 0] = np.clip(odds / error, -8, 8) / 8
    rows[(all_of < MIN_TEXTS) | (np.arange(PADDING + 1) == PADDING)] = 0
    return model._replace(embedding=rows.astype(np.float32))


def _fit(model: Model, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, passes: int,
         rng: np.random.Generator) -> tuple[Model, np.ndarray]:
    """(model, whether each embedding row was moved) after Adam over batches of weighted texts; ``model`` stays."""
    params = [p.copy() for p in (*model.filters, *model.biases, model.weights)] + [np.array([model.bias], np.float32)]
    model = model._replace(embedding=model.embedding.copy())
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rows = (np.zeros_like(model.embedding), np.zeros_like(model.embedding))
    step, known = 0, model.embedding.any(1)
    moved = np.zeros(len(known), bool)
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            batch = order[a:a + BATCH]
            step += 1
            lengths = np.concatenate(([0], np.cumsum([len(texts[i]) for i in batch])))
            words, first = padded(np.concatenate([texts[i] for i in batch]), lengths)
            model = model._replace(filters=params[:3], biases=params[3:6], weights=params[6], bias=float(params[7][0]))
            grads, touched, rows_grad = _gradients(model, words, first, labels[batch], weight[batch])
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                p -= _adam(g, m, v, step)
            touched, rows_grad = touched[known[touched]], rows_grad[known[touched]]
            moved[touched] = True
            m, v = rows[0][touched], rows[1][touched]
            model.embedding[touched] -= _adam(rows_grad, m, v, step)
            rows[0][touched], rows[1][touched] = m, v
    return model._replace(filters=params[:3], biases=params[3:6], weights=params[6], bias=float(params[7][0])), moved


def _adam(grad: np.ndarray, m: np.ndarray, v: np.ndarray, step: int) -> np.ndarray:
    m *= 0.9
    m += 0.1 * grad
    v *= 0.999
    v += 0.001 * grad * grad
    return RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def _gradients(model: Model, words: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    """Gradients of filters, biases, weights and bias; rows of the embedding that move, and theirs."""
    texts, last = len(labels), first[1:] - (SPANS[-1] - 1)
    at = np.stack([[a + int(r[a:b].argmax()) for a, b in zip(first[:-1].tolist(), last.tolist(), strict=True)]
                   for r in responses(model, words)], 1).reshape(texts, len(SPANS), FILTERS)
    windows, vectors, pooled = [], [], []
    for k, span in enumerate(SPANS):
        window = words[at[:, k, :, None] + np.arange(span)]                  # texts, filters, span, 2
        vector = model.embedding[window].sum(3).reshape(texts, FILTERS, span * WIDTH)
        pooled.append(np.maximum(np.einsum("tfx,xf->tf", vector, model.filters[k]) + model.biases[k], 0))
        windows.append(window)
        vectors.append(vector)
    x = np.concatenate(pooled, 1)
    error = ((sigmoid(x @ model.weights + model.bias) - labels) * weight / texts).astype(np.float32)
    back = error[:, None] * model.weights[None, :]
    g_filters, g_biases, g_rows = [], [], []
    for k, span in enumerate(SPANS):
        g = back[:, k * FILTERS:(k + 1) * FILTERS] * (pooled[k] > 0)
        g_filters.append(np.einsum("tf,tfx->xf", g, vectors[k]) + DECAY * model.filters[k])
        g_biases.append(g.sum(0))
        rows = np.einsum("tf,xf->tfx", g, model.filters[k]).reshape(texts, FILTERS, span, 1, WIDTH)
        g_rows.append(np.broadcast_to(rows, (texts, FILTERS, span, 2, WIDTH)).reshape(-1, WIDTH))
    touched, place = np.unique(np.concatenate([w.reshape(-1) for w in windows]), return_inverse=True)
    rows_grad = np.zeros((len(touched), WIDTH), np.float32)
    np.add.at(rows_grad, place, np.concatenate(g_rows))
    return [*g_filters, *g_biases, x.T @ error, error.sum(keepdims=True)], touched, rows_grad


def _platt(logits: DataFrame) -> tuple[float, float]:
    """(scale, shift) that make sigmoid(scale * logit + shift) a probability, by Newton steps over all rows.

    Sums are of decimals, whose order does not matter.
    """
    n, n1 = logits.agg(F.count(F.lit(1)), F.sum("label")).first()
    x, w = F.col("logit"), np.array([1.0, 0.0])
    goal = F.when(F.col("label") == 1, (n1 + 1) / (n1 + 2)).otherwise(1 / (n - n1 + 2))
    for _ in range(50):
        p = _sigmoid(x * float(w[0]) + float(w[1]))
        terms = {"h": p * (1 - p), "hx": x * p * (1 - p), "hxx": x * x * p * (1 - p), "g": p - goal, "gx": x * (p - goal)}
        sums = logits.agg(*(F.sum(c.cast("decimal(38,12)")).cast("double").alias(k) for k, c in terms.items())).first()
        hess = np.array([[sums["hxx"], sums["hx"]], [sums["hx"], sums["h"]]]) + 1e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, np.array([sums["gx"], sums["g"]])), -1, 1)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))


def thresholds(scored: DataFrame) -> dict[str | None, float]:
    """``_thresholds`` of the rows (lang, label, score) of a table.

    Distinct scores are ordered in ranges; the counts above a score are those of the
    ranges before and of its own range, so no task orders all rows of a language.
    """
    named = scored.where(F.col("lang") != "")
    counts = (scored.withColumn("lang", F.lit("")).unionByName(named).groupBy("lang", "score")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all_n"), F.sum("hits").alias("all_hits"))
    enough = F.least(F.col("all_hits"), F.col("all_n") - F.col("all_hits")) >= LANGUAGE_TEXTS
    totals = totals.where((F.col("lang") == "") | enough).select("lang", "all_hits")
    ranged = materialize(counts.join(totals, "lang").repartitionByRange("lang", F.desc("score"))
                         .withColumn("part", F.spark_partition_id()), "scores")
    parts = ranged.groupBy("lang", "part").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"),
                                               F.max("score").alias("first"))
    by_part = Window.partitionBy("lang").orderBy("part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("lang", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before_n"),
                         F.coalesce(F.sum("hits").over(before), F.lit(0)).alias("before_hits"),
                         F.coalesce(F.lead("first").over(by_part), F.lit(0.0)).alias("beyond"))
    inside = Window.partitionBy("lang", "part").orderBy(F.desc("score"))
    hits = F.col("before_hits") + F.sum("hits").over(inside)
    taken = F.col("before_n") + F.sum("n").over(inside)
    found = materialize(ranged.join(parts, ["lang", "part"]).select(
        "lang", "score", F.coalesce(F.lead("score").over(inside), "beyond").alias("next"),
        (2 * hits / (taken + F.col("all_hits"))).alias("f1")), "f1")
    best = found.groupBy("lang").agg(F.max("f1").alias("best"))
    widest = F.max(F.struct((F.col("score") - F.col("next")).alias("gap"), "score", "next")).alias("w")
    rows = found.join(best, "lang").where(F.col("f1") >= F.col("best") - 1e-9).groupBy("lang").agg(widest).collect()
    return {None: 0.5} | {r["lang"] or None: (r["w"]["score"] + r["w"]["next"]) / 2 for r in rows}


def _thresholds(scores: np.ndarray, labels: np.ndarray, languages: list[str | None]) -> dict[str | None, float]:
    """Per language the threshold of best F1 on held-back texts; key None is for all others.

    In memory; ``thresholds`` gives the same of a table.
    """
    known = np.array([x if x is not None else "" for x in languages])
    out: dict[str | None, float] = {None: _best_threshold(scores, labels)}
    for language in np.unique(known[known != ""]):
        own = known == language
        if min(labels[own].sum(), (1 - labels[own]).sum()) >= LANGUAGE_TEXTS:
            out[str(language)] = _best_threshold(scores[own], labels[own])
    return out


def _best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap among thresholds of best F1."""
    order = np.argsort(-scores)
    s, hits = scores[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + labels.sum())
    last = np.append(s[1:], 0.0)
    gap = np.where(f1 >= f1.max() - 1e-9, s - last, -1.0)
    best = int(gap.argmax())
    return float((s[best] + last[best]) / 2)


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", with_words: bool = True) -> DataFrame:
    """words, bytes of the text, lang, label, times (rows of ``labels`` that say so) and place (a hash) of all
    labelled texts. The packed words travel to the labels, or nothing of the text without ``with_words``."""
    texts = _texts(docs, id_col, text_col).where("doc_id IS NOT NULL")
    texts = _words(texts, *texts.drop("text").columns) if with_words else texts.drop("text")
    return _labelled(texts, _marked(labels, label_col, id_col).hint("merge"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), language.alias("lang"),
                       F.xxhash64(text_col).alias("key"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("bytes"))


def _labelled(texts: DataFrame, marked: DataFrame) -> DataFrame:
    place = F.xxhash64("doc_id", "key", "label").alias("place")
    return texts.join(marked, "doc_id").select(*(c for c in texts.columns if c not in ("doc_id", "key")),
                                               "label", "times", place)


def _marked(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    return (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .agg(F.count(F.lit(1)).alias("times")))


def _words(rows: DataFrame, *kept: str) -> DataFrame:
    """Word buckets of each ``text`` (two uint16 a word, deflated) and the columns ``kept``."""
    chosen = rows.select("text", *kept)
    out = StructType().add("words", "binary")
    for field in chosen.schema.fields[1:]:
        out = out.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, at in text_chunks(batch.column("text")):
                words, begin = bucket_words(data, at)
                words[:, 1] -= BUCKETS
                short = words.astype(np.uint16)
                packed = [zlib.compress(short[a:b].tobytes(), 1) for a, b in zip(begin[:-1], begin[1:], strict=True)]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *part.columns[1:]], out.names)

    return chosen.mapInArrow(run, out)


def _unpacked(words: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(words), np.uint16).reshape(-1, 2).astype(np.int32) + np.array([0, BUCKETS], np.int32)


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic",
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[list[np.ndarray], np.ndarray, list]:
    """Word buckets, labels and languages of at most TRAIN_TEXTS labelled texts per label, to look at.

    ``fit`` does not use it: it learns from all labelled texts.
    """
    marked = _marked(labels, label_col, id_col)
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    # A hash of the id picks the sample, so that it is the same on every run.
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, TRAIN_TEXTS / n))).otherwise(share)
    # Distinct ids, each with the same chance: about TRAIN_TEXTS a label, whatever the tables' size.
    rows = _labelled(_texts(docs, id_col, text_col), F.broadcast(marked.where(draw < share)))
    packed = materialize(_words(rows, "lang", "label", "times", "place"), "labelled")
    # Read in order of a hash: each label's words up to its bound are a draw, not the first files.
    out, room = [], {0: TRAIN_WORDS // 2, 1: TRAIN_WORDS // 2}
    for r in packed.orderBy("place").toLocalIterator():
        size = max(1, len(_unpacked(r["words"])))
        copies = min(r["times"], room[r["label"]] // size)
        out.extend([(bytes(r["words"]), r["lang"], r["label"])] * copies)
        room[r["label"]] -= copies * size
        if max(room.values()) <= 0:
            break
    out.sort(key=lambda r: (r[0], r[1] or "", r[2]))
    return ([_unpacked(w) for w, _, _ in out], np.array([y for _, _, y in out], np.int64), [x for _, x, _ in out])


class Group(NamedTuple):
    key: tuple[int, int]               # its number, and which part of an overgrown one it is
    texts: list[np.ndarray]            # word buckets
    labels: np.ndarray


def _dealt(rows: DataFrame, groups: int) -> DataFrame:
    """number, held, words, label and lang of the labelled ``rows``, each as often as ``times`` says.

    Rows of a group follow each other in order of a hash.
    """
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")
    return (rows.select("words", "lang", "label", "place", "held", copy)
            .withColumn("number", F.pmod(F.xxhash64("place", "copy"), F.lit(groups)))
            .repartition(groups, "number").sortWithinPartitions("number", "held", "place", "copy")
            .select("number", "held", "words", "label", "lang"))


def _read_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    """Rows (number, words, label) group by group.

    A group that outgrows its bound (many copies of one row) becomes several.
    """
    texts, labels, held, number, part = [], [], 0, None, 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("number", "words", "label")]
        for own, words, label in zip(*columns, strict=True):
            full = held > 4 * GROUP_BYTES or len(texts) >= 2 * GROUP_TEXTS
            if texts and (own != number or full):
                yield Group((number, part), texts, np.array(labels, np.int64))
                texts, labels, held, part = [], [], 0, part + 1 if own == number else 0
            number = own
            texts.append(_unpacked(words))
            labels.append(label)
            held += texts[-1].nbytes
    if texts:
        yield Group((number, part), texts, np.array(labels, np.int64))


def _bucket_counts(dealt: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have each bucket, and those of them with label 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, PADDING + 1), np.int64)
        for batch in batches:
            for words, label in zip(batch.column("words").to_pylist(), batch.column("label").to_pylist(), strict=True):
                total[label, np.unique(_unpacked(words))] += 1
        there = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total.sum(0)[there]), pa.array(total[1, there])],
                                         ["bucket", "n", "hits"])

    counts = dealt.select("words", "label").mapInArrow(run, "bucket long, n long, hits long")
    all_of, hits = np.zeros(PADDING + 1), np.zeros(PADDING + 1)
    for bucket, n, n1 in counts.groupBy("bucket").agg(F.sum("n"), F.sum("hits")).collect():
        all_of[bucket], hits[bucket] = n, n1
    return all_of, hits


def _as_rows(model: Model) -> np.ndarray:
    """All parameters in rows of WIDTH numbers: the embedding, then the others."""
    others = np.concatenate([p.ravel() for p in (*model.filters, *model.biases, model.weights)] + [[model.bias]])
    filled = np.concatenate((others, np.zeros(-len(others) % WIDTH)))
    return np.concatenate((model.embedding.astype(np.float64), filled.reshape(-1, WIDTH)))


def _from_rows(rows: np.ndarray, like: Model) -> Model:
    out, rest = [], rows[PADDING + 1:].ravel()
    for p in (*like.filters, *like.biases, like.weights):
        out.append(rest[:p.size].reshape(p.shape).astype(np.float32))
        rest = rest[p.size:]
    return like._replace(embedding=rows[:PADDING + 1].astype(np.float32), filters=out[:3], biases=out[3:6],
                         weights=out[6], bias=float(rest[0]))


def _round(dealt: DataFrame, model: Model, weights: tuple[float, float], passes: int, seed: tuple[int, ...]) -> Model:
    """``model`` after each group has trained it: changed by the mean of their changes."""
    sent = dealt.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = sent.value
        base = _as_rows(start)
        change, times = np.zeros(base.shape, np.int64), np.zeros(len(base), np.int64)
        for group in _read_groups(batches):
            rng = np.random.default_rng([*seed, *group.key])
            found, moved = _fit(start, group.texts, group.labels, np.array(weights)[group.labels], passes, rng)
            change += np.rint((_as_rows(found) - base) * PLACES).astype(np.int64)
            times[:len(moved)] += moved
            times[len(moved):] += 1
        at = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times[at]), *(pa.array(c) for c in change[at].T)], names)

    names = ["at", "times", *(f"c{i}" for i in range(WIDTH))]
    changes = dealt.select("number", "words", "label").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    rows = _as_rows(model)
    for at, times, *change in changes.groupBy("at").agg(*(F.sum(n).alias(n) for n in names[1:])).collect():
        rows[at] += np.array(change) / (PLACES * times)
    sent.unpersist()
    return _from_rows(rows, model)


def _logits(dealt: DataFrame, model: Model) -> DataFrame:
    """lang, label and logit of every text."""
    sent = dealt.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                texts = [_unpacked(w) for w in part.column("words").to_pylist()]
                first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
                logits = sent.value.logits(*padded(np.concatenate(texts), first))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(logits.astype(np.float64))],
                                                 ["lang", "label", "logit"])

    return dealt.select("words", "lang", "label").mapInArrow(run, "lang string, label int, logit double")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", seed: int = 7) -> Model:
    """Train on all labelled rows of ``docs``."""
    rng = np.random.default_rng(seed)
    model = _blank(rng)
    drawn = F.pmod(F.xxhash64("place", F.lit(1)), F.lit(1 << 30)) < int(CALIBRATION_SHARE * (1 << 30))
    rows = labelled_texts(docs, labels, label_col).withColumn("held", drawn)
    sizes = labelled_texts(docs, labels, label_col, with_words=False).withColumn("held", drawn)
    counted = sizes.groupBy("held", "label").agg(F.sum("times").alias("n"),
                                                 F.sum(F.col("bytes") * F.col("times")).alias("bytes")).collect()
    n = {label: sum(r["n"] for r in counted if r["label"] == label) for label in (0, 1)}
    if not n[0] or not n[1]:
        return model._replace(scale=0.0, shift=30.0 if n[1] else -30.0)
    if len(counted) < 4:
        rows = rows.withColumn("held", F.lit(None).cast("boolean"))
    else:
        n = {r["label"]: r["n"] for r in counted if not r["held"]}
    groups = max(-(-sum(r["n"] for r in counted) // GROUP_TEXTS), -(-sum(r["bytes"] for r in counted) // GROUP_BYTES))
    dealt = materialize(_dealt(rows, groups), "groups")
    learned = dealt.where(~F.coalesce("held", F.lit(False)))
    held = dealt.where(F.coalesce("held", F.lit(True)))
    trainers, texts = learned.select("number").distinct().count(), n[0] + n[1]
    model = _started(model, *_bucket_counts(learned), n[1], n[0], rng)
    passes = max(EPOCHS, -(-LEAST_STEPS * BATCH * trainers // texts))
    rounds = 1 if trainers == 1 else EPOCHS
    weights = (0.5 * texts / n[0], 0.5 * texts / n[1])
    for i in range(rounds):
        model = _round(learned, model, weights, passes * (i + 1) // rounds - passes * i // rounds, (seed, i))
    logits = materialize(_logits(held, model), "logits")
    scale, shift = _platt(logits)
    scored = logits.select("lang", "label", _sigmoid(F.col("logit") * scale + shift).alias("score"))
    return model._replace(scale=scale, shift=shift, thresholds=thresholds(scored))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score",
          toxic_col: str = "toxic", keep_clean: bool = False) -> DataFrame:
    """``docs`` with the score and whether it reaches the language's threshold.

    Columns of these names are replaced. ``keep_clean`` returns the rows below the
    threshold with their own columns only.
    """
    rest = docs if keep_clean else docs.drop(score_col, toxic_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    has_lang = "lang" in rest.columns
    out = rest.schema if keep_clean else StructType([*rest.schema.fields]).add(score_col, "double").add(
        toxic_col, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for first, last, data, at in text_chunks(batch.column(text_col), 1 << 19):
                part = batch.slice(first, last - first)
                scores = own.scores(*padded(*bucket_words(data, at)))
                languages = part.column("lang").to_pylist() if has_lang else [None] * len(scores)
                limit = np.array([own.thresholds.get(x, own.thresholds[None]) for x in languages])
                if keep_clean:
                    yield part.filter(pa.array(scores < limit))
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores), pa.array(scores >= limit)],
                                                     out.names)

    return rest.mapInArrow(run, out)
