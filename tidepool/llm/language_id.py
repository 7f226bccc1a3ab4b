"""Language identification by interpolated Kneser-Ney character models.

Letters are folded to lower case and to 12-bit symbols (code points below 2048 as they
are, others hashed into the upper half), every run of other characters is one border
symbol, and a 5-gram is one 60-bit integer. Spark counts the 5-grams of every training
text, per language; lower orders follow from the distinct higher ones, as Kneser-Ney
counts them, and discounts, context totals, back-off weights and probabilities from
groupings and joins over all of them. The model keeps every gram: per order one sorted
table of grams, with the log-probability under each language beside each (already
interpolated), and one of contexts with their back-off weights. The tables grow with the
corpus and are cut by key range into slices of at most ``SLICE_BYTES``, each a broadcast
of its own: the driver holds one at a time, a worker ``RESIDENT_BYTES`` of them and one
more, which it reads from its disk for every block of texts.

A text's cross-entropy per symbol under each language comes from binary searches of a
block's distinct grams in these tables; the lowest wins, the alphabetically first of equals. ``rejected`` marks
texts whose cross-entropy exceeds what ``ACCEPTED`` of the language's texts reach;
thresholds and the scale of ``score`` (the winner's posterior) are fitted on about
``CALIBRATION_TEXTS`` training rows set aside before counting.

Defined cases: a text that is null or has no letter is ``und`` with score 0.0;
training rows with a null text or language are left out; with no training rows every
text is ``und``; repeated rows count as often as they occur; an empty table gives no
rows. Only text, id and (to learn) language are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial, reduce
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize, text_chunks

ORDER, BITS = 5, 12
SYMBOLS = 1 << BITS
SLICE_BYTES = 32 << 20     # of one slice of the model
RESIDENT_BYTES = 64 << 20  # of the slices a worker keeps in memory
CALIBRATION_TEXTS = 4_000
ACCEPTED = 0.995
FLUSH = 1 << 20            # distinct grams a worker holds before it passes them on
UNKNOWN = "und"


class Table(NamedTuple):
    keys: np.ndarray                 # sorted
    values: np.ndarray               # (keys, languages)


class Slice(NamedTuple):
    """The part of a table from key ``first`` to ``last``."""
    first: int
    last: int
    table: Table | Broadcast
    resident: bool

    def load(self) -> Table:
        if isinstance(self.table, Table):
            return self.table
        path = getattr(self.table, "_path", None)      # none where Spark encrypts its files
        return self.table.value if self.resident or path is None else self.table.load_from_path(path)


class Model(NamedTuple):
    languages: list[str]
    grams: list[list[Slice]]         # per order 1 .. ORDER: log-probability of each gram
    contexts: list[list[Slice]]      # per order: log weight of the lower order, by context (order - 1 symbols)
    unseen: np.ndarray               # log-probability of a symbol never seen
    limits: np.ndarray               # cross-entropy above which a text is rejected
    scale: float

    def block_bytes(self) -> int:
        """Bytes of text scored at once: more where slices are read again for each block."""
        return 1 << 20 if all(s.resident for t in (*self.grams, *self.contexts) for s in t) else 1 << 22


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """Symbol of every code point; 0 is the border."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        letter = chr(c)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            out[c] = low if low < SYMBOLS // 2 else SYMBOLS // 2 + low * 40503 % (SYMBOLS // 2)
    return out


def symbol_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, first symbol of each); borders are single, a text without letters is empty."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
    found = symbols()[points]
    keep = found > 0
    text = np.repeat(np.arange(len(at) - 1), np.diff(begins))
    after_letter = np.zeros(len(found), bool)
    after_letter[1:] = keep[:-1] & (text[1:] == text[:-1])
    keep |= after_letter
    return found[keep], np.concatenate(([0], np.cumsum(keep)))[begins]


def gram_keys(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The ORDER-gram that ends at each symbol; borders stand before a text."""
    place = np.arange(len(found)) - np.repeat(first[:-1], np.diff(first))
    out = found.astype(np.uint64)
    for back in range(1, ORDER):
        before = np.zeros(len(found), np.uint64)
        before[back:] = found[:-back]
        before[place < back] = 0
        out |= before << np.uint64(BITS * back)
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each ORDER-gram ends at a symbol of a text of the language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                grams, n = _summed(keys, counts)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int32))),
                    "gram": pa.array(grams.view(np.int64)), "n": pa.array(n)})
            held.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, b, data, at in text_chunks(batch.column("text")):
                found, first = symbol_runs(data, at)
                keys, owner = gram_keys(found, first), np.array(langs[a:b], object)
                sizes = np.diff(first)
                for lang in sorted(set(langs[a:b])):
                    grams, n = np.unique(keys[np.repeat(owner == lang, sizes)], return_counts=True)
                    own = held.setdefault(lang, ([], []))
                    own[0].append(grams)
                    own[1].append(n)
                    size += len(grams)
                if size > FLUSH:
                    for lang, (k, c) in held.items():
                        grams, n = _summed(k, c)
                        held[lang] = ([grams], [n])
                    size = sum(len(k[0]) for k, _ in held.values())
                    if size > FLUSH // 2:
                        yield from flush()
                        size = 0
        yield from flush()

    return (rows.mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _kneser_ney(keys: np.ndarray, counts: np.ndarray) -> list[dict]:
    """Per order of one language: grams, probabilities; contexts, back-off weights."""
    tables = []
    for order in range(ORDER, 0, -1):
        tables.append((keys, counts))
        # A lower gram counts the distinct symbols before it.
        keys, counts = np.unique(keys & np.uint64((1 << BITS * (order - 1)) - 1), return_counts=True)
    out, lower = [], None
    for order, (grams, n) in enumerate(reversed(tables), 1):
        ones, twos = (n == 1).sum(), (n == 2).sum()
        cut = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
        context, place, types = np.unique(grams >> np.uint64(BITS), return_inverse=True, return_counts=True)
        total = np.bincount(place, n, len(context))
        weight = cut * types / total
        if lower is None:
            below = np.full(len(grams), 1.0 / SYMBOLS)
        else:
            suffix = grams & np.uint64((1 << BITS * (order - 1)) - 1)
            below = lower["p"][np.searchsorted(lower["grams"], suffix)]
        p = np.maximum(n - cut, 0) / total[place] + weight[place] * below
        lower = {"grams": grams, "p": p, "contexts": context, "weight": weight}
        out.append(lower)
    return out


def build(languages: list[str], keys: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """Merge the languages' models into shared sorted arrays."""
    models = [_kneser_ney(k, c) for k, c in zip(keys, counts, strict=True)]
    grams, logs, contexts, backoff = [], [], [], []
    unseen = np.array([np.log(m[0]["weight"][0] / SYMBOLS) for m in models])
    for i in range(ORDER):
        ctx = np.unique(np.concatenate([m[i]["contexts"] for m in models]))
        back = np.zeros((len(ctx), len(models)))
        all_grams = np.unique(np.concatenate([m[i]["grams"] for m in models]))
        at_ctx = np.searchsorted(ctx, all_grams >> np.uint64(BITS))
        if i:
            suffix = all_grams & np.uint64((1 << BITS * i) - 1)
            lower = logs[-1][np.searchsorted(grams[-1], suffix)]
        for j, m in enumerate(models):
            back[np.searchsorted(ctx, m[i]["contexts"]), j] = np.log(m[i]["weight"])
        value = back[at_ctx] + lower if i else np.tile(unseen, (len(all_grams), 1))
        for j, m in enumerate(models):
            value[np.searchsorted(all_grams, m[i]["grams"]), j] = np.log(m[i]["p"])
        grams.append(all_grams)
        logs.append(value)
        contexts.append(ctx)
        backoff.append(back)

    def whole(keys: np.ndarray, values: np.ndarray) -> list[Slice]:
        return [Slice(int(keys[0]), int(keys[-1]), Table(keys, values.astype(np.float32)), True)]

    return Model(languages, [whole(*x) for x in zip(grams, logs, strict=True)],
                 [whole(*x) for x in zip(contexts, backoff, strict=True)], unseen.astype(np.float32),
                 np.full(len(languages), np.inf), 1.0)


def _find(slices: list[Slice], keys: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether the table has each key, its values or zeros), for keys in any order."""
    distinct, place = np.unique(keys, return_inverse=True)
    there, values = np.zeros(len(distinct), bool), np.zeros((len(distinct), languages), np.float32)
    for part in slices:
        a, b = np.searchsorted(distinct, np.uint64(part.first)), np.searchsorted(distinct, np.uint64(part.last), "right")
        if a < b:
            table = part.load()
            at = np.searchsorted(table.keys, distinct[a:b])
            there[a:b] = table.keys[at] == distinct[a:b]
            values[a:b][there[a:b]] = table.values[at[there[a:b]]]
    return there[place], values[place]


def _logs(model: Model, keys: np.ndarray) -> np.ndarray:
    """(keys, languages): log-probability of each distinct ORDER-gram."""
    value = np.zeros((len(keys), len(model.languages)), np.float32)
    rest = np.arange(len(keys))
    for order in range(ORDER, 0, -1):
        if not len(rest):
            break
        key = keys[rest] & np.uint64((1 << BITS * order) - 1)
        there, found = _find(model.grams[order - 1], key, len(model.languages))
        value[rest] += found
        rest, key = rest[~there], key[~there]
        value[rest] += (model.unseen if order == 1 else
                        _find(model.contexts[order - 1], key >> np.uint64(BITS), len(model.languages))[1])
    return value


def cross_entropies(model: Model, found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, languages): mean negative log-probability of a symbol; NaN for a text without symbols."""
    place, distinct = pd.factorize(gram_keys(found, first))
    value = _logs(model, distinct)[place]
    n = np.diff(first)
    full = np.flatnonzero(n)
    out = np.full((len(n), len(model.languages)), np.nan)
    if len(full):
        sums = np.stack([np.add.reduceat(np.ascontiguousarray(value[:, j]), first[full], dtype=np.float64)
                         for j in range(len(model.languages))], 1)
        out[full] = -sums / n[full][:, None]
    return out


def posteriors(entropies: np.ndarray, scale: float) -> np.ndarray:
    x = -scale * (entropies - entropies.min(1, keepdims=True))
    p = np.exp(x)
    return p / p.sum(1, keepdims=True)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from every row of ``docs`` that has a text and a language.

    A hash of the id sets aside about CALIBRATION_TEXTS rows, at most a tenth, to
    calibrate on; all others are counted.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                       F.coalesce(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)), F.lit(1 << 30)).alias("draw"))
    rows = rows.dropna(subset=["text", "lang"])
    aside = int(min(0.1, CALIBRATION_TEXTS / max(1, rows.count())) * (1 << 30))
    counts = materialize(gram_counts(rows.where(F.col("draw") >= aside)), "grams")
    model = learned(counts)
    return model if model is None else _calibrated(model, rows.where(F.col("draw") < aside))


def _per_language(languages: list[str], value: Callable[[int], Column]) -> Column:
    return F.array(*[value(i) for i in range(len(languages))])


def learned(counts: DataFrame) -> Model | None:
    """The model of every gram in ``counts`` (lang, gram, n), which is read several times."""
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    each = partial(_per_language, languages)
    n, below = F.col("n"), F.col("below")
    tables = [materialize(counts.groupBy("gram").agg(each(
        lambda i: F.sum(F.when(F.col("lang") == languages[i], n).otherwise(0))).alias("n")), "order")]
    for order in range(ORDER - 1, 0, -1):
        # A lower gram counts the distinct symbols before it.
        lower = F.col("gram").bitwiseAND((1 << BITS * order) - 1).alias("gram")
        tables.insert(0, materialize(tables[0].select(lower, "n").groupBy("gram").agg(each(
            lambda i: F.sum((n[i] > 0).cast("long"))).alias("n")), "order"))
    parts, lower, unseen = [], None, None
    for order, table in enumerate(tables, 1):
        few = table.agg(each(lambda i: F.sum((n[i] == 1).cast("long"))), each(lambda i: F.sum((n[i] == 2).cast("long"))))
        cuts = [min(0.95, max(0.1, a / max(1, a + 2 * b))) for a, b in zip(*few.first(), strict=True)]
        keyed = table.withColumn("context", F.shiftright("gram", BITS))
        sums = keyed.groupBy("context").agg(each(lambda i: F.sum(n[i])).alias("total"),
                                            each(lambda i: F.sum((n[i] > 0).cast("long"))).alias("types"))
        total, weight = F.col("total"), F.col("weight")
        # A language without the context leaves everything to the lower order.
        contexts = materialize(sums.withColumn("weight", each(
            lambda i: F.when(total[i] > 0, F.lit(cuts[i]) * F.col("types")[i] / total[i]).otherwise(1.0))), "contexts")
        if lower is None:
            unseen = np.log(np.array(contexts.first()["weight"]) / SYMBOLS)
            joined = keyed.withColumn("below", F.array_repeat(F.lit(1.0 / SYMBOLS), len(languages)))
        else:
            suffix = F.col("gram").bitwiseAND((1 << BITS * (order - 1)) - 1)
            joined = keyed.withColumn("suffix", suffix).join(
                lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        lower = materialize(joined.join(contexts, "context").select("gram", each(
            lambda i: F.when(n[i] > 0, (n[i] - cuts[i]) / total[i]).otherwise(0.0) + weight[i] * below[i]).alias("p")),
            "probabilities")
        for number, keys, value in ((order - 1, lower.select(F.col("gram").alias("key"), "p"), "p"),
                                    (ORDER + order - 1, contexts.select(F.col("context").alias("key"), "weight"),
                                     "weight")):
            parts.append(keys.select(F.lit(number).alias("number"), "key",
                                     F.transform(value, lambda x: F.log(x).cast("float")).alias("logs")))
    slices = _slices(reduce(DataFrame.unionByName, parts), len(languages))
    return Model(languages, slices[:ORDER], slices[ORDER:], unseen.astype(np.float32),
                 np.full(len(languages), np.inf), 1.0)


def _slices(rows: DataFrame, languages: int) -> list[list[Slice]]:
    """The slices of each table in ``rows`` (number, key, logs), in key order."""
    most = max(1, SLICE_BYTES // (8 + 4 * languages))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("number").to_numpy()
            keys = batch.column("key").to_numpy()
            logs = batch.column("logs").flatten().to_numpy().reshape(-1, languages)
            edges = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(keys) else []
            for a, b in zip(edges, [*edges[1:], len(keys)], strict=True):
                yield pa.RecordBatch.from_pydict({"number": pa.array([int(numbers[a])], pa.int32()),
                                                  "keys": pa.array([keys[a:b].tobytes()], pa.binary()),
                                                  "logs": pa.array([logs[a:b].tobytes()], pa.binary())})

    context, out = rows.sparkSession.sparkContext, [[] for _ in range(2 * ORDER)]
    room = RESIDENT_BYTES
    packed = rows.orderBy("number", "key").mapInArrow(pack, "number int, keys binary, logs binary")
    for number, group in groupby(packed.toLocalIterator(), key=lambda r: r["number"]):
        keys, logs, more = np.zeros(0, np.uint64), np.zeros((0, languages), np.float32), True
        while more:
            held, parts = len(keys), [(keys, logs)]
            while held < most and (more := (r := next(group, None)) is not None):
                parts.append((np.frombuffer(r["keys"], np.uint64),
                              np.frombuffer(r["logs"], np.float32).reshape(-1, languages)))
                held += len(parts[-1][0])
            keys, logs = (np.concatenate(x) for x in zip(*parts, strict=True))
            while len(keys) >= most or (len(keys) and not more):
                table = Table(keys[:most].copy(), logs[:most].copy())
                size = table.keys.nbytes + table.values.nbytes
                out[number].append(Slice(int(table.keys[0]), int(table.keys[-1]), context.broadcast(table),
                                         size <= room))
                room -= size if size <= room else 0
                keys, logs = keys[most:], logs[most:]
    return out


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Limits and scale from texts that were not counted."""
    part = entropies(rows, model, ["lang"]).limit(2 * CALIBRATION_TEXTS).toPandas()
    part = part[part["entropies"].map(lambda x: x is not None)]
    part = part[part["lang"].isin(model.languages)]
    if part.empty:
        return model
    h = np.stack(part["entropies"].to_numpy())
    truth = np.array([model.languages.index(x) for x in part["lang"]])
    limits = np.full(len(model.languages), np.inf)
    for j in range(len(model.languages)):
        own = h[truth == j, j]
        if len(own):
            limits[j] = np.quantile(own, ACCEPTED)
    scales = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0]
    fits = [np.log(posteriors(h, s)[np.arange(len(h)), truth] + 1e-12).sum() for s in scales]
    return model._replace(limits=limits, scale=scales[int(np.argmax(fits))])


def entropies(rows: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``entropies`` (per language; null for a text without letters) of every row."""
    sub = rows.select(*keep, F.col(text_col).alias("__text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sub.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in text_chunks(batch.column("__text"), model.block_bytes()):
                h = cross_entropies(model, *symbol_runs(data, at))
                none = np.isnan(h[:, 0])
                values = pa.array([None if x else row for x, row in zip(none, h.tolist(), strict=True)],
                                  pa.list_(pa.float64()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], values], [*keep, "entropies"])

    return sub.mapInArrow(run, f"{fields}, entropies array<double>")


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (posterior of lang_pred), entropy and rejected of every row."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return keyed.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                            F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected"))
    h = F.col("entropies")
    low = F.array_min(h)
    best = F.array_position(h, low).cast("int")
    weights = F.transform(h, lambda x: F.exp((low - x) * float(model.scale)))
    score = 1.0 / F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    languages = F.array(*[F.lit(x) for x in model.languages])
    limits = F.array(*[F.lit(float(x)) for x in model.limits])
    return entropies(keyed, model, ["doc_id"]).select(
        "doc_id", F.when(h.isNull(), F.lit(UNKNOWN)).otherwise(F.element_at(languages, best)).alias("lang_pred"),
        F.when(h.isNull(), F.lit(0.0)).otherwise(score).alias("score"), low.alias("entropy"),
        (h.isNull() | (low > F.element_at(limits, best))).alias("rejected"))
