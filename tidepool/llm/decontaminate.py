"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

Index: the question (all sentences but the last) and the answer (the last one) of each
test item are cut into pieces of their own, of at most ``PIECE`` words, so that either
retrieves the item wherever the other stands; a part below ``SHINGLE`` words is not
indexed beside a longer one, it would retrieve almost every text and is only verified.
A term's weight in a piece is its BM25 contribution divided by the piece's score against
itself, so one threshold serves long and short items. Pieces are numbered by that
self-score, which puts similar weights side by side, and the numbers are cut into blocks;
beside each term stands its largest weight in every block.

Queries: every passage of every document, ``2 * STRIDE`` words at steps of ``STRIDE``,
so that any ``STRIDE`` consecutive words lie in one passage. The sums of the block
maxima of a passage's distinct terms rule out most blocks, for all passages of a batch
at once; in the others WAND advances the terms' postings from pivot to pivot and scores
only pieces whose bound reaches the threshold. Everything at or above it is retrieved,
there is no top-k.

Check: of a retrieved item the question and the answer must each have ``OVERLAP`` of their
distinct shingles (``SHINGLE`` words, or all words of a shorter part) in the whole document.
Shingles all of whose words the document has bound that share from above; only if both
bounds hold are the document's own shingles hashed, once for each length. An item is
missed only if each of its pieces is itself torn apart, so that no passage holds
``THRESHOLD`` of any piece's weight.

Test sets beyond ``INDEX_WORDS`` words are dealt by hash into several indexes, each of
that bounded size, that go over the documents in turn. Document frequencies and the mean
length are counted by Spark over the whole test set, so a score does not depend on the
dealing. Words are runs of letters and digits, A-Z folded.

Defined cases: a null or empty text has no passages; an item without a word matches
nothing; an item of fewer than five words must stand in the document as it is; a
one-sentence item is all question; repeated items each give their rows, under a null
item_id too; repeated documents and those without a doc_id each give theirs; empty tables give
no hits; ``contaminated`` reads the id and the text only, ``drop_contaminated`` keeps all columns.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import (
    LOWER_ASCII,
    WORD_BASE,
    materialize,
    rolling,
    text_chunks,
    window_starts,
    word_hashes,
    words_of,
)

STRIDE = PIECE = 64        # words
SHINGLE, OVERLAP = 5, 0.8
THRESHOLD = 0.6            # of a piece's score against itself
K1, B = 1.2, 0.75
BLOCK, MOST_BLOCKS = 4, 128
INDEX_WORDS = 64_000       # about 1,000 pieces; the block maxima take up to 32 MB
SUM_KEYS = 1 << 16         # (passage, term) pairs whose block maxima are summed at once, up to 32 MB

OTHERS = np.ones(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    OTHERS[ord(_first):ord(_last) + 1] = False
OTHERS[0x80:] = False

_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text)."""
    folded = LOWER_ASCII[data]
    start, end, first = words_of(folded, at, OTHERS)
    return word_hashes(folded, start, end), first


def words_of_text(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return hashed_words(raw, np.array([0, len(raw)]))[0]


def question_and_answer(text: str) -> tuple[str, str]:
    """All sentences but the last, and the last; one sentence is all question."""
    sentences = [s for s in _SENTENCE_END.split(text.strip()) if len(words_of_text(s))]
    return (text, "") if len(sentences) < 2 else (" ".join(sentences[:-1]), sentences[-1])


def shingles(words: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(shingle length, distinct shingle hashes, which of them starts at each word); fewer than SHINGLE words are one."""
    n = min(SHINGLE, len(words))
    if not n:
        return 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return n, *np.unique(shingle_hashes(words, n), return_inverse=True)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    at = window_starts(np.array([0, len(words)]), n)
    return rolling(words, at, at + n, WORD_BASE)


class Statistics(NamedTuple):
    """What the weights need to know of the whole test set."""

    pieces: int
    words: int
    df: dict[int, int]         # pieces that hold a term


def pieces_of(parts: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """What is indexed of an item's question and answer."""
    longest = max(len(p) for p in parts)
    return [p[a:a + PIECE] for p in parts if len(p) >= min(SHINGLE, longest) for a in range(0, len(p), PIECE)]


def parts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of question and answer."""
    question, answer = question_and_answer(text)
    return words_of_text(question), words_of_text(answer)


def statistics(texts: list[str]) -> Statistics:
    """Counted from all texts of a test set that is at hand."""
    pieces = [p for t in texts for p in pieces_of(parts_of(t))]
    terms, df = np.unique(np.concatenate([np.unique(p) for p in pieces] + [np.zeros(0, np.uint64)]), return_counts=True)
    return Statistics(len(pieces), sum(map(len, pieces)), dict(zip(terms.tolist(), df.tolist(), strict=True)))


class Index:
    """Inverted index of test items with block maxima."""

    def __init__(self, items: list[tuple[object, str]], known: Statistics | None = None):
        self.items = [(i, t) for i, t in items if len(words_of_text(t))]
        known = known or statistics([t for _, t in self.items])
        parts = [parts_of(t) for _, t in self.items]
        self.parts = [tuple((n, wanted, words, which) for words in part for n, wanted, which in (shingles(words),))
                      for part in parts]
        pieces = [(number, words) for number, part in enumerate(parts) for words in pieces_of(part)]
        counted = [np.unique(w, return_counts=True) for _, w in pieces]
        self.terms = np.unique(np.concatenate([t for t, _ in counted] + [np.zeros(0, np.uint64)]))
        df = np.array([known.df[t] for t in self.terms.tolist()], float)
        n = len(pieces)
        idf = np.log(1 + (known.pieces - df + 0.5) / (df + 0.5))
        mean = known.words / max(1, known.pieces)
        scored = []
        for (number, words), (terms, tf) in zip(pieces, counted, strict=True):
            at = np.searchsorted(self.terms, terms)
            weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            scored.append((float(weight.sum()), number, at, weight / weight.sum()))
        scored.sort(key=lambda x: x[:2])
        self.item_of = np.array([x[1] for x in scored], np.int64)
        self.block = max(BLOCK, math.ceil(n / MOST_BLOCKS))
        self.blocks = max(1, math.ceil(n / self.block))
        self.most = np.zeros((len(self.terms), self.blocks), np.float32)
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in range(self.blocks)]
        for piece, (_, _, at, weight) in enumerate(scored):
            b = piece // self.block
            np.maximum.at(self.most, (at, b), weight.astype(np.float32))
            for t, w in zip(at.tolist(), weight.tolist(), strict=True):
                self.postings[b].setdefault(t, []).append((piece, w))

    def wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """(piece, score) of the block's pieces that reach ``threshold`` for these distinct terms."""
        lists = [(self.postings[block][t], float(self.most[t, block])) for t in terms if t in self.postings[block]]
        cursors = [[p[0][0], 0, p, bound] for p, bound in lists]     # current piece, place, postings, bound
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, None
            for c in cursors:
                total += c[3]
                if total >= threshold - 1e-6:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                score = 0.0
                for c in cursors:
                    if c[0] == pivot:
                        score += c[2][c[1]][1]
                        c[1] += 1
                if score >= threshold - 1e-6:
                    out.append((pivot, score))
            else:
                for c in cursors:
                    while c[1] < len(c[2]) and c[2][c[1]][0] < pivot:
                        c[1] += 1
            cursors = [c for c in cursors if c[1] < len(c[2])]
            for c in cursors:
                c[0] = c[2][c[1]][0]
        return out

    def retrieve(self, words: np.ndarray, first: np.ndarray, threshold: float) -> dict[tuple[int, int], float]:
        """{(text, item): best score} over all passages of the texts."""
        if not len(self.terms) or not len(words):
            return {}
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == words)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))[known]
        step = (known - first[text]) // STRIDE
        passages = np.maximum(-(-np.diff(first) // STRIDE) - 1, 1)
        number = np.concatenate(([0], np.cumsum(passages)))
        # A word of step s lies in passages s - 1 and s of its text, where they exist.
        size = len(self.terms)
        here = step < passages[text]
        back = step > 0
        key = np.concatenate(((number[text] + step)[here] * size + at[known[here]],
                              (number[text] + step - 1)[back] * size + at[known[back]]))
        key = np.unique(key)
        if not len(key):
            return {}
        passage, term = key // size, key % size
        begins = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        ends = np.append(begins[1:], len(key))
        out: dict[tuple[int, int], float] = {}
        first_group = 0
        while first_group < len(begins):
            start = begins[first_group]
            last_group = max(first_group + 1, int(np.searchsorted(ends, start + SUM_KEYS, "right")))
            bound = np.add.reduceat(self.most[term[start:ends[last_group - 1]]],
                                    begins[first_group:last_group] - start, axis=0)
            for group, block in zip(*np.nonzero(bound >= threshold - 1e-4), strict=True):
                a, b = begins[first_group + group], ends[first_group + group]
                for piece, score in self.wand(term[a:b].tolist(), int(block), threshold):
                    owner = int(np.searchsorted(number, passage[a], "right")) - 1
                    pair = (owner, int(self.item_of[piece]))
                    out[pair] = max(out.get(pair, 0.0), score)
            first_group = last_group
        return out

    def overlaps(self, item: int, words: np.ndarray, terms: np.ndarray, seen: dict[int, np.ndarray],
                 overlap: float) -> tuple[float, float]:
        """Shares of the question's and the answer's shingles in a document (1.0 for no answer).

        ``terms`` are the document's distinct words; (0.0, 0.0) if they already rule a part out.
        """
        for n, wanted, part, which in self.parts[item]:
            if n:
                there = terms[np.minimum(np.searchsorted(terms, part), len(terms) - 1)] == part
                lacking = np.concatenate(([0], np.cumsum(~there)))
                possible = np.bincount(which, lacking[n:] == lacking[:-n], len(wanted))
                if np.count_nonzero(possible) < overlap * len(wanted):
                    return 0.0, 0.0
        out = []
        for n, wanted, *_ in sorted(self.parts[item], key=lambda p: -p[0]):
            if n and n not in seen:
                seen[n] = np.unique(shingle_hashes(words, n))
            out.append(float(np.isin(wanted, seen[n]).mean()) if n else 1.0)
            if out[-1] < overlap:
                return 0.0, 0.0
        return (out[0], out[1]) if self.parts[item][0][0] >= self.parts[item][1][0] else (out[1], out[0])

    def hits(self, words: np.ndarray, first: np.ndarray, threshold: float = THRESHOLD,
             overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap) of verified items, in order."""
        out, seen, last = [], {}, -1
        terms = np.zeros(0, np.uint64)
        for (text, item), score in sorted(self.retrieve(words, first, threshold).items()):
            own = words[first[text]:first[text + 1]]
            if text != last:
                seen, last, terms = {}, text, np.unique(own)
            question, answer = self.overlaps(item, own, terms, seen, overlap)
            if question >= overlap and answer >= overlap:
                out.append((text, item, score, question, answer))
        return out


def whole_statistics(items: DataFrame) -> tuple[int, int, DataFrame]:
    """(pieces, words, rows of term and df) of all ``items`` (text), counted by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                pieces = pieces_of(parts_of(text))
                terms = np.concatenate([np.unique(p) for p in pieces] + [np.zeros(0, np.uint64)])
                size = np.zeros(len(terms), np.int64)
                first = np.cumsum([0] + [len(np.unique(p)) for p in pieces])[:-1]
                size[first[first < len(terms)]] = [len(p) for p in pieces if len(p)]
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(size)], ["term", "piece_words"])

    counted = materialize(items.select("text").mapInArrow(run, "term long, piece_words long")
                          .groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("piece_words").alias("words"),
                                               F.count_if(F.col("piece_words") > 0).alias("pieces")), "test-terms")
    total = counted.agg(F.sum("pieces"), F.sum("words")).first()
    return total[0] or 0, total[1] or 0, counted.select("term", "df")


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes of bounded size that together hold the test set, one after the other."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).dropna(subset=["text"])
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // (4 * INDEX_WORDS)))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    if parts > 1:
        dealt = materialize(dealt, "test-items")
        pieces, words, terms = whole_statistics(dealt)
    for part in range(parts):
        items = dealt.where(F.col("part") == part).select("item_id", "text").collect()
        items = sorted(((r["item_id"], r["text"]) for r in items), key=lambda x: (str(x[0]), x[1]))
        if parts == 1:
            yield Index(items)
            continue
        own = np.unique(np.concatenate([w for _, t in items for w in parts_of(t)] + [np.zeros(0, np.uint64)]))
        asked = benchmark.sparkSession.createDataFrame([(t,) for t in own.view(np.int64).tolist()], "term long")
        df = {r["term"] % (1 << 64): r["df"] for r in terms.join(asked, "term").collect()}
        yield Index(items, Statistics(pieces, words, df))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, bm25, question_overlap, answer_overlap) of every verified test item in a document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    found = None
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                for a, b, data, at in text_chunks(batch.column("text"), 1 << 19):
                    hits = own.hits(*hashed_words(data, at), threshold, overlap)
                    text, item, score, question, answer = zip(*hits, strict=True) if hits else ((),) * 5
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id")[a:b].take(pa.array(text, pa.int64())),
                        pa.array([own.items[i][0] for i in item]).cast(pa.int64()) if item_kind == "bigint"
                        else pa.array([own.items[i][0] for i in item]),
                        pa.array(score, pa.float64()), pa.array(question, pa.float64()),
                        pa.array(answer, pa.float64())],
                        ["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap"])

        part = rows.mapInArrow(run, f"doc_id {kind}, item_id {item_kind}, bm25 double, question_overlap double, "
                                    "answer_overlap double")
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` without a verified test item, with all their columns."""
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                for a, b, data, at in text_chunks(batch.column(text_col), 1 << 19):
                    clean = np.ones(b - a, bool)
                    clean[[h[0] for h in own.hits(*hashed_words(data, at), threshold, overlap)]] = False
                    yield batch.slice(a, b - a).filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
