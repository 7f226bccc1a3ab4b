"""Byte-level BPE encoding and decoding from a public tokenizer file.

A pre-token is a row of byte symbols. A segment tree over its adjacent pairs holds
``rank * leaves + place`` for each mergeable pair, so its root is the leftmost pair
of lowest rank; a merge changes the leaves of the pair, of the pair to its left and
of the one that vanishes, each with one path to the root, until the root holds no
mergeable pair. Pre-tokens of one size class are merged side by side, one tree a row
of a numpy array; long ones, which are rare, one by one in a tree of their own.

The file's added tokens are found in texts first, as its own library does, unless
``plain_special`` makes their strings ordinary text. Files with a normaliser, a
prefix space, an unknown token or added tokens that strip or match whole words are
refused.

Defined cases: a null text is empty and has no ids; every text decodes to itself;
ids that are no whole UTF-8 characters decode with replacement characters; a null
id array decodes to the empty text; repeated rows are encoded alike and stay; an
empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.llm.pieces import PieceCache

# Fixed value: the pre-token pattern of byte-level BPE files of this kind.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

NONE = np.iinfo(np.int64).max   # a leaf without a mergeable pair
SIDE_BY_SIDE = 64               # symbols; longer pre-tokens get a tree of their own
CACHED = 400_000                # pieces a worker remembers
ROWS = 20_000                   # pre-tokens merged side by side at once


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def refuse_others(spec: dict, path: str) -> None:
    """Raise for a tokenizer file whose pieces are not those of ``pieces``: only plain byte-level BPE is known."""
    before = spec.get("pre_tokenizer") or {}
    odd = [t for t in spec.get("added_tokens") or [] if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if (spec["model"]["type"] != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel" or odd
            or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["model"].get("unk_token")):
        raise ValueError(f"{path} is no plain byte-level BPE file")


class Bpe:
    """Merge ranks and token bytes of one tokenizer file."""

    def __init__(self, path: str, plain_special: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_others(spec, path)
        model, letters = spec["model"], byte_letters()
        added = spec.get("added_tokens") or []
        vocab: dict[str, int] = model["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        back = {c: b for b, c in letters.items()}
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        for t in added:
            self.token_bytes[t["id"]] = t["content"].encode()
        self.special = {} if plain_special else {t["content"]: t["id"] for t in added}
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = np.append(pairs[order], NONE), np.append(order, 0)
        self.rank_of = dict(zip(pairs.tolist(), range(len(pairs)), strict=True))
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.cache = PieceCache(self.encode_whole, tuple(self.special), CACHED)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = (left << 32) | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.ranks[at], -1)

    def merge_rows(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Packed ids of pre-tokens of at most ``leaves`` bytes (a power of two), side by side."""
        n, bits = len(words), leaves.bit_length() - 1
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(leaves, b"\0") for w in words), np.uint8).reshape(n, leaves)
        place = np.arange(leaves)
        ids = self.byte_id[raw]
        there = place[None, :] < size[:, None]
        rank = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, leaves - 1)
        tree = np.full((n, 2 * leaves), NONE)
        mergeable = (rank >= 0) & there[:, 1:]
        tree[:, leaves:-1] = np.where(mergeable, (rank << bits) | place[:-1], NONE)
        for node in range(leaves - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        after = np.tile(place + 1, (n, 1))
        before = np.tile(place - 1, (n, 1))
        row = np.flatnonzero(tree[:, 1] != NONE)
        while len(row):
            top = tree[row, 1]
            left = top & (leaves - 1)
            right = after[row, left]
            beyond = after[row, right]
            ids[row, left] = self.merged[top >> bits]
            there[row, right] = False
            after[row, left] = beyond
            inner = beyond < size[row]
            before[row[inner], beyond[inner]] = left[inner]
            self._leaf(tree, row, right, np.full(len(row), NONE), leaves)
            follows = np.minimum(beyond, leaves - 1)
            found = self.rank(ids[row, left], ids[row, follows])
            self._leaf(tree, row, left, np.where(inner & (found >= 0), (found << bits) | left, NONE), leaves)
            at = np.flatnonzero(before[row, left] >= 0)
            r, was = row[at], before[row[at], left[at]]
            found = self.rank(ids[r, was], ids[r, left[at]])
            self._leaf(tree, r, was, np.where(found >= 0, (found << bits) | was, NONE), leaves)
            row = row[tree[row, 1] != NONE]
        raw, last = ids[there].astype(np.int32).tobytes(), (4 * np.cumsum(there.sum(1))).tolist()
        return [raw[a:b] for a, b in zip([0, *last[:-1]], last, strict=True)]

    @staticmethod
    def _leaf(tree: np.ndarray, row: np.ndarray, place: np.ndarray, value: np.ndarray, leaves: int) -> None:
        """Set one leaf a row and the minima on its path to the root."""
        node = place + leaves
        tree[row, node] = value
        while leaves > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            leaves >>= 1

    def merge_long(self, word: bytes) -> bytes:
        """Packed ids of one pre-token of any length."""
        n = len(word)
        leaves = 1 << (n - 1).bit_length()
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, merged, none = self.rank_of, self.merged, int(NONE)

        def pair(a: int, b: int) -> int:
            found = rank_of.get((ids[a] << 32) | ids[b])
            return none if found is None else found * leaves + a

        tree = [none] * leaves + [pair(i, i + 1) for i in range(n - 1)] + [none] * (leaves - n + 1)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(place: int, value: int) -> None:
            node = place + leaves
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        while tree[1] != none:
            top, left = divmod(tree[1], leaves)
            right = after[left]
            ids[left] = int(merged[top])
            beyond = after[left] = after[right]
            ids[right] = -1
            put(right, none)
            if beyond < n:
                before[beyond] = left
            put(left, pair(left, beyond) if beyond < n else none)
            if before[left] >= 0:
                put(before[left], pair(before[left], left))
        return np.array([i for i in ids if i >= 0], np.int32).tobytes()

    def encode_pretokens(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, packed as int32."""
        out: list[bytes] = [b""] * len(words)
        classes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            classes.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
        for leaves, members in classes.items():
            if leaves > SIDE_BY_SIDE:
                for i in members:
                    out[i] = self.merge_long(words[i])
                continue
            for first in range(0, len(members), ROWS):
                part = members[first:first + ROWS]
                for i, ids in zip(part, self.merge_rows([words[i] for i in part], leaves), strict=True):
                    out[i] = ids
        return out

    def _pretokens(self, text: str) -> list[str | int]:
        """Special tokens as their ids, the pre-tokens between them as text."""
        out, last = [], 0
        for m in self.split.finditer(text):
            out += [*PATTERN.findall(text[last:m.start()]), self.special[m[0]]]
            last = m.end()
        return out + PATTERN.findall(text[last:])

    def encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        """int32 ids of each text, each distinct pre-token of them merged once."""
        split = [self._pretokens(t) if any(s in t for s in self.special) else PATTERN.findall(t) for t in texts]
        new = list(dict.fromkeys(w for words in split for w in words if isinstance(w, str)))
        known: dict[str | int, bytes] = dict(zip(new, self.encode_pretokens([w.encode() for w in new]), strict=True))
        known |= {i: np.array([i], np.int32).tobytes() for i in self.special.values()}
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """int32 ids of each text."""
        return self.cache.encode(texts)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str, plain_special: bool = False) -> Bpe:
    """Once per worker. ``path`` must name the same file on every executor."""
    return Bpe(path, plain_special)


def list_of(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.int32)])))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           plain_special: bool = False) -> DataFrame:
    """doc_id and ids (array<int>) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, plain_special)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                ids = bpe.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), list_of(ids)], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  plain_special: bool = False) -> DataFrame:
    """doc_id, ids and decoded (the text of those ids) of every row.

    The same as ``decode(encode(...))`` in one pass, so a task needs one Python worker.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, plain_special)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                ids = bpe.encode(part.column("text").to_pylist())
                texts = [bpe.decode(x.tolist()) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), list_of(ids), pa.array(texts, pa.string())],
                                                 ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; a column of the name ``decoded_col`` is replaced."""
    kept = encoded.drop(decoded_col)
    names = [*kept.columns, decoded_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = [bpe.decode(ids or []) for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields]).add(decoded_col, "string"))
