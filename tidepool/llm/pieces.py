"""Texts to token ids through a cache of the pieces between spaces.

In byte-level BPE a token never spans the border before a space, or around a line
end, that stands between two non-space characters, so a text may be cut there and
each piece (with the space or line end before it) encoded alone. Arrow cuts a chunk
of texts and numbers its distinct pieces, so only these become Python objects; the
texts' ids are then gathered by number. A worker keeps the pieces it has met and their
ids in arrays, which Arrow compares with a chunk's pieces in one pass; beyond a bound
the half that no chunk has asked for longest is forgotten. New ones that are letters and closing punctuation are put together from
both parts; of the others thousands are encoded in one string with line ends between
them, whose id tells them apart again. Where the caller can encode one word without
looking for words in it, pieces of letters go that way: such a piece is one word of
the byte-level pattern. Texts with other runs of white space, or with a special token,
are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidepool.llm.common import text_chunks

CACHE_PIECES = 800_000     # half is forgotten beyond this; bounds its memory (about 60 bytes a piece)
CHUNK_BYTES = 4 << 20      # text whose pieces are numbered at once
WHOLE_TEXTS = 256
JOINED = 4096
LINE_END, NOTHING = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())
NOT_CUT = re.compile(r" \n?+\s")   # among pieces joined by spaces: one that is empty or starts with white space
OLD_LETTERS = "\u058f"     # up to here every version of Unicode in use has the same letters
CLOSING = '.,;:!?*&$%#)"'  # no apostrophe: with letters after it, it starts a token of its own


def is_word(piece: str) -> bool:
    """Letters only, with a space before them one word of the pattern."""
    return piece.isalpha() and (piece.isascii() or max(piece) <= OLD_LETTERS)


class PieceCache:
    """``encode_many`` gives the int32 ids of texts; ``special`` are strings that rule out cutting.

    ``encode_words`` gives the packed int32 ids of words of letters, each with the space before it, if any.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[np.ndarray]], special: tuple[str, ...] = (),
                 most: int | None = None, encode_words: Callable[[list[str]], list[bytes]] | None = None):
        self.encode_many, self.encode_words = encode_many, encode_words
        self.special = [s for s in special if " " not in s and "\n" not in s]   # found in a piece
        self.torn = [s for s in special if " " in s or "\n" in s]               # found in a text only
        self.most = most or CACHE_PIECES
        # Known pieces, the number of ids of each, all these ids, and the chunk that last asked for each piece.
        self.known = pa.array([], pa.large_string())
        self.size, self.ids, self.asked = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.n_chunks = 0
        self.closings: dict[str, bytes] = {}
        self.line_end = encode_many(["\n"])[0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """int32 ids of each text."""
        return [x for ids, counts in self.chunks(pa.array(texts, pa.large_string()))
                for x in np.split(ids, np.cumsum(counts)[:-1])]

    def chunks(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of the texts: the int32 ids of all, one after the other, and how many each has."""
        texts = texts.cast(pa.large_string())
        for first, last, _, _ in text_chunks(texts, CHUNK_BYTES):
            yield self._chunk(texts.slice(first, last - first).fill_null(""))

    def _chunk(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.most:
            self._forget()
        self.n_chunks += 1
        # A line end opens a piece of its own; the first piece is one after a line end, less that.
        opened = pc.binary_join_element_wise(LINE_END, pc.replace_substring(texts, "\n", " \n"), NOTHING)
        cut = pc.split_pattern(opened, " ")
        first = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values.dictionary_encode()
        number, pieces = coded.indices.to_numpy(), coded.dictionary
        at = self._places(pieces)
        lacking = np.flatnonzero(at < 0)
        new = pieces.take(pa.array(lacking)).to_numpy(zero_copy_only=False).tolist()

        whole = np.zeros(len(texts), bool)
        for s in self.torn:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        joined = f" {' '.join(new)} "
        if NOT_CUT.search(joined) or any(s in joined for s in self.special):
            bad = np.zeros(len(pieces), bool)
            bad[lacking] = [self._uncut(p) or any(s in p for s in self.special) for p in new]
            whole |= np.logical_or.reduceat(bad[number], first[:-1])
        alone = np.repeat(whole, np.diff(first))
        if whole.any():
            # Pieces that only such texts have are not learned.
            used = np.zeros(len(pieces), bool)
            used[number[~alone]] = True
            new = [p for p, u in zip(new, used[lacking].tolist(), strict=True) if u]
            lacking = lacking[used[lacking]]
        at[lacking] = self._learn(new)
        there = at >= 0
        self.asked[at[there]] = self.n_chunks

        size, start = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        size[there], start[there] = self.size[at[there]], (np.cumsum(self.size) - self.size)[at[there]]
        size, start = size[number], start[number]
        start[first[:-1]] += len(self.line_end)
        size[first[:-1]] -= len(self.line_end)
        size[alone] = 0
        ids = self._gathered(start, size)
        counts = np.add.reduceat(size, first[:-1])
        if whole.any():
            lone = texts.filter(pa.array(whole)).to_pylist()
            uncut = [x for i in range(0, len(lone), WHOLE_TEXTS) for x in self.encode_many(lone[i:i + WHOLE_TEXTS])]
            before = (np.cumsum(counts) - counts)[whole]
            counts[whole] = [len(x) for x in uncut]
            ids = np.insert(ids, np.repeat(before, counts[whole]), np.concatenate(uncut))
        return ids, counts

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each of these distinct pieces stands among the known ones, or -1."""
        met = pc.index_in(self.known, value_set=pieces).fill_null(-1).to_numpy()
        known = np.flatnonzero(met >= 0)
        at = np.full(len(pieces), -1, np.int64)
        at[met[known]] = known
        return at

    def _gathered(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``size`` of the known ids from each ``start``, one after the other."""
        return self.ids[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]

    def _packed(self, at: np.ndarray) -> list[bytes]:
        """The ids of some known pieces, each as bytes."""
        size = self.size[at]
        raw, last = self._gathered((np.cumsum(self.size) - self.size)[at], size).tobytes(), (4 * np.cumsum(size)).tolist()
        return [raw[a:b] for a, b in zip([0, *last][:-1], last, strict=True)]

    def _forget(self) -> None:
        """Keep half of the pieces, those that were asked for last."""
        kept = np.sort(np.argsort(-self.asked, kind="stable")[:self.most // 2])
        self.ids = self._gathered((np.cumsum(self.size) - self.size)[kept], self.size[kept])
        self.known, self.size, self.asked = self.known.take(pa.array(kept)), self.size[kept], self.asked[kept]

    @staticmethod
    def _uncut(piece: str) -> bool:
        """White space stands at the start of the piece (after its line end)."""
        body = piece[1:] if piece[:1] == "\n" else piece
        return not body or body[0].isspace()

    def _learn(self, new: list[str]) -> np.ndarray:
        """Add pieces that are not known yet; where they stand then."""
        ending = {p: p.rstrip(CLOSING) for p in new if p[-1] in CLOSING}
        closed = {p: core for p, core in ending.items() if core.lstrip("\n").isalpha()}
        cores = [p for p in new if p not in closed]
        parted = list(set(closed.values()).difference(cores))
        at = self._places(pa.array(parted, pa.large_string()))
        cores += [p for p, i in zip(parted, at.tolist(), strict=True) if i < 0]
        added = self._encoded([p for p in cores if p[0] != "\n"], " ")
        before = self.line_end.tobytes()
        lines = self._encoded([p[1:] for p in cores if p[0] == "\n"], "")
        added.update(("\n" + p, before + ids) for p, ids in lines.items())
        closings = list({p[len(core):] for p, core in closed.items()}.difference(self.closings))
        self.closings.update(self._encoded(closings, ""))
        older = dict(zip([p for p, i in zip(parted, at.tolist(), strict=True) if i >= 0],
                         self._packed(at[at >= 0]), strict=True))
        added.update([(p, (added.get(core) or older[core]) + self.closings[p[len(core):]])
                      for p, core in closed.items()])
        place = dict(zip(added, range(len(self.known), len(self.known) + len(added)), strict=True))
        self.known = pa.concat_arrays([self.known, pa.array(list(added), pa.large_string())])
        self.size = np.append(self.size, np.fromiter(map(len, added.values()), np.int64, len(added)) // 4)
        self.ids = np.append(self.ids, np.frombuffer(b"".join(added.values()), np.int32))
        self.asked = np.append(self.asked, np.full(len(added), self.n_chunks))
        return np.fromiter(map(place.__getitem__, new), np.int64, len(new))

    def _encoded(self, pieces: list[str], before: str) -> dict[str, bytes]:
        """Packed ids of ``before + piece``; pieces with control characters or white space are encoded alone."""
        out: dict[str, bytes] = {}
        if self.encode_words:
            words = list(filter(is_word, pieces))
            out.update(zip(words, self.encode_words([before + p for p in words]), strict=True))
            pieces = [p for p in pieces if p not in out]
        plain = [p for p in pieces if p.isprintable()] if len(self.line_end) == 1 else []
        alone = [p for p in pieces if not p.isprintable()] if plain else pieces
        for first in range(0, len(plain), JOINED):
            part = plain[first:first + JOINED]
            ids = self.encode_many([before + ("\n" + before).join(part)])[0]
            ends = 4 * np.flatnonzero(ids == self.line_end[0])
            if len(ends) != len(part) - 1:
                alone = alone + part
                continue
            raw = ids.tobytes()
            out.update(zip(part, [raw[a:b] for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)],
                                                           strict=True)], strict=True))
        out.update(zip(alone, [x.tobytes() for x in self.encode_many([before + p for p in alone])], strict=True))
        return out
