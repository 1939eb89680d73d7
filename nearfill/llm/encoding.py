"""Token ids of whole texts by the tokenizers library, with a cache of pieces.

A tokenizer that splits at spaces gives every piece between two spaces the same
ids wherever it stands.  Texts are cut into such pieces on their UTF-8 bytes, a
(a comma or full stop after an ASCII letter is one more), a
piece is known by two independent 64-bit hashes, and the library encodes
each piece that a worker does not know yet.  Ids are then gathered for a slice of
texts at a time.  Where white space has ids of its own, only texts whose words are
separated by single spaces and line feeds are cut; the others are encoded whole.
"""
from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import textbytes

#: Pieces that a worker keeps; further ones are encoded again in every slice of texts.
CACHE_PIECES = 250_000
_PROBES = 24
_GROUP = 256
_APART = (0x20, 0x0A)
_PIECE = np.ones(256, dtype=bool)
_PIECE[list(_APART)] = False
#: Other ASCII white space, and controls that some readers take for it.
_ODD = np.zeros(256, dtype=bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_STOP, _LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_STOP[[0x2C, 0x2E]] = True
_LETTER[65:91] = _LETTER[97:123] = True
_loaded: dict[str, "Encoder"] = {}


def tokenizer(path: str):
    """The tokenizer of a file, one thread, special tokens' strings read as ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


def encoder(path: str) -> "Encoder":
    """This worker's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Encoder:
    """Ids of texts; ``encode`` yields one uint32 array for each text."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.vocab_size = self.tok.get_vocab_size()
        # white space gives no ids, so that a line feed separates like a space; else it is a piece of its own
        self.drops_white = not any(x.size for x in self._whole([" ", "\n"]))
        self._mark = "\x01" if self.drops_white else "\n"
        mark = self._whole([self._mark])[0]
        self._mark_id = int(mark[0]) if len(mark) == 1 else None
        slots = 1 << max(10, int(2 * CACHE_PIECES - 1).bit_length())
        self._key, self._check = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self._index = np.zeros(slots, np.int64)
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)
        self.known = self.used = 0
        self._append(["\n"])  # piece 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pieces, and how many each has; many pieces are encoded as one text, with a mark between them."""
        if self._mark_id is not None and len(pieces) > 1 and not any(self._mark in p for p in pieces):
            glue = self._mark if not self.drops_white else f" {self._mark} "
            groups = [glue.join(pieces[i:i + _GROUP]) + glue for i in range(0, len(pieces), _GROUP)]
            ids = np.concatenate(self._whole(groups))
            marks = np.flatnonzero(ids == self._mark_id)
            if len(marks) == len(pieces):
                return np.delete(ids, marks), np.diff(marks, prepend=-1) - 1
        ids = self._whole(pieces)
        return np.concatenate(ids), np.array([len(x) for x in ids], dtype=np.int64)

    def _append(self, pieces: list[str]) -> None:
        """Encode pieces and put their ids behind those known."""
        ids, lens = self._ids(pieces)
        n, total = self.known, len(ids)
        while n + len(pieces) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.size[n:n + len(pieces)] = lens
        self.start[n:n + len(pieces)] = self.used + np.cumsum(lens) - lens
        self.flat[self.used:self.used + total] = ids
        self.known += len(pieces)
        self.used += total

    def _find(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Numbers of pieces by their hashes, -1 for unknown ones."""
        out, todo = np.full(len(h), -1), np.arange(len(h))
        slot = (h & np.uint64(len(self._key) - 1)).astype(np.int64)
        for _ in range(_PROBES):
            key = self._key[slot]
            hit = (key == h[todo]) & (self._check[slot] == check[todo])
            out[todo[hit]] = self._index[slot[hit]]
            more = ~hit & (key != 0)
            todo, slot = todo[more], (slot[more] + 1) & (len(self._key) - 1)
            if not len(todo):
                break
        return out

    def _keep(self, h: np.ndarray, check: np.ndarray, first: int) -> None:
        mask = len(self._key) - 1
        for i, (a, b) in enumerate(zip(h.tolist(), check.tolist())):
            for slot in range(a & mask, (a & mask) + _PROBES):
                if not self._key[slot & mask]:
                    self._key[slot & mask], self._check[slot & mask], self._index[slot & mask] = a, b, first + i
                    break

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for t in textbytes.slices(column):
            yield from self._slice(t)

    def _uneven(self, t: textbytes.Texts, runs: textbytes.Words) -> np.ndarray:
        """Texts with white space other than single spaces and line feeds between words."""
        size, n_runs = np.diff(t.bounds), np.diff(runs.first)
        run = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[t.bounds])
        apart = run(~_PIECE[t.buf])
        odd = _ODD[t.buf]
        nxt = np.concatenate([t.buf[1:], [0]])[:len(t.buf)]
        odd |= (t.buf == 0xC2) & ((nxt == 0x85) | (nxt == 0xA0))
        odd |= (t.buf >= 0xE1) & (t.buf <= 0xE3) & ((nxt == 0x9A) | (nxt == 0x80) | (nxt == 0x81))
        ends = np.zeros(t.count, dtype=bool)  # begins or ends with white space
        full = np.flatnonzero(size > 0)
        ends[full] = ~(_PIECE[t.buf[t.bounds[full]]] & _PIECE[t.buf[t.bounds[full + 1] - 1]])
        return (run(odd) > 0) | ends | (apart != np.maximum(n_runs - 1, 0))

    def _slice(self, t: textbytes.Texts) -> Iterator[np.ndarray]:
        runs = textbytes.words(t, _PIECE)
        start, end = runs.start, runs.end
        whole = np.zeros(t.count, dtype=bool)
        feed = np.zeros(len(start), dtype=bool)
        if not self.drops_white:
            whole = self._uneven(t, runs)
            inner = np.ones(len(start), dtype=bool)  # not the first piece of its text
            inner[runs.first[:-1][np.diff(runs.first) > 0]] = False
            before = t.buf[np.maximum(start - 1, 0)]
            feed = inner & (before == 0x0A)
            start = start - (inner & (before == 0x20))  # a piece after a space keeps it
        cut = (end - start > 1) & _STOP[t.buf[end - 1]] & _LETTER[t.buf[np.maximum(end - 2, 0)]]
        order = np.arange(len(start)) + np.cumsum(cut) - cut  # a stop after a letter is a piece of its own
        first_piece = np.concatenate([order, [len(start) + int(cut.sum())]])[runs.first]
        owner, feeds = np.repeat(runs.owner, 1 + cut), np.zeros(int(first_piece[-1]), dtype=bool)
        feeds[order] = feed
        starts, ends_ = np.repeat(start, 1 + cut), np.repeat(end, 1 + cut)
        ends_[order[cut]] -= 1
        starts[order[cut] + 1] = end[cut] - 1
        start, end, feed = starts, ends_, feeds
        h = np.maximum(textbytes.Spans(t.buf).hash(start, end), np.uint64(1))
        check = textbytes.Spans(t.buf, which=1).hash(start, end)
        number = self._find(h, check)
        known, used = self.known, self.used
        missing = np.flatnonzero((number < 0) & ~whole[owner])
        if len(missing):
            _, first, back = np.unique(h[missing], return_index=True, return_inverse=True)
            first = missing[first]
            raw = t.buf.tobytes()
            self._append([raw[a:b].decode() for a, b in zip(start[first].tolist(), end[first].tolist())])
            number[missing] = known + back
            if self.known <= CACHE_PIECES:
                self._keep(h[first], check[first], known)
        # line feeds are pieces between the others
        at = np.arange(len(number)) + np.cumsum(feed)
        pieces = np.zeros(len(number) + int(feed.sum()), dtype=np.int64)
        pieces[at] = np.maximum(number, 0)
        size = self.size[pieces]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[pieces] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        edge = np.concatenate([[0], ends])[np.concatenate([at, [len(pieces)]])[first_piece]]
        if self.known > CACHE_PIECES:
            self.known, self.used = known, used
        odd = iter(self._whole([t.raw(i).decode() for i in np.flatnonzero(whole)]))
        for i in range(t.count):
            yield next(odd) if whole[i] else ids[edge[i]:edge[i + 1]]
