"""Token ids of whole texts through the tokenizers library.

Both public vocabularies split a text at white space before any merge, so a
text's ids are the ids of its white-space pieces one after the other. Every
distinct piece is encoded once by the library and kept in a bounded table;
numpy then cuts texts into pieces, looks them up and lays the ids out. Texts
with white space beyond ASCII or with an added token of the file (such as
``<|endoftext|>``) go through the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .textbytes import span_hashes, text_chunks

#: Bytes of texts that are encoded at once; sequences are numbered by chunk.
ENCODE_BYTES = 1 << 20
#: UTF-8 forms of Unicode white space beyond ASCII.
OTHER_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: ASCII signs without the apostrophe, which can start a contraction.
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(33, 127) if not _ALNUM[b] and b != 39]] = True


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


class PieceEncoder:
    """Encodes batches of texts with one tokenizer file.

    ``keeps_space``: byte-level vocabularies give white space its own ids and
    tie a single space to the word after it; word-end vocabularies drop it.
    ``max_pieces`` bounds the table; beyond it the table starts afresh.
    """

    def __init__(self, path: str, keeps_space: bool, max_pieces: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.whole = re.compile(b"|".join([OTHER_SPACE.pattern, *(re.escape(t.encode("utf-8")) for t in added)]))
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.keeps_space, self.max_pieces = keeps_space, max_pieces
        self._clear()

    def _clear(self) -> None:
        self.bits, self.used, self.n_ids = 16, 0, 0
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.where = np.zeros(1 << self.bits, np.int64)
        self.count = np.zeros(1 << self.bits, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)

    # -- table of known pieces: open addressing, whole arrays at a time
    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or -1."""
        mask = np.int64((1 << self.bits) - 1)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        key = self.keys[slot]
        hit = key == h
        out[hit] = slot[hit]
        open_ = np.flatnonzero(~hit & (key != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            key = self.keys[slot[open_]]
            hit = key == h[open_]
            out[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (key != 0)]
        return out

    def _insert(self, h: np.ndarray, where: np.ndarray, count: np.ndarray) -> None:
        """Add distinct, absent hashes."""
        while (self.used + len(h)) * 2 > len(self.keys):
            old = np.flatnonzero(self.keys)
            keys, w, c = self.keys[old], self.where[old], self.count[old]
            self.bits += 1
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.where = np.zeros(1 << self.bits, np.int64)
            self.count = np.zeros(1 << self.bits, np.int32)
            self._place(keys, w, c)
        self._place(h, where, count)
        self.used += len(h)

    def _place(self, h, where, count) -> None:
        mask = np.int64((1 << self.bits) - 1)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = h[free]
            won = free[self.keys[slot[free]] == h[free]]
            self.where[slot[won]], self.count[slot[won]] = where[won], count[won]
            left = left[self.keys[slot[left]] != h[left]]
            slot[left] = (slot[left] + 1) & mask

    def _learn(self, buf, starts, ends, h) -> None:
        _, first = np.unique(h, return_index=True)
        if self.used + len(first) > self.max_pieces:
            self._clear()
            _, first = np.unique(h, return_index=True)
        raw = buf.tobytes()
        pieces = [raw[a:b].decode("utf-8") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        ids = [e.ids for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        total = int(count.sum())
        while self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.n_ids:self.n_ids + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self._insert(h[first], self.n_ids + np.cumsum(count, dtype=np.int64) - count, count)
        self.n_ids += total

    # -- pieces
    def _pieces(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of pieces whose ids don't depend on their context."""
        n = len(buf)
        space = _SPACE[buf]
        begin = np.zeros(n + 1, bool)  # of a text
        begin[off] = True
        before = np.zeros(n, bool)  # the byte before is white space of the same text
        before[1:] = space[:-1]
        before &= ~begin[:-1]
        alnum, sign = _ALNUM[buf], _SIGN[buf]
        start = begin[:-1].copy()
        start[1:] |= (alnum[1:] & sign[:-1]) | (sign[1:] & alnum[:-1])
        if not self.keeps_space:
            start |= before | space
            starts = np.flatnonzero(start)
            ends = np.append(starts[1:], n)
            keep = ~space[starts]
            return starts[keep], ends[keep]
        plain = np.zeros(n, bool)  # the byte before is one space sign of the same text
        plain[1:] = buf[:-1] == 32
        start |= ~space & before & ~plain
        after = np.zeros(n, bool)  # the byte after is no white space and of the same text
        after[:-1] = ~space[1:]
        after &= ~begin[1:]
        start |= space & (after | ~before)
        starts = np.flatnonzero(start)
        return starts, np.append(starts[1:], n)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, np.uint32)

    def encode(self, column, end_id: int):
        """Yield (first row, ids, bounds) per chunk of a string column:
        the ids of text ``first + k``, ``end_id`` last, are
        ``ids[bounds[k]:bounds[k + 1]]``. Null texts are empty."""
        for first, buf, off in text_chunks(column, ENCODE_BYTES):
            ids, bounds = self._chunk(buf, off)
            if self.whole.search(buf):  # at least one text must go whole
                texts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                raw = buf.tobytes()
                for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    if self.whole.search(raw, a, b):
                        texts[k] = self._whole(raw[a:b])
                bounds = np.append(0, np.cumsum([len(x) for x in texts]))
                ids = np.concatenate(texts)
            n = len(off) - 1
            out = np.empty(len(ids) + n, np.uint32)
            last = bounds[1:] + np.arange(n)
            keep = np.ones(len(out), bool)
            keep[last] = False
            out[keep], out[last] = ids, end_id
            yield first, out, bounds + np.arange(n + 1)

    def _chunk(self, buf, off) -> tuple[np.ndarray, np.ndarray]:
        n = len(off) - 1
        if len(buf) == 0:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        starts, ends = self._pieces(buf, off)
        h = span_hashes(buf, starts, ends) | np.uint64(1)
        slot = self._find(h)
        missing = slot < 0
        if missing.any():
            held = self.used
            self._learn(buf, starts[missing], ends[missing], h[missing])
            if self.used < held:  # the table started afresh
                slot = self._find(h)
                if (missing := slot < 0).any():
                    self._learn(buf, starts[missing], ends[missing], h[missing])
            slot = self._find(h)
        count = self.count[slot].astype(np.int64)
        stop = np.cumsum(count)
        ids = self.ids[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.where[slot] - (stop - count), count)]
        return ids, np.append(0, stop)[np.searchsorted(starts, off)]


_encoders: dict[tuple, PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """The worker's encoder of a file; its table serves all later tasks."""
    key = (path, keeps_space)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, keeps_space)
    return _encoders[key]
