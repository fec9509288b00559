"""Suffix array and common prefixes of a byte block, in numpy.

``suffix_array`` is Larsson-Sadakane refinement: suffixes are sorted by their
first eight bytes, then every group that is still tied is sorted by the rank
of the suffix ``h`` bytes on, with ``h`` doubling; groups of one are never
touched again. ``common_prefixes`` is Kasai's algorithm in whole arrays: a
suffix whose neighbour is the successor of its predecessor's neighbour has a
common prefix one byte shorter, as long as there is one, so only the starts
of such chains are compared byte for byte. A chain ends behind a suffix whose
first byte differs from its neighbour's (at most 255 in a block).
"""

from __future__ import annotations

import numpy as np


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position, first byte highest; zeros follow."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.zeros(len(text), np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k:k + len(text)]
    return words


def _group_starts(change: np.ndarray) -> np.ndarray:
    """Index of the first member of each one's group."""
    return np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, compared on at
    least ``depth`` bytes; the end of the block counts as zeros."""
    n = len(text)
    words = _words(text)
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    change = np.append(True, sorted_words[1:] != sorted_words[:-1]) if n else np.zeros(0, bool)
    rank = np.zeros(n, np.int64)
    rank[order] = _group_starts(change)
    h = 8
    while h < depth and n:
        single = change & np.append(change[1:], True)
        tied = np.flatnonzero(~single)
        if not len(tied):
            break
        at = order[tied]
        on = at + h
        after = np.where(on < n, rank[np.minimum(on, n - 1)] + 1, 0)
        key = (rank[at] << 32) | after
        by = np.argsort(key, kind="stable")
        order[tied], key = at[by], key[by]
        change[tied] = np.append(True, key[1:] != key[:-1])
        rank[order[tied]] = _group_starts(change)[tied]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix length of every entry of ``order`` with the one before
    it (0 for the first); exact below ``depth``, at least ``depth`` else."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    words = _words(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    chain = np.zeros(n, bool)
    chain[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (text[:-1] == text[before[:-1]])
    chain[::depth] = False  # a chain restarts before its start's limit is used up
    heads = np.flatnonzero(~chain & (before >= 0))
    length = np.zeros(len(heads), np.int64)
    limit = np.minimum(n - np.maximum(heads, before[heads]), 2 * depth)
    open_ = np.arange(len(heads))
    while len(open_):
        a, b = heads[open_] + length[open_], before[heads[open_]] + length[open_]
        differ = words[a] ^ words[b]
        same = differ == 0
        bits = np.frexp(differ[~same].astype(np.float64))[1]  # may round one up at a byte's edge, mended below
        length[open_[~same]] += (64 - bits) // 8
        short = open_[~same]
        mend = heads[short] + length[short]
        other = before[heads[short]] + length[short]
        inside = (mend < n) & (other < n)
        length[short[inside]] += text[mend[inside]] == text[other[inside]]
        open_ = open_[same]
        length[open_] += 8
        open_ = open_[length[open_] < limit[open_]]
    found = np.zeros(n, np.int64)
    found[heads] = np.minimum(length, limit)
    start = np.maximum.accumulate(np.where(chain, 0, np.arange(n)))
    found = found[start] - (np.arange(n) - start)
    return found[order]
