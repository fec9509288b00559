"""Packing token ids of whole texts into sequences of one window length.

A document is cut into full windows and a rest. Rests are cut into pieces,
gathered into batches, and each batch is dealt to windows by Karmarkar-Karp
multiway differencing: partial partitions are merged so that the fullest
window of one meets the emptiest of the other, until one near-equal
partition is left. If its fullest window exceeds the capacity, the number of
windows rises and the batch is dealt again.

The work is one narrow pass: no shuffle, memory bounded by one batch, and a
lost task is simply run again (sequence numbers come from the partition).
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .encoder import encoder

WINDOW = 1024
#: Longest piece of a rest: several pieces a window let the sums meet.
PIECE = 256
#: Pieces of rests that one differencing deals out, and half as many more may
#: join to make the sum fall just under whole windows.
BATCH = 256

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size by Karmarkar-Karp multiway differencing.

    A partial partition holds its window sums in falling order, less the
    smallest; the two with the largest spread are merged first, the fullest
    window of one with the emptiest of the other."""
    if windows == 1:
        return np.zeros(len(sizes), np.int64)
    heap = []
    for k in range(len(sizes)):
        sums = np.zeros(windows, np.int64)
        sums[0] = sizes[k]
        groups: list = [None] * windows
        groups[0] = k
        heap.append((-int(sizes[k]), k, sums, groups))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        merged = [p if q is None else q if p is None else (p, q) for p, q in zip(x, reversed(y))]
        groups = [merged[k] for k in order.tolist()]
        sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), serial, sums, groups))
        serial += 1
    window = np.zeros(len(sizes), np.int64)
    for w, top in enumerate(heap[0][3]):
        stack = [] if top is None else [top]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            else:
                window[node] = w
    return window


def deal(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Near-equal windows of at most ``capacity``; every size fits one."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, windows)
        if np.bincount(window, sizes, windows).max() <= capacity:
            return window
        windows += 1


def cuts(n: int, window: int, piece: int) -> tuple[int, list[int]]:
    """(number of full windows, lengths of the rest's pieces)."""
    full, rest = divmod(n, window)
    return full, [piece] * (rest // piece) + ([rest % piece] if rest % piece else [])


def batch_end(sizes: np.ndarray, batch: int, window: int) -> int:
    """Where to end a batch: the least padding that leaves each window a
    token of slack."""
    total = np.cumsum(sizes)[batch - 1:]
    gap = -total % window
    gap[gap < total // window] = window
    return batch + int(np.argmin(gap))


def pack_tokens(docs: DataFrame, path: str, keeps_space: bool, end_id: int, window: int = WINDOW,
                piece: int = PIECE, batch: int = BATCH, with_ids: bool = False,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of sequences: which ids of which document lie where.

    One row per piece (``PIECES``); ``with_ids`` adds the ids themselves, the
    real output. A null or empty text has its end id alone; repeated rows are
    packed as often as they occur; an empty table gives no rows; further
    columns of ``docs`` are not read. A null ``doc_id`` stays null."""
    schema = PIECES + (", ids array<bigint>" if with_ids else "")

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path, keeps_space)
        sequence = TaskContext.get().partitionId() << 36
        rests: list[tuple] = []

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
            cols = dict(zip(names, zip(*rows)))
            out = [pa.array(cols[n], pa.int64()) for n in names if n != "ids"]
            if with_ids:
                out.append(pa.array([x.astype(np.int64) for x in cols["ids"]], pa.list_(pa.int64())))
            return pa.record_batch(out, names=[n for n in names if n != "ids"] + (["ids"] if with_ids else []))

        def flush(items: list[tuple]) -> list[tuple]:
            nonlocal sequence
            sizes = np.array([x[2] for x in items], np.int64)
            where = deal(sizes, window)
            order = np.lexsort((np.arange(len(items)), where))
            filled = np.cumsum(sizes[order]) - sizes[order]
            first = np.searchsorted(where[order], where[order])
            rows = [items[k] + (sequence + int(where[k]), int(filled[j] - filled[first[j]]))
                    for j, k in enumerate(order.tolist())]
            sequence += int(where.max()) + 1
            return rows

        for rb in batches:
            doc_ids = rb.column(0).to_pylist()
            for first, ids, bounds in codec.encode(rb.column(1), end_id):
                rows: list[tuple] = []
                raw = memoryview(ids.astype("<u4").tobytes())
                edges = bounds.tolist()
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    doc, n = doc_ids[first + k], b - a
                    full, parts = cuts(n, window, piece)
                    at = 0
                    for j, size in enumerate([window] * full + parts):
                        row = (doc, at, size, zlib.crc32(raw[4 * (a + at):4 * (a + at + size)]), n,
                               ids[a + at:a + at + size] if with_ids else None)
                        if j < full:
                            rows.append(row + (sequence, 0))
                            sequence += 1
                        else:
                            rests.append(row)
                        at += size
                while len(rests) >= batch * 3 // 2:
                    stop = batch_end(np.array([x[2] for x in rests[:batch * 3 // 2]]), batch, window)
                    rows += flush(rests[:stop])
                    del rests[:stop]
                if rows:
                    yield emit(rows)
        if rests:
            yield emit(flush(rests))

    return docs.select(id_column, text_column).mapInArrow(partition, schema)
