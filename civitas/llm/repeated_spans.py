"""Removal of byte strings that occur more than once in the corpus.

Every string of ``SPAN`` bytes holds an anchor: the gram of ``GRAM`` bytes
with the smallest hash among the string's grams (winnowing). Equal strings
have equal anchors at equal places, so the windows around equal anchors meet
in one *cell*, and a cell lies in one shard:

1. One pass over the texts marks anchors with the hash of their window: all
   strings that have this anchor and no other, about half of those that hold
   its gram. Windows of an anchor that occurs once are done with; equal
   windows are counted, not carried.
2. A string has at least half of the bytes beside its anchor on one side, so
   windows that share neither the bytes before nor those behind their anchor
   (two hashes) with another window of their cell are done with, too. The
   other distinct windows are cut out of one text each. Shards of whole cells,
   about ``BLOCK_BYTES`` at a time, are sorted by Larsson-Sadakane refinement;
   Kasai's common prefixes of at least ``SPAN`` bytes give the strings that
   two windows of a cell share.
3. A cell with very many different windows is split by the bytes that the
   strings of one range of offsets have in common; what is still crowded is
   split into single strings, which a grouping counts. So no cell is one
   task's burden, whatever its size.
4. Covered intervals go back to every place of their window, are united per
   text and cut out.

Passages counted in words are found the same way: every word is laid out as a
code of ``CODE`` bytes of its hash, and strings of that many codes are sought.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import dropped, stored
from .suffix_array import common_prefixes, suffix_array
from .textbytes import hasher, mix, span_hashes, text_buffer, text_chunks, word_spans

SPAN, GRAM = 400, 100
#: Different windows of a cell that are sorted together; a larger cell is split.
CROWD = 1000
#: Ranges of offsets that a crowded cell is split into.
RANGES = 18
#: Bytes of a block that is sorted at once (whole cells, so one may have more):
#: a worker holds some hundred bytes of arrays for each.
BLOCK_BYTES = 1 << 18
#: Longest stretch of a text that is hashed at once.
STRETCH = 1 << 20
#: Bytes of a word's code; a passage takes another for itself where they
#: differ in one word of equal codes, 4e-15 a place.
CODE = 6

_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOWBITS = np.uint64(0xFFFFFFFF)


def anchors(hashes, off: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(positions, gram hashes, first starts, last starts) of the anchors of
    all spans inside a text; the spans from the first to the last start have
    this anchor. ``hashes`` hashes spans of the texts' bytes."""
    n, width = int(off[-1]), span - gram + 1
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - gram + 1)
    grams = hashes(at, at + gram)
    value = (grams & _HIGH) | at.astype(np.uint64)  # ties go to the first place
    table = np.concatenate([value, np.full(-len(value) % width, _HIGH | _LOWBITS)]).reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[:n - span + 1], ahead[width - 1:len(value)])
    ends = np.repeat(off[1:], np.diff(off))[:len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + span <= ends)
    chosen = (least[starts] & _LOWBITS).astype(np.int64)
    head = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1])[:len(chosen)])
    tail = np.append(head[1:], len(chosen))[:len(head)] - 1
    return chosen[head], grams[chosen[head]], starts[head], starts[tail]


def _stretches(buf: np.ndarray, off: np.ndarray, span: int):
    """(bytes, offsets, rows, first byte of each text, range kept) so that a
    very long text comes in overlapping stretches."""
    if len(off) > 2 or len(buf) <= STRETCH:
        yield buf, off, 0, 0, len(buf)
        return
    for a in range(0, len(buf), STRETCH):
        lo, hi = max(0, a - span), min(len(buf), a + STRETCH + span)
        yield buf[lo:hi], np.array([0, hi - lo]), lo, a - lo, min(len(buf), a + STRETCH) - lo


def word_codes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts with every word as its code."""
    starts, ends, before = word_spans(buf, off)
    codes = span_hashes(buf, starts, ends).view(np.uint8).reshape(-1, 8)[:, :CODE]
    return codes.reshape(-1), before * CODE


def _as_is(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return buf, off


def _mark(span: int, gram: int, lay=_as_is):
    """Runs of equal anchors: key, window hash, window start, reach of the
    run, window size, anchor's place in the window, anchors in the run, hashes
    of ``half`` bytes before the anchor and of what the strings with fewer
    have behind it (null where the window has no such string)."""
    half = (span - gram + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for first, whole, offs in text_chunks(rb.column(2)):
                for buf, off, base, keep_from, keep_to in _stretches(*lay(whole, offs), span):
                    if len(buf) < span:
                        continue
                    hashes = hasher(buf)
                    pos, key, a, b = anchors(hashes, off, span, gram)
                    inside = (pos >= keep_from) & (pos < keep_to)
                    pos, key, a, b = pos[inside], key[inside], a[inside], b[inside] + span
                    if not len(pos):
                        continue
                    row = np.searchsorted(off, pos, side="right") - 1
                    window = mix(hashes(a, b) ^ (pos - a).astype(np.uint64))
                    head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (window[1:] != window[:-1])))
                    tail = np.append(head[1:], len(pos)) - 1
                    rows, p, a, b = pa.array(row[head] + first), pos[head], a[head], b[head]
                    before, behind = p - a >= half, b - p > span - half
                    sides = [np.zeros(len(p), np.int32), np.zeros(len(p), np.int32)]
                    sides[0][before] = hashes(p[before] - half, p[before]).astype(np.uint32).view(np.int32)
                    sides[1][behind] = hashes(p[behind] + gram, p[behind] + span - half + 1).astype(np.uint32).view(np.int32)
                    yield pa.record_batch(
                        [rb.column(0).take(rows), rb.column(1).take(rows), pa.array(key[head].view(np.int64)),
                         pa.array(window[head].view(np.int64)), pa.array(a - off[row[head]] + base),
                         pa.array(pos[tail] - p), pa.array((b - a).astype(np.int32)),
                         pa.array((p - a).astype(np.int32)), pa.array(tail - head + 1),
                         pa.array(sides[0], mask=~before), pa.array(sides[1], mask=~behind)],
                        names=["doc", "th", "cell", "win", "at", "reach", "size", "lead", "reps", "before", "behind"])
    return run


_MARKS = "doc bigint, th bigint, cell bigint, win bigint, at bigint, reach bigint, size int, lead int, reps bigint, before int, behind int"
_CUTS = "cell bigint, win bigint, n bigint, lead int, bytes binary, up_cell bigint, up_win bigint, up_at int"


def _cut(span: int, gram: int, ranges: int, lay=_as_is):
    """Cut windows out of their texts; a crowded cell's into its ranges."""
    width = span - gram + 1
    step = -(-width // ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows: list[tuple] = []
            held = 0
            for text, wanted in zip(rb.column(0), rb.column(1).to_pylist()):
                raw = lay(*text_buffer(pa.array([text.as_py()], pa.string())))[0].tobytes()
                for w in wanted:
                    a, size, lead = w["at"], w["size"], w["lead"]
                    data = raw[a:a + size]
                    held += size
                    if not w["crowded"]:
                        rows.append((w["cell"], w["win"], w["n"], lead, data, None, None, 0))
                        continue
                    buf = np.frombuffer(data, np.uint8)
                    lows = np.arange(0, width, step)
                    highs = np.minimum(lows + step, width) - 1
                    # starts of the range's strings: lead - high .. lead - low, inside the window
                    some = (np.maximum(lead - highs, 0) <= np.minimum(lead - lows, size - span))
                    lows, highs = lows[some], highs[some]
                    begin, end = np.maximum(lead - highs, 0), np.minimum(lead - lows + span, size)
                    core = span_hashes(buf, lead - lows, lead - highs + span)
                    cells = mix(core ^ mix(np.uint64(w["cell"] & (2**64 - 1)) + lows.astype(np.uint64)))
                    wins = mix(span_hashes(buf, begin, end) ^ (lead - begin).astype(np.uint64))
                    for c, v, x, y in zip(cells.view(np.int64).tolist(), wins.view(np.int64).tolist(), begin.tolist(), end.tolist()):
                        rows.append((c, v, w["n"], lead - x, data[x:y], w["cell"], w["win"], x))
                    held += size * len(lows)
                if held > 4 * BLOCK_BYTES:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
    names = ["cell", "win", "n", "lead", "bytes", "up_cell", "up_win", "up_at"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def shared_strings(cells: np.ndarray, lead: np.ndarray, windows: list[bytes], span: int) -> tuple[np.ndarray, ...]:
    """(window, from, to) of the parts of each window that are covered by a
    string of ``span`` bytes which another window of its cell has too, at the
    same place from the anchor."""
    text = np.frombuffer(b"".join(windows), np.uint8)
    size = np.array([len(w) for w in windows])
    begin = np.cumsum(size) - size
    order = suffix_array(text, span)
    string = np.zeros(len(text), np.int64)
    string[order] = np.cumsum(common_prefixes(text, order, span) < span)
    count = np.maximum(size - span + 1, 0)
    window = np.repeat(np.arange(len(windows)), count)
    inner = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    _, cell = np.unique(cells, return_inverse=True)
    where = string[begin[window] + inner]
    place = lead[window] - inner + span  # never negative
    by = np.lexsort((place, cell[window], where))
    w, c, p = where[by], cell[window[by]], place[by]
    alike = (w[1:] == w[:-1]) & (c[1:] == c[:-1]) & (p[1:] == p[:-1])
    twice = np.zeros(len(by), bool)
    twice[by] = np.append(alike, False) | np.append(False, alike)
    window, inner = window[twice], inner[twice]
    if not len(window):
        return window, inner, inner
    head = np.append(True, (window[1:] != window[:-1]) | (inner[1:] > inner[:-1] + span))
    tail = np.append(head[1:], True)
    return window[head], inner[head], inner[tail] + span


def _sort_shards(span: int):
    """Covered parts of windows; batches hold whole cells in order."""
    def block(rows: list[tuple]) -> pa.RecordBatch | None:
        once = {(r[0], r[1]): r for r in rows}  # a repeated row cuts its windows twice
        rows = list(once.values())
        cells = np.array([r[0] for r in rows], np.int64)
        lead = np.array([r[2] for r in rows], np.int64)
        window, lo, hi = shared_strings(cells, lead, [r[3] for r in rows], span)
        wins = np.array([r[1] for r in rows], np.int64)
        return pa.record_batch([pa.array(cells[window]), pa.array(wins[window]), pa.array(lo.astype(np.int32)),
                                pa.array(hi.astype(np.int32))], names=["cell", "win", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for rb in batches:
            for r in zip(*(rb.column(k).to_pylist() for k in range(4))):
                if held >= BLOCK_BYTES and r[0] != rows[-1][0]:
                    yield block(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[3])
        if rows:
            yield block(rows)
    return run


def _single_strings(span: int):
    """Hash of each string of a window, with its place from the anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for cell, win, n, lead, data in zip(*(rb.column(k).to_pylist() for k in range(5))):
                buf = np.frombuffer(data, np.uint8)
                at = np.arange(max(0, len(buf) - span + 1))
                h = mix(span_hashes(buf, at, at + span) ^ mix((lead - at + span).astype(np.uint64) ^ np.uint64(cell & (2**64 - 1))))
                m = len(at)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(np.full(m, cell)), pa.array(np.full(m, win)),
                                       pa.array(np.full(m, n)), pa.array(at.astype(np.int32)),
                                       pa.array((at + span).astype(np.int32))], names=["string", "cell", "win", "n", "lo", "hi"])
    return run


def _word_cuts(raw: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Bytes of a text from the first to the last whole word of each run of codes."""
    if not runs:
        return []
    starts, ends, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    words = [(-(-a // CODE), b // CODE) for a, b in runs]
    return [{"lo": starts[a], "hi": ends[b - 1]} for a, b in words if a < b]


def _keep(as_text: bool):
    def run(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "kept_text": []}
        for t, s in zip(text, spans):
            raw = t.encode("utf-8") if t is not None else b""
            kept, removed, count = raw, 0, 0
            if s is not None and len(s):
                parts, at = [], 0
                for a, b in united([x for x in s if not x["coded"]] + _word_cuts(raw, united(x for x in s if x["coded"]))):
                    parts.append(raw[at:a])
                    removed, count, at = removed + b - a, count + 1, b
                kept = b"".join([*parts, raw[at:]])
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(removed)
            out["n_spans"].append(count)
            out["kept"].append(None if as_text else kept)
            out["kept_text"].append(kept.decode("utf-8", errors="ignore") if as_text else None)
        return pd.DataFrame(out)
    return run


def united(spans) -> list[tuple[int, int]]:
    """Maximal runs of the union of [from, to) spans."""
    out: list[list[int]] = []
    for a, b in sorted((int(s["lo"]), int(s["hi"])) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(spark: SparkSession, docs: DataFrame, span: int = SPAN, gram: int = GRAM, crowd: int = CROWD,
                   ranges: int = RANGES, as_text: bool = False, id_column: str = "doc_id",
                   text_column: str = "text", words: int | None = None) -> DataFrame:
    """``docs`` with a struct column ``dedup``: n_bytes, n_removed, n_spans
    (maximal removed runs) and the bytes that stay (``kept``; with ``as_text``
    ``kept_text``, where characters cut in two are dropped).

    A byte goes if a string of ``span`` bytes that covers it also starts
    anywhere else, in the same text or another; all of it is judged on the
    input. With ``words``, so does a word (signs between ASCII white space) in
    a passage of that many words that also starts anywhere else, however short
    its words and whatever white space is between them; white space between
    two words that go is taken with them. Null and empty texts, and texts
    under both lengths, keep all they have (null: no bytes). Repeated rows
    repeat each other's strings. An empty table gives no rows; further columns
    pass through, one named ``dedup`` is replaced."""
    from pyspark.sql.functions import pandas_udf

    keyed = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.xxhash64(text_column).alias("th"),
                        F.col(text_column).alias("body"))
    spans = _repeated(spark, keyed, span, gram, crowd, ranges, _as_is).withColumn("coded", F.lit(False))
    if words:
        coded = _repeated(spark, keyed, words * CODE, max(1, words // 4) * CODE, crowd, ranges, word_codes)
        spans = spans.unionByName(coded.withColumn("coded", F.lit(True)))
    spans = spans.groupBy("doc", "th").agg(F.collect_set(F.struct("coded", "lo", "hi")).alias("spans"))
    spans = spans.select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("spans").alias("__spans"))
    keep = pandas_udf(_keep(as_text), "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_text string")
    rows = docs.withColumn("__key", F.xxhash64(text_column))
    joined = rows.join(spans, rows["__key"].eqNullSafe(spans["__th"])
                       & rows[id_column].cast("bigint").eqNullSafe(spans["__doc"]), "left")
    return joined.withColumn("dedup", keep(F.col(text_column), F.col("__spans"))).drop("__key", "__doc", "__th", "__spans")


def _repeated(spark: SparkSession, keyed: DataFrame, span: int, gram: int, crowd: int, ranges: int, lay) -> DataFrame:
    """doc, th, lo, hi: repeated strings of ``span`` bytes of the texts
    ``body`` as ``lay`` lays them out, united where they share a window."""
    folder = scratch_dir(spark, "repeats")
    marks = stored(keyed.mapInArrow(_mark(span, gram, lay), _MARKS), f"{folder}/marks")
    cells = stored(marks.groupBy("cell").agg(F.sum("reps").alias("total")).where("total > 1").select("cell"), f"{folder}/cells")
    windows = stored(marks.join(cells, "cell").groupBy("cell", "win").agg(
        F.sum("reps").alias("n"), F.min(F.struct("doc", "th", "at")).alias("place"), F.first("size").alias("size"),
        F.first("lead").alias("lead"), F.first("before").alias("before"), F.first("behind").alias("behind")), f"{folder}/windows")
    # sides that a window without a twin shares with another one
    sides = windows.select("cell", "n", F.explode(F.array(*[
        F.struct(F.lit(k).alias("side"), F.col(c).alias("hash")) for k, c in enumerate(("before", "behind"))])).alias("s"))
    sides = stored(sides.where("s.hash is not null").groupBy("cell", "s.side", "s.hash").agg(F.count("*").alias("m"), F.min("n").alias("least"))
                   .where("m > 1 and least = 1").select("cell", "side", "hash"), f"{folder}/sides")
    near = windows
    for k, c in enumerate(("before", "behind")):
        near = near.join(sides.where(F.col("side") == k).select("cell", F.col("hash").alias(c), F.lit(True).alias(f"by_{c}")), ["cell", c], "left")
    near = stored(near.where("by_before or by_behind").select("cell", "win", "n", "place", "size", "lead"), f"{folder}/near")
    crowds = stored(near.groupBy("cell").agg(F.count("*").alias("m"), F.min("n").alias("least")), f"{folder}/crowds")

    # every window with a twin is covered; cells whose windows all have one need no sorting
    covers = windows.where("n > 1").select("cell", "win", F.lit(0).alias("lo"), F.col("size").alias("hi"))
    wanted = (near.join(crowds.where("m > 1 and least = 1"), "cell")
              .select("place.doc", "place.th", F.struct("cell", "win", "n", F.col("place.at").alias("at"), "size", "lead",
                                                        (F.col("m") > crowd).alias("crowded")).alias("w"))
              .groupBy("doc", "th").agg(F.collect_list("w").alias("wanted")))
    cuts = stored(keyed.alias("k").join(wanted.alias("w"), F.col("k.th").eqNullSafe(F.col("w.th"))
                                        & F.col("k.doc").eqNullSafe(F.col("w.doc")))
                  .select("body", "wanted").mapInArrow(_cut(span, gram, ranges, lay), _CUTS), f"{folder}/cuts")

    plain = cuts.where("up_cell is null").select("cell", "win", "lead", "bytes")
    parts = stored(cuts.where("up_cell is not null").dropDuplicates(["cell", "win", "up_cell", "up_win"])
                   .groupBy("cell", "win").agg(F.sum("n").alias("n"), F.first("lead").alias("lead"),
                                               F.first("bytes").alias("bytes")), f"{folder}/parts")
    part_crowds = parts.groupBy("cell").agg(F.count("*").alias("m"), F.min("n").alias("least"))
    open_parts = stored(parts.join(part_crowds.where("m > 1 and least = 1"), "cell"), f"{folder}/open-parts")
    strings = open_parts.where(F.col("m") > crowd).select("cell", "win", "n", "lead", "bytes").mapInArrow(
        _single_strings(span), "string bigint, cell bigint, win bigint, n bigint, lo int, hi int")
    common = strings.groupBy("string").agg(F.sum("n").alias("total")).where("total > 1").select("string")

    shards = plain.unionByName(open_parts.where(F.col("m") <= crowd).select("cell", "win", "lead", "bytes"))
    sorted_ = (shards.repartition("cell").sortWithinPartitions("cell")
               .select("cell", "win", "lead", "bytes")
               .mapInArrow(_sort_shards(span), "cell bigint, win bigint, lo int, hi int"))
    found = stored(sorted_.unionByName(strings.join(common, "string").select("cell", "win", "lo", "hi")).unionByName(
        parts.where("n > 1").select("cell", "win", F.lit(0).alias("lo"), F.length("bytes").cast("int").alias("hi"))),
        f"{folder}/found")
    # every string holds its cell's anchor, so what a window has covered is one interval
    found = found.groupBy("cell", "win").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # parts report to the window they were cut from
    ups = cuts.where("up_cell is not null").select("cell", "win", "up_cell", "up_win", "up_at").distinct()
    covers = covers.unionByName(found.join(plain.select("cell", "win").distinct(), ["cell", "win"], "left_semi")).unionByName(
        found.join(ups, ["cell", "win"]).select(
            F.col("up_cell").alias("cell"), F.col("up_win").alias("win"), (F.col("lo") + F.col("up_at")).alias("lo"),
            (F.col("hi") + F.col("up_at")).alias("hi")))
    covers = stored(covers.groupBy("cell", "win").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), f"{folder}/covers")
    dropped(spark, *[f"{folder}/{t}" for t in ("cells", "windows", "sides", "near", "crowds", "cuts", "parts", "open-parts", "found")])
    return marks.join(covers, ["cell", "win"]).select(
        "doc", "th", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("reach") + F.col("hi")).alias("hi"))
