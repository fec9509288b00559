"""Near-duplicate documents by HyperMinHash.

1. One pass over the texts hashes every distinct 3-word shingle and keeps, in
   each of 128 buckets of the hash range, the smallest value as its count of
   leading zeros and ten mantissa bits (a 16-bit register). Empty registers
   of short texts are filled from other buckets in a fixed order per bucket.
2. Texts with equal shingle sets are one class, its smallest id stands for it.
3. Five registers make a band; two sets with Jaccard 0.85 miss all 25 bands
   with probability 4e-7 (from 0.8 on four: 32 bands, 5e-8).
4. Every band bucket first pairs its members with its most central one (the
   member in the most crowded buckets), which is linear in its size; pairs
   pass the collision-corrected Jaccard estimate and then the exact check on
   full sets. Components are formed, and only members of one bucket that are
   still in different components are paired, in blocks of bounded size. So no
   link that could join two components is left out, and a group of thousands
   of copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import connected_components, stored
from .textbytes import lower_ascii, mix, span_hashes, text_chunks, word_spans

BUCKETS = 128
MANTISSA = 10
_LOW = 57  # bits below the bucket number
#: Chance that different minima give one register: equal zero counts, times
#: equal mantissas.
COLLISION = (1 / 3) / (1 << MANTISSA)
#: Rows and shingles of a block when members of a crowded bucket are compared.
BLOCK_ROWS, BLOCK_ITEMS = 2048, 1 << 20

_FILL = np.stack([np.random.default_rng(100 + j).permutation(BUCKETS) for j in range(BUCKETS)])
_WORD_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(column, words: int = 3) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct 64-bit shingle hashes per text). A text of
    fewer words is one shingle, a text without words none."""
    for first, buf, off in text_chunks(column):
        buf = lower_ascii(buf)
        starts, ends, edges = word_spans(buf, off)
        h = span_hashes(buf, starts, ends)
        n = max(0, len(h) - words + 1)
        runs = np.zeros(n, np.uint64)
        for k in range(words):
            runs += h[k:k + n] * _WORD_FACTORS[k % 3] * np.uint64(2 * (k // 3) + 1)
        runs = mix(runs)
        sets = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a >= words:
                sets.append(np.unique(runs[a:b - words + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for k in range(a, b):
                    short = mix(np.array([short ^ h[k]], np.uint64))[0]
                sets.append(np.array([short], np.uint64))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, sets


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit registers per set; 0 throughout for an empty set."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    if sizes.sum() == 0:
        return out
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    cell = row * BUCKETS + (flat >> np.uint64(_LOW)).astype(np.int64)
    least = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))  # sets are sorted
    value = flat[least] & np.uint64((1 << _LOW) - 1)
    length = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    down = np.maximum(length - 1 - MANTISSA, 0).astype(np.uint64)
    up = np.maximum(MANTISSA + 1 - length, 0).astype(np.uint64)
    mantissa = ((value >> down) << up) & np.uint64((1 << MANTISSA) - 1)
    zeros = np.maximum(_LOW - length, 0).astype(np.uint64)
    out.reshape(-1)[cell[least]] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16) + 1
    found = out.copy()
    rows, cells = np.nonzero((out == 0) & (sizes > 0)[:, None])
    for t in range(BUCKETS):
        if not len(rows):
            break
        value = found[rows, _FILL[cells, t]]
        out[rows, cells] = value
        left = value == 0
        rows, cells = rows[left], cells[left]
    return out


def band_rows(similarity: int) -> int:
    """Registers of a band: chance to miss all bands under 1e-6 from 80 on."""
    return 5 if similarity >= 85 else 4 if similarity >= 80 else 3


def _bands_of(regs: np.ndarray, rows: int) -> np.ndarray:
    bands = BUCKETS // rows
    return regs[:, :bands * rows].reshape(len(regs), bands, rows)


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    part = _bands_of(regs, rows).astype(np.uint64)
    key = np.zeros(part.shape[:2], np.uint64) + np.arange(1, part.shape[1] + 1, dtype=np.uint64)
    for k in range(rows):
        key = mix(key ^ part[:, :, k])
    return key.view(np.int64)


def estimate(equal: np.ndarray) -> np.ndarray:
    """Jaccard from the number of equal registers, less chance agreement."""
    return (equal / BUCKETS - COLLISION) / (1 - COLLISION)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = (np.arange(len(rows) + 1) * width).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets),
                                                                pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for first, sets in shingle_sets(rb.column(1), words):
                size = np.array([len(s) for s in sets], np.int64)
                sums = [np.array([int(f(s)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                        for f in (lambda s: s.sum(dtype=np.uint64), lambda s: mix(s).sum(dtype=np.uint64))]
                yield pa.record_batch([rb.column(0).slice(first, len(sets)), pa.array(size), pa.array(sums[0]),
                                       pa.array(sums[1]), _binary(registers(sets))],
                                      names=["doc_id", "n_shingles", "d1", "d2", "regs"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for first, sets in shingle_sets(rb.column(1), words):
                offsets = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if offsets[-1] else np.zeros(0, np.int64)
                yield pa.record_batch([rb.column(0).slice(first, len(sets)),
                                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["rep", "items"])
    return run


def _bands(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            keys = band_keys(np.frombuffer(b"".join(rb.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS), rows)
            rep, size = (np.repeat(rb.column(k).to_numpy(zero_copy_only=False), keys.shape[1]) for k in (0, 2))
            yield pa.record_batch([pa.array(rep), pa.array(keys.reshape(-1)), pa.array(size)], names=["rep", "key", "size"])
    return run


def _promising(low: float):
    """Keep pairs (a, b, regs_a, regs_b) whose estimate is at least ``low``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            a, b = (np.frombuffer(b"".join(rb.column(k).to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in (2, 3))
            keep = estimate((a == b).sum(axis=1)) >= low
            yield pa.record_batch([c.filter(pa.array(keep)) for c in (rb.column(0), rb.column(1))], names=["a", "b"])
    return run


def _across(low: float, similarity: int, rows: int):
    """Links of one block between members of different components, on full
    sets. A pair is looked at in the first band it shares; once a link joins
    two components, no further pair of them is."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(block["regs"]), np.uint16).reshape(-1, BUCKETS)
        probe, rep, size = (block[c].to_numpy() for c in ("probe", "rep", "size"))
        comp = block["comp"].to_numpy().copy()
        count = np.array([len(x) for x in block["items"]])
        begin = np.cumsum(count) - count
        _, items = np.unique(np.concatenate(block["items"].tolist()), return_inverse=True)
        present = np.zeros(len(items) + 1, np.int64)
        band = int(np.argmax(band_keys(regs[:1], rows)[0] == block["key"].iloc[0]))
        members = np.flatnonzero(~probe)
        links: list[tuple[int, int]] = []
        for p in np.flatnonzero(probe):
            m = members[comp[members] != comp[p]]
            m = m[100 * np.minimum(size[m], size[p]) >= similarity * np.maximum(size[m], size[p])]
            equal = regs[m] == regs[p]
            bands = _bands_of(equal, rows).all(axis=2)
            m = m[(estimate(equal.sum(axis=1)) >= low) & (bands.argmax(axis=1) == band)]
            if not len(m):
                continue
            own = items[begin[p]:begin[p] + count[p]]
            present[own] = 1
            take = np.arange(count[m].sum()) + np.repeat(begin[m] - (np.cumsum(count[m]) - count[m]), count[m])
            shared = np.bincount(np.repeat(np.arange(len(m)), count[m]), present[items[take]], len(m))
            present[own] = 0
            for k in m[100 * shared >= similarity * (count[m] + count[p] - shared)]:
                if comp[k] != comp[p]:
                    links.append((min(rep[k], rep[p]), max(rep[k], rep[p])))
                    comp[comp == comp[k]] = comp[p]
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 3, similarity: int = 85,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Documents are linked when 100 * shared >= similarity * united shingles;
    a component's smallest id is its ``component_id`` and the one row kept.
    Empty and null texts have no shingles and link with nothing; repeated
    rows are links like any other; an empty table gives no rows; further
    columns are not read. A null id has a null component unless its set
    equals that of a document with an id, and is not kept."""
    folder = scratch_dir(spark, "near-duplicates")
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    band = band_rows(similarity)
    low = similarity / 100 - 4 * (similarity / 100 * (1 - similarity / 100) / BUCKETS) ** 0.5

    sketch = stored(texts.mapInArrow(_sketch(words), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, regs binary"),
                    f"{folder}/sketch")
    classes = stored(sketch.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.first("regs").alias("regs")), f"{folder}/classes")
    reps = classes.where("rep is not null")

    members = reps.select("rep", "regs", "n_shingles").mapInArrow(_bands(band), "rep bigint, key bigint, size bigint")
    crowded = stored(members.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1"), f"{folder}/crowded")
    crowd = stored(members.join(crowded, "key"), f"{folder}/crowd")
    central = crowd.groupBy("rep").agg(F.sum("crowd").alias("score"))
    leaders = stored(crowd.join(central, "rep").groupBy("key").agg(
        F.max_by("rep", F.struct("score", -F.col("rep"))).alias("lead")), f"{folder}/leaders")
    star = crowd.join(leaders, "key").where("rep <> lead").select(
        F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct()

    by_rep = reps.groupBy("rep").agg(F.first("regs").alias("regs"), F.max("n_shingles").alias("size"))
    near = star
    for side in ("a", "b"):
        near = near.join(by_rep.select(F.col("rep").alias(side), F.col("regs").alias(f"regs_{side}")), side)
    near = stored(near.select("a", "b", "regs_a", "regs_b").mapInArrow(_promising(low), "a bigint, b bigint"),
                  f"{folder}/star")

    sets = stored(texts.join(crowd.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                  .mapInArrow(_sets(words), "rep bigint, items array<bigint>"), f"{folder}/sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough."""
        for side in ("b", "a"):
            pairs = pairs.join(sets.select(F.col("rep").alias(side), F.col("items").alias(f"set_{side}")), side)
        shared = F.size(F.array_intersect("set_a", "set_b"))
        return (pairs.withColumn("shared", shared)
                .where(100 * F.col("shared") >= similarity * (F.size("set_a") + F.size("set_b") - F.col("shared")))
                .select("a", "b"))

    edges = stored(linked(near), f"{folder}/edges")
    found = connected_components(spark, edges, f"{folder}/first")
    placed = stored(crowd.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("comp"), "size",
        (1 / F.lit(BLOCK_ROWS) + F.col("size") / BLOCK_ITEMS).alias("load")), f"{folder}/placed")
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    # the component with the largest load of a bucket is not compared with itself
    per = placed.join(split.select("key"), "key").groupBy("key", "comp").agg(F.sum("load").alias("n"))
    main = stored(per.groupBy("key").agg(F.ceil(F.sum("n")).cast("int").alias("blocks"),
                                         F.max_by("comp", F.struct("n", -F.col("comp"))).alias("main"),
                                         F.ceil(F.sum("n") - F.max("n")).cast("int").alias("parts")), f"{folder}/main")
    rows = placed.join(main, "key").withColumn("h", F.xxhash64("rep"))
    as_member = (rows.withColumn("block", F.pmod("h", "blocks").cast("int"))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)))
                 .withColumn("probe", F.lit(False)))
    as_probe = (rows.where("comp <> main").withColumn("part", F.pmod("h", F.greatest("parts", F.lit(1))).cast("int"))
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("probe", F.lit(True)))
    columns = ["key", "block", "part", "probe", "rep", "comp", "size"]
    more = stored(as_member.select(columns).unionByName(as_probe.select(columns))
                  .join(by_rep.select("rep", "regs"), "rep").join(sets, "rep")
                  .groupBy("key", "block", "part").applyInPandas(_across(low, similarity, band), "a bigint, b bigint").distinct(),
                  f"{folder}/more")
    component = connected_components(spark, edges.unionByName(more), f"{folder}/second")

    return (sketch.join(classes.select("n_shingles", "d1", "d2", "rep"), ["n_shingles", "d1", "d2"], "left")
            .join(component.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
