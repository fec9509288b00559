"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions, shifted and cut into
cells of width ``WIDTH``; ``k`` cell numbers make the key of one hash table.
Vectors with cosine 0.9 lie 0.447 apart and share one cell with probability
0.82, vectors at right angles with 0.49. The number of rows sets ``k`` (a
bucket holds some hundred unrelated vectors) and the number of tables (a link
at the threshold itself is missed with probability ``MISS``).

Equal vectors are one class with a count. Buckets are compared in blocks of
bounded size; a pair counts in the first table it shares, so every link is
counted once, and a block reports sums and one tree per component instead of
pairs: a crowd of near copies never becomes all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import connected_components, stored

WIDTH = 2.0
BUCKET = 200
MISS = 0.002
#: Vectors of one side of a block.
BLOCK = 2048
#: Rows that a task compares, about.
TASK_ROWS = 50_000


def cell_chance(distance: float, width: float) -> float:
    """Chance that two vectors so far apart share a cell of one projection."""
    r = width / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_shape(n: int, cosine: float, width: float = WIDTH) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` vectors."""
    near, far = (cell_chance(math.sqrt(2 - 2 * c), width) for c in (cosine, 0.0))
    k = max(4, math.ceil(math.log(max(n, 1) / BUCKET) / -math.log(far))) if n > BUCKET else 4
    return k, math.ceil(math.log(MISS) / math.log(1 - near ** k))


def _unit(rows) -> np.ndarray:
    x = rows if isinstance(rows, np.ndarray) else np.stack([np.asarray(r, np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table_keys(unit: np.ndarray, k: int, tables: int, width: float = WIDTH) -> np.ndarray:
    """(vectors, tables) 64-bit keys; directions depend on the dimension only."""
    d = unit.shape[1]
    rng = np.random.default_rng(1000 + d)
    cells = np.floor((unit @ rng.normal(size=(d, k * tables)) + rng.uniform(0, width, k * tables)) / width).astype(np.int64)
    cells = cells.view(np.uint64).reshape(len(unit), tables, k)
    key = np.zeros((len(unit), tables), np.uint64) + np.arange(1, tables + 1, dtype=np.uint64)
    for j in range(k):
        key = (key ^ cells[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _by_dimension(rows: list) -> Iterator[np.ndarray]:
    size = np.array([len(r) for r in rows])
    for d in np.unique(size):
        yield np.flatnonzero(size == d)


def _keys(k: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows = [np.asarray(v) for v in rb.column(1).to_pylist()]
            for at in _by_dimension(rows):
                keys = table_keys(_unit([rows[i] for i in at]), k, tables)
                yield pa.record_batch([rb.column(0).take(pa.array(at)), pa.array(np.full(len(at), len(rows[at[0]]), np.int32)),
                                       pa.array(list(keys), pa.list_(pa.int64()))], names=["rep", "dim", "keys"])
    return run


def block_links(unit: np.ndarray, keys: np.ndarray, copies: np.ndarray, chunk: np.ndarray, within: bool,
                cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links per vector, root of each one's tree) among the vectors of a
    block; pairs that share a key of an earlier table (``keys``) were counted
    there. Of two chunks only pairs across count, unless ``within``."""
    n = len(unit)
    total, root = np.zeros(n, np.int64), np.arange(n)
    for a in range(0, n, 256):
        i, j = np.nonzero(unit[a:a + 256] @ unit[a:].T >= cosine)
        i, j = i + a, j + a
        pair = (i < j) & (within | (chunk[i] != chunk[j]))
        i, j = i[pair], j[pair]
        for t in range(keys.shape[1]):
            if not len(i):
                break
            new = keys[i, t] != keys[j, t]
            i, j = i[new], j[new]
        if not len(i):
            continue
        total += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
        while True:
            least = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, root[i], least)
            np.minimum.at(root, root[j], least)
            root = root[root]
            if (root == before).all():
                break
    return total, root


BLOCK_KEY = ["table", "dim", "key", "low", "high"]
_PLACED = [*BLOCK_KEY, "rep", "copies", "chunk", "vector", "earlier"]


def _blocks(cosine: float):
    """Sums of links per vector, and its tree's root, of all blocks of a
    partition; rows come sorted by block."""
    def judged(rows: pa.Table, bounds: list[int]) -> pa.RecordBatch:
        column = {c: rows.column(c).combine_chunks() for c in _PLACED}
        plain = {c: column[c].to_numpy() for c in (*BLOCK_KEY, "rep", "copies", "chunk")}
        vectors, earlier = (column[c].flatten().to_numpy() for c in ("vector", "earlier"))
        v_at, e_at = (column[c].offsets.to_numpy() - column[c].offsets[0].as_py() for c in ("vector", "earlier"))
        out: list[tuple] = []
        for a, b in zip(bounds, bounds[1:]):
            unit = _unit(vectors[v_at[a]:v_at[b]].reshape(b - a, -1))
            keys = earlier[e_at[a]:e_at[b]].reshape(b - a, -1)
            total, root = block_links(unit, keys, plain["copies"][a:b], plain["chunk"][a:b], plain["low"][a] == plain["high"][a], cosine)
            some = np.flatnonzero((total > 0) | (root != np.arange(b - a)))
            if len(some):
                rep = plain["rep"][a:b]
                out.append((rep[some], total[some], rep[root[some]]))
        columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else ((), (), ()))]
        return pa.record_batch([pa.array(c) for c in columns], names=["rep", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for rb in batches:
            if not rb.num_rows:
                continue
            rows = pa.Table.from_batches([rb]) if held is None else pa.concat_tables([held, pa.Table.from_batches([rb])])
            change = np.zeros(rows.num_rows - 1, bool)
            for c in BLOCK_KEY:
                value = rows.column(c).to_numpy()
                change |= value[1:] != value[:-1]
            cuts = (np.flatnonzero(change) + 1).tolist()
            if cuts:
                yield judged(rows.slice(0, cuts[-1]), [0, *cuts])
                rows = rows.slice(cuts[-1])
            held = rows
        if held is not None:
            yield judged(held, [0, held.num_rows])
    return run


def _usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(spark: SparkSession, vectors: DataFrame, cosine: float = 0.9, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Links join vectors of one dimension with cosine >= ``cosine`` in double
    precision. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing and stay. Repeated rows are
    linked vectors like any other; a null id counts as a copy but is never a
    component's id; further columns are not read; an empty table gives no
    rows."""
    folder = scratch_dir(spark, "near-vectors")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(_usable(F.col("vector")), F.col("vector")))
    rows = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.hash("vector"))
    classes = stored(rows.where("vector is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")), f"{folder}/classes")
    reps = classes.where("rep is not null")
    k, tables = table_shape(reps.count(), cosine)

    keyed = stored(reps.select("rep", "vector").mapInArrow(_keys(k, tables), "rep bigint, dim int, keys array<bigint>"), f"{folder}/keys")
    entries = keyed.select("rep", "dim", F.posexplode("keys").alias("table", "key"))
    crowds = stored(entries.groupBy("table", "dim", "key").agg(F.count("*").alias("n")).where("n > 1"), f"{folder}/crowds")
    placed = (entries.join(crowds, ["table", "dim", "key"])
              .withColumn("chunks", F.ceil(F.col("n") / BLOCK).cast("int"))
              .withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other")))
    size = crowds.agg(F.sum(F.col("n") * F.ceil(F.col("n") / BLOCK))).first()[0] or 0
    blocks = (placed.join(keyed.select("rep", "keys"), "rep").join(reps.select("rep", "copies", "vector"), "rep")
              .withColumn("earlier", F.slice("keys", F.lit(1), F.col("table"))).select(*_PLACED)
              .repartition(-(-size // TASK_ROWS) or 1, *BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY))
    found = stored(blocks.mapInArrow(_blocks(cosine), "rep bigint, links bigint, root bigint"), f"{folder}/found")
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected_components(spark, found.select(F.col("rep").alias("a"), F.col("root").alias("b")), f"{folder}/components")
    known = stored(classes.select("h1", "h2", "rep", "copies").join(sums, "rep", "left")
                   .join(component.withColumnRenamed("node", "rep"), "rep", "left"), f"{folder}/known")
    result = rows.join(known, (rows["vector"].isNotNull()) & (rows["h1"] == known["h1"]) & (rows["h2"] == known["h2"]), "left")
    return (result.select("vec_id", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                          F.coalesce("component", "rep", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
