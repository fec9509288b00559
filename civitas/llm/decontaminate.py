"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A seed is a fixed mask over token places: the places it leaves out may hold
any token, so a passage with some words replaced still shares seeds with its
source. Hashes of all masks at all places of the texts are looked up among
those of the benchmark items, and around every hit the item and the text are
laid side by side: a window of ``WINDOW`` tokens (the whole item if it is
shorter) that agrees in 80 of 100 places is a leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import stored

#: Places that count, six of each mask; the rest are ignored.
MASKS = ((0, 1, 2, 4, 5, 7), (0, 1, 3, 4, 6, 8), (0, 2, 3, 5, 8, 9), (0, 1, 4, 6, 7, 9))
WINDOW, AGREE = 13, 80
#: Seeds of the benchmark that are looked up at once: a block of this many
#: rows, each with at most 2 * WINDOW - 1 tokens of its item around the place,
#: is broadcast (under 80 MB); a larger benchmark comes in blocks.
BLOCK_SEEDS = 300_000
#: Tokens of a stretch that is searched at once.
STRETCH = 4096


def tokens(text: Column) -> Column:
    """Runs of letters and digits in lower case, as 64-bit hashes."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def short_runs(n: int, agree: int) -> list[tuple[int, int]]:
    """(start, length) of the runs that an item of ``n`` tokens, fewer than a
    window, is cut into: one more than places may differ, so that one run
    agrees whole in every overlap that counts."""
    parts = n - -(-n * agree // 100) + 1
    cuts = [n * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _short_seeds(items: DataFrame, lengths: list[int], agree: int) -> DataFrame:
    """Rows of short items (all columns, place, seed), one per run."""
    def seed(start: int, run: int) -> Column:
        return F.xxhash64(F.lit(100 + run), *[F.get("toks", F.lit(start + k)) for k in range(run)])
    seeds = [F.when(F.size("toks") == n, F.array(*[F.struct(F.lit(a).alias("place"), seed(a, r).alias("seed")) for a, r in short_runs(n, agree)]))
             for n in lengths]
    rows = items.withColumn("run", F.explode(F.coalesce(*seeds)))
    return rows.select(*items.columns, "run.place", "run.seed")


def _seeds(rows: DataFrame, masks=MASKS, runs=()) -> DataFrame:
    """One row per place and mask or run that fits: all columns, place, seed."""
    last = min([m[-1] for m in masks] + [r - 1 for r in runs])
    places = F.when(F.size("toks") > last, F.sequence(F.lit(0), F.size("toks") - 1 - last))
    keys = [F.when(F.col("place") + m[-1] < F.size("toks"),
                   F.xxhash64(F.lit(k), *[F.get("toks", F.col("place") + o) for o in m])) for k, m in enumerate(masks)]
    keys += [F.when(F.col("place") + r <= F.size("toks"), F.xxhash64(F.lit(100 + r), *[F.get("toks", F.col("place") + k) for k in range(r)]))
             for r in runs]
    placed = rows.withColumn("place", F.explode(places))
    return placed.withColumn("seed", F.explode(F.array(*keys))).where("seed is not null")


def _stretches(texts: DataFrame, window: int) -> DataFrame:
    """Texts in overlapping stretches of tokens: what a hit carries along is
    bounded, however long the text. Every window lies whole in one stretch."""
    reach = STRETCH + 2 * window + max(m[-1] for m in MASKS) + 1
    starts = F.when(F.size("toks") > 0, F.sequence(F.lit(0), F.size("toks") - 1, F.lit(STRETCH)))
    return texts.select("doc_id", "text_hash", F.explode(F.transform(starts, lambda s: F.slice("toks", s + 1, reach))).alias("toks"))


def _overlap(window: int) -> tuple[Column, Column]:
    """(agreement per token of ``part``, most agreeing places of a window of
    ``wide`` tokens that holds the hit, -1 if none fits item and text).
    ``part`` starts at place ``base`` of the item."""
    same = F.transform(F.col("part"), lambda t, j: F.when(F.get("toks", F.col("shift") + F.col("base") + j) == t, 1).otherwise(0))
    starts = F.sequence(F.greatest(F.lit(0), F.col("at") - F.col("wide") + 1), F.least(F.col("at"), F.col("long") - F.col("wide")))
    inside = F.filter(starts, lambda s: (F.col("shift") + s >= 0) & (F.col("shift") + s + F.col("wide") <= F.size("toks")))
    best = F.array_max(F.transform(inside, lambda s: F.aggregate(
        F.slice("same", s - F.col("base") + 1, F.col("wide")), F.lit(0), lambda x, y: x + y)))
    return same, F.coalesce(best, F.lit(-1))


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, agree: int = AGREE,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per text and item that leaks into it: doc_id, text_hash,
    item_id, agreeing (most agreeing places), of (places compared).

    Null and empty texts and items never match. Items of fewer than ``window``
    tokens are compared whole; they are looked up by runs, one of which must
    agree (a single token's item leaks into every text that has the token).
    Repeated texts give one row, items of equal text a
    row each; empty tables give no rows; further columns are not read."""
    folder = scratch_dir(spark, "leaks")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), tokens(F.col("text")).alias("toks"))
    base = F.greatest(F.lit(0), F.col("place") - window + 1)
    short = sorted(r[0] for r in items.where(F.size("toks").between(1, window - 1)).select(F.size("toks")).distinct().collect())
    runs = sorted({r for n in short for _, r in short_runs(n, agree)})
    placed = _seeds(items.where(F.size("toks") >= window))
    if short:
        placed = placed.unionByName(_short_seeds(items.where(F.size("toks").between(1, window - 1)), short, agree))
    seeds = stored(placed.select(
        "seed", "item_id", F.col("place").alias("at"), base.alias("base"), F.size("toks").alias("long"),
        F.least(F.lit(window), F.size("toks")).alias("wide"), F.slice("toks", base + 1, 2 * window - 1).alias("part")).distinct(),
        f"{folder}/seeds")
    blocks = -(-seeds.count() // BLOCK_SEEDS)
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.xxhash64(text_column).alias("text_hash"),
                        tokens(F.col(text_column)).alias("toks"))
    found = None
    for k in range(max(blocks, 1)):
        block = seeds.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == k) if blocks > 1 else seeds
        hits = _seeds(_stretches(texts, window), runs=runs).join(F.broadcast(block), "seed").withColumn("shift", F.col("place") - F.col("at"))
        same, best = _overlap(window)
        hits = hits.withColumn("same", same).withColumn("agreeing", best).select("doc_id", "text_hash", "item_id", "agreeing", "wide")
        found = hits if found is None else found.unionByName(hits)
    # the threshold comes after the grouping, so that it stays out of the join
    best_of = found.groupBy("doc_id", "text_hash", "item_id").agg(F.max("agreeing").alias("agreeing"), F.max("wide").alias("of"))
    return best_of.where(100 * F.col("agreeing") >= agree * F.col("of"))


def flag_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, agree: int = AGREE,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``contaminated`` and ``n_items``, the number of items
    that leak into the text (see ``find_leaks``). Columns of these names are
    replaced, all others kept; a null id works like any other value."""
    leaks = stored(find_leaks(spark, docs, benchmark, window, agree, id_column, text_column)
                   .groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")), f"{scratch_dir(spark, 'leaks')}/found")
    leaks = leaks.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("n").alias("__n"))
    rows = docs.withColumn("__text", F.xxhash64(text_column))
    joined = rows.join(leaks, F.col("__text").eqNullSafe(F.col("__hash"))
                       & F.col(id_column).cast("bigint").eqNullSafe(F.col("__doc")), "left")
    return (joined.withColumn("contaminated", F.col("__n").isNotNull()).withColumn("n_items", F.coalesce("__n", F.lit(0)))
            .drop("__text", "__doc", "__hash", "__n"))
