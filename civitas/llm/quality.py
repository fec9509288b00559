"""Quality rules: plain counts of a text, base rules, and robust outliers.

The counts of a document, as a vector of logarithms of size, word length and
shares, are compared with those of its language and source. Location and
scatter of such a group are minimum-covariance-determinant estimates: of all
subsets of ``COVER`` of the group's documents, the one whose covariance has
the least determinant. Concentration steps find it: distances from the
present estimate, then the mean and covariance of the nearest documents, until
the determinants stay; they start from medians and median deviations. A
document whose Mahalanobis distance from the final, reweighted estimate
exceeds ``CUT`` is rejected.

All of it is DataFrame functions. Texts are read once, into a table of counts.
A step is two passes over that table: one counts the documents per group and
class of distance (1/32 octave), the other sums the moments up to the class in
which ``COVER`` is reached; a group that holds a third of all documents is
combined before the shuffle. Vectors are rounded to ``GRID``, so sums don't depend on
their order. As every covariance is floored by ``LEAST`` (the regularised
estimate of Boudt et al. 2020 with a diagonal target), groups that agree in
some count have a distance as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import stored

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a window that counts as repeated.
WINDOW = 5
#: Documents that a group needs for an estimate of its own; the smaller ones of
#: a language are one group, and those of small languages another.
LEAST_ROWS = 60
COVER = 0.75
GRID = 1024.0
#: Standard deviation of each coordinate that no group goes below.
LEAST = (0.3, 0.1, 0.5, 0.5, 0.6, 1.0)
#: Tail of the chi-square law beyond which a document is rejected. Counts have
#: heavier tails than a normal law, so it lies far out (a distance of 8).
TAIL = 1e-11
STEPS = 30
FALL = 1e-3
P = len(LEAST)


def _chance(x: float, freedom: int) -> float:
    """Chance that a chi-square variable of an even number of degrees of
    freedom is at most ``x``."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def _quantile(chance: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chance(mid, freedom) < chance else (low, mid)
    return low


def _consistency(share: float) -> float:
    """Factor that makes the covariance of the central ``share`` of a normal
    law that of the whole law."""
    return share / _chance(_quantile(share, P), P + 2)


CUT = _quantile(1 - TAIL, P)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words that lie in windows which occur twice or more in the array."""
    last = F.size(words) - WINDOW
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    grams = _let(hashed, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                                               lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    def count(gram: Column) -> Column:
        by_gram = F.sort_array(F.transform(gram, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = _let(by_gram, lambda s: F.filter(s, lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        covered = _let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"), lambda a, b: a + b))
        return F.when(F.size(F.array_distinct(gram)) == F.size(gram), F.lit(0).cast("bigint")).otherwise(covered)

    return F.when(last < 1, F.lit(0).cast("bigint")).otherwise(_let(grams, count))


def text_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and n_capitals (A-Z) of a whole text; a null text has none of them.
    Windows are equal if 64-bit hashes of their words are."""
    def without(t: Column, signs: str) -> Column:
        return F.length(F.translate(t, signs, ""))

    def counts(t: Column) -> Column:
        words = F.array_remove(F.split(t, "[\\x20\\x09-\\x0D]+"), "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
        more = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("repeated")))
        return F.struct(more.alias("words"), without(t, BLANKS).alias("word_chars"), (F.length(t) - without(t, SYMBOLS)).alias("n_symbols"),
                        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
                        (F.length(t) - without(t, CAPITALS)).alias("n_capitals"))

    return _let(F.coalesce(text, F.lit("")), counts)


def _coordinates() -> list[Column]:
    n, chars = F.col("n_words"), F.col("word_chars")
    rate = {c: F.col(c) / F.greatest(chars, F.lit(1)) for c in ("n_symbols", "n_capitals")}
    rate |= {c: F.col(c) / F.greatest(n, F.lit(1)) for c in ("n_dup_lines", "n_repeat_words")}
    logs = [F.log1p(n), F.log1p(chars / F.greatest(n, F.lit(1))), F.log1p(1000 * rate["n_symbols"]),
            F.log1p(100 * rate["n_capitals"]), F.log1p(1000 * rate["n_dup_lines"]), F.log1p(100 * rate["n_repeat_words"])]
    return [(F.rint(x * GRID) / GRID).alias(f"x{j}") for j, x in enumerate(logs)]


def _groups(rows: DataFrame, by: list[str], least: int, folder: str) -> DataFrame:
    """(``by``, pool): the group in which a document is judged."""
    counts = rows.groupBy(*by).agg(F.count("*").alias("n")).withColumn("own", F.monotonically_increasing_id())
    counts = stored(counts, folder)
    small = counts.where(F.col("n") < least)
    wide = small.groupBy(F.col(by[0]).alias("_wide")).agg(F.sum("n").alias("_n"), F.min("own").alias("_pool"))
    rest = wide.where(F.col("_n") < least).agg(F.min("_pool")).first()[0]
    pool = F.when(F.col("n") >= least, F.col("own")).when(F.col("_n") >= least, F.col("_pool")).otherwise(F.lit(rest).cast("bigint"))
    return counts.join(wide, F.col(by[0]).eqNullSafe(F.col("_wide")), "left").select(
        *[F.col(c).alias(f"_{c}") for c in by], pool.alias("pool"))


def _middle(counts: DataFrame, value: str) -> DataFrame:
    """(pool, j, middle): lower median of ``value`` by its counts ``n``; at
    most as many rows meet in a task as there are values on the grid."""
    running = counts.selectExpr("pool", "j", value, f"sum(n) OVER (PARTITION BY pool, j ORDER BY {value}) AS upto",
                                "sum(n) OVER (PARTITION BY pool, j) AS total")
    return running.where("2 * upto >= total").groupBy("pool", "j").agg(F.min(value).alias("middle"))


def _start(x: DataFrame) -> DataFrame:
    """(pool, m0.., l00, l10, l11, ..): medians, and scatter from median
    deviations alone."""
    long = x.select("pool", F.posexplode(F.array(*[f"x{j}" for j in range(P)])).alias("j", "v"))
    counts = long.groupBy("pool", "j", "v").agg(F.count("*").alias("n"))
    median = _middle(counts, "v")
    away = counts.join(median, ["pool", "j"]).groupBy("pool", "j", F.abs(F.col("v") - F.col("middle")).alias("away")).agg(F.sum("n").alias("n"))
    both = median.join(_middle(away, "away").withColumnRenamed("middle", "away"), ["pool", "j"])
    return both.groupBy("pool").agg(
        *[F.max(F.when(F.col("j") == j, F.col("middle"))).alias(f"m{j}") for j in range(P)],
        *[(F.max(F.when(F.col("j") == j, F.greatest(1.4826 * F.col("away"), F.lit(LEAST[j])))) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
          for i in range(P) for j in range(i + 1)])


def _distances(x: DataFrame, estimate: DataFrame) -> DataFrame:
    """``x`` with ``d2``, the squared Mahalanobis distance in its pool: the
    length of the forward solution of the scatter's triangular root."""
    names = [c for c in x.columns]
    rows = x.join(estimate, "pool")
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return rows.select(*names, sum(F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)).alias("d2"))


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS]]


def _estimate(moments: DataFrame, share: float) -> DataFrame:
    """Means and the triangular root of the scatter of (pool, n, sums)."""
    factor = _consistency(share)
    rows = moments.select("pool", "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(P)], *[f"p{i}{j}" for i, j in PAIRS])
    for i, j in PAIRS:
        covered = factor * F.greatest(F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"), F.lit(0.0) if i == j else F.lit(-1e300))
        rest = covered + (LEAST[i] ** 2 if i == j else 0.0)
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        rows = rows.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(LEAST[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}"))
    return rows.drop("n", *[f"p{i}{j}" for i, j in PAIRS])


def _concentrated(x: DataFrame, estimate: DataFrame) -> DataFrame:
    """Moments of the nearest ``COVER`` of every pool: counts per class of
    distance give the last class, then one more pass sums what lies within."""
    placed = _distances(x, estimate).withColumn("bin", F.floor(32 * F.log2(F.col("d2") + 1e-6)))
    classes = placed.groupBy("pool", "bin").agg(F.count("*").alias("n"))
    near = classes.selectExpr("*", "sum(n) OVER (PARTITION BY pool ORDER BY bin) AS upto", "sum(n) OVER (PARTITION BY pool) AS total")
    last = near.where(F.col("upto") - F.col("n") < F.ceil(COVER * F.col("total"))).groupBy("pool").agg(F.max("bin").alias("last"))
    return placed.join(last, "pool").where("bin <= last").groupBy("pool").agg(*_moments())


def covariance_estimates(x: DataFrame, folder: str) -> DataFrame:
    """Estimates of all pools of ``x`` (pool, x0, x1, ...): concentration
    steps until no pool's determinant falls by ``FALL`` (of its root's
    logarithm; a pool that doesn't fall keeps its estimate and is left out of
    further steps), then one reweighting."""
    size = sum(F.log(F.col(f"l{i}{i}")) for i in range(P))
    estimate = stored(_start(x).withColumn("size", F.lit(1e300)).withColumn("open", F.lit(True)), f"{folder}/start")
    for step in range(STEPS):
        found = _estimate(_concentrated(x, estimate.where("open").drop("size", "open")), COVER).withColumn("size", size)
        fell = F.coalesce(F.col("n.size") < F.col("o.size") - FALL, F.lit(False))
        names = [c for c in estimate.columns if c not in ("pool", "open")]
        estimate = stored(estimate.alias("o").join(found.alias("n"), "pool", "left").select(
            "pool", *[F.when(fell, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in names], fell.alias("open")),
            f"{folder}/step-{step}")
        if not estimate.where("open").limit(1).count():
            break
    estimate = estimate.drop("size", "open")
    inner = _distances(x, estimate).where(F.col("d2") <= _quantile(0.975, P)).groupBy("pool").agg(*_moments())
    return stored(_estimate(inner, 0.975), f"{folder}/reweighted")


def quality_verdicts(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     group_columns: tuple[str, str] = ("lang", "source"), least_rows: int = LEAST_ROWS, cut: float = CUT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_capitals, base_failed, distance (null where
    the base rules failed) and kept.

    Base rules: at least 10 words, of which at most 20 of 100 lie in repeated
    windows. Estimates rest on all documents that pass them. Null and empty
    texts fail them; a null language or source is a value like any other;
    repeated rows count as often as they occur; an empty table gives no rows;
    further columns are not read."""
    folder = scratch_dir(spark, "quality")
    by = list(group_columns)
    rows = docs.select(F.col(id_column).alias("doc_id"), *[F.col(c).alias(f"g{k}") for k, c in enumerate(by)],
                       text_counts(F.col(text_column)).alias("c"))
    counts = [F.col("c.words.n").cast("bigint").alias("n_words"), *[F.col(f"c.{c}").cast("bigint").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")],
              F.col("c.words.repeated").alias("n_repeat_words"), F.col("c.n_capitals").cast("bigint").alias("n_capitals")]
    rows = stored(rows.select("doc_id", "g0", "g1", *counts), f"{folder}/counts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    passed = rows.where(~F.col("base_failed"))
    groups = _groups(passed, ["g0", "g1"], least_rows, f"{folder}/groups")
    placed = rows.join(groups, F.col("g0").eqNullSafe(F.col("_g0")) & F.col("g1").eqNullSafe(F.col("_g1")), "left").drop("_g0", "_g1", "g0", "g1")
    placed = stored(placed.select("*", *_coordinates()), f"{folder}/vectors")
    x = placed.where(~F.col("base_failed")).select("pool", *[f"x{j}" for j in range(P)])
    estimates = covariance_estimates(x, folder)
    judged = _distances(placed.where(~F.col("base_failed")), estimates)
    out = judged.unionByName(placed.where("base_failed").withColumn("d2", F.lit(None).cast("double")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "base_failed",
                      F.sqrt("d2").alias("distance"), (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cut)).alias("kept"))
