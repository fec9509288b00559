"""Joins and set operations.

No join forces a broadcast of data that grows: Catalyst's statistics and
AQE's runtime sizes choose it under ``autoBroadcastJoinThreshold`` and fall
back to a sort-merge join, whose hot keys AQE's skew join splits.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, written


def _on(key):
    return [key] if isinstance(key, str) else list(key)


def enrich(df: DataFrame, ref: DataFrame, key) -> DataFrame:
    """Left outer equi join to a reference table."""
    return df.join(ref, _on(key), "left")


def enrich_strict(df: DataFrame, ref: DataFrame, key, required: str) -> DataFrame:
    """Left join then drop unmatched rows (Catalyst plans it as inner)."""
    return enrich(df, ref, key).filter(F.col(required).isNotNull())


class ObservedJoin:
    """Counters of a join that its own run fills in, without another scan:
    rows before and after it and rows without a match (J8's metrics; more rows
    after than before are repeated keys of the reference)."""

    def __init__(self):
        self._before, self._after = (Observation(f"join-{uuid.uuid4().hex}") for _ in range(2))

    def enrich_strict(self, df: DataFrame, ref: DataFrame, key, required: str) -> DataFrame:
        """``enrich_strict``, counted."""
        seen = df.observe(self._before, F.count(F.lit(1)).alias("rows_before"))
        joined = enrich(seen, ref, key).observe(self._after, F.count(F.lit(1)).alias("rows_after"),
                                                F.count_if(F.col(required).isNull()).alias("unmatched"))
        return joined.filter(F.col(required).isNotNull())

    def counts(self) -> dict[str, int]:
        """The counters of the first run of the joined frame; waits for it."""
        return {**self._before.get, **self._after.get}


def join_on_pair(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                 keep: str = "left", how: str = "inner") -> DataFrame:
    """Equi join with different key names; one key column kept."""
    out = left.join(right, left[lkey] == right[rkey], how)
    return out.drop(right[rkey]) if keep == "left" else out.drop(left[lkey])


def join_on_key(left: DataFrame, right: DataFrame, key, right_cols, how: str = "inner") -> DataFrame:
    """Equi join on a shared key, right side pruned to what is needed."""
    keys = _on(key)
    return left.join(right.select(*keys, *right_cols), keys, how)


#: Pairs of one key that a task makes, about; a key with more is dealt out.
MOST_PAIRS = 1_000_000


def fan_out(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Report of a null-safe join: (keys, n_left, n_right, n_pairs) of every
    key that both sides have; missing keys match each other."""
    keys = _on(keys)
    l, r = (df.groupBy(*[F.col(k).alias(f"{side}{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias(f"n_{name}"))
            for df, side, name in ((left, "__l", "left"), (right, "__r", "right")))
    same = reduce(lambda a, b: a & b, [F.col(f"__l{i}").eqNullSafe(F.col(f"__r{i}")) for i in range(len(keys))])
    return l.join(r, same).select(*[F.col(f"__l{i}").alias(k) for i, k in enumerate(keys)], "n_left", "n_right",
                                  (F.col("n_left") * F.col("n_right")).alias("n_pairs"))


def _dealt(left: DataFrame, right: DataFrame, keys, most_pairs: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with block numbers that a join has to agree in as well: a key
    of more than ``most_pairs`` pairs is cut into blocks of rows on either
    side, and each left block meets each right block once. Such a key has
    matches on both sides, so outer joins are as they were."""
    side = math.isqrt(most_pairs)
    hot = fan_out(left, right, keys).where(F.col("n_pairs") > most_pairs).select(
        *[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)],
        F.ceil(F.col("n_left") / side).alias("__nl"), F.ceil(F.col("n_right") / side).alias("__nr"))
    hot = written(hot, "hot-keys")
    if not hot.limit(1).count():
        return left, right, []

    def placed(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)])
        block = F.pmod(F.xxhash64(*df.columns), F.coalesce(own, F.lit(1)))
        rows = df.join(hot, same, "left").withColumn(mine, block)
        rows = rows.withColumn(theirs, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(other, F.lit(1)) - 1)))
        return rows.select(*df.columns, mine, theirs)
    return placed(left, "__nl", "__nr", "__bl", "__br"), placed(right, "__nr", "__nl", "__br", "__bl"), ["__bl", "__br"]


def null_safe_join(left: DataFrame, right: DataFrame, keys, suffixes=("_l", "_r"),
                   how: str = "inner", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Pandas ``merge`` semantics — missing keys match each other.

    Keys are counted on both sides first (``fan_out``); those of more than
    ``most_pairs`` pairs, such as one name without a department that a third
    of the rows have, are dealt out in blocks of rows.

    ``eqNullSafe`` is still planned as an equi join (hash on
    ``coalesce(k, default), isnull(k)``). Clashing non-key columns get
    the suffixes; the key columns are kept once, taken from the left.
    """
    keys = _on(keys)
    left, right, dealt = _dealt(left, right, keys, most_pairs)
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    clash = set(lcols) & set(rcols)
    lcols, rcols = ([c for c in cols if c not in dealt] for cols in (lcols, rcols))
    l2 = left.select(*[F.col(k).alias(f"__lk_{k}") for k in [*keys, *dealt]],
                     *[F.col(c).alias(c + suffixes[0] if c in clash else c) for c in lcols])
    r2 = right.select(*[F.col(k).alias(f"__rk_{k}") for k in [*keys, *dealt]],
                      *[F.col(c).alias(c + suffixes[1] if c in clash else c) for c in rcols])
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"__lk_{k}").eqNullSafe(F.col(f"__rk_{k}")) for k in [*keys, *dealt]])
    j = l2.join(r2, cond, how)
    return j.select(*[F.col(f"__lk_{k}").alias(k) for k in keys],
                    *[c for c in j.columns if not c.startswith("__")])


def added_removed(old: DataFrame, new: DataFrame, key: str, tag: str = "change") -> DataFrame:
    """Rows whose key exists only in ``old`` (removed) or only in ``new``
    (added), tagged; two anti joins, no collected key sets."""
    removed = old.join(new.select(key), key, "left_anti").withColumn(tag, F.lit("removed"))
    added = new.join(old.select(key), key, "left_anti").withColumn(tag, F.lit("added"))
    return removed.unionByName(added, allowMissingColumns=True)


def assemble_features(tables: list[DataFrame], keys) -> DataFrame:
    """Wide table of all indicators per key via a chain of left joins.

    The first table defines the rows. All tables are shuffled on the same
    keys, so Spark reuses one hash partitioning for every join in the chain.
    A key that occurs twice in a later table stops the job when it runs: it
    would multiply rows.
    """
    keys = _on(keys)
    return reduce(lambda a, b: a.join(_unique(b, keys), keys, "left"), tables)


def write_bucketed(df: DataFrame, name: str, keys, buckets: int) -> str:
    """``df`` as a table in ``buckets`` buckets of its keys, sorted by them,
    in the shared folder; its name in the catalog."""
    keys = _on(keys)
    folder = scratch_dir(df.sparkSession, "bucketed")
    table = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(table)
    return table


def assemble_bucketed(spark: SparkSession, names: list[str], keys) -> DataFrame:
    """``assemble_features`` of tables that ``write_bucketed`` wrote with the
    same keys and number of buckets: no join of the chain, nor the check for
    repeated keys, moves a row."""
    return assemble_features([spark.table(n) for n in names], keys)


def _unique(df: DataFrame, keys) -> DataFrame:
    """``df`` itself; a repeated key raises while rows are read."""
    others = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(*[F.first(c).alias(c) for c in others], F.count(F.lit(1)).alias("__n"))
    failure = F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*keys))))
    return one.filter(F.when(F.col("__n") > 1, failure.cast("boolean")).otherwise(True)).drop("__n")


def join_audit(left: DataFrame, right: DataFrame, key, match_col: str) -> DataFrame:
    """Rows before/after a left join, unmatched rows and duplicate keys
    in the reference, as a tidy (metric, value) table. Each input is read once
    and counted per key; the counts are joined, not the rows. Missing keys
    match nothing."""
    keys = _on(key)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    l = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__l")).withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    r = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__r"), F.count_if(F.col(match_col).isNull()).alias("__null")).withColumn("__whole", whole)
    same = reduce(lambda a, b: a & b, [F.col(f"__k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)])
    both, meets = l.join(r, same, "full"), F.coalesce("__whole", F.lit(False))
    zero = F.lit(0).cast("bigint")
    found = both.agg(F.sum("__l").alias("rows_before"), F.sum(F.col("__l") * F.when(meets, F.col("__r")).otherwise(1)).alias("rows_after"),
                     F.sum(F.col("__l") * F.when(meets, F.col("__null")).otherwise(1)).alias("unmatched"), F.sum(F.col("__r") - 1).alias("ref_duplicates"))
    names = ["rows_before", "rows_after", "unmatched", "ref_duplicates"]
    return found.select(*[F.coalesce(n, zero).alias(n) for n in names]).unpivot([], names, "metric", "value")


def key_difference(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (set difference)."""
    return a.select(key).subtract(b.select(F.col(b_key or key).alias(key)))


def distinct_union(frames: list[DataFrame], col: str, name: str | None = None) -> DataFrame:
    """Sorted distinct non-missing values over several frames."""
    name = name or col
    parts = [f.select(F.col(col).alias(name)) for f in frames]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.dropna().distinct().orderBy(name)
