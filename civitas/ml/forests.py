"""Forests of fully grown trees.

Spark ML grows all trees of a forest level by level on the driver, which 300
trees without a depth limit don't allow. Here trees are grown side by side:
every tree draws its rows by a hash of (row, tree), a shuffle brings the rows
of a few trees together, and a task grows them level by level with numpy, all
nodes of a level at once.

A tree is grown from all rows: a bootstrap tree draws as many rows as there
are, a tree without bootstrap takes each once. ``maxRows`` of ``Forest`` makes
smaller trees for those who ask for them; no query does.

Fully grown trees have up to two nodes per row, so 300 of them are many times
the table. A model fresh from ``fit`` therefore writes no trees: the rows to
predict travel to the tasks that grow, and only sums of leaves come back. The
trees become a table, one row per tree, when they are asked for (to save the
model); then they are grown for it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

N_TREES = 300
TREES_A_TASK = 8
#: Rows of a tree's nodes that are grown at once; the tree itself is of all rows.
AT_ONCE = 16_384
#: Trees of at most ``maxRows`` rows share their rows in groups up to this many times as many rows.
SHARED = 4
#: Nodes of stored trees that a task holds at once.
NODES_AT_ONCE = 1_000_000
#: Rows, once per feature, whose random cuts are judged at once.
PAIR_ROWS = 400_000
TREE = "tree int, feature array<int>, threshold array<double>, left array<int>, value array<double>"
LEAVES = "group int, row long, trees int, total array<double>"


def _starts(node: np.ndarray) -> np.ndarray:
    change = np.ones(len(node), bool)
    np.not_equal(node[1:], node[:-1], out=change[1:])
    return np.flatnonzero(change)


def _score(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Size of the squared sums of both sides over their weights; the weight is
    the first column. The highest score is the least impurity."""
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        return (left[:, 1:] ** 2).sum(1) / left[:, 0] + (right[:, 1:] ** 2).sum(1) / right[:, 0]


def _best_cuts(code: np.ndarray, values: np.ndarray, stats: np.ndarray, node: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, threshold) of the best cut between two values, per node;
    ``code`` is the place of a row's value among the sorted ``values``."""
    key = node * len(values) + code
    order = np.argsort(key)
    key, node = key[order], node[order]
    first = node[1:] != node[:-1]
    score, threshold = np.full(len(total), -np.inf), np.zeros(len(total))
    cut = np.flatnonzero((key[1:] != key[:-1]) & ~first)
    if not len(cut):
        return score, threshold
    start = np.concatenate([[0], np.flatnonzero(first) + 1])  # of every node
    which = np.cumsum(first)[cut] if len(start) > 1 else np.zeros(len(cut), np.int64)
    at = node[cut]
    sums = []  # left and right sums of weight and targets
    for column in range(stats.shape[1]):
        upto = np.cumsum(stats[order, column])
        before = np.concatenate([[0.0], upto[start[1:] - 1]])
        left = upto[cut] - before[which]
        sums.append((left, total[at, column] - left))
    (left, right), targets = sums[0], sums[1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        found = sum(a * a for a, _ in targets) / left + sum(b * b for _, b in targets) / right
    begin = _starts(at)
    best = np.maximum.reduceat(found, begin)
    hit = np.flatnonzero(found == np.repeat(best, np.diff(np.append(begin, len(cut)))))
    hit = cut[hit[_starts(at[hit])]]  # the first of equal cuts
    low, high = values[key[hit] % len(values)], values[key[hit + 1] % len(values)]
    middle = (low + high) / 2
    score[node[hit]], threshold[node[hit]] = best, np.where(middle < high, middle, low)
    return score, threshold


def _random_cuts(x: np.ndarray, stats: np.ndarray, size: np.ndarray, looked: np.ndarray, total: np.ndarray, low: np.ndarray, high: np.ndarray,
                 rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, feature, threshold) of the best of one cut per node and feature
    it looks at, drawn between the node's least and greatest value. Rows of
    ``x`` come node by node, ``size`` of each; a node and a feature are a
    pair, and the pairs of a few features are judged at once."""
    nodes = len(total)
    begin = np.cumsum(size) - size
    best, feature, threshold = np.full(nodes, -np.inf), np.full(nodes, -1, np.int32), np.zeros(nodes)
    features = np.flatnonzero(looked.any(0))
    at_once = max(1, PAIR_ROWS // max(len(x), 1))
    for some in (features[k:k + at_once] for k in range(0, len(features), at_once)):
        cut = low[:, some] + rng.random((len(some), nodes)).T * (high - low)[:, some]
        cut = np.where(cut < high[:, some], cut, low[:, some])
        at, j = np.nonzero(looked[:, some])
        if not len(at):
            continue
        pair = np.repeat(np.arange(len(at)), size[at])
        row = np.arange(len(pair)) - np.repeat(np.cumsum(size[at]) - size[at] - begin[at], size[at])
        goes = x[row, some[j][pair]] <= cut[at, j][pair]
        pair, row = pair[goes], row[goes]
        left = np.stack([np.bincount(pair, s[row], len(at)) for s in stats.T], axis=1)
        score = np.where((left[:, 0] > 0) & (left[:, 0] < total[at, 0]), _score(left, total[at]), -np.inf)
        first = _starts(at)
        most = np.maximum.reduceat(score, first)
        hit = np.flatnonzero(score == np.repeat(most, np.diff(np.append(first, len(at)))))
        hit = hit[_starts(at[hit])]  # the first of equal features
        hit = hit[score[hit] > best[at[hit]]]
        best[at[hit]], feature[at[hit]], threshold[at[hit]] = score[hit], some[j[hit]], cut[at[hit], j[hit]]
    return best, feature, threshold


def _levels(x: np.ndarray, stats: np.ndarray, constant: np.ndarray, node: np.ndarray, roots: int, n_features: int, random_cuts: bool,
            rng: np.random.Generator, at_once: int = 0) -> tuple[dict[str, np.ndarray], list[tuple[int, np.ndarray]]]:
    """Nodes below ``roots`` nodes, all of a level at once, numbered by level;
    and (number, rows) of nodes of at most ``at_once`` rows, which are left as
    they are. ``node`` is the root of every row."""
    rows, size, number, ids, aside = np.arange(len(x)), roots, roots, np.arange(roots), []
    sorted_ = [] if random_cuts else [np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])]
    out: dict[str, list] = {"ids": [], "feature": [], "threshold": [], "left": [], "value": []}
    while size:
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        start = _starts(node)
        count = np.diff(np.append(start, len(rows)))
        if at_once:
            big = count > at_once
            aside += [(int(ids[k]), rows[start[k]:start[k] + count[k]]) for k in np.flatnonzero(~big)]
            rows, count, ids = rows[np.repeat(big, count)], count[big], ids[big]
            size = len(ids)
            if not size:
                break
            node, start = np.repeat(np.arange(size), count), np.cumsum(count) - count
        values, sums = x[rows], stats[rows]
        total = np.add.reduceat(sums, start)
        low, high = np.minimum.reduceat(values, start), np.maximum.reduceat(values, start)
        same = np.minimum.reduceat(constant[rows], start) == np.maximum.reduceat(constant[rows], start)
        open_ = (high > low) & ~same[:, None]
        # the features a node looks at: the first in a random order, of those that vary
        draw = np.where(open_, rng.random(open_.shape), np.inf)
        limit = np.partition(draw, min(n_features, draw.shape[1]) - 1, axis=1)[:, min(n_features, draw.shape[1]) - 1]
        looked = open_ & (draw <= limit[:, None])
        best, feature, threshold = np.full(size, -np.inf), np.full(size, -1, np.int32), np.zeros(size)
        if random_cuts:
            best, feature, threshold = _random_cuts(values, sums, count, looked, total, low, high, rng)
        for f in [] if random_cuts else np.flatnonzero(looked.any(0)):
            seen = slice(None) if looked[:, f].all() else np.flatnonzero(looked[:, f][node])
            score, cut = _best_cuts(sorted_[f][1][rows[seen]], sorted_[f][0], sums[seen], node[seen], total)
            better = looked[:, f] & (score > best)
            best, feature, threshold = np.where(better, score, best), np.where(better, f, feature), np.where(better, cut, threshold)
        splits = feature >= 0
        child = np.cumsum(splits) - 1
        out["ids"].append(ids)
        out["feature"].append(feature.astype(np.int32))
        out["threshold"].append(threshold)
        out["left"].append(np.where(splits, number + 2 * child, -1).astype(np.int32))
        out["value"].append(total[:, 1:] / total[:, :1])
        stay = splits[node]
        rows, node = rows[stay], node[stay]
        right = x[rows, feature[node]] > threshold[node]
        node = 2 * child[node] + right
        size = 2 * int(splits.sum())
        ids = number + np.arange(size)
        number += size
    at = np.concatenate(out.pop("ids")) if out["ids"] else np.zeros(0, np.int64)
    tree = {"feature": np.zeros(number, np.int32), "threshold": np.zeros(number), "left": np.zeros(number, np.int32), "value": np.zeros((number, stats.shape[1] - 1))}
    for name, parts in out.items():
        if len(at):
            tree[name][at] = np.concatenate(parts)
    return tree, aside


def grow_tree(x: np.ndarray, stats: np.ndarray, constant: np.ndarray, n_features: int, random_cuts: bool,
              rng: np.random.Generator, at_once: int = 0) -> dict[str, np.ndarray]:
    """One fully grown tree: the left child's number (the right one follows
    it), -1 for a leaf. ``stats`` are a row's weight and weighted targets,
    ``constant`` its target: a node whose rows agree in it, or in all
    features, is a leaf. Nodes of at most ``at_once`` rows (0: of any number)
    are set aside and grown in lots of so many rows, which fit the cache."""
    how = n_features, random_cuts, rng
    tree, aside = _levels(x, stats, constant, np.zeros(len(x), np.int64), 1, *how, at_once if len(x) > at_once else 0)
    parts, number, k = {c: [v] for c, v in tree.items()}, len(tree["left"]), 0
    sizes = np.cumsum([len(rows) for _, rows in aside])
    while k < len(aside):
        end = max(k + 1, int(np.searchsorted(sizes, (sizes[k - 1] if k else 0) + at_once, "right")))
        roots, lot = zip(*aside[k:end])
        rows, k = np.concatenate(lot), end
        below, _ = _levels(x[rows], stats[rows], constant[rows], np.repeat(np.arange(len(lot)), [len(r) for r in lot]), len(lot), *how)
        below["left"] = np.where(below["left"] < 0, -1, below["left"] + number - len(lot)).astype(np.int32)
        for c, v in below.items():
            tree[c][list(roots)] = v[:len(lot)]
            parts[c].append(v[len(lot):])
        number += len(below["left"]) - len(lot)
    return {c: np.concatenate(v) for c, v in parts.items()}


def compact(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, value: np.ndarray, width: int) -> tuple:
    """A tree as predictions need it: small feature numbers, values of the
    leaves only, and a leaf's ``left`` the place of its value."""
    leaf = feature < 0
    feature = feature.astype(np.int16) if feature.max(initial=0) < 2 ** 15 else feature
    return feature, threshold, np.where(leaf, np.cumsum(leaf) - 1, left).astype(np.int32), value.reshape(len(leaf), width)[leaf]


def leaf_values(trees: list[tuple], x: np.ndarray, width: int) -> np.ndarray:
    """Sum over ``compact`` trees of the values of the leaves that rows fall into."""
    total = np.zeros((len(x), width))
    rows = np.arange(len(x))
    for feature, threshold, left, value in trees:
        at, moving = np.zeros(len(x), np.int64), rows
        while len(moving):
            f = feature[at[moving]]
            moving, f = moving[f >= 0], f[f >= 0]
            at[moving] = left[at[moving]] + (x[moving, f] > threshold[at[moving]])
        total += value[left[at]]
    return total


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    nClasses = Param(Params._dummy(), "nClasses", "number of classes, 0 for regression", TypeConverters.toInt)
    nTrees = Param(Params._dummy(), "nTrees", "number of trees", TypeConverters.toInt)


def _matrix(part: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(group, whether these rows are to be predicted, the rows) of batches
    sorted by group and row; what a group's trees are made of has row -1."""
    for batch in batches:
        if batch.num_rows:
            group, asked = batch.column("group").to_numpy(), batch.column("row").to_numpy() >= 0
            edges = np.flatnonzero((group[1:] != group[:-1]) | (asked[1:] != asked[:-1])) + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                yield int(group[start]), bool(asked[start]), batch.slice(start, end - start)


def _leaves(make: Callable[[int, list[pa.RecordBatch]], list[tuple]], width: int):
    """Sums over a group's trees of the leaves that rows fall into; ``make``
    gives the trees as ``compact`` ones. Rows pass by a batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, trees = None, [], None
        for group, asked, part in _stretches(batches):
            if group != now:
                now, parts, trees = group, [], None
            if not asked:
                parts.append(part)
                continue
            if trees is None:
                trees, parts = make(group, parts), []
            n = part.num_rows
            total = leaf_values(trees, _matrix(part), width)
            yield pa.record_batch([pa.array(np.full(n, group, np.int32)), part.column("row"), pa.array(np.full(n, len(trees), np.int32)),
                                   pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), total.reshape(-1))],
                                  names=["group", "row", "trees", "total"])
    return run


def _mean_leaves(sums: DataFrame, width: int) -> DataFrame:
    """(row, found): mean leaf over all trees, added up in the order of groups."""
    parts = F.array_sort(F.collect_list(F.struct("group", "total"))).alias("parts")
    added = F.aggregate("parts", F.array_repeat(F.lit(0.0), width), lambda a, p: F.zip_with(a, p["total"], lambda u, v: u + v))
    return sums.where("trees > 0").groupBy("row").agg(F.sum("trees").alias("trees"), parts).select(
        "row", F.transform(added, lambda v: v / F.col("trees")).alias("found"))


def _by_group(table: DataFrame, together: int, groups: int) -> DataFrame:
    """Rows of a group in one partition, sorted as ``_stretches`` takes them."""
    tasks = groups if together == 1 else 4 * groups  # several a group, so that few hold two of them
    return table.repartition(tasks, "group").sortWithinPartitions("group", "row", "key")


class Forest(Estimator, _ForestParams):
    """``nClasses`` 0: regression on ``labelCol``, all features at every
    split. Otherwise labels are class numbers, a split looks at the square
    root of the number of features, and ``probability`` is the mean of the
    leaves' class shares. ``randomCuts``: one random cut per feature and node
    (extremely randomised trees) and no bootstrap; otherwise the best cut.
    ``maxRows`` 0: a tree is grown from all rows; else every tree draws its
    own rows of a larger table."""

    keyCol = Param(Params._dummy(), "keyCol", "column that identifies a row", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column, '' for none", TypeConverters.toString)
    randomCuts = Param(Params._dummy(), "randomCuts", "random instead of best cuts", TypeConverters.toBoolean)
    maxRows = Param(Params._dummy(), "maxRows", "rows that a tree is grown from, 0 for all", TypeConverters.toInt)
    atOnce = Param(Params._dummy(), "atOnce", "rows of a tree's nodes that are grown at once", TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", keyCol="id", weightCol="", nClasses=0,
                 nTrees=N_TREES, randomCuts=False, maxRows=0, atOnce=AT_ONCE, seed=42):
        super().__init__()
        self._setDefault(weightCol="", nClasses=0, nTrees=N_TREES, randomCuts=False, maxRows=0, atOnce=AT_ONCE, seed=42)
        self._set(**self._input_kwargs)

    def _rows(self, dataset: DataFrame) -> DataFrame:
        """(key, x, y, w) of the rows to learn from."""
        o = self.getOrDefault
        weight = F.col(o("weightCol")) if o("weightCol") else F.lit(1.0)
        return dataset.where(F.col(o("labelCol")).isNotNull()).select(
            F.xxhash64(F.lit(o("seed")), F.col(o("keyCol"))).alias("key"), vector_to_array(o("featuresCol")).alias("x"),
            F.col(o("labelCol")).cast("double").alias("y"), weight.cast("double").alias("w"))

    def _drawn(self, dataset: DataFrame) -> tuple[DataFrame, int]:
        """``_dealt`` rows of a table of features."""
        return self._dealt(self._rows(dataset))

    def _dealt(self, rows: DataFrame) -> tuple[DataFrame, int]:
        """Rows dealt to groups of trees, (group, key, x, y, w, times), with how
        often each tree of the group takes the row; and the trees of a group.
        Where trees draw ``maxRows`` of more than ``SHARED`` times as many rows
        they share few, and every tree is a group of its own: a row is only
        copied for the trees that take it."""
        o = self.getOrDefault
        n = max(rows.count(), 1)
        most = o("maxRows") or n
        share = min(1.0, most / n)
        if o("randomCuts"):
            limits = [1 - share]
        else:  # a Poisson number of copies: a bootstrap whose size is that of the sample
            limits = list(np.cumsum([math.exp(-share) * share ** k / math.factorial(k) for k in range(8)]))

        def times(u):
            return sum((u >= float(c)).cast("int") for c in limits).cast("byte")

        def uniform(key, t):
            return F.shiftrightunsigned(F.xxhash64(key, t), 11).cast("double") / float(1 << 53)

        if n > SHARED * most:
            each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(o("nTrees") - 1))).alias("group"))
            taken = each.where(uniform(F.col("key"), F.col("group")) >= float(limits[0]))
            return taken.select("group", "key", "x", "y", "w", F.array(times(uniform(F.col("key"), F.col("group")))).alias("times")), 1
        trees = F.sequence(F.lit(0), F.lit(TREES_A_TASK - 1))
        groups = -(-o("nTrees") // TREES_A_TASK)
        drawn = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.struct(
            g.alias("group"), F.transform(F.transform(trees, lambda j: uniform(F.col("key"), g * TREES_A_TASK + j)), times).alias("times")))
        dealt = rows.select("*", F.explode(drawn).alias("drawn"))
        return dealt.where(F.exists("drawn.times", lambda k: k > 0)).select("drawn.group", "key", "x", "y", "w", "drawn.times"), TREES_A_TASK

    def _grow(self, together: int):
        """A function that grows a group's trees, (tree, grown), from its rows
        in the order of their keys."""
        o = self.getOrDefault
        n_trees, classes, cuts, at_once, seed = o("nTrees"), o("nClasses"), o("randomCuts"), o("atOnce"), o("seed")

        def run(group: int, parts: list[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
            if not parts:
                return
            x, times = (np.concatenate([_matrix(p, c) for p in parts]) for c in ("x", "times"))
            y, w = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("y", "w"))
            parts.clear()
            target = (y[:, None] == np.arange(classes)).astype(float) if classes else y[:, None] - y.mean()
            width = math.ceil(math.sqrt(x.shape[1])) if classes else x.shape[1]
            for j in range(together):
                tree = group * together + j
                took = np.flatnonzero(times[:, j] > 0)
                if tree >= n_trees or not len(took):
                    continue
                weight = (times[took, j] * w[took])[:, None]
                stats = np.concatenate([weight, weight * target[took]], axis=1)
                grown = grow_tree(x[took], stats, y[took], width, cuts, np.random.default_rng([seed, tree]), at_once)
                if not classes:
                    grown["value"] += y.mean()
                yield tree, grown
        return run

    def _fit(self, dataset: DataFrame) -> ForestModel:
        o = self.getOrDefault
        rows = written(self._rows(dataset), "forest-rows")
        drawn, together = self._dealt(rows)
        model = ForestModel(featuresCol=o("featuresCol"), predictionCol=o("predictionCol"), nClasses=o("nClasses"))
        model.ungrown = (drawn.withColumn("row", F.lit(-1).cast("long")), self._grow(together), together, -(-o("nTrees") // together))
        return model


class ForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """Trees as a table, or not grown yet: then every call of ``transform``
    grows them beside the rows and writes the predictions only, and ``trees``
    writes them. Stored trees are held by tasks in blocks of ``NODES_AT_ONCE``
    nodes that all rows pass by. Rows with NaN in a feature go left."""

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", nClasses=0):
        super().__init__()
        self._setDefault(nClasses=0)
        self._set(**self._input_kwargs)
        self.ungrown: tuple | None = None  # rows dealt to groups, how to grow a group, trees of a group, groups
        self._trees: DataFrame | None = None

    @property
    def trees(self) -> DataFrame:
        if self._trees is None:
            dealt, grow, together, groups = self.ungrown

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                now, parts = None, []

                def grown():
                    for tree, t in grow(now, parts):
                        columns = [pa.array([tree], pa.int32()), *(pa.array([t[c].reshape(-1)]) for c in ("feature", "threshold", "left", "value"))]
                        yield pa.record_batch(columns, names=["tree", "feature", "threshold", "left", "value"])
                for group, _, part in _stretches(batches):
                    if group != now:
                        yield from grown()
                        now, parts = group, []
                    parts.append(part)
                yield from grown()
            self._trees = written(_by_group(dealt, together, groups).mapInArrow(run, TREE), "forest")
        return self._trees

    @trees.setter
    def trees(self, table: DataFrame) -> None:
        self._trees = table

    def _grown_beside(self, rows: DataFrame) -> DataFrame:
        """Sums of leaves of trees that are grown for it."""
        dealt, grow, together, groups = self.ungrown
        width = max(self.getOrDefault("nClasses"), 1)

        def make(group: int, parts: list[pa.RecordBatch]) -> list[tuple]:
            return [compact(t["feature"], t["threshold"], t["left"], t["value"].reshape(-1), width) for _, t in grow(group, parts)]
        asked = rows.select("row", "x", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
        return _by_group(dealt.unionByName(asked, allowMissingColumns=True), together, groups).mapInArrow(_leaves(make, width), LEAVES)

    def _read_from_table(self, rows: DataFrame) -> DataFrame:
        """Sums of leaves of stored trees: blocks of trees, as many times as
        there are shares of the rows."""
        width = max(self.getOrDefault("nClasses"), 1)
        largest, last = self.trees.agg(F.max(F.size("feature")), F.max("tree")).first()
        together = max(1, NODES_AT_ONCE // (largest or 1))
        blocks = (last or 0) // together + 1
        shares = -(-rows.sparkSession.sparkContext.defaultParallelism // blocks)

        def make(group: int, parts: list[pa.RecordBatch]) -> list[tuple]:
            return [compact(*(p.column(c)[k].values.to_numpy() for c in ("feature", "threshold", "left", "value")), width)
                    for p in parts for k in range(p.num_rows)]
        block = (F.floor(F.col("tree") / F.lit(together)) * shares).cast("int")
        trees = self.trees.select("*", F.col("tree").cast("long").alias("key"), F.lit(-1).cast("long").alias("row"),
                                  F.explode(F.sequence(block, block + shares - 1)).alias("group"))
        share = F.pmod(F.xxhash64("row"), F.lit(shares)).cast("int")
        asked = rows.select("row", "x", F.explode(F.sequence(share, F.lit((blocks - 1) * shares) + share, F.lit(shares))).alias("group"))
        return _by_group(trees.unionByName(asked, allowMissingColumns=True), 2, blocks * shares).mapInArrow(_leaves(make, width), LEAVES)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        classes, name = self.getOrDefault("nClasses"), self.getOrDefault("predictionCol")
        rows = written(dataset.withColumn("__row", F.monotonically_increasing_id()), "forest-asked")
        asked = rows.select(F.col("__row").alias("row"), vector_to_array(self.getOrDefault("featuresCol")).alias("x"))
        sums = self._grown_beside(asked) if self._trees is None else self._read_from_table(asked)
        found = written(_mean_leaves(sums, max(classes, 1)), "forest-leaves")
        rows = rows.join(found.withColumnsRenamed({"row": "__row", "found": "__found"}), "__row", "left").drop("__row")
        if not classes:
            return rows.withColumn(name, F.get("__found", F.lit(0))).drop("__found")
        likeliest = F.array_position("__found", F.array_max("__found")) - 1
        return rows.withColumn(name, likeliest.cast("double")).withColumn("probability", array_to_vector("__found")).drop("__found")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.trees.write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.trees = self.sparkSession.read.parquet(f"{path}/trees")
        return model
