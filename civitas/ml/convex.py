"""Margin models on lifted features: minimise, over weights w and intercept b,

    |w|^2 / 2 + sum over rows and sides of c * max(0, side's excess),

the objective of support vector machines, by Newton steps on a smoothed hinge,
(excess + sqrt(excess^2 + delta^2)) / 2, with falling ``delta``.

One pass over the rows serves all problems of a batch (pairs of classes,
folds) at once: loss, gradient and curvature at a trial point, and the loss at
``SCALES`` of the step that led there, so that a step too long is cut to the
best scale in one further pass. Tasks sum their rows, groupings sum the tasks,
and the step is solved for where the sums end: the driver gets a few vectors
of the feature length per problem and never a curvature.

Of many rows a sample gives the start only; all rows decide the weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

BUCKETS = 32
#: Widths of the smoothing; each starts from the solution of the one before.
DELTAS = (1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001)
STEPS = 60
#: Decrease that is left, as a share of the loss, where a width is roughly solved.
ROUGH = 1e-4
#: Rows further than so many widths from the hinge's corner have no curvature worth a sum.
NEAR = 12.0
#: Shares of a step whose losses a pass compares.
SCALES = 0.5 ** np.array([0, 1, 2, 3, 4, 5, 6, 7, 9, 11, 14, 18, 23, 30, 40])
#: Rows of the sample that gives the start, and the widths left to all rows.
START_ROWS = 50_000
LAST_DELTAS = 3


@dataclass
class Problem:
    """``sides(y, fold, weight)`` gives, per side of the loss, (sign, offset,
    c) of every row: its excess is ``offset - sign * (w.z + b)``; c = 0 leaves
    the row out."""
    sides: Callable[[np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]
    start: float = 0.0  # first intercept
    w: np.ndarray | None = None
    loss: float = np.inf
    step: np.ndarray | None = None
    scale: int = 0  # place of the trial's share of the step in SCALES
    done: bool = field(default=False)


@dataclass
class Sums:
    """What a pass finds of a problem: the losses at all scales, and at the
    trial point the exact loss, the dual objective's linear part, the gradient
    (both without the ridge) and the Newton step (with it)."""
    losses: np.ndarray
    exact: float
    dual: float
    gradient: np.ndarray
    step: np.ndarray


def _smooth(excess: np.ndarray, delta: float) -> np.ndarray:
    return (excess + np.sqrt(excess * excess + delta * delta)) / 2


def _terms(z: np.ndarray, w: np.ndarray, step: np.ndarray, scale: int, sides, delta: float, copies: float) -> np.ndarray:
    """Exact loss, dual part, losses at the scales, gradient and upper half of
    the curvature of rows, in one array; the last feature is the constant 1 of
    the intercept."""
    d = len(w)
    exact = dual = 0.0
    losses, gradient, curvature = np.zeros(len(SCALES)), np.zeros(d), np.zeros((d, d))
    fit = z @ w
    moved = z @ step if step.any() else None
    for sign, offset, c in sides:
        used = np.flatnonzero(c)
        if not len(used):
            continue
        rows, sign, offset, c = z if len(used) == len(z) else z[used], sign[used], offset[used], c[used] * copies
        base = offset - sign * fit[used]
        change = None if moved is None else sign * moved[used]
        if change is None:
            losses += float((c * _smooth(base, delta)).sum())
            excess = base
        else:
            losses += [float((c * _smooth(base - s * change, delta)).sum()) for s in SCALES]
            excess = base - SCALES[scale] * change
        size = np.sqrt(excess * excess + delta * delta)
        inside = np.abs(excess) < NEAR * delta
        slope = (1 + excess / size) / 2 * c
        exact += float((c * np.maximum(excess, 0)).sum())
        dual += float((slope * offset).sum())
        gradient -= rows.T @ (sign * slope)
        some = rows[inside]
        curvature += (some * (c[inside] * delta * delta / (2 * size[inside] ** 3))[:, None]).T @ some
    return np.concatenate([[exact, dual], losses, gradient, curvature[np.triu_indices(d)]])


def _step(sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact loss, dual part, losses, gradient and Newton step from ``at``."""
    d, head = len(at), 2 + len(SCALES)
    ridge = np.append(np.ones(d - 1), 0.0)
    gradient = sums[head:head + d]
    curvature = np.zeros((d, d))
    curvature[np.triu_indices(d)] = sums[head + d:]
    curvature += np.triu(curvature, 1).T + np.diag(ridge + 1e-9)
    # an intercept without curvature moves a little, not without end
    curvature[-1, -1] += 1e-6 * (1 + np.trace(curvature) / d)
    return np.concatenate([sums[:head + d], -np.linalg.solve(curvature, gradient + ridge * at)])


def _summed(rows: DataFrame, problems: dict[int, tuple], lift, delta: float, copies: float, tasks: int) -> dict[int, Sums]:
    """Sums over all rows, per problem (sides, w, step, scale); every row
    counts ``copies`` times, ``tasks`` is the number of partitions."""
    schema = "problem int, sums array<double>"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            x = rb.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, -1)
            z = np.concatenate([lift(x), np.ones((len(x), 1))], axis=1)
            y, fold, weight = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "weight"))
            for k, (sides, w, step, scale) in problems.items():
                found = _terms(z, w, step, scale, sides(y, fold, weight), delta, copies)
                total[k] = total[k] + found if k in total else found
        for k, sums in total.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([sums], pa.list_(pa.float64()))], names=["problem", "sums"])

    def added(table: pa.Table) -> np.ndarray:
        total = 0.0
        for chunk in table.column("sums").chunks:
            if len(chunk):
                total = total + chunk.flatten().to_numpy().reshape(len(chunk), -1).sum(0)
        return total

    def add(table: pa.Table) -> pa.Table:
        return pa.table([table.column("problem").slice(0, 1), pa.array([added(table)], pa.list_(pa.float64()))], names=["problem", "sums"])

    def finish(table: pa.Table) -> pa.Table:
        _, w, step, scale = problems[table.column("problem")[0].as_py()]
        found = _step(added(table), w + SCALES[scale] * step)
        return pa.table([table.column("problem").slice(0, 1), pa.array([found], pa.list_(pa.float64()))], names=["problem", "sums"])

    parts = rows.mapInArrow(part, schema)
    if tasks > BUCKETS:
        parts = parts.withColumn("bucket", F.spark_partition_id() % BUCKETS).groupBy("problem", "bucket").applyInArrow(add, schema)
    table = parts.groupBy("problem").applyInArrow(finish, schema).toArrow()
    found = {k: sums.values.to_numpy() for k, sums in zip(table.column("problem").to_pylist(), table.column("sums"))}
    head = 2 + len(SCALES)
    out = {}
    for k, (_, w, step, scale) in problems.items():
        v = found[k] if k in found else _step(np.zeros(head + len(w) + len(w) * (len(w) + 1) // 2), w + SCALES[scale] * step)
        out[k] = Sums(v[2:head], v[0], v[1], v[head:head + len(w)], v[head + len(w):])
    return out


def _advance(p: Problem, found: Sums, ridge: np.ndarray, tolerance: float) -> None:
    """Take the trial point, or try the step's best scale next."""
    points = p.w + SCALES[:, None] * p.step
    losses = found.losses + (ridge * points ** 2).sum(1) / 2
    best = int(losses.argmin())
    if losses[best] > p.loss * (1 + 1e-12) + 1e-12:  # no scale is lower
        p.done = True
        return
    if np.isfinite(p.loss) and p.loss - losses[p.scale] < 0.5 * (p.loss - losses[best]):
        p.scale = best
        return
    p.w, p.loss = points[p.scale], losses[p.scale]
    p.done = -(found.gradient + ridge * p.w) @ found.step <= tolerance * (1 + abs(p.loss))
    p.step, p.scale = found.step, 0


def _descend(rows: DataFrame, problems: Sequence[Problem], lift, deltas, tolerance: float, copies: float = 1.0) -> None:
    """Every width from the weights that the problems have; the widths before
    the last are only roughly solved."""
    tasks = rows.rdd.getNumPartitions()
    ridge = np.append(np.ones(len(problems[0].w) - 1), 0.0) if problems else None
    for delta in deltas:
        for p in problems:
            p.loss, p.step, p.scale, p.done = np.inf, np.zeros_like(p.w), 0, False
        for _ in range(STEPS):
            open_ = {k: (p.sides, p.w, p.step, p.scale) for k, p in enumerate(problems) if not p.done}
            if not open_:
                break
            for k, found in _summed(rows, open_, lift, delta, copies, tasks).items():
                _advance(problems[k], found, ridge, tolerance if delta == deltas[-1] else max(tolerance, ROUGH))


def solve(rows: DataFrame, problems: Sequence[Problem], lift, n_features: int, deltas=DELTAS, tolerance: float = 1e-9) -> list[np.ndarray]:
    """Weights, intercept last, of every problem. ``rows`` (x array<double>, y,
    fold, weight) are read once per step: give a written table. ``lift`` maps a
    matrix of x to features, ``n_features`` of them."""
    for p in problems:
        p.w = np.append(np.zeros(n_features), p.start)
    deltas, n = list(deltas), rows.count()
    if n > 4 * START_ROWS:
        share = START_ROWS / n
        some = written(rows.where(F.pmod(F.xxhash64("x", "y"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))).repartition(
            2 * rows.sparkSession.sparkContext.defaultParallelism), "margins-start")
        _descend(some, problems, lift, deltas, ROUGH, n / max(some.count(), 1))
        deltas = deltas[-LAST_DELTAS:]
    _descend(rows, problems, lift, deltas, tolerance)
    return [p.w for p in problems]


def duality_gap(rows: DataFrame, problems: Sequence[Problem], lift, n_features: int, delta: float = DELTAS[-1]) -> list[float]:
    """Exact objective minus the dual objective of the slopes, as a share of
    the former: an upper bound of how far each solution is from the least
    value, where the gradient vanishes."""
    still = np.zeros(n_features + 1)
    sums = _summed(rows, {k: (p.sides, p.w, still, 0) for k, p in enumerate(problems)}, lift, delta, 1.0, rows.rdd.getNumPartitions())
    out = []
    for k, p in enumerate(problems):
        half = (p.w[:-1] ** 2).sum() / 2
        primal = half + sums[k].exact
        v = sums[k].gradient[:-1]  # minus the weights that the slopes make up
        out.append(float((primal - (sums[k].dual - (v ** 2).sum() / 2)) / max(abs(primal), 1e-12)))
    return out
