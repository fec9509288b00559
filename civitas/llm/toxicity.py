"""Toxicity by subword embeddings averaged into a linear softmax.

Words are runs of letters and digits in lower case; a word stands for its
byte n-grams of three to six with its edges marked, so a misspelt or unseen
word shares most vectors with the known one. The mean of a text's n-gram
vectors goes through a softmax over the two classes; vectors and softmax are
trained together, in numpy, on a bounded sample of the labelled rows. As the
score is linear in the vectors, scoring needs one number per n-gram bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .sampling import hash_sample
from .textbytes import CHUNK_BYTES, lower_ascii, text_chunks

SIZES = (3, 4, 5, 6)
BUCKET_BITS = 17
DIMENSIONS = 8
#: Most labelled rows that a model is fitted on, in the order of a hash.
SAMPLE = 5_000
EPOCHS, BATCH, RATE = 15, 128, 0.05
SHRINK, TOXIC_WEIGHT = 1.0, 1.5
#: The mean of a text's vectors is scaled by this before the softmax: a few
#: per cent of a text's words must be able to decide.
SCALE = 50.0

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def subwords(column, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, buckets, text of each bucket) per chunk of a string column."""
    for first, buf, off in text_chunks(column, chunk_bytes):
        n = len(off) - 1
        # one edge mark before, between and after the texts
        data = np.full(len(buf) + n + 1, 32, np.uint8)
        data[np.arange(len(buf)) + 1 + np.repeat(np.arange(n), np.diff(off))] = lower_ascii(buf)
        word = _WORD[data]
        data = np.where(word, data, np.uint8(32)).astype(np.uint64)
        row = np.minimum(np.searchsorted(off + np.arange(n + 1), np.arange(len(data)), side="right") - 1, n - 1)
        gram, inner = data.copy(), np.ones(len(data), bool)
        buckets, rows = [], []
        for size in range(2, SIZES[-1] + 1):
            gram = (gram[:-1] << np.uint64(8)) | data[size - 1:]
            # only the ends of an n-gram may be edge marks
            inner = inner[:-1] & word[size - 2:-1] if size > 2 else np.ones(len(gram), bool)
            if size in SIZES:
                at = np.flatnonzero(inner)
                mixed = (gram[at] + np.uint64(size)) * _FACTOR
                buckets.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
                rows.append(row[at])
        yield first, np.concatenate(buckets), np.concatenate(rows)


@dataclass
class SubwordModel:
    """``weights[b]``: what one occurrence of bucket ``b`` adds to the log
    odds, times the number of occurrences in the text."""
    weights: np.ndarray
    bias: float

    def score(self, column) -> np.ndarray:
        out = np.zeros(len(column))
        for first, buckets, rows in subwords(column):
            n = int(rows.max()) + 1 if len(rows) else 0
            total = np.bincount(rows, self.weights[buckets], n)
            out[first:first + n] = total / np.maximum(np.bincount(rows, minlength=n), 1)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -50, 50)))


def _bags(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each text with their shares, and row bounds."""
    idx, share, size = [], [], np.zeros(len(texts), np.int64)
    for first, buckets, rows in subwords(pa.array(texts, pa.string()), CHUNK_BYTES // 2):  # on the driver: small steps
        key, count = np.unique(rows.astype(np.int64) << BUCKET_BITS | buckets, return_counts=True)
        row = key >> BUCKET_BITS
        total = np.bincount(rows, minlength=int(row[-1]) + 1 if len(row) else 0)
        idx.append((key & ((1 << BUCKET_BITS) - 1)).astype(np.int32))
        share.append((count / total[row]).astype(np.float32) if len(row) else np.zeros(0, np.float32))
        distinct = np.bincount(row, minlength=0)
        size[first:first + len(distinct)] = distinct
    all_idx = np.concatenate(idx)
    del idx  # the driver holds one copy at a time
    return all_idx, np.concatenate(share), np.append(0, np.cumsum(size))


def fit(texts: list, labels: list, seed: int = 11) -> SubwordModel:
    """Train vectors and softmax together (Adam on batches of whole texts).

    After every step each vector is shortened by ``SHRINK`` times the rate,
    down to zero, so n-grams without steady evidence weigh nothing. Without
    rows of both classes the score is the one class's share."""
    y = np.asarray(labels, np.int64)
    prior = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    model = SubwordModel(np.zeros(1 << BUCKET_BITS), float(np.log(prior / (1 - prior))))
    if len(set(y.tolist())) < 2:
        return model
    rng = np.random.default_rng(seed)
    idx, share, bounds = _bags(texts)
    params = [np.zeros((1 << BUCKET_BITS, DIMENSIONS), np.float32),
              rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32),
              np.log(np.array([1 - prior, prior], np.float32))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = np.where(y == 1, TOXIC_WEIGHT, 1.0)
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            rows = order[a:a + BATCH]
            size = bounds[rows + 1] - bounds[rows]
            take = np.arange(size.sum()) + np.repeat(bounds[rows] - (np.cumsum(size) - size), size)
            b, w, doc = idx[take], share[take], np.repeat(np.arange(len(rows)), size)
            vectors, soft, bias = params
            out = vectors @ soft
            p = np.stack([np.bincount(doc, w * out[b, c], len(rows)) for c in (0, 1)], 1) * SCALE + bias
            p = np.exp(p - p.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (weight[rows] / weight[rows].sum())[:, None]
            per_bucket = np.stack([np.bincount(b, w * p[doc, c], 1 << BUCKET_BITS) for c in (0, 1)], 1).astype(np.float32) * SCALE
            grads = [per_bucket @ soft.T, vectors.T @ per_bucket, p.sum(axis=0).astype(np.float32)]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, (g, (m, v)) in enumerate(zip(grads, moments)):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] = params[k] - rate * m / (np.sqrt(v) + 1e-6)
            norm = np.sqrt((params[0] ** 2).sum(axis=1, keepdims=True))
            params[0] *= np.maximum(0, 1 - SHRINK * rate / np.maximum(norm, 1e-9))
    out = params[0] @ params[1]
    return SubwordModel((out[:, 1] - out[:, 0]).astype(np.float64) * SCALE, float(params[2][1] - params[2][0]))


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that no model learns from; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE,
                  id_column: str = "doc_id", text_column: str = "text") -> SubwordModel:
    """Fit on at most ``sample`` labelled rows that are not held out, taken in
    the order of a hash of the id. Null labels and null texts teach nothing."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).alias("i"), F.col(label).cast("int").alias("y")).distinct()
    chosen = hash_sample(known, "i", sample, scratch_dir(docs.sparkSession, "toxicity"))
    texts = docs.select(F.col(id_column).alias("i"), F.col(text_column).alias("t")).where("t is not null")
    rows = texts.join(F.broadcast(chosen), "i").toPandas().sort_values(["i", "y", "t"])  # at most ``sample`` ids
    return fit(rows["t"].tolist(), (rows["y"] > 0).astype(int).tolist())


def score_toxicity(docs: DataFrame, model: SubwordModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    A null or empty text, or one without words, has the model's score for no
    evidence. Columns of these names are replaced, all others kept; repeated
    rows score alike; an empty table gives no rows."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(pa.array(text, pa.string(), from_pandas=True)))

    return docs.withColumn("score", score(F.col(text_column))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
