"""Counts against plain Python, estimates against numpy, verdicts against the labels."""

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

from civitas.llm import quality as q
from civitas.llm import queries

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def distances(x):
    """Squared distances from numpy's version of the estimate."""
    n, p = x.shape
    least = np.array(q.LEAST)

    def lower_median(v):
        return np.sort(v)[(len(v) + 1) // 2 - 1]

    def d2(center, scatter):
        return np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(scatter), x - center)

    def estimate(rows, share):
        s = q._consistency(share) * np.cov(rows.T, bias=True) + np.diag(least ** 2)
        return rows.mean(0), s

    center = np.array([lower_median(x[:, j]) for j in range(p)])
    away = np.array([lower_median(abs(x[:, j] - center[j])) for j in range(p)])
    scatter = np.diag(np.maximum(1.4826 * away, least) ** 2)
    size = math.inf
    for _ in range(q.STEPS):
        bins = np.floor(32 * np.log2(d2(center, scatter) + 1e-6))
        near = bins <= np.sort(bins)[math.ceil(q.COVER * n) - 1]
        found = estimate(x[near], q.COVER)
        now = np.linalg.slogdet(found[1])[1] / 2
        if now >= size - q.FALL:
            break
        center, scatter, size = *found, now
    center, scatter = estimate(x[d2(center, scatter) <= q._quantile(0.975, p)], 0.975)
    return d2(center, scatter)


def test_chi_square():
    assert abs(q._quantile(0.95, 6) - 12.591587) < 1e-5 and abs(q._quantile(0.975, 8) - 17.534546) < 1e-5


def test_counts_of_odd_texts(spark):
    texts = [None, "", " \t\x0b\x0c\r\n", "a", "a b c d", "a b c d e", "a b c d e f a b c d e", "x " * 12, "x y " * 9 + "z", "é# ñ* 　 |<>\x85 a\xa0b",
             "one\none\n\n \n one\none\r", "p q r s t\np q r s t\nu", "a b c d e a b c d e a b c", ("long words " * 40_000), "".join(chr(k) for k in range(1, 400)),
             "v w x y z " + " ".join(map(str, range(300))) + " v w x y z"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string").select("id", q.text_counts(F.col("text")).alias("c"))
    found = {r.id: (r.c.words.n, r.c.word_chars, r.c.n_symbols, r.c.n_dup_lines, r.c.words.repeated) for r in rows.collect()}
    assert found == {k: counts(t) for k, t in enumerate(texts)}


def test_estimates_equal_numpy(spark, tmp_path):
    r = np.random.default_rng(3)
    base = r.normal(size=(4000, q.P)) @ r.normal(size=(q.P, q.P)) + 5
    base[::9] += 25 * r.normal(size=(len(base[::9]), q.P))  # far rows
    base[:1500, 2] = 1.0  # most agree
    x = np.rint(base * q.GRID) / q.GRID
    pool = np.arange(len(x)) % 3
    table = spark.createDataFrame([(int(g), *map(float, v)) for g, v in zip(pool, x)], "pool long, " + ", ".join(f"x{j} double" for j in range(q.P)))
    table = table.repartition(7)
    found = q._distances(table, q.covariance_estimates(table, str(tmp_path))).toPandas()
    for g in range(3):
        got = np.sort(found[found.pool == g].d2.to_numpy())
        assert np.allclose(got, np.sort(distances(x[pool == g])), rtol=1e-6)


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().set_index("doc_id")
    found = queries.QUERIES["op13_quality_rules"](spark, sf_dir).toPandas().set_index("doc_id")
    assert len(found) == len(docs)
    for k, row in found.iterrows():
        want = counts(docs.text[k])
        assert tuple(row[COUNTS]) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (row.base_failed and row.kept)


def test_verdicts_follow_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.QUERIES["op13_quality_rules"](spark, folder).toPandas()
    rows = found.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    rows = rows[~rows.base_failed]
    assert rows[rows.quality == 1].kept.mean() > 0.99
    assert rows[rows.quality == 0].kept.mean() < 0.1


def test_odd_rows(spark):
    text = "Some quite common words that stand in one line, as others do."
    rows = [(k, "en" if k % 2 else None, None, f"{text} {k}") for k in range(90)] + [(None, None, None, None), (7, "en", "s", ""), (8, "en", "s", text), (8, "en", "s", text)]
    rows += [(900, "de", "t", "### " * 5 + " ".join(f"{k}###" for k in range(400)))]
    table = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    table = table.select("*", *[F.lit(1).alias(c) for c in ("pool", "x0", "kept", "n_words", "c")])
    found = q.quality_verdicts(spark, table).toPandas()
    assert len(found) == len(rows) and found.kept.sum() >= 92
    assert not found[found.n_words == 0].kept.any() and not found[found.doc_id == 900].kept.all()
    assert q.quality_verdicts(spark, table.limit(0)).count() == 0
