"""The manifest against plain hashing, and against its SQL."""

import hashlib

import pytest
from pyspark.sql import functions as F

from civitas.llm import oracles, queries
from civitas.llm.merkle import folded, leaf_digest, merkle_manifest, proof_digest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(level, fan_out):
    """(root, siblings of every leaf, bottom up) of a list of digests."""
    place, proofs = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for k, p in enumerate(place):
            run = p - p % fan_out
            proofs[k] += [level[j] for j in range(run, min(run + fan_out, len(level))) if j != p]
            place[k] = p // fan_out
        level = [h(*level[j:j + fan_out]) for j in range(0, len(level), fan_out)]
    return level[0], proofs


def manifest(rows, fan_out):
    """{leaf: set of (subroot, root, proof digest)} of (id, group, leaf) rows."""
    groups = {}
    for k, g, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(g, []).append(x)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {g: tree(groups[g], fan_out) for g in order}
    root, above = tree([below[g][0] for g in order], fan_out) if order else (None, [])
    out = {}
    for g, up in zip(order, above):
        for x, own in zip(groups[g], below[g][1]):
            out.setdefault(x, []).append((below[g][0], root, h(*own, *up)))
    return out


@pytest.mark.parametrize("fan_out, groups", [(2, 5), (2, 1), (3, 4), (5, 7)])
def test_against_plain_hashing(spark, fan_out, groups):
    rows = [(k * 7 % 101 - 50, None if k % groups == 0 else "gé€"[: k % groups] * (k % groups), "text" * (k % 5)) for k in range(101)]
    rows += [(None, "solo", "x"), (3, "solo2", None), (None, None, None), (5, None, "same"), (5, None, "same"), (5, "", "other")]
    table = spark.createDataFrame(rows, "id long, tree string, text string")
    table = table.withColumn("leaf", leaf_digest(F.col("id"), F.col("tree"), F.col("text"))).withColumn("size", F.lit(1))
    got = merkle_manifest(spark, table, "tree", "id", fan_out=fan_out).withColumn("proved", folded(F.col("leaf"), F.col("proof")))
    got = got.withColumn("digest", proof_digest(F.col("proof"))).toPandas()
    want = manifest([(k, g, leaf(k, g, t)) for k, g, t in rows], fan_out)
    assert len(got) == len(rows) and set(got["size"]) == {1}
    found = {}
    for r in got.itertuples():
        assert r.proved == r.root
        found.setdefault(r.leaf, []).append((r.subroot, r.root, r.digest))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_altered_leaf_does_not_fold_to_the_root(spark):
    table = spark.range(9).select("id", F.lit("a").alias("lang"), leaf_digest(F.col("id")).alias("leaf"))
    rows = merkle_manifest(spark, table, id_column="id")
    assert rows.where(folded(leaf_digest(F.col("id") + 1), F.col("proof")) == F.col("root")).count() == 0


def test_few_rows(spark):
    table = spark.createDataFrame([(1, "a", "d")], "doc_id long, lang string, leaf string").withColumn("root", F.lit("clash"))
    assert merkle_manifest(spark, table.limit(0)).count() == 0
    row = merkle_manifest(spark, table).first()
    assert (row.leaf, row.subroot, row.root, row.proof) == ("d", "d", "d", [])
    rows = merkle_manifest(spark, table.unionByName(table.withColumn("lang", F.lit("b")))).collect()
    assert {r.root for r in rows} == {h("d", "d")} and {len(r.proof) for r in rows} == {1}


def test_query_equals_its_sql(spark, sf_dir, duck):
    rows = queries.QUERIES["op11_merkle"](spark, sf_dir).toPandas().set_index("doc_id").sort_index()
    want = duck.execute(oracles.MERKLE).df().set_index("doc_id").sort_index()[rows.columns]
    assert rows.equals(want.astype(rows.dtypes))
    assert 0 < rows.verified.mean() < 1
