"""Merkle manifest of a table: one digest for all rows, one proof per row.

Rows are leaves. Each group's leaves, in order, are the lowest nodes of a
tree in which every ``fan_out`` consecutive nodes become the digest of their
digests, level by level; the groups' roots are the leaves of one more tree.

A level is one table. It equijoins itself on the computed indices of every
node's siblings - the index XOR 1 in a binary tree, otherwise the other slots
of the run - and the rows in slot zero, which then hold their whole run, emit
the parents. Each level is written before the next one reads it, so a lost
executor costs tasks of one level; with ``fan_out`` 2 all levels together hold
twice the leaves. Proofs come down the other way: a node's proof is its own
siblings, then its parent's proof.

Leaves are put in order by a range sort whose equal keys may spread over
partitions, and nodes meet by (tree, index): neither a group nor an id that
holds a third of all rows is one task's burden. Digests, keys and carried
columns move, texts never do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import stored
from .ordering import in_order

#: Hex digits of a digest.
WIDE = 64
#: Levels that proofs come down between two writes.
CUT = 3


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: H of its fields in the given order."""
    return digest(*[field(v) for v in values])


def siblings(index: Column, fan_out: int) -> list[Column]:
    """Indices of the other nodes of a node's run; some of the last run's may
    not exist. Slot zero's come in ascending order."""
    if fan_out == 2:
        return [index.bitwiseXOR(F.lit(1))]
    slot = index % fan_out
    return [index - slot + (slot + k) % fan_out for k in range(1, fan_out)]


def _with_siblings(nodes: DataFrame, fan_out: int) -> DataFrame:
    """Nodes (tree, index, size, digest, ...) with ``slot``, ``others`` (the
    other digests of the run put together in order) and, in slot zero,
    ``parent``. A tree's only node has none of them."""
    single, level = F.col("size") == 1, nodes
    for k, where in enumerate(siblings(F.col("index"), fan_out)):
        other = level.select(F.col("tree").alias("_tree"), F.col("index").alias("_index"), F.col("digest").alias(f"_other{k}"))
        nodes = nodes.withColumn("_want", where).join(
            other, (F.col("tree") == F.col("_tree")) & (F.col("_want") == F.col("_index")), "left").drop("_tree", "_index", "_want")
    slot = (F.col("index") % fan_out).cast("int")
    # in the order of slots: those after this one come first in the list
    found = [F.coalesce(f"_other{k}", F.lit("")) for k in range(fan_out - 1)]
    others = F.concat(*found)
    for s in range(1, fan_out):
        after = fan_out - 1 - s
        others = F.when(slot == s, F.concat(*found[after:], *found[:after])).otherwise(others)
    nodes = nodes.withColumn("slot", F.when(~single, slot)).withColumn("others", F.when(~single, others))
    parent = F.when(F.col("slot") == 0, digest(F.col("digest"), F.col("others")))
    return nodes.withColumn("parent", parent).drop(*[f"_other{k}" for k in range(fan_out - 1)])


def _tree(nodes: DataFrame, fan_out: int, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels from the leaves up, one row per tree with its root) of ``nodes``
    (tree, index, size, digest, ...). A tree that is lower than others hands
    its root up until all have theirs."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    levels = []
    while largest > 1:
        nodes = stored(_with_siblings(nodes, fan_out), f"{folder}/level-{len(levels)}")
        levels.append(nodes)
        largest = -(-largest // fan_out)
        nodes = nodes.where("slot = 0 OR size = 1").select(
            "tree", F.floor(F.col("index") / fan_out).alias("index"), F.ceil(F.col("size") / fan_out).alias("size"),
            F.coalesce("parent", "digest").alias("digest"))
    return levels, nodes


def _proofs(levels: list[DataFrame], tops: DataFrame, fan_out: int, keep: Sequence[str], folder: str) -> DataFrame:
    """Nodes of the lowest level with ``proof``; columns ``keep`` of ``tops``
    (tree, index, proof, ...) go down to every node. Every ``CUT`` levels the
    proofs so far are written, so no job holds a longer chain of joins."""
    down = tops.select("tree", F.col("index").alias("up"), "proof", *keep)
    for depth, level in reversed(list(enumerate(levels))):
        own = F.when(F.col("slot").isNotNull(), F.array(F.struct("slot", "others"))).otherwise(F.array().cast("array<struct<slot:int,others:string>>"))
        below = (level.withColumn("up", F.floor(F.col("index") / fan_out)).join(down, ["tree", "up"])
                 .withColumn("proof", F.concat(own, F.col("proof"))))
        down = below.drop("up") if depth == 0 else below.select("tree", F.col("index").alias("up"), "proof", *keep)
        if depth and depth % CUT == 0:
            down = stored(down, f"{folder}/proofs-{depth}")
    return down if levels else down.withColumnRenamed("up", "index")


def merkle_manifest(spark: SparkSession, leaves: DataFrame, group_column: str = "lang", id_column: str = "doc_id",
                    leaf_column: str = "leaf", fan_out: int = 2) -> DataFrame:
    """``leaves`` with ``subroot`` (its group's), ``root`` (of all) and
    ``proof``: from the leaf up to the root, per level the node's slot in its
    run and the other digests of the run (hex, put together in order).

    Per group, leaves ascend by id (null first), equal ids by leaf; a group's
    only leaf is its subroot; subroots ascend by group, null first, bytewise.
    Rows of equal id and leaf may change places, which alters no digest of
    the trees, only which copy has which of the proofs. All columns of
    ``leaves`` are kept, also such as are named like the manifest's inner
    ones; columns named subroot, root or proof are replaced. An empty table
    gives no rows. ``leaves`` is read twice: give it a written table."""
    folder = scratch_dir(spark, "merkle")
    carried = F.struct(*[leaves[c] for c in leaves.columns])
    rows = leaves.select(F.col(group_column).alias("grp"), F.col(id_column).alias("id"), F.col(leaf_column).alias("digest"),
                         carried.alias("carried"))
    placed = in_order(rows, ["grp", "id", "digest"], f"{folder}/leaves")
    trees = placed.groupBy("grp").agg(F.min("at").alias("tree"), F.count("*").alias("size"))
    nodes = placed.join(trees, placed["grp"].eqNullSafe(trees["grp"])).select(
        "tree", (F.col("at") - F.col("tree")).alias("index"), "size", "digest", "carried")
    nodes = stored(nodes, f"{folder}/nodes")
    levels, roots = _tree(nodes, fan_out, f"{folder}/groups")

    # groups stand in the order of their first leaves
    roots = stored(roots.select("tree", "digest"), f"{folder}/subroots")
    ranked = in_order(roots, ["tree"], f"{folder}/ranked")
    size = roots.count()
    tops = ranked.select(F.lit(0).cast("bigint").alias("tree"), F.col("at").alias("index"), F.lit(size).cast("bigint").alias("size"),
                         "digest", F.col("tree").alias("group"))
    upper, root = _tree(tops, fan_out, f"{folder}/top")
    none = F.array().cast("array<struct<slot:int,others:string>>")
    if upper:
        root = root.select("tree", "index", none.alias("proof"), F.col("digest").alias("root"))
        found = _proofs(upper, root, fan_out, ["root"], f"{folder}/top")
    else:
        found = tops.select("digest", "group", none.alias("proof"), F.col("digest").alias("root"))
    found = stored(found.select(F.col("group").alias("tree"), F.lit(0).cast("bigint").alias("index"),
                                F.col("digest").alias("subroot"), "root", "proof"), f"{folder}/subroot-proofs")
    if levels:
        proved = _proofs(levels, found, fan_out, ["subroot", "root"], f"{folder}/groups")
    else:
        proved = nodes.join(found.drop("index"), "tree")
    kept = [F.col("carried")[c].alias(c) for c in leaves.columns if c not in ("subroot", "root", "proof")]
    return proved.select(*kept, "subroot", "root", "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    def up(below: Column, step: Column) -> Column:
        left = step["slot"] * WIDE
        return digest(F.substr(step["others"], F.lit(1), left), below, F.substr(step["others"], left + 1))
    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: step["others"]), ""), 256)
