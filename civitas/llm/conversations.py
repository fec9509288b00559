"""Repair of conversation structure by cheapest edits.

A conversation's roles, in order, should read as an optional system turn and
then one or more pairs of user and assistant (or nothing at all). Each turn is
kept (0), given another role (2) or deleted (3); empty turns may be inserted
anywhere (2). Blank and duplicate turns must go; a truncated turn that stays
costs 1. Among the cheapest edits those whose initials (D, I, K, R) are the
least as text are taken.

1. Turns get their places by a range sort of keys without texts
   (``ordering``); a conversation is cut into segments of ``SEGMENT`` turns, so
   its length is no task's burden.
2. A segment's costs from each of the four states to each other are a matrix;
   suffix products of matrices by doubling joins on segment numbers tell every
   segment what lies behind it. Conversations of one segment skip this.
3. Within segments, after the cost recursion, all (place, state) nodes of a
   batch are ranked by their least optimal audit of 1, 2, 4, ... edits, as in
   prefix doubling: rank and rank of the node that many edits ahead. The ranks
   choose among a node's optimal arcs, and the doubled pointers of the chosen
   arcs spell the audit from every entry state.
4. Segments map entry to exit states; prefix compositions, again by doubling
   joins, choose each segment's entry state and with it its piece of audit.

An initial leads from a node to one node only, so ranks need no knowledge of
what follows the segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import stored
from .ordering import in_order

SEGMENT = 512
#: Turns handled by numpy at once.
CHUNK = 100_000
BLANKS = " \t\n\x0b\x0c\r"

# States by the last turn written: none, system, user, assistant.
STATES, NONE = 4, 4
#: State after a user or assistant turn that fits (inserted or renamed).
NEXT = np.array([2, 2, 3, 2])
#: State after a kept turn whose role begins with s, u, a or another sign.
KEEP = np.array([[1, 2, NONE, NONE], [NONE, 2, NONE, NONE], [NONE, NONE, 3, NONE], [NONE, 2, NONE, NONE]])
#: Insertions that a conversation still needs at its end.
AT_END = [0, 4, 2, 0]
FAR = 1 << 40
EDITS = np.frombuffer(b"DIKR", np.uint8)
ADJACENT = np.zeros((4, 4), bool)
ADJACENT[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


def _insertions(cost: np.ndarray) -> np.ndarray:
    for _ in range(2):  # more than two insertions in a row lead back
        cost = np.minimum(cost, 2 + cost[:, NEXT])
    return cost


class Segments:
    """Segments of a batch: ``kind`` (role's initial) and ``fault`` (0 none, 1
    blank, 2 duplicate, 3 truncated) of all turns, one after another; every
    segment has one place more than turns. Longer segments come first."""

    def __init__(self, codes: list[np.ndarray], end: np.ndarray, last: np.ndarray):
        sizes = np.array([len(c) for c in codes])
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes, self.end, self.last = sizes[self.order], end[self.order], last[self.order]
        self.start = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]])
        self.places = int((self.sizes + 1).sum())
        self.kind, self.fault = np.zeros(self.places, np.int64), np.zeros(self.places, np.int64)
        for at, k in zip(self.start, self.order):
            self.kind[at:at + len(codes[k])], self.fault[at:at + len(codes[k])] = codes[k] & 3, codes[k] >> 2
        self.final = np.zeros(self.places, bool)
        self.final[self.start + self.sizes] = True

    def edit_costs(self, ahead: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs to the end by deleting, keeping, renaming the turns ``at``,
        given those from the places ``ahead`` of them."""
        late = (self.fault[at] == 3)[:, None]
        gone = ((self.fault[at] == 1) | (self.fault[at] == 2))[:, None]
        padded = np.concatenate([ahead, np.full((len(at), 1), FAR)], axis=1)
        keep = np.where(gone, FAR, np.take_along_axis(padded, KEEP.T[self.kind[at]], 1) + late)
        return ahead + 3, keep, np.where(gone, FAR, ahead[:, NEXT] + 2 + late)

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Cost to the end from every (place, state), given those behind."""
        cost = np.full((self.places, STATES), FAR, np.int64)
        cost[self.start + self.sizes] = end
        for i in range(int(self.sizes.max(initial=0)) - 1, -1, -1):
            at = self.start[:np.searchsorted(-self.sizes, -i)] + i
            cost[at] = np.minimum(_insertions(np.minimum.reduce(self.edit_costs(cost[at + 1], at))), FAR)
        return cost

    def matrices(self) -> np.ndarray:
        """(segments, entry state, exit state) costs, in the given order."""
        out = np.empty((len(self.order), STATES, STATES), np.int64)
        for t in range(STATES):
            end = np.full((len(self.order), STATES), FAR)
            end[:, t] = 0
            out[self.order, :, t] = self.costs(end)[self.start]
        return out

    def audits(self) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """(cost from the first state, exit per entry state, audit per entry
        state) of every segment, in the given order."""
        cost = self.costs(self.end)
        place = np.repeat(np.arange(self.places), STATES)
        state = np.tile(np.arange(STATES), self.places)
        at = np.flatnonzero(~self.final)
        by = np.full((4, self.places, STATES), FAR)
        by[0, at], by[2, at], by[3, at] = self.edit_costs(cost[at + 1], at)
        ends = np.zeros(self.places, bool)
        ends[(self.start + self.sizes)[self.last]] = True
        more = ~self.final | ends
        by[1, more] = cost[more][:, NEXT] + 2
        best = by.reshape(4, -1).T == cost.reshape(-1, 1)  # optimal arcs of every node
        best[np.repeat(self.final, STATES) & (cost.reshape(-1) == 0)] = False
        best[cost.reshape(-1) >= FAR] = False
        kept = KEEP[state, self.kind[place]]
        ahead = np.minimum(place + 1, self.places - 1) * STATES
        to = np.stack([ahead + state, place * STATES + NEXT[state], ahead + kept % STATES, ahead + NEXT[state]], axis=1)

        nodes = np.arange(len(place))
        sink = ~best.any(axis=1)
        edit = best.argmax(axis=1)
        pointer = np.where(sink, nodes, to[nodes, edit])
        rank = np.where(sink, 0, edit + 1)
        while not sink[pointer].all():  # ranks by audits of 1, 2, 4, ... edits
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]

        edit = np.where(best, np.arange(4) * (rank.max() + 1) + rank[to], np.iinfo(np.int64).max).argmin(axis=1)
        jumps, length = [np.where(sink, nodes, to[nodes, edit])], np.where(sink, 0, 1)
        while not sink[jumps[-1]].all():
            length = length + length[jumps[-1]]
            jumps.append(jumps[-1][jumps[-1]])
        entry = (self.start[:, None] * STATES + np.arange(STATES)).reshape(-1)
        long = length[entry]
        first = np.concatenate([[0], np.cumsum(long)])
        offset = np.arange(first[-1]) - np.repeat(first[:-1], long)
        walk = np.repeat(entry, long)
        for j, jump in enumerate(jumps):
            ahead = (offset >> j) & 1 == 1
            walk[ahead] = jump[walk[ahead]]
        text = EDITS[edit[walk]].tobytes().decode()
        pieces = [text[a:b] for a, b in zip(first[:-1], first[1:])]
        back = np.argsort(self.order)
        exits = (jumps[-1][entry] % STATES).reshape(-1, STATES)
        return (cost[self.start, 0][back], exits[back], [pieces[k * STATES:(k + 1) * STATES] for k in back])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """Parts of bounded size: (rows, codes of each segment's own turns, turns
    before the segment's first, 1 where there is one)."""
    for rb in batches:
        lists = rb.column("codes")
        ends = lists.offsets.to_numpy()
        low = 0
        while low < rb.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + CHUNK, "right")) - 1)
            flat = lists.slice(low, high - low).flatten().to_numpy().astype(np.int64)
            cuts = ends[low:high + 1] - ends[low]
            border = (rb.column("seg").slice(low, high - low).to_numpy() > 0).astype(np.int64)
            yield rb.slice(low, high - low), [flat[a:b] for a, b in zip(cuts, cuts[1:])], border
            low = high


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb, codes, border in _chunks(batches):
        own = [c[b:] for c, b in zip(codes, border)]
        none = np.zeros((len(own), STATES), np.int64)
        found = Segments(own, none, np.zeros(len(own), bool)).matrices().reshape(len(own), -1)
        yield pa.record_batch([rb.column("conv"), rb.column("seg"), pa.array(list(found), pa.list_(pa.int64()))],
                              names=["conv", "seg", "m"])


def _solutions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb, codes, border in _chunks(batches):
        last = rb.column("last").to_numpy(zero_copy_only=False)
        end = rb.column("end").flatten().to_numpy().reshape(-1, STATES)
        cost, exits, pieces = Segments([c[b:] for c, b in zip(codes, border)], end, last).audits()
        faults = np.stack([np.bincount(c[b:] >> 2, minlength=4) for c, b in zip(codes, border)])
        illegal = [int((~ADJACENT[c[:-1] & 3, c[1:] & 3]).sum()) for c in codes]
        yield pa.record_batch(
            [rb.column("conv"), rb.column("seg"), pa.array(cost), pa.array(list(exits), pa.list_(pa.int64())),
             pa.array(pieces, pa.list_(pa.string())), *[pa.array(faults[:, k]) for k in (1, 2, 3)], pa.array(illegal, pa.int64())],
            names=["conv", "seg", "cost", "exits", "pieces", "blank", "duplicate", "truncated", "illegal"])


def _doubled(table: DataFrame, column: str, step: int, combine, segments: int, folder: str) -> DataFrame:
    """``table`` (conv, seg, ``column``) with ``column`` combined over all
    segments from each one on to the last (``step`` 1) or first (-1)."""
    reach = 1
    while reach < segments:
        other = table.select(F.col("conv").alias("_conv"), (F.col("seg") - step * reach).alias("_seg"), F.col(column).alias("_other"))
        both = table.join(other, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("seg") == F.col("_seg")), "left")
        table = stored(both.select("conv", "seg", F.when(F.col("_other").isNull(), F.col(column)).otherwise(
            combine(F.col(column), F.col("_other"))).alias(column)), f"{folder}-{reach}")
        reach *= 2
    return table


def _product(a: Column, b: Column) -> Column:
    """Product of two cost matrices in (min, +)."""
    cell = F.sequence(F.lit(0), F.lit(STATES * STATES - 1))
    return F.transform(cell, lambda k: F.least(F.lit(FAR), F.array_min(F.array(*[
        F.get(a, F.floor(k / STATES).cast("int") * STATES + m) + F.get(b, k % STATES + STATES * m) for m in range(STATES)]))))


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Keys that order turns, and what their repair needs; no texts."""
    role_of, text_of = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    bare = F.rtrim(text_of, F.lit(BLANKS))
    initial = F.left(role_of, F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", 1).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role_of.alias("role"),
                       F.left(text_of, F.lit(64)).alias("head"), F.unhex(F.sha2(text_of, 256)).alias("hash"),
                       kind.alias("kind"), fault.alias("fault"))


ORDER = ["conv", "turn", "role", "head", "hash"]


def repair_plans(spark: SparkSession, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows``: conv_id, turns, gaps, blank,
    duplicate, truncated, illegal, cost (longs) and audit.

    Turns are taken in order of turn (null first), role, the text's first 64
    characters and its SHA-256; equal rows are duplicates. A null role or text
    counts as one space, a null conversation is one of its own, null turns
    count as no turn in ``gaps`` (null if it exceeds a long). Texts are judged
    whole; their equality is that of their SHA-256. Further columns are not
    read; an empty table gives no rows."""
    folder = scratch_dir(spark, "conversations")
    rows = stored(turns(rows, conv, turn, role, text), f"{folder}/turns")
    placed = in_order(rows, ORDER, f"{folder}/order")
    span = F.try_subtract(F.max("turn").cast("bigint"), F.min("turn").cast("bigint"))
    convs = placed.groupBy("conv").agg(
        F.min("at").alias("start"), F.count("*").alias("n"), F.count("turn").alias("with_turn"),
        F.try_subtract(F.try_add(span, F.lit(1)), F.count_distinct("turn")).alias("gaps"))
    convs = stored(convs.withColumn("gaps", F.when(F.col("with_turn") == 0, F.lit(0)).otherwise(F.col("gaps"))), f"{folder}/convs")
    firsts = placed.groupBy("conv", "role", "hash").agg(F.min("at").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    placed, firsts = placed.alias("p"), firsts.alias("f")
    marked = (placed.join(firsts, F.col("p.conv").eqNullSafe(F.col("f.conv")) & (F.col("p.role") == F.col("f.role"))
                          & (F.col("p.hash") == F.col("f.hash")), "left")
              .select("p.conv", "p.at", "kind", F.when((F.col("fault") != 1) & (F.col("at") > F.col("first")), 2)
                      .otherwise(F.col("fault")).alias("fault")).alias("m"))
    inside = marked.join(convs.alias("c"), F.col("m.conv").eqNullSafe(F.col("c.conv"))).select(
        "m.conv", "n", (F.col("at") - F.col("start")).alias("i"), (F.col("kind") + 4 * F.col("fault")).cast("byte").alias("code"))
    own = F.floor(F.col("i") / segment)
    border = ((F.col("i") + 1) % segment == 0) & (F.col("i") + 1 < F.col("n"))  # the next segment sees its role
    listed = inside.withColumn("seg", F.explode(F.when(border, F.array(own, own + 1)).otherwise(F.array(own))))
    segs = listed.groupBy("conv", "seg", "n").agg(F.sort_array(F.collect_list(F.struct("i", "code"))).alias("list"))
    segs = stored(segs.select("conv", "seg", "n", (F.col("seg") == F.floor((F.col("n") - 1) / segment)).alias("last"),
                              F.transform("list", lambda x: x["code"]).alias("codes")), f"{folder}/segments")
    count = (segs.agg(F.max("seg")).first()[0] or 0) + 1

    end = F.array(*[F.lit(c).cast("bigint") for c in AT_END])
    if count > 1:
        costs = segs.where(F.col("n") > segment).mapInArrow(_matrices, "conv " + rows.schema["conv"].dataType.simpleString() + ", seg bigint, m array<bigint>")
        costs = _doubled(stored(costs, f"{folder}/matrices"), "m", 1, _product, count, f"{folder}/suffix")
        behind = F.transform(F.sequence(F.lit(0), F.lit(STATES - 1)), lambda s: F.array_min(F.array(*[
            F.get("m", s * STATES + t) + AT_END[t] for t in range(STATES)])))
        behind = costs.select(F.col("conv").alias("_conv"), (F.col("seg") - 1).alias("_seg"), behind.alias("behind"))
        todo = segs.join(behind, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("seg") == F.col("_seg")), "left").select(
            "conv", "seg", "last", "codes", F.coalesce("behind", end).alias("end"))
    else:
        todo = segs.select("conv", "seg", "last", "codes", end.alias("end"))
    solved = stored(todo.mapInArrow(_solutions, "conv " + rows.schema["conv"].dataType.simpleString() + (
        ", seg bigint, cost bigint, exits array<bigint>, pieces array<string>, blank bigint, duplicate bigint, "
        "truncated bigint, illegal bigint")), f"{folder}/solved")

    if count > 1:
        maps = solved.select("conv", "seg", "exits")
        maps = _doubled(maps, "exits", -1, lambda late, early: F.transform(early, lambda s: F.get(late, s.cast("int"))),
                        count, f"{folder}/prefix")
        entry = maps.select(F.col("conv").alias("_conv"), (F.col("seg") + 1).alias("_seg"), F.get("exits", F.lit(0)).alias("entry"))
        solved = solved.join(entry, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("seg") == F.col("_seg")), "left")
        piece = F.get("pieces", F.coalesce("entry", F.lit(0)).cast("int"))
    else:
        piece = F.get("pieces", F.lit(0))
    sums = solved.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", piece.alias("piece")))), lambda x: x["piece"]), "").alias("audit"),
        F.max(F.when(F.col("seg") == 0, F.col("cost"))).alias("cost"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    return sums.alias("s").join(convs.alias("c"), F.col("s.conv").eqNullSafe(F.col("c.conv"))).select(
        F.col("s.conv").alias("conv_id"), F.col("n").alias("turns"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies audits to turns that follow them in order. What is kept between
    turns is one conversation's audit."""
    conv, audit, at, line, user_last = None, "", 0, 0, False
    out: list[tuple] = []

    def write(edit: str, role: str | None, text: str) -> None:
        nonlocal line, user_last
        if role is None:
            role = "assistant" if user_last else "user"
        user_last = role[:1] == "u"
        out.append((conv, line, edit, role, text))
        line += 1

    def insertions() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            write("I", None, "")
            at += 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * 5
        made = pa.record_batch([pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), pa.string(), pa.string(), pa.string()))],
                               names=["conv", "line", "edit", "role", "text"])
        out.clear()
        return made

    kind = pa.null()
    for rb in batches:
        kind = rb.column("conv").type
        columns = [rb.column(c) for c in ("conv", "audit", "role", "text")]
        for c, plan, role, text in zip(*[x.to_pylist() for x in columns]):
            if plan is not None:
                insertions()
                conv, audit, at, line, user_last = c, plan, 0, 0, False
                continue
            insertions()
            if audit[at] == "K":
                write("K", role, text)
            elif audit[at] == "R":
                write("R", None, text)
            at += 1
        yield batch()
    insertions()
    if out:
        yield batch()


def repaired_turns(rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The repaired conversations of ``rows`` by their ``plans``: conv, line
    (from 0), edit (K, R or I), role, text. Rows of a conversation come in
    order in one partition; a task streams them and holds one audit."""
    body = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c2) for c, c2 in ((role, "role"), (text, "text"))])
    body = body.withColumn("head", F.left("text", F.lit(64))).withColumn("hash", F.unhex(F.sha2("text", 256)))
    headers = plans.select(F.col("conv_id").alias("conv"), "audit")
    both = headers.unionByName(body, allowMissingColumns=True).withColumn("is_turn", F.col("audit").isNull())
    ordered = both.repartition("conv").sortWithinPartitions("conv", "is_turn", *ORDER[1:])
    kind = rows.schema[conv].dataType.simpleString()
    return ordered.select("conv", "audit", "role", "text").mapInArrow(
        _edited, f"conv {kind}, line bigint, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest = None, None
    for rb in batches:
        done = []
        for c, line, role, text in zip(*[rb.column(x).to_pylist() for x in ("conv", "line", "role", "text")]):
            if line == 0:
                if digest:
                    done.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.record_batch([pa.array([c for c, _ in done], rb.column("conv").type), pa.array([d for _, d in done], pa.string())],
                              names=["conv", "digest"])
        kind = rb.column("conv").type
    if digest:
        yield pa.record_batch([pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv", "digest"])


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv, digest): SHA-256 of each conversation's lines ``role:text``, put
    together with line breaks; conversations without a line have no row. Takes
    ``repaired_turns`` as it comes. The digest is one hash over one text, so
    one task reads a conversation through, however long, a batch at a time."""
    kind = repaired.schema["conv"].dataType.simpleString()
    return repaired.mapInArrow(_digests, f"conv {kind}, digest string")
