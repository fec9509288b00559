"""Repairs against trying all edits, and against their SQL."""

import collections
import functools
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitas.llm import oracles, queries
from civitas.llm.conversations import Segments, repair_plans, repaired_digests, repaired_turns

GOOD = re.compile("(s?(ua)+)?")


def faults(turns):
    """0 none, 1 blank, 2 duplicate, 3 truncated of every (role, text)."""
    out, seen = [], set()
    for role, text in turns:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append(1 if not marks else 2 if (role, text) in seen else 3 if marks[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def every_repair(turns):
    """(cost, audit) of the cheapest edits: all edits of all turns, with up to
    three insertions in every gap."""
    bad, best = faults(turns), None
    gaps = [""] + ["".join(x) for n in (1, 2, 3) for x in itertools.product("ua", repeat=n)]
    choices = []
    for (role, _), f in zip(turns, bad):
        own = [("D", "", 3)]
        if f not in (1, 2):
            own += [("K", role[:1] if role[:1] in ("s", "u", "a") else "x", int(f == 3)), ("R", "u", 2 + (f == 3)), ("R", "a", 2 + (f == 3))]
        choices.append(own)
    for picked in itertools.product(*choices):
        for put in itertools.product(gaps, repeat=len(turns) + 1):
            cost = sum(c for _, _, c in picked) + 2 * sum(map(len, put))
            if best and cost > best[0]:
                continue
            kinds = "".join(g + p[1] for g, p in zip(put, picked)) + put[-1]
            if GOOD.fullmatch(kinds):
                audit = "".join("I" * len(g) + p[0] for g, p in zip(put, picked)) + "I" * len(put[-1])
                best = min(best or (cost, audit), (cost, audit))
    return best


def cheapest(turns):
    """The same for longer conversations, by the least rest of the audit."""
    bad = faults(turns)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.lru_cache(None)
    def rest(i, last, inserted):
        found = [(0, "")] if i == len(turns) and last in ("", "a") else []
        fit = "a" if last == "u" else "u"
        if inserted < 3:
            found += [(c + 2, "I" + a) for c, a in [rest(i, fit, inserted + 1)]]
        if i < len(turns):
            found += [(c + 3, "D" + a) for c, a in [rest(i + 1, last, 0)]]
            if bad[i] not in (1, 2):
                kind = step[last].get(turns[i][0][:1])
                found += [(c + (bad[i] == 3), "K" + a) for c, a in [rest(i + 1, kind, 0)]] if kind else []
                found += [(c + 2 + (bad[i] == 3), "R" + a) for c, a in [rest(i + 1, fit, 0)]]
        return min(found, default=(1 << 30, ""))
    return rest(0, "", 0)


def lines(turns, audit):
    out, at = [], 0
    for edit in audit:
        fit = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((fit, ""))
        else:
            if edit != "D":
                out.append((turns[at][0] if edit == "K" else fit, turns[at][1]))
            at += 1
    assert GOOD.fullmatch("".join(r[:1] for r, _ in out))
    return "\n".join(f"{r}:{t}" for r, t in out)


def invented(seed, longest, count):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "usher"]
    texts = ["One.", "Two!", "cut", "", " \t\x0b", "Three? ", "four.\n", "é."]
    return {k: [(r.choices(roles, [6, 6, 2, 1, 1, 1])[0], r.choice(texts) if r.random() < 0.6 else f"Text {r.random()}.")
                for _ in range(r.randint(1, longest))] for k in range(count)}


def as_rows(conversations):
    return [(k, t, role, text) for k, turns in conversations.items() for t, (role, text) in enumerate(turns)]


def test_trying_everything_gives_the_cheapest():
    for turns in invented(1, 3, 40).values():
        assert every_repair(turns) == cheapest(turns)


def solve(conversations):
    kind = {"s": 0, "u": 1, "a": 2}
    codes = [np.array([kind.get(r[:1], 3) + 4 * f for (r, _), f in zip(t, faults(t))]) for t in conversations]
    n = len(codes)
    return Segments(codes, np.tile([0, 4, 2, 0], (n, 1)), np.ones(n, bool)).audits()


def test_ranked_paths_of_whole_conversations():
    conversations = [*invented(2, 3, 60).values(), *invented(3, 60, 200).values()]
    cost, _, pieces = solve(conversations)
    assert [(c, p[0]) for c, p in zip(cost, pieces)] == [cheapest(t) for t in conversations]


@pytest.mark.parametrize("segment", [1, 3, 512])
def test_conversations_in_segments(spark, segment):
    conversations = invented(segment, 23, 40) | {1000: [("user", "Same.")] * 50, 1001: [("tool", "Odd.")] * 9 + [("user", "Last.")]}
    table = spark.createDataFrame(as_rows(conversations), "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))
    plans = repair_plans(spark, table.repartition(5), segment=segment)
    found = {r.conv_id: r for r in plans.collect()}
    digests = dict(repaired_digests(repaired_turns(table, plans)).collect())
    for k, turns in conversations.items():
        count, r = collections.Counter(faults(turns)), found[k]
        kinds = [role[:1] for role, _ in turns]
        assert (r.cost, r.audit) == cheapest(turns)
        assert (r.turns, r.gaps, r.blank, r.duplicate, r.truncated) == (len(turns), 0, count[1], count[2], count[3])
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        text = lines(turns, r.audit)
        assert digests.get(k, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (7, None, "user", "Hi."), (7, None, "user", "Hi."),
            (8, 5, "user", "x." * 200_000), (8, 9, "assistant", "y." * 200_000), (8, 9, "assistant", "y." * 200_000),
            (9, -2**63, "user", "Hi."), (9, 2**63 - 1, "assistant", "Ho.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.select("*", *[F.lit("clash").alias(c) for c in ("conv", "seg", "codes", "audit", "kind", "at")])
    plans = repair_plans(spark, table)
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.cost, r.audit) for r in plans.collect()}
    assert found == {None: (0, 1, 0, 5, "DKI"), 7: found[7], 8: (3, 0, 1, 3, found[8][4]),
                     9: (None, 0, 0, 0, "KK")}
    assert found[7][:4] == (0, 0, 1, 5) and sorted(found[7][4]) == ["D", "I", "K"]
    digests = dict(repaired_digests(repaired_turns(table, plans)).collect())
    assert digests[8] == hashlib.sha256(f"user:{'x.' * 200_000}\nassistant:{'y.' * 200_000}".encode()).hexdigest()
    assert digests[None] == hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()
    empty = table.limit(0)
    plans = repair_plans(spark, empty)
    assert plans.count() == 0 and repaired_digests(repaired_turns(empty, plans)).count() == 0


def test_query_equals_its_sql(spark, sf_dir, duck):
    rows = queries.QUERIES["op12_conversations"](spark, sf_dir).toPandas().set_index("conv_id").sort_index()
    want = duck.execute(oracles.CONVERSATIONS).df().set_index("conv_id").sort_index()[rows.columns]
    assert rows.equals(want.astype(rows.dtypes))
    assert (rows.cost > 0).any() and (rows.audit.str.contains("I")).any()
