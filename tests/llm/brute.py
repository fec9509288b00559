"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np


def smallest_reachable(nodes, links):
    """Smallest node reachable from each node."""
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo, seen = [n], {n}
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out |= dict.fromkeys(seen, n)
    return out


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1)))


def near_duplicates(rows, words=3, similarity=85):
    """{doc_id: (size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {k: shingles(t, words) for k, t in rows}
    index = collections.defaultdict(list)
    links = []
    for k, s in sets.items():
        shared = collections.Counter(j for x in s for j in index[x])
        links += [(k, j) for j, n in shared.items() if 100 * n >= similarity * (len(s) + len(sets[j]) - n)]
        for x in s:
            index[x].append(k)
    comp = smallest_reachable(sets, links)
    return {k: (len(s), comp[k]) for k, s in sets.items()}


def repeats(texts, span):
    """(bytes, removed, runs, sha256 of the rest) of every text."""
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i:i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if count[b[i:i + span]] > 1:
                gone[i:i + span] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def vectors(ids, rows, cosine):
    """(links, component) of every vector; None for unusable ones."""
    unit = []
    for v in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if ok else None)
    links = [(i, j) for i in range(len(ids)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
    degree = collections.Counter(x for link in links for x in link)
    comp = smallest_reachable(range(len(ids)), links)
    least = collections.defaultdict(list)
    for i, c in comp.items():
        least[c].append(ids[i])
    return [(degree[i], min(least[comp[i]])) for i in range(len(ids))]


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def leaks(docs, items, window=13, agree=80):
    """{doc_id: set of item ids} by laying every item on every place."""
    out = {}
    for doc, text in docs:
        w, found = words(text), set()
        at = collections.defaultdict(list)
        for p, x in enumerate(w):
            at[x].append(p)
        for item, body in items:
            x = words(body)
            wide = min(window, len(x))
            shifts = collections.defaultdict(set)
            for j, token in enumerate(x):
                for p in at.get(token, ()):
                    shifts[p - j].add(j)
            for s, same in shifts.items():
                for a in range(max(0, -s), min(len(x), len(w) - s) - wide + 1):
                    if 100 * sum(a + y in same for y in range(wide)) >= agree * wide:
                        found.add(item)
                        break
        out[doc] = found
    return out
