"""Vectors, urls, archives and the pipeline."""

import base64
import collections
import hashlib
import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from civitas.llm import near_vectors as nv  # noqa: E402
from civitas.llm import queries, repeated_spans  # noqa: E402
from civitas.llm.url_filter import judge_urls  # noqa: E402
from civitas.llm.warc import _ranges, archive_pages, parse, record  # noqa: E402


def test_vectors_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    rows = queries.QUERIES["op3_near_vectors"](spark, sf_dir).toPandas().set_index("vec_id")
    want = brute.vectors(table.vec_id.tolist(), [list(v) for v in table.embedding], 0.9)
    got = [(rows.n_links[k], rows.component_id[k]) for k in table.vec_id]
    assert sum(a == b for a, b in zip(got, want)) >= 0.99 * len(want)


def test_vectors_crowds_and_edges(spark, monkeypatch):
    monkeypatch.setattr(nv, "BLOCK", 32)
    r = np.random.default_rng(0)
    base = r.normal(size=(4, 16))
    rows = [(k, (base[k % 4] + 0.2 * r.normal(size=16)).tolist()) for k in range(240)]
    rows += [(300 + k, base[0].tolist()) for k in range(5)]
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [1.0, 2.0]), (404, [2.0, 4.0]), (405, []),
             (406, [None, 1.0]), (407, [1e200] * 16), (408, [1e200] * 16), (409, [float("inf")] + [1.0] * 15)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1))
    found = nv.near_vectors(spark, table).toPandas().set_index("vec_id")
    want = brute.vectors([k for k, _ in rows], [v for _, v in rows], 0.9)
    links = [int(found.n_links[k]) for k, _ in rows]
    total = sum(n for n, _ in want)
    assert all(a <= n for a, (n, _) in zip(links, want)) and sum(links) >= 0.99 * total  # none below the threshold, few missed
    assert sum(found.component_id[k] == c for (k, _), (_, c) in zip(rows, want)) >= 0.99 * len(rows)
    assert found.n_links[403] == 1 and found.n_links[407] == 1 and found.n_links[[400, 401, 402, 405, 406, 409]].sum() == 0
    assert nv.near_vectors(spark, table.limit(0)).count() == 0


def test_urls_of_the_table(spark, sf_dir):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").toPandas()
    rows = queries.QUERIES["op6_url_filter"](spark, sf_dir).toPandas().set_index("page_id")
    for page, url in zip(table.page_id, table.url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].lower(), rest[cut:]
            path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = rows.loc[page]
        assert (r.host, r.path) == (host, path)
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_urls_edges(spark):
    rows = [(1, None, "h"), (2, "nohost", "h"), (3, "http://A.COM", "h"), (4, "x://WWW.Example.com/en/a?b://c", "h"), (5, "http://a.net/es/#x", "h"),
            (6, "http://xnet/es/", "h"), (7, "http://net/es/", "h"), (7, "http://net/es/", "h"), (8, "", "h"), (9, "http://É.com/", "h")]
    found = judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).toPandas()
    got = {r.page_id: (r.host, r.path, r.rule) for r in found.itertuples()}
    assert len(found) == len(rows) and set(found.verdict) <= {"allow", "block"}
    assert got[1] == ("", "", None) and got[2] == ("", "", None) and got[3] == ("a.com", "", None)
    assert got[4] == ("www.example.com", "/en/a", "www.example.com/en/") and got[5] == ("a.net", "/es/", "net/es/")
    assert got[6][2] is None and got[7][2] == "net/es/" and got[9] == ("É.com", "/", "com/")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(empty).count() == 0
    only = spark.createDataFrame([(1, "http://q.org/")], "page_id long, url string")
    assert judge_urls(only).first().verdict == "allow"


def check_archives(rows, pages, least=0):
    first = {}
    for page, html in sorted((p, h or "") for p, h in pages if p is not None):
        first.setdefault(html, page)
    for page, html in pages:
        raw = (html or "").encode()
        r = rows.loc[page]
        later = len(raw) >= least and first[html or ""] != page
        assert r.payload_bytes == len(raw) and r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r.record_type == ("revisit" if later else "response")
        assert r.refers_to == first[html or ""] if later else r.refers_to != r.refers_to


def test_archives_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").toPandas()
    rows = queries.QUERIES["op9_warc"](spark, sf_dir).toPandas().set_index("page_id")
    check_archives(rows, list(zip(table.page_id, table.html)))


def test_archives_edges(spark):
    pages = [(5, "u\r\nX: y", "same"), (3, None, "same"), (9, "u", None), (8, "u", ""), (7, "u", "é" * 3000), (6, "u", "\r\n\r\nbody\r\n")]
    table = spark.createDataFrame([(p, u, h, "z") for p, u, h in pages], "page_id long, url string, html string, digest string")
    found = archive_pages(spark, table, with_payload=True).toPandas().set_index("page_id")
    check_archives(found, [(p, h) for p, _, h in pages])
    assert bytes(found.payload[7]).decode() == "é" * 3000 and bytes(found.payload[6]) == b"\r\n\r\nbody\r\n" and found.url[5] == "u%0D%0AX:%20y"
    big = archive_pages(spark, table, min_bytes=1).toPandas().set_index("page_id")
    check_archives(big, [(p, h) for p, _, h in pages], least=1)
    assert archive_pages(spark, table.limit(0)).count() == 0


def test_ranges_are_coalesced():
    assert list(_ranges([(0, 10), (10, 5), (20, 5), (10**6, 7)])) == [(0, 3, 0, 25), (3, 4, 10**6, 10**6 + 7)]
    fields, http, payload = parse(record(4, "u", b"abc", "D", 3))
    assert payload == b"abc" and http["Content-Length"] == "3" and fields["WARC-Record-ID"] == "<urn:page:4>"


def test_pipeline_stages(spark, sf_dir):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeated_spans", "decontamination", "packing"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        out = stage(spark, docs, sf_dir)
        after = out.toPandas()
        if name == "toxicity":
            assert 0.8 * len(before) < len(after) < len(before)
        if name == "near_duplicates":
            want = brute.near_duplicates(zip(before.doc_id, before.text), 5, 80)
            assert set(after.doc_id) == {c for _, c in want.values()} and after.doc_id.is_unique
        if name == "repeated_spans":
            want = {k: r[3] for k, r in zip(before.doc_id, brute.repeats(before.text, corpus_pipeline.PASSAGE))}
            same = [hashlib.sha256(t.encode()).hexdigest() == want[k] for k, t in zip(after.doc_id, after.text)]
            assert sum(same) >= 0.9 * len(same) and (after.n_chars == after.text.str.len()).all()  # signs cut in two are dropped
        if name == "decontamination":
            found = brute.leaks(zip(before.doc_id, before.text), items)
            assert set(after.doc_id) == {k for k, v in found.items() if not v}
        if name != "packing":
            assert list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(after, out.schema)
        else:
            assert set(after.doc_id) == set(before.doc_id) and after.groupby("sequence_id").length.sum().max() <= 1024


def without_passages(texts, n, span):
    """Every text without its words in passages of ``n`` words and its bytes
    in strings of ``span`` bytes that occur more than once."""
    raw = [t.encode() for t in texts]
    at = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for b in raw]
    words = [[b[i:j] for i, j in s] for b, s in zip(raw, at)]
    passages = collections.Counter(tuple(w[k:k + n]) for w in words for k in range(len(w) - n + 1))
    strings = collections.Counter(b[i:i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b, s, w in zip(raw, at, words):
        gone = np.zeros(len(b), bool)
        twice = {j for k in range(len(w) - n + 1) if passages[tuple(w[k:k + n])] > 1 for j in range(k, k + n)}
        for j in twice:
            gone[s[j][0]:s[j + 1][0] if j + 1 in twice else s[j][1]] = True
        for i in range(len(b) - span + 1):
            if strings[b[i:i + span]] > 1:
                gone[i:i + span] = True
        out.append(bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore"))
    return out


@pytest.mark.parametrize("crowd", [1000, 2])
def test_passages_are_counted_in_words(spark, crowd):
    """Passages of 50 to 60 short words under 280 bytes, other white space
    between the words, one passage next to another, signs of several bytes."""
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 4)))
    some = lambda n: [word() for _ in range(n)]
    short, under, other = ["a" if k % 3 else word()[:2] for k in range(51)], [word()[:2] for _ in range(50)], some(60)
    rows = [" ".join(some(20) + short + some(30)), " ".join(some(5)) + " \n" + "\t ".join(short) + "\n" + " ".join(some(9)),
            " ".join(some(7) + under + some(9)), " ".join(under + some(12)), " ".join(other + short + some(4)),
            " ".join(some(8) + other), " ".join(["x"] * 52), " ".join(["y"] * 51), "", " \n ", " ".join(some(400)), None]
    rows += [" ".join(some(r.randint(0, 9)) + other[r.randint(0, 5):r.randint(54, 60)] + some(r.randint(0, 9))) for _ in range(20)]
    assert len(" ".join(short).encode()) < 280 and len(" ".join(under).encode()) < 280
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = repeated_spans.remove_repeats(spark, docs, span=280, gram=70, crowd=crowd, ranges=4, as_text=True, words=51)
    got = {x.doc_id: x.dedup.kept_text for x in found.collect()}
    want = without_passages([t or "" for t in rows], 51, 280)
    assert [got[k] for k in range(len(rows))] == want
    assert " ".join(short) not in want[0] and want[2] == rows[2] and want[6] == "" and want[7] == rows[7]


def test_pipeline_drops_passages_of_short_words(spark, sf_dir):
    """Among the table's documents, two that share 51 words of 2 letters."""
    r = random.Random(6)
    passage = " ".join(r.choice("abcdefgh") + r.choice("stuvw") for _ in range(51))
    planted = [(-1, f"one before {passage} one behind", "en", "s", 0), (-2, f"other start {passage} other end", "en", "s", 0)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    before = docs.toPandas()
    got = {x.doc_id: x.text for x in corpus_pipeline.drop_repeats(spark, docs, sf_dir).collect()}
    want = without_passages(before.text.fillna("").tolist(), 51, 280)
    assert got[-1] == "one before  one behind" and got[-2] == "other start  other end"
    assert [got[k] or "" for k in before.doc_id] == want


def test_pipeline_takes_odd_rows(spark, sf_dir):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c d e f", "en", "s", 11), (3, "a b c d e f g", "en", "s", 13), (3, "a b c d e f g", "en", "s", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, sf_dir)
        docs = out if name == "packing" else spark.createDataFrame(out.collect(), out.schema)
    assert {r.doc_id for r in docs.collect()} == {1, 2, 3, None}
