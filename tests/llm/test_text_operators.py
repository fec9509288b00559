"""Operators on texts against plain versions and round trips."""

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from civitas.llm import near_duplicates as near  # noqa: E402
from civitas.llm import queries  # noqa: E402
from civitas.llm.arrow_store import token_files  # noqa: E402
from civitas.llm.components import connected_components  # noqa: E402
from civitas.llm.decontaminate import flag_leaks  # noqa: E402
from civitas.llm.encoder import PieceEncoder, tokenizer_path  # noqa: E402
from civitas.llm.licenses import scan_licenses  # noqa: E402
from civitas.llm.packing import deal, pack_tokens  # noqa: E402
from civitas.llm.repeated_spans import remove_repeats, shared_strings  # noqa: E402
from civitas.llm.suffix_array import common_prefixes, suffix_array  # noqa: E402
from civitas.llm.toxicity import fit, fit_on_labels, score_toxicity  # noqa: E402

#: Nulls, empty and odd texts, ties, repeated rows, clashing column names.
EDGE = [(1, None, "a"), (2, "", "b"), (3, "  \n\t ", "c"), (4, "one", "d"), (5, "One", "e"), (6, "one two", "f"),
        (7, "x " * 4000, "g"), (8, "don't 's  É'll €5 12ab3\n\n c\t <|endoftext|>", "h"), (8, "don't 's  É'll €5 12ab3\n\n c\t <|endoftext|>", "h"),
        (9, "a\u00a0b c", "i"), (None, "one two three four", "j"), (None, None, "k")]


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


@pytest.fixture(scope="module")
def edge(spark):
    names = ("key", "size", "component_id", "n", "cell", "dedup", "score", "__row", "shift", "toks")
    rows = spark.createDataFrame(EDGE, "doc_id long, text string, rep string")
    return rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


def test_encoder_gives_the_librarys_ids(documents):
    texts = documents.text.tolist() + [t for _, t, _ in EDGE]
    for name, keeps in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        codec = PieceEncoder(tokenizer_path(name), keeps, max_pieces=20_000)  # the table starts afresh on the way
        got = [ids[a:b].tolist() for _, ids, e in codec.encode(pa.array(texts, pa.string()), 7) for a, b in zip(e, e[1:])]
        want = [e.ids + [7] for e in codec.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert got == want


def test_encoder_knows_the_files_added_tokens(documents):
    """Against the library as it comes, without the encoder's settings."""
    texts = ["a b<|endoftext|>c d", "<|startoftext|> one<|endoftext|><|endoftext|>\n two", "<|endoftext|>", "<|endoftext|", "|>", None,
             "plain text", "<|ENDOFTEXT|> x", "a\u00a0b<|startoftext|>", "tail <|endoftext|>"] + documents.text.tolist()[:40]
    for name, keeps in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        codec = PieceEncoder(tokenizer_path(name), keeps)
        got = [ids[a:b].tolist() for _, ids, e in codec.encode(pa.array(texts, pa.string()), 7) for a, b in zip(e, e[1:])]
        library = Tokenizer.from_file(tokenizer_path(name))
        assert got == [library.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
        assert library.token_to_id("<|endoftext|>") in got[0]


def test_packing_covers_every_id_once(spark, sf_dir, documents):
    rows = queries.QUERIES["op5_packing"](spark, sf_dir).toPandas()
    codec = PieceEncoder(tokenizer_path("byte_bpe_50k.json"), True)
    ids = dict(zip(documents.doc_id, (np.array(e.ids + [0], "<u4") for e in codec.tokenizer.encode_batch(
        documents.text.fillna("").tolist(), add_special_tokens=False))))
    for doc, pieces in rows.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        assert pieces.start.tolist() == (pieces.length.cumsum() - pieces.length).tolist()
        assert (pieces.doc_tokens == len(ids[doc])).all() and pieces.length.sum() == len(ids[doc])
        assert pieces.ids_crc32.tolist() == [zlib.crc32(ids[doc][a:a + n].tobytes()) for a, n in zip(pieces.start, pieces.length)]
    for _, pieces in rows.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == (pieces.length.cumsum() - pieces.length).tolist() and pieces.length.sum() <= 1024
    assert rows.doc_id.nunique() == len(documents)
    assert rows.length.sum() > 0.95 * 1024 * rows.sequence_id.nunique()


def test_differencing_keeps_capacity():
    sizes = np.random.default_rng(1).integers(1, 257, 400)
    windows = deal(sizes, 1024)
    assert np.bincount(windows, sizes).max() <= 1024 and windows.max() + 1 <= 1.03 * -(-sizes.sum() // 1024)
    assert deal(np.array([1024]), 1024).tolist() == [0]


def test_packing_edge_cases(spark, edge):
    rows = pack_tokens(edge, tokenizer_path("byte_bpe_50k.json"), True, 0, window=64, piece=16, batch=8, with_ids=True).toPandas()
    assert rows.groupby("sequence_id").length.sum().max() <= 64
    assert (rows.ids.map(len) == rows.length).all()
    one = rows[rows.doc_id == 8]
    assert one.length.sum() == 2 * one.doc_tokens.iloc[0]
    assert pack_tokens(edge.limit(0), tokenizer_path("byte_bpe_50k.json"), True, 0).count() == 0


def test_token_files_round_trip(spark, sf_dir, documents):
    rows = queries.QUERIES["op7_token_files"](spark, sf_dir).toPandas().sort_values("doc_id")
    docs = documents.sort_values("doc_id")
    codec = PieceEncoder(tokenizer_path("word_bpe_49k.json"), False)
    ids = [np.array(e.ids + [2], "<u4") for e in codec.tokenizer.encode_batch(docs.text.fillna("").tolist(), add_special_tokens=False)]
    size = np.array([len(x) for x in ids])
    assert rows.doc_id.tolist() == docs.doc_id.tolist() and rows.n_tokens.tolist() == size.tolist()
    assert rows.start.tolist() == (np.cumsum(size) - size).tolist()
    assert rows.ids_crc32.tolist() == [zlib.crc32(x.tobytes()) for x in ids]


def test_token_files_edge_cases(spark, edge):
    path = tokenizer_path("word_bpe_49k.json")
    rows = token_files(spark, edge, path, False, 2, length=8).toPandas()
    assert len(rows) == len(EDGE) and rows.start.is_unique and rows.n_tokens.min() == 1
    assert token_files(spark, edge.limit(0), path, False, 2).count() == 0


def test_near_duplicates_of_documents(spark, sf_dir, documents):
    rows = queries.QUERIES["op2_near_duplicates"](spark, sf_dir).toPandas().set_index("doc_id")
    want = brute.near_duplicates(zip(documents.doc_id, documents.text))
    assert {k: (r.n_shingles, r.component_id) for k, r in rows.iterrows()} == want
    assert (rows.kept == (rows.index == rows.component_id)).all()


def test_a_crowd_of_near_copies(spark, monkeypatch):
    """Copies of one text with many edits: chains, stars and strays in the
    same buckets, compared in small blocks."""
    monkeypatch.setattr(near, "BLOCK_ROWS", 40)
    r = random.Random(5)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(160):
        text = list(base)
        for _ in range(r.randint(0, 5)):
            text[r.randrange(len(text))] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    r.shuffle(rows)
    found = near.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    want = brute.near_duplicates(rows)
    assert {k: (n, c) for k, n, c in zip(found.doc_id, found.n_shingles, found.component_id)} == want
    assert len(set(c for _, c in want.values())) > 3


def test_near_duplicates_edge_cases(spark, edge):
    rows = near.near_duplicates(spark, edge).toPandas()
    got = {(r.doc_id if r.doc_id == r.doc_id else None, r.n_shingles): (r.component_id, r.kept) for r in rows.itertuples()}
    assert len(rows) == len(EDGE)
    assert got[(1, 0)] == (1, True) and got[(2, 0)] == (2, True) and got[(3, 0)] == (3, True)
    assert got[(4, 1)] == (4, True) and got[(5, 1)] == (4, False) and got[(6, 1)] == (6, True)
    assert got[(8, 5)][0] == 8 and not rows[rows.doc_id.isna()].kept.any()
    assert near.near_duplicates(spark, edge.limit(0)).count() == 0


def test_connected_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 50), (50, 75), (7, 7), (None, 3), (200, 201), (201, 200)]
    rows = connected_components(spark, spark.createDataFrame(links, "a long, b long")).collect()
    assert dict(rows) == {k: 0 for k in range(41)} | {50: 50, 75: 50, 100: 50, 200: 200, 201: 200}
    assert len(rows) == len(dict(rows))


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(3)
    text = r.integers(97, 100, 600).astype(np.uint8)
    text[300:420] = text[:120]
    raw = text.tobytes()
    order = suffix_array(text, 40)
    shared = common_prefixes(text, order, 40)
    assert [raw[i:i + 40].ljust(40, b"\0") for i in order] == sorted(raw[i:i + 40].ljust(40, b"\0") for i in range(600))
    for k in range(1, 600):
        exact = len(os.path.commonprefix([raw[order[k]:], raw[order[k - 1]:]]))
        assert shared[k] == exact if exact < 40 else shared[k] >= 40


def test_common_prefixes_behind_a_pair_without_one():
    """A rare sign before a passage: its suffix and the one before it share
    nothing, the passage behind them all the same."""
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(450))
    raw = f"some words ^{passage} aaa other things _{passage}zzz".encode()
    text = np.frombuffer(raw, np.uint8)
    order = suffix_array(text, 400)
    shared = common_prefixes(text, order, 400)
    for k in range(1, len(raw)):
        exact = len(os.path.commonprefix([raw[order[k]:], raw[order[k - 1]:]]))
        assert shared[k] == exact if exact < 400 else shared[k] >= 400
    first, second = raw.index(passage.encode()), raw.rindex(passage.encode())
    windows = [raw[first - 12:first + 450], raw[second - 18:second + 450]]
    _, lo, hi = shared_strings(np.zeros(2, np.int64), np.array([12, 18]), windows, 400)
    assert lo.tolist() == [12, 18] and hi.tolist() == [462, 468]


def test_repeats_of_documents(spark, sf_dir, documents):
    rows = queries.QUERIES["op8_repeated_spans"](spark, sf_dir).toPandas().set_index("doc_id")
    contract = rows[["n_bytes", "n_removed", "n_spans", "kept_sha256"]]
    assert [tuple(contract.loc[k]) for k in documents.doc_id] == brute.repeats(documents.text, 400)


@pytest.mark.parametrize("crowd", [1000, 4, 1])
def test_repeats_around_shared_passages(spark, crowd):
    """A passage in many surroundings, runs of one sign, equal rows and ids;
    small crowds go through the split of cells."""
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = noise(90)
    rows = [(i, noise(r.randint(0, 60)) + passage[r.randint(0, 20):r.randint(60, 90)] + noise(r.randint(0, 60))) for i in range(60)]
    rows += [(100, "a" * 500), (101, "ab" * 120 + "xyz"), (102, None), (103, ""), (100, "a" * 500), (None, passage), (106, "é" * 60)]
    found = remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), span=40, gram=10, crowd=crowd, ranges=4)
    got = {(r.doc_id, r.text): (r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, hashlib.sha256(r.dedup.kept).hexdigest())
           for r in found.collect()}
    assert got == dict(zip(rows, brute.repeats([t for _, t in rows], 40)))


def test_repeats_edge_cases(spark, edge):
    rows = remove_repeats(spark, edge, as_text=True).collect()
    assert len(rows) == len(EDGE) and all(r.dedup.kept is None for r in rows)
    assert {r.dedup.kept_text for r in rows if r.doc_id == 7} == {""}  # one sign and space over and over
    assert remove_repeats(spark, edge.limit(0)).count() == 0


def test_leaks_of_documents(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").toPandas()
    rows = queries.QUERIES["op10_decontamination"](spark, sf_dir).toPandas()
    want = brute.leaks(zip(documents.doc_id, documents.text), list(zip(items.item_id, items.text)))
    assert dict(zip(rows.doc_id, rows.n_items)) == {k: len(v) for k, v in want.items()}
    assert (rows.contaminated == (rows.n_items > 0)).all() and rows.contaminated.any()


def test_leaks_with_words_replaced(spark, edge):
    item = " ".join(f"token{k}" for k in range(30))
    words = item.split()
    rows = [(1, "before " + item.upper() + "!! after"), (2, " ".join(w if k % 8 else "other" for k, w in enumerate(words))),
            (3, " ".join(words[:12])), (4, " ".join(reversed(words))), (5, " ".join(words[9:22])), (6, " ".join(w if k % 2 else "x" for k, w in enumerate(words)))]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    found = flag_leaks(spark, spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {r.doc_id for r in found if r.contaminated} == {1, 2, 5}
    edges = flag_leaks(spark, edge, bench)
    assert edges.count() == len(EDGE) and edges.where("contaminated").count() == 0 and set(edge.columns) <= set(edges.columns)
    assert flag_leaks(spark, edge.limit(0), bench).count() == 0 and flag_leaks(spark, edge, bench.limit(0)).count() == len(EDGE)


def test_licenses_of_documents(spark, sf_dir, documents):
    rows = queries.QUERIES["op1_license_scan"](spark, sf_dir).toPandas()
    lines = {"MIT-line": "Released under the MIT License.", "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
             "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3."}
    want = {(d, k) for d, t in zip(documents.doc_id, documents.text) for k, line in lines.items() if line in (t or "")}
    assert {(r.doc_id, r.license) for r in rows.itertuples() if r.license in lines} == want and want


def test_licenses_long_templates_and_edges(spark, edge):
    body = [f"clause{k}" for k in range(120)]
    noise = [f"n{k}" for k in range(700)]
    near_copy = [w if k % 40 else "changed" for k, w in enumerate(body)]
    rows = [(1, " ".join(noise[:333] + body + noise[333:])), (2, " ".join(noise[:100] + near_copy)),
            (3, " ".join(noise + body[:60])), (4, " ".join(noise))]
    templates = {"T": " ".join(body), "short": "two words"}
    found = scan_licenses(spark, spark.createDataFrame(rows, "doc_id long, text string"), templates).toPandas()
    assert set(found.doc_id) == {1, 2} and found.set_index("doc_id").containment[1] == 1.0
    assert scan_licenses(spark, edge).count() == 0 and scan_licenses(spark, edge.limit(0)).count() == 0
    assert scan_licenses(spark, edge, {"short": "two words"}).count() == 0


def test_toxicity_held_out_accuracy(spark):
    """Learnt on sf0.1's labels without the held-out fifth."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = queries.QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").toPandas()
    assert set(rows.held_out) == {True, False} and rows.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(rows.doc_id, rows.held_out))
    test = rows[rows.held_out]
    assert (test.predicted == test.toxic).mean() > 0.96
    assert docs.count() >= len(rows)


def test_toxicity_unseen_spelling_and_edges(spark, edge):
    plain = [f"a calm sentence number {k} about rivers and hills" for k in range(200)]
    rude = [t + " you wretched scoundrel" for t in plain]
    model = fit(plain + rude, [0] * 200 + [1] * 200)
    scores = model.score(pa.array(["rivers and wretcheds hills scoundrell", "a calm sentence about hills", "", None]))
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3] < 0.6
    rows = score_toxicity(edge, model)
    assert rows.count() == len(EDGE) and rows.where("score is null").count() == 0 and score_toxicity(edge.limit(0), model).count() == 0
    one = fit_on_labels(edge, spark.createDataFrame([(4, 1, 1), (6, 0, None)], "doc_id long, quality int, toxic int"))
    assert 0 <= one.score(pa.array(["one"]))[0] <= 1
    assert fit_on_labels(edge, spark.createDataFrame([], "doc_id long, toxic int")).score(pa.array(["x"]))[0] < 0.5
