"""Short benchmark items, long templates, samples, read-back tasks, planted
passages."""

import os
import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from civitas.llm import arrow_store, repeated_spans, warc  # noqa: E402
from civitas.llm.decontaminate import find_leaks, short_runs  # noqa: E402
from civitas.llm.encoder import tokenizer_path  # noqa: E402
from civitas.llm.licenses import scan_licenses  # noqa: E402
from civitas.llm.repeated_spans import remove_repeats  # noqa: E402
from civitas.llm.sampling import hash_sample  # noqa: E402


def test_runs_cover_an_item_and_one_must_agree():
    for n in range(1, 13):
        runs = short_runs(n, 80)
        assert [k for a, r in runs for k in range(a, a + r)] == list(range(n))
        assert len(runs) == n - -(-n * 80 // 100) + 1


def test_short_items_against_every_place(spark):
    r = random.Random(4)
    words = [f"w{k}" for k in range(40)]
    items = [(n, " ".join(r.choices(words, k=n))) for n in range(1, 20)] + [(50, ""), (51, None), (52, "w1 w2 w3 w4 w5")]
    docs = []
    for k in range(150):
        text = r.choices(words, k=r.randint(0, 60))
        own = (r.choice(items)[1] or "").split()
        for p in range(len(own)):
            if r.random() < 0.12:
                own[p] = "changed"
        docs.append((k, " ".join(text[:20] + own + text[20:])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(x.doc_id, x.item_id) for x in find_leaks(spark, table, bench).collect()}
    want = {(k, i) for k, s in brute.leaks([d for d in docs], [i for i in items if i[1]]).items() for i in s}
    assert found == want and {i for _, i in want} >= set(range(3, 13))


def test_template_of_three_thousand_shingles(spark):
    r = random.Random(5)
    template = [f"t{r.randint(0, 900)}" for _ in range(3004)]
    changed = [w if k % 40 else "other" for k, w in enumerate(template)]  # 125 of 1000 shingles differ
    docs = [(1, "before " * 700 + " ".join(template) + " after" * 900), (2, " ".join(changed)), (3, " ".join(template[:2000])), (4, "x " * 4000)]
    found = scan_licenses(spark, spark.createDataFrame(docs, "doc_id long, text string"), {"long": " ".join(template)})
    got = {x.doc_id: x.containment for x in found.collect()}
    assert set(got) == {1, 2} and got[1] == 1.0 and 0.8 <= got[2] < 0.9


def test_samples_are_the_least_hashes(spark, tmp_path):
    rows = spark.range(20_000).withColumn("y", F.col("id") % 3)
    want = rows.orderBy(F.xxhash64("id"), "id", "y").limit(500).collect()
    assert sorted(hash_sample(rows, "id", 500, str(tmp_path / "a")).collect()) == sorted(want)
    same = rows.withColumn("id", F.lit(7))  # one key: no bound leaves enough, or too few
    assert hash_sample(same, "id", 500, str(tmp_path / "b")).count() == 500
    assert hash_sample(rows.limit(10), "id", 500, str(tmp_path / "c")).count() == 10


def test_files_and_stripes_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(60).select(F.col("id").alias("doc_id"), F.format_string("some words %d", "id").alias("text"))
    folder = str(tmp_path / "tokens")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of small parts
    try:
        arrow_store.write_token_files(rows, folder, tokenizer_path("word_bpe_49k.json"), False, 2).write.parquet(f"{folder}/parts")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    parts = spark.read.parquet(f"{folder}/parts")
    back = arrow_store.read_token_files(spark, parts, folder)
    assert parts.count() > 2 and back.rdd.getNumPartitions() == parts.count() and back.count() == 60
    monkeypatch.setattr(warc, "STRIPE", 100)
    pages = rows.select(F.col("doc_id").alias("page_id"), F.lit("http://a/").alias("url"), F.col("text").alias("html"))
    found = warc.archive_pages(spark, pages, folder=str(tmp_path / "warc"))
    assert found.rdd.getNumPartitions() > 2 and found.count() == 60


def test_folder_addresses():
    import pytest
    assert arrow_store._open("/a/b")[1] == "/a/b" and arrow_store._open("dbfs:/x/y")[1] == "/dbfs/x/y"
    assert arrow_store._open("file:///a")[1] == "/a"
    with pytest.raises(ValueError, match="wasbs"):
        arrow_store._open("wasbs://c@a/x")


def test_planted_passages(spark):
    """By ``n_removed``: passages of 400 bytes and more go from all copies, a
    passage of 51 words under 400 bytes stays unless words are counted, and
    what is planted nowhere is left alone."""
    r = random.Random(6)

    def prose(n, longest=9):
        return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, longest))) for _ in range(n))
    long, short = prose(90), prose(51, 6)
    assert len(long) >= 400 and len(short) < 400
    docs = []
    for k in range(60):
        planted = long if k % 3 == 0 else short if k % 3 == 1 else ""
        docs.append((k, f"{prose(r.randint(20, 200))} {planted} {prose(30)}"))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    by_bytes = {x.doc_id: x.dedup.n_removed for x in remove_repeats(spark, table).collect()}
    by_words = {x.doc_id: x.dedup.n_removed for x in remove_repeats(spark, table, span=280, gram=70, words=51).collect()}
    for k, _ in docs:
        assert by_bytes[k] >= len(long) if k % 3 == 0 else by_bytes[k] == 0
        assert by_words[k] >= len(long if k % 3 == 0 else short) if k % 3 < 2 else by_words[k] == 0
    want = {k: v[1] for (k, _), v in zip(docs, brute.repeats([t for _, t in docs], 400))}
    assert by_bytes == want


def test_windows_hold_only_strings_of_their_anchor():
    """A window reaches over the strings that have this anchor, not over all
    that hold its gram; every string lies in exactly one window."""
    text = bytes(random.Random(5).choices(b"abcdefgh ", k=9000))
    table = pa.record_batch([pa.array([1]), pa.array([2]), pa.array([text.decode()])], names=["doc", "th", "body"])
    marks = pa.Table.from_batches(repeated_spans._mark(400, 100)(iter([table]))).to_pandas()
    starts = [s for m in marks.itertuples() for s in range(m.at, m.at + m.reach + m.size - 400 + 1)]
    assert sorted(starts) == list(range(9000 - 400 + 1))
    assert marks["size"].sum() < 0.85 * 700 * len(marks)


def test_sorting_and_marking_take_bounded_memory():
    """Arrays of a block of windows and of a chunk of texts stay small beside
    a worker's own memory, whatever the batch."""
    r = np.random.default_rng(2)
    texts = [bytes(r.integers(97, 123, 550).astype(np.uint8)) for _ in range(4000)]
    windows = pa.record_batch([pa.array(np.arange(8000) // 2), pa.array(np.arange(8000)), pa.array(np.full(8000, 100, np.int32)),
                               pa.array([t for t in texts for _ in range(2)], pa.binary())], names=["cell", "win", "lead", "bytes"])
    bodies = pa.record_batch([pa.array(np.arange(4000)), pa.array(np.arange(4000)), pa.array([t.decode() for t in texts])], names=["doc", "th", "body"])
    for step, batch in ((repeated_spans._sort_shards(400), windows), (repeated_spans._mark(400, 100), bodies)):
        tracemalloc.start()
        rows = sum(out.num_rows for out in step(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= 4000 and peak < 64e6, peak
