"""Corpus pipeline over ``documents``: toxic documents go, one document of
each near-duplicate group stays, repeated passages and benchmark leaks are
taken out, and what is left is packed into token sequences. Every stage is
written as Parquet in the shared folder and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.llm.decontaminate import flag_leaks
from civitas.llm.encoder import tokenizer_path
from civitas.llm.near_duplicates import near_duplicates
from civitas.llm.packing import pack_tokens
from civitas.llm.repeated_spans import remove_repeats
from civitas.llm.toxicity import fit_on_labels, score_toxicity
from civitas.session import scratch_dir

#: Words of a passage that may not repeat, and bytes of a string that may not,
#: for texts of long words or without white space.
PASSAGE_WORDS, PASSAGE = 51, 280


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. The model learns
    from ``labels`` and the texts of this stage's documents."""
    model = fit_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).where("predicted = 0").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates
    (5-word shingles, Jaccard 0.8). Rows that repeat an id are one document;
    rows without an id can't be named and all stay."""
    kept = near_duplicates(spark, docs, words=5, similarity=80).where("kept").select("doc_id").distinct()
    return (docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
            .unionByName(docs.where("doc_id is null")).select(docs.columns))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ``PASSAGE_WORDS`` words and the strings of
    ``PASSAGE`` bytes that occur more than once; a text may end up empty, its
    document stays. A null text stays null."""
    cut = remove_repeats(spark, docs, span=PASSAGE, gram=PASSAGE // 4, as_text=True, words=PASSAGE_WORDS)
    text = F.when(F.col("text").isNotNull(), F.col("dedup.kept_text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    flagged = flag_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.where("not contaminated").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids from the texts that are left."""
    return pack_tokens(docs, tokenizer_path("byte_bpe_50k.json"), True, 0)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", one_of_each_group), ("repeated_spans", drop_repeats),
          ("decontamination", drop_leaks), ("packing", pack)]

#: Hashing, learning and token ids: SQL can't express the stages; tests hold
#: them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
