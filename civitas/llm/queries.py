"""Queries of the ten operators over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import oracles
from .arrow_store import token_files
from .components import stored
from .conversations import repair_plans, repaired_digests, repaired_turns
from .decontaminate import flag_leaks
from .encoder import tokenizer_path
from .licenses import scan_licenses
from .merkle import folded, leaf_digest, merkle_manifest, proof_digest
from .near_duplicates import near_duplicates
from .near_vectors import near_vectors
from .packing import pack_tokens
from .quality import quality_verdicts
from .repeated_spans import remove_repeats
from .url_filter import judge_urls
from .warc import archive_pages
from .toxicity import fit_on_labels, held_out, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op11_merkle": oracles.MERKLE, "op12_conversations": oracles.CONVERSATIONS}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), True, 0)


@register
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), False, 2)


@register
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


@register
def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark, table(spark, sf_dir, "documents"))
    # the text as it stays: characters cut in two are replaced
    kept = F.make_valid_utf8(F.col("dedup.kept").cast("string"))
    return found.select("doc_id", "dedup.n_bytes", "dedup.n_removed", "dedup.n_spans",
                        F.sha2("dedup.kept", 256).alias("kept_sha256"), kept.alias("text"))


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@register
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "contaminated", "n_items")


@register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark, table(spark, sf_dir, "documents")).select("doc_id", "license", "containment", "first_token")


@register
def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


@register
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [F.try_add(F.col("n_chars"), F.lit(1)) if k == 3 else c for k, c in enumerate(row)]
    leaves = stored(docs.select("doc_id", "lang", leaf_digest(*row).alias("leaf"),
                                F.when(tampered, leaf_digest(*changed)).alias("tampered")), scratch_dir(spark, "leaves"))
    rows = merkle_manifest(spark, leaves).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in, by a checksum of conversation and turn."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


@register
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    turns = damaged(rows)
    plans = stored(repair_plans(spark, turns), scratch_dir(spark, "plans"))
    digests = repaired_digests(repaired_turns(turns, plans))
    found = rows.select("conv_id").distinct().alias("r").join(
        plans.alias("p"), F.col("r.conv_id").eqNullSafe(F.col("p.conv_id")), "left").join(
        digests, F.col("r.conv_id").eqNullSafe(F.col("conv")), "left")
    # gaps beyond a long stay null; other nulls are conversations without rows
    zero = [F.when(F.col("turns").isNull(), F.lit(0)).otherwise(F.col(c)).alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("r.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@register
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(spark, table(spark, sf_dir, "documents"))
