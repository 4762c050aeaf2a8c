"""The corpus operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    best_fit,
    decontamination,
    filter_audit,
    fingerprints,
    jaccard,
    language,
    merkle,
    packing,
    secret_scan,
    sharding,
    toxicity,
    url_rules,
    warc,
)
from .common import ascii_lower, table
from .signature_tree import Threshold

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")).drop("lost", "won")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer="byte_bpe_50k", window=1024)


def id_remainder(divisor: int) -> Column:
    """The crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(5) == 0
    filters = language.learned_filters(docs.where(~held_out))
    return language.identified(docs, filters).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=3, threshold=Threshold(90, 100))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleaved_shards(table(spark, sf_dir, "documents"), shards=8)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def toxic_model(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    """Learned from the labels that may be learned from."""
    labels = table(spark, sf_dir, "labels").where(id_remainder(3) != 1)
    return toxicity.learned_model(table(spark, sf_dir, "documents"), labels)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), toxic_model(spark, sf_dir))
    return scored.select("doc_id", (id_remainder(3) == 1).alias("held_out"), "score", "predicted")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged_urls(table(spark, sf_dir, "pages"), RULES).drop("by")


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit_packed(table(spark, sf_dir, "documents"), tokenizer="byte_bpe_50k", window=2048)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    tampered = F.when(id_remainder(5) == 0, ascii_lower(text)).otherwise(text)
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"), claimed={"text": tampered})


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_fingerprints": op2_fingerprints,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_urls": op10_urls,
    "op11_best_fit": op11_best_fit,
    "op12_merkle": op12_merkle,
    "op13_filter_audit": op13_filter_audit,
}
