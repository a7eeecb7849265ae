"""The registered queries: each operator over the whole documents table, as digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    filter_audit,
    language,
    merkle,
    packing,
    passages,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    toxicity,
)
from tillroll.llm.common import documents, held_out, vocabulary


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(documents(spark, sf_dir))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.learn(docs.filter(~held_out()))
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return language.identify(marked, model).drop("text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), vocabulary())
    crc = F.crc32("ids").alias("ids_crc32")
    names = ("doc_tokens", "sequence_id", "offset", "continues")
    return pieces.select("doc_id", "start", "length", crc, *names)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = exact_dedup.duplicate_report(documents(spark, sf_dir))
    return report.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.decode(bpe.encode(documents(spark, sf_dir), vocabulary()), vocabulary())
    spelt = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2(spelt, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "distance")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    removed = F.col("n_bytes") - F.length("kept")
    return found.select(
        "doc_id",
        "n_bytes",
        removed.cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    mark = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", mark.alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.learn(docs, labels.filter(~held_out()))
    scored = toxicity.score(docs.withColumn("held_out", held_out()), model)
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        of_kind = F.filter("base", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    counts = [count(k.name) for k in secret_scan.KINDS]
    digest = F.sha2(secret_scan.spelt(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.spelt(F.col("spans")).alias("spans"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(documents(spark, sf_dir), items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(documents(spark, sf_dir), labels)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document, by the checksum of its id, loses its line breaks."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    flat = F.replace("text", F.lit("\n"), F.lit(""))
    text = F.when(even, flat).otherwise(F.col("text"))
    return merkle.Manifest(documents(spark, sf_dir), text).refold().drop("source")


QUERIES = {
    "op1_passages": op1_passages,
    "op2_language": op2_language,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scan": op10_secret_scan,
    "op11_decontaminate": op11_decontaminate,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
}
