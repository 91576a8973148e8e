"""The operators on the test tables, with the results that their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import (
    conversations,
    imatch,
    licenses,
    lines,
    packing,
    phrases,
    pii,
    quality,
    repeats,
    rules,
    search,
    simhash,
    token_files,
)
from martflow.llm.oracle import ORACLE as ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.size("removed_lines")
    left = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
    return kept.select(
        "doc_id",
        removed.cast("bigint").alias("n_removed"),
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"),
        F.coalesce(left, F.lit(0)).cast("bigint").alias("n_left"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(_table(spark, sf_dir, "documents"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *columns)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of their key; NULLs become one space."""
    space = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    fault = F.crc32(name) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    bare = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    found = rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), bare.alias("text"), fault.alias("fault")
    ).filter("fault <> 0")
    copies = F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return found.withColumn("copy", F.explode(copies)).drop("fault", "copy")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    repair = conversations.Repair(damaged(rows))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = repair.audit().join(
        repair.digests().withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left"
    )
    found = found.withColumnRenamed("conv_id", "mended").drop("own")
    every = rows.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("mended")), "left").select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_duplicates": op1,
    "op2_quality_scores": op2,
    "op3_benchmark_contamination": op3,
    "op4_repeated_bytes": op4,
    "op5_personal_data": op5,
    "op6_imatch_fingerprints": op6,
    "op7_token_files": op7,
    "op8_license_scan": op8,
    "op9_packed_sequences": op9,
    "op10_line_dedup": op10,
    "op11_host_rules": op11,
    "op12_conversation_repair": op12,
    "op13_ranked_search": op13,
}
