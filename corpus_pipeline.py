"""From raw documents to packed sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import lines, packing, phrases, quality, simhash
from martflow.llm.tables import held, released, store
from martflow.sources.workdir import discard, scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores one half or more.

    NULL and empty texts score by the model's bias alone. Each row is judged for itself, also one that is
    repeated or has no key. An empty table stays empty; without labels every score is one half.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.filter(~quality.held_out(F.col("doc_id"))))
    rows = docs.select("text", held(docs, "text").alias("held"))
    good = quality.with_score(rows, model, "text", "score").filter("score >= 0.5")
    return good.select(*released(docs, "held", text="text"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are similar to an earlier line; ``n_chars`` follows the text.

    NULL and empty texts stay as they are. Rows that agree in key and text lose the same lines; rows
    without a key come first in the order of documents.
    """
    apart = ("doc_id", "text", "n_chars")
    kept = lines.dedup_lines(docs.select(*apart, held(docs, *apart).alias("held")))
    size = F.when(F.size("removed_lines") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    done = kept.withColumn("n_chars", size)
    return done.select(*released(docs, "held", **{c: c for c in apart}))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near duplicates.

    NULL, empty and blank texts are near duplicates of each other. Rows without a key come last, and of
    repeated rows one stays.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    NULL and empty texts have none. Repeated rows and rows without a key stay or go by their own text;
    without items all stay.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    mark = F.xxhash64("doc_id", "text").alias("mark")
    found = phrases.contamination(docs.select(mark, "text"), items, key="mark")
    hit = found.filter("contaminated").select("mark").distinct()
    rows = docs.select(mark, held(docs).alias("held"))
    return rows.join(hit, "mark", "left_anti").select(*released(docs, "held"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 tokens.

    NULL and empty texts are a piece of the end id alone. Each row is packed, also one that is repeated or
    has no key.
    """
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
#: Learned scores, similarity joins and packing are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage on what the others left.

    A stage's own tables are discarded as it ends, and its result when the next one is stored.
    """
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as paths:
            docs = store(stage(spark, docs, sf_dir), name)
            result = paths.pop()
        if read:
            discard(spark, read)
        read = result
    return STAGES[-1][1](spark, docs, sf_dir)
