"""From documents to packed training sequences, one operator a stage.

A stage gets what the one before kept and returns the same columns; the last one returns packed pieces.
A document is its doc_id and its text: rows that repeat a doc_id, or have none, are judged one by one, and of rows
that repeat both one stays. Tables of dropped documents hold keys only; each is written, so that Spark broadcasts it if it
is small and otherwise sorts both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinions.llm import decontaminate, exact, packing, quality, simhash
from opinions.llm.common import shipped, written
from opinions.llm.queries import tokenizer


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(decontaminate.row_identity().alias("doc_id"), "text")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``gone`` names in doc_id; a null key is a key like any other."""
    gone = written(gone.select(F.col("doc_id.key").alias("_gone"), F.col("doc_id.text").alias("_text")).distinct())
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_text"]), "left_anti")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line model finds bad. Labels of held-out documents are not learned."""
    chain = quality.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.score(chain, F.col("text")) >= quality.THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts, the longest as written."""
    groups = exact.deduplicated(docs).filter("group_size > 1")
    groups = groups.groupBy(F.col("doc_id").alias("_key"), F.xxhash64("text_sha256").alias("_text"))
    # Rows that repeat key and text are all kept or all dropped.
    odd = written(groups.agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n")).filter("NOT _kept OR _n > 1"))
    text = F.xxhash64(F.sha2(exact.normalised(docs["text"]), 256))
    same = docs["doc_id"].eqNullSafe(odd["_key"]) & (text == odd["_text"])
    left = docs.join(odd, same, "left_anti")
    several = odd.filter("_kept")
    if several.isEmpty():
        return left
    best = F.min(F.struct((-F.length(docs["text"])).alias("_size"), *[docs[c] for c in docs.columns])).alias("_row")
    some = docs.join(several, same).groupBy("_key", "_text").agg(best)
    return left.unionByName(some.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class, the one with the smallest doc_id."""
    found = simhash.near_duplicates(_rows(docs))
    return _without(docs, found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that repeat the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.contamination(_rows(docs), benchmark).filter("contaminated"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.best_fit(docs, tokenizer())


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]
#: The quality model, XXH64 and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    shipped(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
