"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.llm import decontaminate, language_id, mixing, pseudonyms, shingle_join
from lotmill.llm.common import dropped, small, table, without_ids, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled texts of ``docs``; texts without a letter (or null) are rejected, and the language
    found fills a null ``lang``. Known languages stay as they are."""
    samples = language_id.learn(docs)
    rows = docs.select(F.struct("*").alias("row"), language_id.predicted(spark, samples, F.col("text")).alias("found"))
    named = [F.coalesce("row.lang", "found.lang_pred").alias(c) if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return rows.where("found.lang_pred <> 'und'").select(*named) if samples else docs.where(r"text RLIKE '\\p{L}'")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group (shingles of five words, similarity 0.8); of rows that repeat id and text, one."""
    classes = shingle_join.jaccard_classes(docs, k=5, percent=80)  # a written table
    kept = without_ids(docs, "doc_id", classes.where("doc_id <> component_id").select("doc_id"))
    again = small(written(classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id")), "again"))
    dropped(classes)
    if again.isEmpty():
        return kept
    repeats = kept["doc_id"] == again["again_id"]
    once = kept.join(again, repeats, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, repeats, "left_anti").unionByName(once)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return without_ids(docs, "doc_id", decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms into the texts and keeps every document."""
    return pseudonyms.pseudonymise(docs, pseudonyms.secret_key(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds rate and number of copies per document; documents of rate 0 go."""
    return mixing.mix(docs, table(spark, sf_dir, "labels")).where("mix_rate > 0")


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark_leaks), ("PII", personal_data), ("mixing", mixture)]

#: SQL has no suffix automata, Feistel networks or projected gradient; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage{number}")
    return docs
