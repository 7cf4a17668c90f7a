"""Registered queries of the text operators, over whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.llm import (
    byte_pairs, collocations, decontaminate, language_id, mixing, neighbours, passages, pseudonyms, quality, ranked_search, shingle_join, token_counts, toxicity,
)
from lotmill.llm.common import fold, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_target_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])


@query
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), pseudonyms.secret_key(spark), spans_col="spans")
    return docs.select("doc_id", "text", F.size("spans").cast("long").alias("n_pii"), "spans")


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_classes(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    samples = language_id.learn(docs.where(~held_out))
    found = language_id.identify(docs, samples)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits")


def _judged(spark: SparkSession, sf_dir: str, operator, limit: float) -> DataFrame:
    """Scores of all documents by a model that never saw the labels of the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    model = operator.train(docs.where(~held_out), labels.where(~held_out))
    found = operator.scores(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


@query
def op3_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, quality, 0.3)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, toxicity, 0.5)


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.read_vocabulary())


@query
def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"), span=passages.SPAN)


@query
def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    decoded = byte_pairs.decode(encoded, ranks, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_collocations"] = collocations.ORACLE
ORACLES["op13_ranked_search"] = ranked_search.ORACLE
