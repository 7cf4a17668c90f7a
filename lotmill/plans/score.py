"""Scoring of listings with a saved model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions.numeric import tier_label
from lotmill.sources.tables import path_exists, read_table, write_table


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return PipelineModel.load(path)


def predict(df: DataFrame, model: PipelineModel, with_probabilities: bool = False) -> DataFrame:
    """Adds the predicted tier and its confidence; null confidence for models without probabilities.

    A map over the rows: no shuffle, whatever the batch size.
    """
    numbered = df.withColumn("_row", F.struct(*df.columns))
    out = model.transform(numbered)
    tiers = tier_label("prediction").alias("predicted_tier")
    if "probability" in out.columns:
        chances = vector_to_array("probability")
        confidence = F.array_max(chances)
    else:
        chances = F.lit(None).cast("array<double>")
        confidence = F.lit(None).cast("double")
    columns = [tiers, confidence.alias("confidence")]
    if with_probabilities:
        columns.append(chances.alias("probabilities"))
    return out.select(*[F.col("_row")[c].alias(c) for c in df.columns], *columns)


def predict_table(spark: SparkSession, in_path: str, model_path: str, out_path: str | None = None, in_format: str = "parquet",
                  out_format: str = "parquet") -> DataFrame:
    scored = predict(read_table(spark, in_path, in_format), load_model(spark, model_path))
    if out_path:
        write_table(scored, out_path, out_format)
        return read_table(spark, out_path, out_format)
    return scored


def predict_one(spark: SparkSession, model: PipelineModel, /, **listing) -> dict:
    """Score one record given by column name: tier, confidence and probability per tier."""
    kinds = {"power": "double", "kilometer": "double", "yearOfRegistration": "int"}
    columns = [c for c in rules.LISTING_COLUMNS if c not in ("price", "price_tier")]
    listing = {"dataSource": "kaggle", **listing}
    values = tuple(float(listing[c]) if kinds.get(c) == "double" else listing[c] for c in columns)
    row = predict(spark.createDataFrame([values], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)), model, True).first()
    chances = row["probabilities"] or [None] * len(rules.TIERS)
    return {"tier": row["predicted_tier"], "confidence": row["confidence"], "probabilities": dict(zip(rules.TIERS, chances))}
