"""Classification metrics. One aggregation over the predictions; the rest works on class counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(truth).alias("y_true"), F.col(predicted).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """Every (true, predicted) pair of the given classes, zero where it does not occur."""
    pairs = df.sparkSession.createDataFrame(
        [(a, b) for a in classes for b in classes],
        f"y_true {df.schema[truth].dataType.simpleString()}, y_pred {df.schema[predicted].dataType.simpleString()}",
    )
    found = confusion_counts(df, truth, predicted)
    return pairs.join(found, ["y_true", "y_pred"], "left").select("y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 and support per class from confusion counts (zero division -> 0)."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(zero)
    sides = F.explode(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), zero.alias("claimed"), hit.alias("hits")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("support"), F.col("n").alias("claimed"), zero.alias("hits")),
    )).alias("s")
    sums = counts.select(*by, sides).select(*by, "s.*").groupBy(*by, "label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits")
    )
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    precision, recall = safe(F.col("hits"), F.col("claimed")), safe(F.col("hits"), F.col("support"))
    scored = sums.select(*by, "label", precision.alias("precision"), recall.alias("recall"), "support", "hits")
    f1 = safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1)


def classification_report(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """Rows per class plus accuracy, macro and weighted averages."""
    scores = class_scores(confusion_counts(df, truth, predicted))
    classes = scores.select(F.col("label").cast("string").alias("row"), "precision", "recall", "f1", "support")
    accuracy = F.sum("hits") / F.sum("support")
    totals = scores.agg(
        accuracy.alias("acc"), F.sum("support").alias("n"),
        *[F.avg(m).alias(f"m_{m}") for m in ("precision", "recall", "f1")],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"w_{m}") for m in ("precision", "recall", "f1")],
    )
    line = lambda name, p, r, f: F.struct(
        F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("n").alias("support"))
    c = F.col
    summary = totals.select(F.explode(F.array(
        line("accuracy", c("acc"), c("acc"), c("acc")),
        line("macro avg", c("m_precision"), c("m_recall"), c("m_f1")),
        line("weighted avg", c("w_precision"), c("w_recall"), c("w_f1")),
    )).alias("s")).select("s.*")
    return classes.unionByName(summary)


def evaluate(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred", by: Sequence[str] = (), top: int = 2) -> DataFrame:
    """macro F1, balanced accuracy, recall of the top class and rate of bottom<->top confusions."""
    counts = confusion_counts(df, truth, predicted, by).persist(StorageLevel.MEMORY_AND_DISK)  # a few rows, used twice
    scores = class_scores(counts, by)
    averages = scores.groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.coalesce(F.max(F.when(F.col("label") == top, F.col("recall"))), F.lit(0.0)).alias("luxury_recall"),
    )
    severe = ((F.col("y_true") == 0) & (F.col("y_pred") == top)) | ((F.col("y_true") == top) & (F.col("y_pred") == 0))
    rate = counts.groupBy(*by).agg(
        (F.coalesce(F.sum(F.when(severe, F.col("n"))), F.lit(0)) / F.sum("n")).alias("severe_misclassification_rate")
    )
    if by:
        return averages.join(rate, list(by))
    return averages.withColumn("severe_misclassification_rate", rate.scalar())


def macro_f1(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    return class_scores(confusion_counts(df, truth, predicted)).agg(F.avg("f1").alias("macro_f1"))


def balanced_accuracy(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    return evaluate(df, truth, predicted).select("balanced_accuracy")


def business_metrics(df: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    return evaluate(df, truth, predicted).select("luxury_recall", "severe_misclassification_rate")
