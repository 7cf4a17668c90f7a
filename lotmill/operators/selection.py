"""Feature scoring and selection. Scores are small tables: one row per feature."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.functions.numeric import known, pearson
from lotmill.operators.boosting import BoostedTrees
from lotmill.operators.neighbour_information import neighbour_information
from lotmill.operators.order_stats import quantiles
from lotmill.operators.quality import _rows
from lotmill.session import kept
from lotmill.sources.tables import write_text


def _number(c: str):
    """A feature as a number; text that is none counts as missing."""
    return known(F.col(f"`{c}`").try_cast("double"))


def _filled(c: str):
    return F.coalesce(_number(c), F.lit(0.0))


def variance_scores(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Sample variance as the score, population variance for the threshold."""
    cells = {c: [F.var_samp(_number(c)), F.var_pop(_number(c))] for c in features}
    return _rows(df, cells, ["score", "population_variance"]).withColumnRenamed("column", "feature")


def correlation_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """|Pearson r| with the label, missing values as 0; constant columns score 0."""
    cells = {c: [F.abs(pearson(_filled(c), label))] for c in features}
    scored = _rows(df, cells, ["score"]).withColumnRenamed("column", "feature")
    return scored.withColumn("score", F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)))


def anova_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way analysis of variance F per feature, from one aggregation per class."""
    per_class = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"), *[F.struct(F.avg(_filled(c)).alias("m"), F.var_pop(_filled(c)).alias("v")).alias(c) for c in features]
    )
    long = per_class.unpivot([label, "_n"], [f"`{c}`" for c in features], "feature", "s").select("feature", "_n", "s.m", "s.v")
    total, classes = F.sum("_n"), F.count(F.lit(1))
    grand = F.sum(F.col("_n") * F.col("m")) / total
    between = F.sum(F.col("_n") * F.col("m") * F.col("m")) - total * grand * grand
    within = F.sum(F.col("_n") * F.col("v"))
    return long.groupBy("feature").agg(F.try_divide(between / (classes - 1), within / (total - classes)).alias("score"))


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information between quantile-binned features and the label, in nats.

    The exact deciles bound the bins; the contingency table has at most features x bins x classes rows.
    """
    slim = df.select(F.col(label).alias("_y"), *[_filled(c).alias(f"_x{i}") for i, c in enumerate(features)])
    names = {f"_x{i}": c for i, c in enumerate(features)}
    probs = {f"p{k}": k / bins for k in range(1, bins)}
    cuts = {r["column"]: sorted({r[p] for p in probs}) for r in quantiles(slim, list(names), probs).collect()}
    for x in names:
        splits = [-math.inf, *cuts.get(x, []), math.inf]
        slim = Bucketizer(splits=splits, inputCol=x, outputCol=f"{x}_bin", handleInvalid="keep").transform(slim)
    long = slim.select("_y", *[F.col(f"{x}_bin").alias(c) for x, c in names.items()]).unpivot(["_y"], [f"`{c}`" for c in features], "feature", "bin")
    joint = long.groupBy("feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n"))
    by_bin = joint.groupBy("feature", "bin").agg(F.sum("n").alias("n_bin"))
    by_class = joint.groupBy("feature", "_y").agg(F.sum("n").alias("n_class"))
    total = joint.groupBy("feature").agg(F.sum("n").alias("n_all"))
    placed = joint.join(by_bin, ["feature", "bin"]).join(by_class, ["feature", "_y"]).join(total, "feature")
    p = F.col("n") / F.col("n_all")
    gain = p * F.log(F.col("n").cast("double") * F.col("n_all") / (F.col("n_bin").cast("double") * F.col("n_class")))
    return placed.groupBy("feature").agg(F.greatest(F.sum(gain), F.lit(0.0)).alias("score"))


def neighbour_scores(df: DataFrame, features: Sequence[str], label: str, k: int = 3) -> DataFrame:
    """Mutual information with the label by k-th neighbours, missing values as 0, in nats."""
    filled = df.select(F.col(f"`{label}`").alias("_label"), *[_filled(c).alias(c) for c in features])
    scored = neighbour_information(filled, features, "_label", k)
    every = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return every.join(scored, "feature", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score"))


def importance_scores(df: DataFrame, features: Sequence[str], label: str, seed: int = 42, rounds: int = 100, depth: int = 6) -> DataFrame:
    """Mean split gain of boosted trees per feature, scaled to sum 1; missing values stay missing, text counts as missing."""
    ready = df.select(F.col(label).cast("int").alias("_y"), F.array(*[_number(c) for c in features]).alias("_f"))
    ready = kept(ready, "importance-rows")  # the booster reads its table three times
    model = BoostedTrees(featuresCol="_f", labelCol="_y", rounds=rounds, depth=depth, seed=seed).fit(ready)
    return model.importances(features)


def importance_table(spark, model, features: Sequence[str]) -> DataFrame:
    """(feature, score) of a fitted tree model: its gains or impurity decreases."""
    if hasattr(model, "importances"):
        return model.importances(features).select("feature", "score")
    values = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, score double")


class FeatureSelector:
    """Scores features by a strategy, keeps some, and projects tables onto them."""

    THRESHOLDS = {"importance": 0.01, "variance": 0.01, "correlation": 0.05}

    def __init__(self, strategy: str = "importance", threshold: float | None = None, k: int | None = None, seed: int = 42,
                 rounds: int = 100):
        self.strategy, self.threshold, self.k, self.seed, self.rounds = strategy, threshold, k, seed, rounds
        self.scores: list[tuple[str, float]] = []
        self.selected: list[str] = []

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "label") -> "FeatureSelector":
        table = {
            "importance": lambda: importance_scores(df, features, label, self.seed, self.rounds),
            "variance": lambda: variance_scores(df, features),
            "correlation": lambda: correlation_scores(df, features, label),
            "k_best": lambda: anova_scores(df, features, label),
            "mutual_info": lambda: neighbour_scores(df, features, label),
            "binned_info": lambda: mutual_information(df, features, label),
        }
        if self.strategy not in table:
            raise ValueError(f"unknown strategy: {self.strategy}")
        rows = table[self.strategy]().collect()  # one row per feature
        place = {f: i for i, f in enumerate(features)}
        rows.sort(key=lambda r: (-(r["score"] if r["score"] is not None else -1.0), place[r["feature"]]))
        self.scores = [(r["feature"], r["score"]) for r in rows]
        head = [f for f, _ in self.scores[: self.k or min(10, len(features))]]
        limit = self.threshold or self.THRESHOLDS.get(self.strategy)
        if self.strategy in ("k_best", "mutual_info", "binned_info"):
            kept = head
        elif self.strategy == "variance":
            kept = [r["feature"] for r in rows if (r["population_variance"] or 0.0) > limit]
            if not kept:
                raise ValueError(f"no feature has a variance above {limit}")
        else:
            kept = [f for f, s in self.scores if s >= limit] or head
        order = set(kept)
        in_table_order = self.strategy in ("variance", "k_best")
        self.selected = [f for f in features if f in order] if in_table_order else kept
        return self

    def transform(self, df: DataFrame, keep: Sequence[str] = ("label", "split")) -> DataFrame:
        if not self.selected:
            return df
        there = [f for f in self.selected if f in df.columns]
        gone = sorted(set(self.selected) - set(there))
        if gone:
            warnings.warn(f"features not found: {gone}")
        return df.select(*[F.col(f"`{c}`") for c in [*there, *[k for k in keep if k in df.columns]]])

    def report(self, top_n: int = 20) -> str:
        if not self.scores:
            return "not fitted"
        lines = [f"FEATURE SELECTION  strategy={self.strategy}", f"features {len(self.scores)}  selected {len(self.selected)}", ""]
        for place, (feature, score) in enumerate(self.scores[:top_n], 1):
            mark = "+" if feature in self.selected else " "
            lines.append(f"{place:3d} {mark} {feature:40s} {score if score is None else format(score, '.6f')}")
        return "\n".join([*lines, "", "selected", *[f"  {f}" for f in self.selected]])

    def selected_document(self) -> str:
        head = ["# Selected features", f"# Strategy: {self.strategy}", f"# Total: {len(self.selected)}"]
        return "\n".join([*head, *self.selected]) + "\n"

    def save(self, spark, path: str, top_n: int = 20) -> None:
        """``<path>.txt`` with the report and ``<path>_features.txt`` with the selected names."""
        write_text(self.report(top_n), f"{path}.txt", spark)
        write_text(self.selected_document(), f"{path}_features.txt", spark)
