"""Ranking of (model, dataset) result rows by a weighted composite score."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.operators.fixed import Fixed
from lotmill.functions.numeric import minmax


@dataclass(frozen=True)
class Criteria:
    primary: str = "luxury_recall"
    secondary: str | None = "val_f1"
    min_primary: float | None = None
    max_severe: float | None = None
    weight_primary: float = 0.7
    weight_secondary: float = 0.3

    def normalised(self, tolerance: float = 0.01) -> "Criteria":
        """Weights that do not add up to one are scaled so that they do."""
        total = self.weight_primary + self.weight_secondary
        if abs(total - 1.0) <= tolerance or total == 0:
            return self
        values = asdict(self)
        values.update(weight_primary=self.weight_primary / total, weight_secondary=self.weight_secondary / total)
        return Criteria(**values)


RESULT_COLUMNS = ("model", "dataset", "test_f1")


def check_results(df: DataFrame) -> DataFrame:
    missing = [c for c in RESULT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"result table lacks columns: {missing}")
    return df


def composite_score(df: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    """Weighted sum of the min-max scaled metrics; a constant metric scales to 1."""
    metrics = [criteria.primary]
    if criteria.secondary and criteria.secondary in df.columns:
        metrics.append(criteria.secondary)
    wide = df.agg(*[F.min(m).alias(f"{m}_lo") for m in metrics], *[F.max(m).alias(f"{m}_hi") for m in metrics])
    ends = Fixed(wide)
    scaled = [minmax(F.col(m), ends.getField(f"{m}_lo"), ends.getField(f"{m}_hi"), flat=1.0) for m in metrics]
    if len(scaled) == 1:
        return df.withColumn("composite_score", scaled[0])
    return df.withColumn("composite_score", criteria.weight_primary * scaled[0] + criteria.weight_secondary * scaled[1])


def filter_results(df: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    if criteria.min_primary is not None:
        df = df.where(F.col(criteria.primary) >= criteria.min_primary)
    if criteria.max_severe is not None and "severe_misclassification_rate" in df.columns:
        df = df.where(F.col("severe_misclassification_rate") <= criteria.max_severe)
    return df


def best_result(df: DataFrame, criteria: Criteria = Criteria(), model: str | None = None, dataset: str | None = None) -> DataFrame:
    """The single best row after all filters, with the number of rows considered; empty if none is left."""
    if model:
        df = df.where(F.col("model") == model)
    if dataset:
        df = df.where(F.col("dataset") == dataset)
    kept = filter_results(df, criteria)
    considered = kept.agg(F.count(F.lit(1)).alias("n")).scalar()
    scored = composite_score(kept, criteria).withColumn("total_models_considered", considered)
    return scored.orderBy(F.desc("composite_score"), "model", "dataset").limit(1)


def top_results(df: DataFrame, k: int = 5, criteria: Criteria = Criteria()) -> DataFrame:
    return composite_score(df, criteria).orderBy(F.desc("composite_score"), "model", "dataset").limit(k)


def best_per_model(df: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    """Best row of every model; an aggregate, so it combines map-side."""
    scored = composite_score(df, criteria)
    rest = [c for c in scored.columns if c != "model"]
    ordered = F.struct((-F.col("composite_score")).alias("_rank"), *["dataset", *[c for c in rest if c != "dataset"]])
    best = scored.groupBy("model").agg(F.min(ordered).alias("b"))
    return best.select(*[F.col(c) if c == "model" else F.col("b")[c].alias(c) for c in scored.columns])


def dataset_impact(df: DataFrame) -> DataFrame:
    """Spread of the metrics per dataset variant, rounded to four digits."""
    r = lambda c, name: F.round(c, 4).alias(name)
    return df.groupBy("dataset").agg(
        r(F.avg("test_f1"), "test_f1_mean"), r(F.stddev_samp("test_f1"), "test_f1_std"),
        r(F.min("test_f1"), "test_f1_min"), r(F.max("test_f1"), "test_f1_max"),
        r(F.avg("luxury_recall"), "luxury_recall_mean"), r(F.stddev_samp("luxury_recall"), "luxury_recall_std"),
        r(F.avg("severe_misclassification_rate"), "severe_mean"), r(F.stddev_samp("severe_misclassification_rate"), "severe_std"),
    )


METRICS = ("test_f1", "val_f1", "test_bal_acc", "luxury_recall", "severe_misclassification_rate", "composite_score")


def selection(df: DataFrame, criteria: Criteria = Criteria(), model: str | None = None, dataset: str | None = None) -> dict:
    """Best row as a dictionary; an ``error`` entry when nothing meets the criteria."""
    rows = best_result(check_results(df), criteria, model, dataset).collect()
    if not rows:
        return {"error": "No models meet the selection criteria", "criteria": asdict(criteria)}
    row = rows[0].asDict()
    return {
        "model_name": row["model"], "dataset_type": row["dataset"], "rank": 1,
        "metrics": {m: float(row.get(m) or 0.0) for m in METRICS},
        "total_models_considered": row["total_models_considered"],
    }


def selection_document(df: DataFrame, criteria: Criteria = Criteria()) -> str:
    """JSON text: best row, criteria, five best rows."""
    return json.dumps({
        "best_model": selection(df, criteria), "selection_criteria": asdict(criteria),
        "top_5_models": [r.asDict() for r in top_results(df, 5, criteria).collect()],
        "timestamp": datetime.now(timezone.utc).isoformat(),
    }, indent=2, default=str)


def selection_report(df: DataFrame, criteria: Criteria = Criteria()) -> str:
    """Plain-text report of the ranking; only the few result rows reach the driver."""
    rule, best = "=" * 72, selection(df, criteria)
    text = [rule, "MODEL SELECTION", rule, f"runs: {df.count()}", ""]
    text += [f"{name}: {value}" for name, value in asdict(criteria).items() if value is not None] + [""]
    if "error" in best:
        text.append(f"ERROR: {best['error']}")
    else:
        text.append(f"best: {best['model_name']} ({best['dataset_type']}), {best['total_models_considered']} considered")
        text += [f"  {name}: {value:.4f}" for name, value in best["metrics"].items()]
    text += ["", "top five"]
    for place, row in enumerate(top_results(df, 5, criteria).collect(), 1):
        text.append(f"  {place}. {row['model']} ({row['dataset']})  F1={row['test_f1']:.4f}  score={row['composite_score']:.4f}")
    text += ["", "best per model"]
    for row in best_per_model(df, criteria).orderBy(F.desc("composite_score"), "model").collect():
        text.append(f"  {row['model']}: {row['dataset']}  F1={row['test_f1']:.4f}  score={row['composite_score']:.4f}")
    text += ["", "per dataset"]
    for row in dataset_impact(df).orderBy("dataset").collect():
        text.append("  " + "  ".join(f"{k}={v}" for k, v in row.asDict().items()))
    return "\n".join([*text, rule])
