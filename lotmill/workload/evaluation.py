"""Classification metrics and ranking of runs (families A41-A45, T1, T10, R, O, F7) on derived predictions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from lotmill.operators import metrics, ranking
from lotmill.workload.listings import PREDICTIONS_CTE, listings, predictions, run_predictions, table, with_listings
from lotmill.plans import train
from lotmill.workload.registry import query

_GRID = "grid AS (SELECT CAST(a.range AS INTEGER) AS y_true, CAST(b.range AS INTEGER) AS y_pred FROM range(3) a, range(3) b)"


def _scores_cte(name: str, source: str, by: str = "") -> str:
    """precision / recall / f1 per class (and group) as a CTE."""
    keys = f"{by}, " if by else ""
    return f"""{name} AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0e0 END AS f1 FROM (
  SELECT {keys}label, CAST(sum(s) AS BIGINT) AS support, sum(h) AS hits, CASE WHEN sum(c) > 0 THEN sum(h) * 1.0e0 / sum(c) ELSE 0.0e0 END AS precision, CASE WHEN sum(s) > 0 THEN sum(h) * 1.0e0 / sum(s) ELSE 0.0e0 END AS recall
  FROM (SELECT {keys}y_true AS label, 1 AS s, 0 AS c, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS h FROM {source} UNION ALL SELECT {keys}y_pred, 0, 1, 0 FROM {source}) GROUP BY {keys}label))"""


_SCORES = _scores_cte("scores", "predictions")


@query("a41_confusion_matrix", with_listings("SELECT g.y_true, g.y_pred, count(p.y_true) AS n FROM grid g LEFT JOIN predictions p ON g.y_true = p.y_true AND g.y_pred = p.y_pred GROUP BY 1, 2", PREDICTIONS_CTE, _GRID))
def a41(spark, sf):
    return metrics.confusion_matrix(predictions(spark, sf), [0, 1, 2])


@query("a41_label_confusion", "SELECT y_true, y_pred, count(*) AS n FROM (SELECT quality AS y_true, toxic AS y_pred FROM labels) GROUP BY 1, 2")
def a41b(spark, sf):
    return metrics.confusion_counts(table(spark, sf, "labels"), "quality", "toxic")


@query("a42_classification_report", with_listings("""SELECT "row", round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM (
 SELECT CAST(label AS VARCHAR) AS "row", precision, recall, f1, support FROM scores
 UNION ALL SELECT 'accuracy', sum(hits) * 1.0e0 / sum(support), sum(hits) * 1.0e0 / sum(support), sum(hits) * 1.0e0 / sum(support), CAST(sum(support) AS BIGINT) FROM scores
 UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM scores
 UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM scores)""", PREDICTIONS_CTE, _SCORES))
def a42(spark, sf):
    out = metrics.classification_report(predictions(spark, sf))
    return out.select("row", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("a43_macro_f1", with_listings("SELECT round(avg(f1), 8) AS macro_f1 FROM scores", PREDICTIONS_CTE, _SCORES))
def a43(spark, sf):
    return metrics.macro_f1(predictions(spark, sf)).select(F.round("macro_f1", 8).alias("macro_f1"))


@query("a44_balanced_accuracy", with_listings("SELECT round(avg(recall) FILTER (support > 0), 8) AS balanced_accuracy FROM scores", PREDICTIONS_CTE, _SCORES))
def a44(spark, sf):
    return metrics.balanced_accuracy(predictions(spark, sf)).select(F.round("balanced_accuracy", 8).alias("balanced_accuracy"))


@query("a45_business_metrics", with_listings("""SELECT round(count(*) FILTER (y_true = 2 AND y_pred = 2) * 1.0e0 / count(*) FILTER (y_true = 2), 8) AS luxury_recall, round(count(*) FILTER ((y_true = 0 AND y_pred = 2) OR (y_true = 2 AND y_pred = 0)) * 1.0e0 / count(*), 8) AS severe_misclassification_rate FROM predictions""", PREDICTIONS_CTE))
def a45(spark, sf):
    out = metrics.business_metrics(predictions(spark, sf))
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])


@query("t1_majority_class", with_listings("SELECT y_true AS label, count(*) AS n FROM predictions GROUP BY 1 ORDER BY n DESC, label LIMIT 1", PREDICTIONS_CTE))
def t1(spark, sf):
    rows = predictions(spark, sf).select(F.col("y_true").alias("label"))
    return rows.where(F.col("label") == train.majority_class(rows)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# ---- a table of runs computed from the predictions -------------------------------------------
# Lines 0-3 of an order count as the validation part of a run, the others as its test part.

_RUN_CTES = [
    PREDICTIONS_CTE,
    'parts AS (SELECT "vehicleType" AS model, "fuelType" AS dataset, CASE WHEN l_linenumber <= 3 THEN \'val\' ELSE \'test\' END AS part, y_true, y_pred FROM predictions WHERE "vehicleType" IS NOT NULL)',
    _scores_cte("part_scores", "parts", "model, dataset, part"),
    """part_results AS (SELECT model, dataset, part, round(avg(f1), 6) AS macro_f1, round(avg(recall) FILTER (support > 0), 6) AS bal, round(coalesce(max(recall) FILTER (label = 2), 0), 6) AS lux FROM part_scores GROUP BY 1, 2, 3)""",
    """severe AS (SELECT model, dataset, part, round(count(*) FILTER ((y_true = 0 AND y_pred = 2) OR (y_true = 2 AND y_pred = 0)) * 1.0e0 / count(*), 6) AS severe_misclassification_rate FROM parts GROUP BY 1, 2, 3)""",
    """runs AS (SELECT t.model, t.dataset, v.macro_f1 AS val_f1, t.macro_f1 AS test_f1, t.bal AS test_bal_acc, t.lux AS luxury_recall, s.severe_misclassification_rate
 FROM part_results t JOIN part_results v ON t.model = v.model AND t.dataset = v.dataset AND t.part = 'test' AND v.part = 'val' JOIN severe s ON s.model = t.model AND s.dataset = t.dataset AND s.part = 'test')""",
]


def runs(spark, sf):
    parts = run_predictions(spark, sf).withColumn("part", F.when(F.col("l_linenumber") <= 3, "val").otherwise("test"))
    # rows per run and part, kept: ranking looks at them several times
    scored = metrics.evaluate(parts, by=["model", "dataset", "part"]).persist(StorageLevel.MEMORY_AND_DISK)
    r = lambda c: F.round(c, 6)
    val = scored.where(F.col("part") == "val").select("model", "dataset", r("macro_f1").alias("val_f1"))
    test = scored.where(F.col("part") == "test").select(
        "model", "dataset", r("macro_f1").alias("test_f1"), r("balanced_accuracy").alias("test_bal_acc"),
        r("luxury_recall").alias("luxury_recall"), r("severe_misclassification_rate").alias("severe_misclassification_rate"))
    return test.join(val, ["model", "dataset"])


_RUN_COLS = "model, dataset, val_f1, test_f1, test_bal_acc, luxury_recall, severe_misclassification_rate"


def _with_runs(body: str, *ctes: str) -> str:
    return with_listings(body, *_RUN_CTES, *ctes)


_SCALED = """((CASE WHEN max({a}) OVER () > min({a}) OVER () THEN ({a} - min({a}) OVER ()) / (max({a}) OVER () - min({a}) OVER ()) ELSE 1.0e0 END) * 0.7e0 + 0.3e0 * (CASE WHEN max({b}) OVER () > min({b}) OVER () THEN ({b} - min({b}) OVER ()) / (max({b}) OVER () - min({b}) OVER ()) ELSE 1.0e0 END))""".format(a="luxury_recall", b="val_f1")
_COMPOSITE = f"composite AS (SELECT *, round({_SCALED}, 6) AS composite_score FROM runs)"


def _composite(df):
    return df.withColumn("composite_score", F.round("composite_score", 6))


@query("t10_run_results", _with_runs(f"SELECT {_RUN_COLS} FROM runs"))
def t10(spark, sf):
    return runs(spark, sf)


@query("f7_threshold_filter", _with_runs(f"SELECT {_RUN_COLS} FROM runs WHERE luxury_recall >= 0.75 AND severe_misclassification_rate <= 0.09"))
def f7(spark, sf):
    return ranking.filter_results(runs(spark, sf), ranking.Criteria(min_primary=0.75, max_severe=0.09))


@query("r1_composite_score", _with_runs("SELECT model, dataset, composite_score FROM composite", _COMPOSITE))
def r1(spark, sf):
    return _composite(ranking.composite_score(runs(spark, sf))).select("model", "dataset", "composite_score")


@query("r2_best_run", _with_runs("SELECT model, dataset, test_f1, composite_score, (SELECT count(*) FROM runs) AS total_models_considered FROM composite ORDER BY composite_score DESC, model, dataset LIMIT 1", f"runs2 AS (SELECT * FROM runs WHERE severe_misclassification_rate <= 0.09)", _COMPOSITE.replace("FROM runs", "FROM runs2")).replace("(SELECT count(*) FROM runs)", "(SELECT count(*) FROM runs2)"))
def r2(spark, sf):
    best = ranking.best_result(runs(spark, sf), ranking.Criteria(max_severe=0.09))
    return _composite(best).select("model", "dataset", "test_f1", "composite_score", "total_models_considered")


@query("o2_top_runs", _with_runs("SELECT model, dataset, composite_score FROM composite ORDER BY composite_score DESC, model, dataset LIMIT 5", _COMPOSITE))
def o2(spark, sf):
    return _composite(ranking.top_results(runs(spark, sf), 5)).select("model", "dataset", "composite_score")


@query("w2_best_per_model", _with_runs("SELECT model, dataset, composite_score FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY composite_score DESC, dataset) AS rn FROM composite) WHERE rn = 1", _COMPOSITE))
def w2(spark, sf):
    return _composite(ranking.best_per_model(runs(spark, sf))).select("model", "dataset", "composite_score")


@query("a23_dataset_impact", _with_runs("""SELECT dataset, round(avg(test_f1), 4) AS test_f1_mean, round(stddev_samp(test_f1), 4) AS test_f1_std, round(min(test_f1), 4) AS test_f1_min, round(max(test_f1), 4) AS test_f1_max, round(avg(luxury_recall), 4) AS luxury_recall_mean, round(stddev_samp(luxury_recall), 4) AS luxury_recall_std, round(avg(severe_misclassification_rate), 4) AS severe_mean, round(stddev_samp(severe_misclassification_rate), 4) AS severe_std FROM runs GROUP BY 1"""))
def a23(spark, sf):
    return ranking.dataset_impact(runs(spark, sf))


@query("o5_top_runs_by_validation", _with_runs("SELECT model, dataset, val_f1 FROM runs ORDER BY val_f1 DESC, model, dataset LIMIT 4"))
def o5(spark, sf):
    return runs(spark, sf).orderBy(F.desc("val_f1"), "model", "dataset").limit(4).select("model", "dataset", "val_f1")
