"""Outlier forest, classifiers, importances and scoring (families A9, L1, O3, T) and file round trips (S, K)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions.numeric import tier_code
from lotmill.functions.text import display_name
from lotmill.operators import encode, forest, selection
from lotmill.operators.encode import feature_columns
from lotmill.plans import score, train
from lotmill.session import shared_dir, written
from lotmill.sources import tables
from lotmill.workload.listings import KEYS, LISTING, complete, listings, with_listings
from lotmill.workload.registry import query

YEAR = 2026


def complete_listings(spark, sf):
    """Training input. In production this is the written result of ``plans.clean.clean_table``."""
    return complete(listings(spark, sf))


def scratch(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder; a temporary one only in local mode, where all tasks share the machine."""
    master = spark.sparkContext.master
    fallback = tempfile.gettempdir() if master == "local" or master.startswith("local[") else None
    return f"{shared_dir(spark, fallback)}/lotmill-{name}-{uuid.uuid4().hex}"


@query("a9_isolation_forest", with_listings("SELECT count(*) AS rows, true AS share_as_set, true AS percentages_agree FROM listings"))
def a9(spark, sf):
    """Properties of the report row: the flagged share is the contamination (less only by ties of the score at the cut)."""
    found = forest.isolation_forest(listings(spark, sf, "price", "power", "kilometer", "yearOfRegistration"))
    share = F.col("outlier_count") / F.col("rows")
    return found.select("rows", share.between(0.115, 0.1201).alias("share_as_set"),
                        ((F.abs(share * 100 - F.col("outlier_pct")) < 1e-4) & (F.abs(100 - F.col("outlier_pct") - F.col("quality_score_pct")) < 0.01)).alias("percentages_agree"))


def expensive(spark, sf, *features):
    rows = listings(spark, sf, *features, "price")
    return rows.withColumn("label", (F.col("price") >= 15000).cast("int")).drop("price")


def importances_of_expensive(spark, sf):
    rows = expensive(spark, sf, "power", "kilometer", "yearOfRegistration")
    return selection.importance_scores(rows, feature_columns(rows), "label", rounds=3, depth=3)


_STUMP_FEATURES = ["power", "l_linenumber", "yearOfRegistration"]
# one round of one split per class at equal chances: gradients 1/2 - y or y - 1/2, curvature 1/2, both classes alike
_STUMP = f"""SELECT feature, CASE WHEN feature = first THEN 1.0e0 ELSE 0.0e0 END AS score, CASE WHEN feature = first THEN round(2 * best, 3) ELSE 0.0e0 END AS total_gain, CAST(CASE WHEN feature = first THEN 2 ELSE 0 END AS BIGINT) AS splits
FROM (SELECT feature, max(gain) AS best, first_value(feature) OVER (ORDER BY max(gain) DESC) AS first FROM (
 SELECT feature, v, gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1) AS gain FROM (
  SELECT feature, v, sum(g) OVER (PARTITION BY feature ORDER BY v) AS gl, sum(h) OVER (PARTITION BY feature ORDER BY v) AS hl, sum(g) OVER (PARTITION BY feature) AS ga, sum(h) OVER (PARTITION BY feature) AS ha FROM (
   SELECT feature, v, sum(CASE WHEN price >= 15000 THEN -0.5e0 ELSE 0.5e0 END) AS g, sum(0.5e0) AS h FROM (
    {' UNION ALL '.join(f"""SELECT '{c}' AS feature, "{c}" AS v, price FROM listings""" for c in _STUMP_FEATURES)}) GROUP BY 1, 2)) WHERE hl >= 1 AND ha - hl >= 1) GROUP BY feature)"""


@query("l1_gain_importance", with_listings(_STUMP))
def l1_gain(spark, sf):
    """Gains of boosted trees of one split: SQL tries every cut of every feature."""
    rows = expensive(spark, sf, *_STUMP_FEATURES)
    return selection.importance_scores(rows, _STUMP_FEATURES, "label", rounds=1, depth=1).withColumn("total_gain", F.round("total_gain", 3))


def importance_properties(table):
    """Feature set, range and sum of importances; the window holds one row per feature."""
    return table.select("feature", F.col("score").between(0, 1).alias("in_range"), F.round(F.sum("score").over(W.partitionBy()), 6).alias("total"))


@query("l1_tree_importance", "SELECT unnest(['kilometer', 'power', 'yearOfRegistration']) AS feature, true AS in_range, 1.0e0 AS total")
def l1(spark, sf):
    return importance_properties(importances_of_expensive(spark, sf))


@query("o3_top_importances", "SELECT unnest([1, 2]) AS place, true AS named, true AS in_order")
def o3(spark, sf):
    """The two most important features in order, under their display names.

    The label of the driver tables is nearly independent of every feature, so SQL can prove the order but not the names.
    """
    top = importances_of_expensive(spark, sf).orderBy(F.desc("score"), "feature").limit(2)
    order = W.partitionBy().orderBy(F.desc("score"), "feature")  # two rows
    placed = top.select(display_name("feature").alias("shown"), "score", F.row_number().over(order).alias("place"), F.lag("score").over(order).alias("before"))
    names = [rules.DISPLAY_NAMES[c] for c in ("power", "kilometer", "yearOfRegistration")]
    return placed.select("place", F.col("shown").isin(names).alias("named"), F.coalesce(F.col("score") <= F.col("before"), F.lit(True)).alias("in_order"))


def rule_tier(year="yearOfRegistration", gearbox="gearbox"):
    """A tier that two features decide, so that what a model has to learn is known."""
    return F.when(F.col(year) >= 2000, "luxury").when(F.col(gearbox) == "manuell", "budget").otherwise("mid-range")


_RULE_TIER = """CASE WHEN "yearOfRegistration" >= 2000 THEN 2 WHEN gearbox = 'manuell' THEN 0 ELSE 1 END"""


def rule_listings(spark, sf, *extra):
    """Complete listings whose tier follows the rule."""
    return complete(listings(spark, sf, *extra, *LISTING)).withColumn("price_tier", rule_tier())


def _small(name: str, tries: int = 1, **grid) -> train.Config:
    known = train.model_configs()[name]
    return train.Config(known.make, grid, tries, known.scale, known.fill)


SMALL = {
    "random_forest": _small("random_forest", trees=[20], depth=[6], min_split=[2]),
    "extra_trees": _small("extra_trees", trees=[20], depth=[12], min_split=[2]),
    "log_reg": _small("log_reg", C=[1.0]),
    "decision_tree": _small("decision_tree", depth=[6], min_split=[2], min_leaf=[1], criterion=["gini"], max_features=[None]),
    "linear_svm": _small("linear_svm", C=[1.0], loss=["squared_hinge"]),
    "boosted_trees": _small("boosted_trees", rounds=[3], depth=[3], rate=[0.3], subsample=[1.0]),
}
#: Least macro F1 on the test part under the known rule; trees that see all features find it exactly.
LEAST_F1 = {"random_forest": 0.95, "extra_trees": 0.95, "log_reg": 0.95, "decision_tree": 1.0, "linear_svm": 0.95, "boosted_trees": 1.0}


_PARTS = """(SELECT n, n_test, CAST(ceil(0.25e0 * (n - n_test)) AS BIGINT) AS n_val FROM (SELECT n, CAST(ceil(0.2e0 * n) AS BIGINT) AS n_test FROM (SELECT count(*) AS n FROM listings WHERE "vehicleType" IS NOT NULL)))"""


def _run(name: str):
    def run(spark, sf):
        """Part sizes, and whether the model finds the rule on the test part as well as stated."""
        prepared = train.prepare(rule_listings(spark, sf), YEAR)
        result, _ = train.train_one(name, "none", prepared.part("train"), prepared.part("val"), prepared.part("test"), prepared.features, SMALL[name])
        base, _ = train.train_one("baseline", "none", prepared.part("train"), prepared.part("val"), prepared.part("test"), prepared.features)
        sizes = prepared.data.groupBy("split").count().groupBy().pivot("split", ["train", "val", "test"]).agg(F.first("count"))
        in_range = all(0 <= result[k] <= 1 for k in ("val_f1", "test_f1", "severe_misclassification_rate"))
        return sizes.select(F.lit(result["model"]).alias("model"), F.lit(result["dataset"]).alias("dataset"), *[F.col(p).alias(f"n_{p}") for p in ("train", "val", "test")],
                            F.lit(result["test_f1"] > base["test_f1"]).alias("beats_majority"), F.lit(in_range).alias("scores_in_range"),
                            F.lit(LEAST_F1[name]).alias("least_f1"), F.lit(result["test_f1"] >= LEAST_F1[name]).alias("reaches_least_f1"))
    return run


for _number, _name in enumerate(SMALL, 2):
    query(f"t{_number}_{_name}", with_listings(f"SELECT '{_name}' AS model, 'none' AS dataset, n - n_test - n_val AS n_train, n_val, n_test, true AS beats_majority, true AS scores_in_range, {LEAST_F1[_name]}e0 AS least_f1, true AS reaches_least_f1 FROM {_PARTS}"))(_run(_name))


_PREDICTED = with_listings(f"""SELECT CAST({_RULE_TIER} AS INTEGER) AS label, CAST({_RULE_TIER} AS DOUBLE) AS prediction, count(*) AS n FROM listings WHERE "vehicleType" IS NOT NULL GROUP BY 1, 2""")


@query("t5_exact_predictions", _PREDICTED)
def t5_exact(spark, sf):
    """Predictions of a tree of two levels over the features that decide the tier, for every row."""
    return _exact(spark, sf, _small("decision_tree"), {"depth": 2, "min_split": 2, "min_leaf": 1, "criterion": "gini", "max_features": None})


@query("t7_exact_predictions", _PREDICTED)
def t7_exact(spark, sf):
    """The same of boosted trees."""
    return _exact(spark, sf, _small("boosted_trees"), {"rounds": 2, "depth": 2, "rate": 0.3, "subsample": 1.0})


def _rule_rows(spark, sf, *extra):
    rows = rule_listings(spark, sf, *extra)
    return rows.select(*extra, "power", "yearOfRegistration", (F.col("gearbox") == "manuell").cast("int").alias("manual"), tier_code("price_tier").alias("label"))


def _exact(spark, sf, config, params):
    features, rows = ["power", "yearOfRegistration", "manual"], written(_rule_rows(spark, sf), "rule-rows")  # fitted, then scored
    model = train.assembled(features, config.make(params, 1), config.scale, config.fill).fit(rows)
    return model.transform(rows).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("cross_validated_predictions", with_listings(f"""SELECT label, CAST(label AS DOUBLE) AS prediction, CAST((rn - 1) % 5 AS INTEGER) AS fold, count(*) AS n FROM (
 SELECT label, row_number() OVER (PARTITION BY label) AS rn FROM (SELECT CAST({_RULE_TIER} AS INTEGER) AS label FROM listings WHERE "vehicleType" IS NOT NULL)) GROUP BY 1, 2, 3"""))
def cross_validated(spark, sf):
    """Five stratified folds: every row scored once by a model that did not see it; the rule is found in every fold."""
    params = {"depth": 2, "min_split": 2, "min_leaf": 1, "criterion": "gini", "max_features": None}
    found = train.cross_validate(_rule_rows(spark, sf, *KEYS), ["power", "yearOfRegistration", "manual"], _small("decision_tree"), params)
    return found.groupBy("label", "prediction", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("t9_training_grid", """SELECT unnest(['decision_tree', 'decision_tree', 'log_reg', 'log_reg']) AS model, unnest(['none', 'undersample', 'none', 'undersample']) AS dataset,
 CAST(3 AS BIGINT) AS n_points, true AS best_validation_won, true AS logged_once, true AS model_saved""")
def t9(spark, sf):
    """Two models on two variants with three points each: the winner has the best validation score, and the log one row a run."""
    log, rows = scratch(spark, "log"), rule_listings(spark, sf)
    configs = {"decision_tree": _small("decision_tree", 3, depth=[1, 2, 3], min_split=[2], min_leaf=[1], criterion=["gini"], max_features=[None]), "log_reg": _small("log_reg", 3, C=[0.01, 0.1, 1.0])}
    attempts = []
    results = train.train_all(rows, YEAR, list(configs), ("none", "undersample"), configs, log_path=log, attempts=attempts)
    tried = spark.createDataFrame(attempts, "model string, dataset string, params map<string,string>, tried_f1 double").groupBy("model", "dataset").agg(
        F.count(F.lit(1)).alias("n_points"), F.max("tried_f1").alias("top"), F.max_by(F.map_entries("params"), "tried_f1").alias("top_params"))
    logged = tables.read_table(spark, f"{log}/runs").groupBy("model", "dataset").agg(F.count(F.lit(1)).alias("n_logged"), F.max(F.col("metrics")["val_f1"]).alias("logged_f1"))
    out = results.join(tried, ["model", "dataset"]).join(logged, ["model", "dataset"])
    exists = {(m, d): tables.path_exists(spark, f"{log}/models/{m}_{d}") for m in configs for d in ("none", "undersample")}
    there = F.concat_ws("/", "model", "dataset").isin([f"{m}/{d}" for (m, d), found in exists.items() if found])
    return out.select("model", "dataset", "n_points", (F.col("val_f1") == F.col("top")).alias("best_validation_won"),
                      ((F.col("n_logged") == 1) & (F.col("logged_f1") == F.col("val_f1"))).alias("logged_once"), there.alias("model_saved"))


def _saved(spark, sf):
    """A shallow tree with its feature stages: as fitted, and the folder it was saved in."""
    rows = complete_listings(spark, sf)
    prepared = train.prepare(rows, YEAR)
    _, model = train.train_one("decision_tree", "none", prepared.part("train"), prepared.part("val"), prepared.part("test"), prepared.features, SMALL["decision_tree"])
    path = scratch(spark, "model")
    whole = PipelineModel(stages=[*prepared.stages.stages, *model.stages])
    whole.write().overwrite().save(path)
    return whole, path


def _with_gaps(spark, sf):
    """All listings, with and without a vehicle type; every seventh order lacks the power."""
    rows = listings(spark, sf, *KEYS[:1], *LISTING)
    return rows.withColumn("power", F.when(F.col("l_orderkey") % 7 != 0, F.col("power"))).drop("l_orderkey", "price", "price_tier")


@query("t11_batch_scores", with_listings("SELECT count(*) AS n_rows, count(*) AS n_listed_tiers, count(*) AS n_same_as_in_memory, count(*) FILTER (l_orderkey % 7 = 0) AS n_without_power FROM listings"))
def t11(spark, sf):
    """The model as saved and loaded gives every row, nulls included, the tier of the model in memory."""
    whole, path = _saved(spark, sf)
    first = score.predict(_with_gaps(spark, sf), whole).withColumnsRenamed({"predicted_tier": "first_tier", "confidence": "first_confidence"})
    both = score.predict(first, score.load_model(spark, path))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("predicted_tier").isin(*rules.TIERS)).alias("n_listed_tiers"),
                    F.count_if((F.col("predicted_tier") == F.col("first_tier")) & F.col("confidence").eqNullSafe(F.col("first_confidence"))).alias("n_same_as_in_memory"),
                    F.count_if(F.col("power").isNull()).alias("n_without_power"))


@query("t12_table_scores", with_listings("SELECT count(*) AS n_rows, count(*) AS n_sum_to_one, count(*) AS n_tier_of_largest FROM listings"))
def t12(spark, sf):
    """Table-to-table scoring, and the probabilities behind each tier."""
    _, path = _saved(spark, sf)
    rows, source = _with_gaps(spark, sf), scratch(spark, "in")
    tables.write_table(rows, source, "parquet")
    scored = score.predict_table(spark, source, path, scratch(spark, "out"))
    chances = score.predict(scored.drop("predicted_tier", "confidence"), score.load_model(spark, path), with_probabilities=True)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    largest = F.element_at(F.array(*[F.lit(t) for t in rules.TIERS]), F.array_position("probabilities", F.array_max("probabilities")).cast("int"))
    return chances.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_to_one"), F.count_if(F.col("predicted_tier") == largest).alias("n_tier_of_largest"))


@query("s1_k1_csv_round_trip", with_listings(f"""SELECT {', '.join(KEYS)}, brand, "vehicleType", price FROM listings"""))
def s1(spark, sf):
    path = scratch(spark, "csv")
    tables.write_table(listings(spark, sf, *KEYS, "brand", "vehicleType", "price"), path, "csv")
    back = tables.read_csv(spark, path)
    return back.select(*[F.col(k).cast("int" if k == "l_linenumber" else "long").alias(k) for k in KEYS], "brand", "vehicleType", F.col("price").cast("double").alias("price"))


@query("s1_inferred_types", with_listings("""SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, brand, gearbox, price, CAST(kilometer AS DOUBLE) / 8 AS eighths, l_linenumber > 3 AS late,
 CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_linenumber * 10 AS BIGINT) END AS gaps, CASE WHEN l_linenumber = 1 THEN 'none given' ELSE CAST(l_linenumber AS VARCHAR) END AS mixed, CASE WHEN l_linenumber = 7 THEN 0.5e0 ELSE l_linenumber END AS half, CAST(NULL AS DOUBLE) AS nothing FROM listings"""))
def s1_types(spark, sf):
    """Listings written as text and read back with types found from all values."""
    path, no = scratch(spark, "typed"), F.col("l_linenumber")
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "l_linenumber", "brand", "gearbox", "price", "kilometer")
    made = {
        "eighths": F.col("kilometer").cast("double") / 8, "late": no > 3, "gaps": F.when(no == 2, "N/A").otherwise((no * 10).cast("string")),
        "mixed": F.when(no == 1, "none given").otherwise(no.cast("string")),
        "half": F.when(no == 7, "0.5").otherwise(no.cast("string")), "nothing": F.lit("NULL"),
    }
    tables.write_table(rows.withColumns(made).drop("kilometer"), path, "csv")
    return tables.read_typed_csv(spark, path)


@query("k5_split_export", with_listings("SELECT split, count(*) AS n FROM (SELECT CASE WHEN l_linenumber <= 1 THEN 'test' WHEN l_linenumber = 2 THEN 'val' ELSE 'train' END AS split FROM listings) GROUP BY 1"))
def k5(spark, sf):
    path = scratch(spark, "split")
    split = F.when(F.col("l_linenumber") <= 1, "test").when(F.col("l_linenumber") == 2, "val").otherwise("train")
    tables.export_split(listings(spark, sf, "l_linenumber", "price", "price_tier").withColumn("split", split), path)
    return tables.read_table(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_NUMBERS = ["power", "kilometer", "vehicleAge", "kmPerYear", "km_power_ratio", "log_km", "brand_freq", "model_freq"]
_ENCODED = f"SELECT unnest({_NUMBERS}) AS feature" + "".join(f""" UNION ALL SELECT '{c}_' || v FROM (SELECT DISTINCT "{c}" AS v FROM whole) WHERE v > (SELECT min("{c}") FROM whole)""" for c in encode.CATEGORIES)


@query("t14_importances_of_a_run", with_listings(f"SELECT feature, true AS in_range, 1.0e0 AS total FROM ({_ENCODED})", 'whole AS (SELECT * FROM listings WHERE "vehicleType" IS NOT NULL)'))
def t14(spark, sf):
    prepared = train.prepare(complete_listings(spark, sf), YEAR)
    numbers = prepared.part("train").select(*[F.col(f"`{c}`").cast("double").alias(c) for c in prepared.features], "label").na.fill(0.0)
    model = train.assembled(prepared.features, SMALL["random_forest"].make({"trees": 10, "depth": 5, "min_split": 2}, 1)).fit(numbers)
    return importance_properties(selection.importance_table(spark, model.stages[-1], prepared.features))


