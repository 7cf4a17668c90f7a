import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotmill.operators import copies, encode, filters, forest, metrics, order_stats, quality, ranking, sampling, selection
from lotmill.operators.smote import nearest_neighbours, smote


@pytest.fixture(scope="module")
def skewed(spark):
    """One value holds a third of the rows; the rest is continuous."""
    rng = random.Random(1)
    values = [75.0] * 400 + [rng.gauss(100, 30) for _ in range(800)]
    return spark.createDataFrame([(v, "hot" if i % 3 else "cold") for i, v in enumerate(values)], "x double, g string")


@pytest.mark.parametrize("rows_per_bucket", [10_000, 50])
def test_quantiles_match_pandas(skewed, rows_per_bucket):
    got = order_stats.quantiles(skewed, ["x"], rows_per_bucket=rows_per_bucket).first()
    series = skewed.toPandas()["x"]
    assert [got["q1"], got["median"], got["q3"]] == pytest.approx(series.quantile([0.25, 0.5, 0.75]).tolist())
    assert got["mode"] == 75.0


def test_grouped_quantiles_and_ranks_over_buckets(skewed):
    pdf = skewed.toPandas()
    got = {r["g"]: r["median"] for r in order_stats.quantiles(skewed, ["x"], by=["g"], rows_per_bucket=50).collect()}
    assert got == pytest.approx(pdf.groupby("g")["x"].median().to_dict())
    ranks = {r["value"]: r["rank"] for r in order_stats.average_ranks(skewed, ["x"], rows_per_bucket=50).collect()}
    assert ranks == pytest.approx(dict(zip(pdf["x"], pdf["x"].rank())))


def test_spearman_matches_pandas(spark):
    rng = random.Random(2)
    rows = [(float(a), float(a + rng.randint(0, 6)), rng.random()) for a in (rng.randint(0, 9) for _ in range(300))]
    pdf = pd.DataFrame(rows, columns=["a", "b", "c"])
    df = spark.createDataFrame(rows, "a double, b double, c double")
    expected = pdf.rank().corr()
    for r in quality.spearman_matrix(df, ["a", "b", "c"], rows_per_bucket=40).collect():
        assert r["r"] == pytest.approx(expected.loc[r["col_a"], r["col_b"]], abs=1e-4)


def test_copies_are_counted_flagged_and_unfolded_in_chunks(spark):
    df = spark.createDataFrame([("a", None)] * 25 + [("b", 1)] * 2 + [("c", 2)], "k string, v int")
    assert copies.drop_copies(df).count() == 3
    numbered = copies.number_copies(df, chunk=4)
    assert sorted(r["copy_no"] for r in numbered.where("k = 'a'").collect()) == list(range(25))
    assert Counter(r["is_copy"] for r in copies.copy_flags(df).collect()) == {True: 25, False: 3}
    assert copies.copied_rows(df).count() == 27
    assert copies.uniqueness(df).first().asDict() == {"rows": 28, "duplicate_rows": 25, "duplicate_rows_pct": 89.2857, "uniqueness_score_pct": 10.71}


def test_stratified_split_is_exact_even_with_copies(spark):
    rows = [(i % 3, 7) for i in range(90)] + [(2, i) for i in range(10)]
    df = spark.createDataFrame(rows, "label int, v int")
    got = sampling.stratified_split(df, "label").groupBy("label", "split").count().collect()
    sizes = Counter()
    for r in got:
        sizes[r["split"]] += r["count"]
    assert sizes == {"test": 20, "val": 20, "train": 60}
    assert {r["count"] for r in sampling.undersample(df, "label").groupBy("label").count().collect()} == {30}
    assert sampling.sample_rows(df, 17).count() == 17


def test_checks_on_edge_cases(spark):
    empty = spark.createDataFrame([(None, None)] * 3, "price double, power double")
    row = {r["column"]: r for r in quality.zscore_outliers(empty).collect()}
    assert row == {}
    assert quality.iqr_outliers(empty).collect() == []
    assert quality.completeness_score(empty).first()[0] == 0.0
    flat = spark.createDataFrame([(5.0,)] * 4 + [(100.0,)], "price double")
    assert quality.iqr_outliers(flat).first()["outlier_count"] == 1
    bounds = spark.createDataFrame([(500.0,), (5_000_000.0,), (499.0,)], "price double")
    got = quality.range_checks(bounds).first()
    assert (got["below_min"], got["above_max"]) == (1, 0)


@pytest.mark.parametrize("nulls,failed", [(10, True), (2, False)])
def test_completeness_threshold(spark, nulls, failed):
    df = spark.createDataFrame([(None if i < nulls else 1.0,) for i in range(100)], "price double")
    assert quality.completeness(df).first()["failed"] is failed


def test_cap_uses_domain_minimum_and_upper_fence(spark):
    df = spark.createDataFrame([(1.0, 1800), (100.0, 2000), (110.0, 2001), (120.0, 2002), (9999.0, None)], "power double, yearOfRegistration int")
    rows = filters.cap_outliers(df, ["power", "yearOfRegistration"]).collect()
    assert min(r["power"] for r in rows) == 5.0 and max(r["power"] for r in rows) == 150.0
    assert [r["yearOfRegistration"] for r in rows].count(None) == 1


def test_isolation_forest_flags_the_contamination_share(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(400, 2))] + [(50.0, 50.0)], "a double, b double")
    got = forest.isolation_forest(df, ["a", "b"], trees=20).first()
    assert got["rows"] == 401 and 35 <= got["outlier_count"] <= 49
    assert forest.isolation_forest(df.limit(5), ["a", "b"]).first()["outlier_count"] is None


def test_metrics(spark):
    df = spark.createDataFrame(list(zip([0, 0, 2, 2], [2, 0, 0, 2])), "y_true int, y_pred int")
    got = metrics.evaluate(df).first()
    assert got["severe_misclassification_rate"] == 0.5 and got["luxury_recall"] == 0.5 and got["macro_f1"] == pytest.approx(0.5)


def test_frequency_and_features(spark, tmp_path):
    df = spark.createDataFrame([("bmw",), ("bmw",), ("audi",), ("audi",), ("audi",)], "brand string")
    model = encode.FrequencyEncoder(cols=["brand", "model"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = encode.FrequencyEncoderModel.load(str(tmp_path / "m"))
    rows = again.transform(spark.createDataFrame([("bmw",), ("fiat",)], "brand string")).collect()
    assert {(r["brand"], r["brand_freq"], r["model_freq"]) for r in rows} == {("bmw", 0.4, 0.0), ("fiat", 0.0, 0.0)}
    made = encode.ListingFeatures(currentYear=2024).transform(
        spark.createDataFrame([(2020, 50_000.0, 99.0)], "yearOfRegistration int, kilometer double, power double")).first()
    assert (made["vehicleAge"], made["kmPerYear"], made["km_power_ratio"]) == (4, 10_000.0, 500.0)


def test_feature_selection(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    rows = [(*map(float, r), 1.0, int(r[0] + r[1] > 0)) for r in x]
    df = spark.createDataFrame(rows, "f1 double, f2 double, f3 double, constant double, label int")
    names = ["f1", "f2", "f3", "constant"]
    assert "constant" not in selection.FeatureSelector("variance").fit(df, names).selected
    assert set(selection.FeatureSelector("k_best", k=2).fit(df, names).selected) == {"f1", "f2"}
    assert set(selection.FeatureSelector("mutual_info", k=2).fit(df, names).selected) == {"f1", "f2"}
    assert "constant" not in selection.FeatureSelector("correlation").fit(df, names).selected
    flat = quality.pearson_matrix(df.select("f1", "constant"), ["f1", "constant"]).where("col_b = 'constant'").collect()
    assert [r["r"] for r in flat] == [None, None]
    with pytest.raises(ValueError):
        selection.FeatureSelector("nope").fit(df, names)


RUNS = [("boost", "none", 0.9, 0.91, 0.92, 0.01), ("boost", "smote", 0.88, 0.9, 0.9, 0.03), ("boost", "under", 0.85, 0.86, 0.95, 0.05),
        ("forest", "none", 0.84, 0.85, 0.8, 0.04), ("forest", "smote", 0.8, 0.81, 0.82, 0.06), ("base", "none", 0.33, 0.33, 0.0, 0.2)]


def test_ranking(spark):
    df = spark.createDataFrame(RUNS, "model string, dataset string, test_f1 double, val_f1 double, luxury_recall double, severe_misclassification_rate double")
    best = ranking.selection(df, ranking.Criteria(max_severe=0.04))
    assert (best["model_name"], best["dataset_type"], best["total_models_considered"]) == ("boost", "none", 3)
    assert "error" in ranking.selection(df, ranking.Criteria(min_primary=0.99))
    assert ranking.best_per_model(df).count() == 3
    assert ranking.Criteria(weight_primary=2, weight_secondary=2).normalised().weight_primary == 0.5
    assert "best per model" in ranking.selection_report(df)
    with pytest.raises(ValueError):
        ranking.selection(df.drop("test_f1"))


def test_nearest_neighbours_match_brute_force_across_blocks(spark):
    x = np.random.default_rng(0).normal(size=(40, 2))
    x[:14, 0] = 0.5  # a third of the rows share one value of an axis
    points = spark.createDataFrame([(str(i), [float(v) for v in r], 1) for i, r in enumerate(x)], "id string, x array<double>, n long")
    for r in nearest_neighbours(points, 3, block=10).collect():
        dist = np.sqrt(((x - x[int(r["id"])]) ** 2).sum(axis=1))
        dist[int(r["id"])] = np.inf
        assert [c["d"] for c in r["near"]] == pytest.approx(sorted(dist)[:3])


def test_smote_balances_inside_the_class_range(spark):
    rows = [(float(i), 0.0, 0) for i in range(12)] + [(100.0 + i, 1.0, 1) for i in range(4)] + [(100.0, 1.0, 1)]
    out = smote(spark.createDataFrame(rows, "a double, b double, label int"), ["a", "b"], "label", k=2).toPandas()
    assert out["label"].value_counts().to_dict() == {0: 12, 1: 12}
    assert out[out["label"] == 1]["a"].between(100, 103).all()


def test_rows_without_a_label_belong_to_no_class(spark):
    from lotmill.operators import sampling

    df = spark.createDataFrame([(i, "a") for i in range(20)] + [(i, "b") for i in range(30)] + [(i, None) for i in range(3)], "x int, y string")
    assert {r["y"]: r["count"] for r in sampling.undersample(df, "y").groupBy("y").count().collect()} == {"a": 20, "b": 20}
    assert sampling.stratified_split(df, "y").count() == sampling.class_ranks(df, "y").count() == 50


def test_nan_is_missing_and_text_features_score_zero(spark):
    from lotmill.operators import quality, selection

    df = spark.createDataFrame([(float("nan"), "x", 0), (1.0, "y", 1), (600.0, "z", 1), (None, None, 0)], "power double, t string, label int")
    assert {r["column"]: r["missing_count"] for r in quality.completeness(df).collect()}["power"] == 2
    assert quality.completeness_score(df.select("power")).first()[0] == 50.0
    assert quality.range_checks(df, {"power": (0, 500)}).first()["values"] == 2
    assert {r["feature"]: r["score"] for r in selection.correlation_scores(df, ["power", "t"], "label").collect()}["t"] == 0.0


def test_isolation_trees_do_not_depend_on_partitions(spark):
    from lotmill.operators import forest

    df = spark.createDataFrame([(float(i % 97), float(i % 31)) for i in range(3000)], "a double, b double")
    one, two = (forest.fit_trees(df.repartition(n), ["a", "b"], 3000, trees=5) for n in (2, 4))
    assert [r["threshold"] for r in one] == [r["threshold"] for r in two]


def test_isolation_trees_draw_rows_and_not_contents(spark):
    """Every tree sees a content that a third of the rows have, and few contents still grow all trees."""
    from lotmill.operators import forest

    hot = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 1000.0D ELSE CAST(id AS double) / 60000 END AS a", "CAST(id % 3 AS double) AS b")
    trees = forest.fit_trees(hot, ["a", "b"], 60_000, trees=20)
    assert len(trees) == 20 and all(any(f == 0 and t > 1.0 or f == 1 and t < 1.0 for f, t in zip(r["feature"], r["threshold"])) for r in trees)
    few = spark.range(200_000).selectExpr("CAST(id % 20 AS double) AS a", "CAST(id % 4 AS double) AS b")
    trees = forest.fit_trees(few, ["a", "b"], 200_000, trees=20)
    assert [r["tree"] for r in trees] == list(range(20)) and all(max(r["feature"]) >= 0 for r in trees)


def test_exact_kolmogorov_distribution(spark):
    from lotmill.operators.quality import exact_ks_p_value, exact_ks_p_values, ks_p_value

    assert exact_ks_p_value(0.274, 10) == pytest.approx(1 - 0.6284796154565043, abs=1e-12)  # table of Marsaglia, Tsang and Wang
    for n in (1, 2, 5, 20):
        for d in np.linspace(max(1 - 1 / n, 0.5) + 1e-9, 0.999, 7):  # here only one of the two sides can be that far
            assert exact_ks_p_value(float(d), n) == pytest.approx(2 * (1 - d) ** n, abs=1e-9)
        for d in np.linspace(0.5 / n + 1e-6, 1 / n, 5):
            assert exact_ks_p_value(float(d), n) == pytest.approx(1 - math.factorial(n) * (2 * d - 1 / n) ** n, abs=1e-9)
    assert exact_ks_p_value(0.0, 5) == 1.0 and exact_ks_p_value(1.0, 5) == 0.0 and exact_ks_p_value(0.9, 100) == 0.0
    assert exact_ks_p_value(0.0001, 10_000) == 1.0
    rows = spark.createDataFrame([(0.0136, 10_000), (0.274, 10), (None, 4)], "d double, n long")
    found = rows.select(exact_ks_p_values()("d", "n").alias("exact"), ks_p_value(F.col("d"), F.col("n")).alias("series")).collect()
    assert found[0]["exact"] == pytest.approx(found[0]["series"], abs=2e-4) and found[1]["exact"] == pytest.approx(0.3715203845, abs=1e-9)
    assert found[2]["exact"] is None


def test_isolation_forest_computes_its_rows_once(spark):
    """Counting, drawing and scoring read one table; more rows than a sample, so that most rows enter no tree."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    noted = counted.asNondeterministic()  # so that filters do not run it a second time
    df = spark.range(0, 5_000, 1, 3).select(noted((F.col("id") * 37 % 1009).cast("double")).alias("a"), (F.col("id") * 11 % 97).cast("double").alias("b"))
    got = forest.isolation_forest(df, ["a", "b"], trees=20).first()
    assert got["rows"] == 5_000 and seen.value == 5_000
    drawn = forest.fit_trees(spark.range(0, 40_000).select(F.col("id").cast("double").alias("a")), ["a"], 40_000, trees=30)
    assert [r["tree"] for r in drawn] == list(range(30)) and all(r["feature"][0] == 0 for r in drawn)
