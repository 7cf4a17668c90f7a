"""Preprocessing with gaps, overview tables, and the report sinks."""

import json

import pytest
from pyspark.sql import functions as F

from lotmill.operators.encode import Preprocessor
from lotmill.operators.profile import eda_tables
from lotmill.operators.ranking import Criteria, selection_document
from lotmill.operators.selection import FeatureSelector
from lotmill.plans import score
from lotmill.sources.tables import read_csv, read_lookup, read_table


def test_preprocessor(spark):
    df = spark.createDataFrame(
        [(1.0, "b", 5, 1), (3.0, "a", 5, 2), (None, None, 5, 3), (float("nan"), "b", None, 4), (8.0, "a", 5, 5)], "x double, `k.k` string, c int, id int")
    fitted = Preprocessor(["x", "c"], ["k.k"]).fit(df)
    rows = [tuple(r) for r in fitted.transform(df).orderBy("id").select("`k.k`", "levels", "c", F.round("x", 6)).collect()]
    filled = [1.0, 3.0, 3.0, 3.0, 8.0]
    mean = sum(filled) / 5
    scale = (sum((v - mean) ** 2 for v in filled) / 5) ** 0.5
    assert rows == [(k, [0 if k == "a" else 1], 0.0, round((v - mean) / scale, 6)) for k, v in zip("baaba", filled)]  # tie of modes: the smallest
    assert fitted.level_names() == ["k.k_a", "k.k_b"]
    new = spark.createDataFrame([(None, "z", 7, 1), (1.0, None, None, 2)], df.schema)
    assert [r["levels"] for r in fitted.transform(new).orderBy("id").collect()] == [[], [0]]


def test_preprocessor_without_values(spark):
    df = spark.createDataFrame([(None, None)], "x double, k string")
    fitted = Preprocessor(["x"], ["k"]).fit(df)
    assert [tuple(r) for r in fitted.transform(df).collect()] == [(None, None, [])]
    assert fitted.transform(df.limit(0)).count() == 0


def test_overview_tables(spark):
    df = spark.createDataFrame([(float(i), "budget" if i < 30 else "luxury", float(i * 2)) for i in range(40)] + [(None, "budget", 1.0)],
                               "price double, price_tier string, kilometer double")
    tables = eda_tables(df, bins=4, sample=7)
    assert [r["n"] for r in tables["histogram"].orderBy("bin").collect()] == [10, 10, 10, 10]
    assert {r["price_tier"]: r["n"] for r in tables["tiers"].collect()} == {"budget": 31, "luxury": 10}
    assert tables["scatter"].count() == 7 and eda_tables(df, sample=100)["scatter"].count() == 40


def test_feature_reports(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i % 3), i % 2) for i in range(40)], "a double, b double, label int")
    selector = FeatureSelector("variance").fit(df, ["a", "b"])
    selector.save(spark, str(tmp_path / "features"))
    report = (tmp_path / "features.txt").read_text()
    assert "strategy=variance" in report and report.index(" a ") < report.index(" b ")
    assert (tmp_path / "features_features.txt").read_text().splitlines()[-2:] == ["a", "b"]
    assert FeatureSelector().report() == "not fitted"


def test_selection_document_and_weights(spark):
    runs = spark.createDataFrame([("boost", "none", 0.9, 0.91, 0.92, 0.8, 0.01), ("base", "none", 0.3, 0.3, 0.3, 0.1, 0.2)],
                                 "model string, dataset string, test_f1 double, val_f1 double, test_bal_acc double, luxury_recall double, severe_misclassification_rate double")
    document = json.loads(selection_document(runs))
    assert document["best_model"]["model_name"] == "boost" and len(document["top_5_models"]) == 2
    scaled = Criteria(weight_primary=3.0, weight_secondary=1.0).normalised()
    assert (scaled.weight_primary, scaled.weight_secondary) == (0.75, 0.25)
    near = Criteria(weight_primary=0.7, weight_secondary=0.305)
    assert near.normalised() is near


def test_lookups_and_required_columns(spark, tmp_path):
    (tmp_path / "map.json").write_text('{"a": "x", "b": 2}')
    (tmp_path / "list.json").write_text('["n/a", "-"]')
    assert {tuple(r) for r in read_lookup(spark, str(tmp_path / "map.json")).collect()} == {("a", "x"), ("b", "2")}
    assert [r["key"] for r in read_lookup(spark, str(tmp_path / "list.json")).collect()] == ["n/a", "-"]
    (tmp_path / "latin.csv").write_bytes("name\nCitroën\n".encode("latin-1"))
    assert read_csv(spark, str(tmp_path / "latin.csv"), encoding="ISO-8859-1").first()["name"] == "Citroën"
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "latin.csv"), "csv", required=["price"])


def test_one_record(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    names = ["power", "kilometer", "yearOfRegistration"]
    rows = [(float(p), 1000.0, 2010, 0 if p < 100 else 2 if p > 200 else 1) for p in range(0, 300, 5)]
    df = spark.createDataFrame(rows, "power double, kilometer double, yearOfRegistration int, label int")
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), DecisionTreeClassifier(maxDepth=3)]).fit(df)
    listing = {"brand": "b", "model": "m", "vehicleType": "v", "gearbox": "g", "fuelType": "f", "seller": "s", "kilometer": 1000, "yearOfRegistration": 2010}
    found = score.predict_one(spark, model, power=250, **listing)
    assert found["tier"] == "luxury" and sum(found["probabilities"].values()) == pytest.approx(1.0)
    assert found["confidence"] == found["probabilities"]["luxury"]
