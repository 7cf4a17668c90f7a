import json

import pytest
from pyspark.sql import functions as F

from lotmill.plans import clean, merge, train
from lotmill.plans.validate import Validator
from lotmill.sources import tables

LISTING = "brand string, model string, vehicleType string, power double, gearbox string, kilometer double, fuelType string, yearOfRegistration int, seller string, dataSource string, price double, price_tier string"


def listing(**changes):
    base = dict(brand="vw", model="golf", vehicleType="limousine", power=100.0, gearbox="manuell", kilometer=50_000.0, fuelType="benzin",
                yearOfRegistration=2015, seller="privat", dataSource="kaggle", price=8000.0, price_tier="mid-range")
    return tuple({**base, **changes}.values())


def test_clean_normalises_fills_and_deduplicates(spark):
    rows = [listing() for _ in range(5)] + [listing(vehicleType=None, model="polo"), listing(price=499.0), listing(brand="N/A"), listing(power=None)]
    out = clean.clean(spark.createDataFrame(rows, LISTING)).collect()
    assert {(r["brand"], r["model"], r["vehicleType"], r["gearbox"], r["fuelType"], r["seller"]) for r in out} == {
        ("volkswagen", "golf", "sedan", "manual", "gasoline", "private"), ("volkswagen", "polo", "sedan", "manual", "gasoline", "private")}
    assert len(out) == 2


def test_impute_median_and_unfillable_brand(spark):
    rows = [listing(power=100.0), listing(power=200.0), listing(power=None), listing(brand="sonstige-autos", power=100.0, model=None)]
    out = clean.impute(spark.createDataFrame(rows, LISTING)).collect()
    assert sorted(r["power"] for r in out) == [100.0, 100.0, 100.0, 200.0]
    assert [r["model"] for r in out if r["brand"] is None] == ["unknown"]


def test_merge_reads_csv_and_writes(spark, tmp_path):
    a = "dateCrawled,seller,price,vehicleType,yearOfRegistration,gearbox,powerPS,model,brand,kilometer,fuelType\n2020-03-01 10:00:00,privat,10000,kombi,2010,manuell,90,k\xe4fer,vw,90000,NA\n"
    b = "brand,model,fuelType,mileage,year,vehicleType,seller,gearbox,power,price\nPeugeot-,2008 ,Gasoline,122566,02/2017,Van,Dealer,Manual,60 kW (82 hp),7450\n"
    (tmp_path / "a.csv").write_bytes(a.encode("latin-1"))
    (tmp_path / "b.csv").write_text(b)
    out = {r["dataSource"]: r for r in merge.merge_files(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), str(tmp_path / "out")).collect()}
    assert out["kaggle"]["price"] == pytest.approx(14790.0) and out["kaggle"]["model"] == "käfer" and out["kaggle"]["fuelType"] is None
    assert (out["crawled"]["power"], out["crawled"]["yearOfRegistration"], out["crawled"]["price_tier"]) == (82.0, 2017, "mid-range")


def test_validator_runs_all_checks_and_writes_reports(spark, tmp_path):
    rows = [listing(power=60.0 + i, kilometer=10_000.0 + 997 * (i * 7 % 60), price=2000.0 + 100 * i, yearOfRegistration=1995 + i % 20) for i in range(60)]
    summary = Validator().run_all(spark.createDataFrame(rows, LISTING), str(tmp_path / "report"))
    assert summary["total"] == 9
    saved = json.loads((tmp_path / "report.json").read_text())
    assert [e["check_type"] for e in saved["details"]][:3] == ["Schema", "Completeness", "Uniqueness"]
    assert "Distribution" in (tmp_path / "report.txt").read_text()


def test_table_reader_checks(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "t"), required=["model"])
    (tmp_path / "m.json").write_text('{"vw": "volkswagen"}')
    assert tables.read_lookup(spark, str(tmp_path / "m.json")).first().asDict() == {"key": "vw", "value": "volkswagen"}


def test_saved_model_fills_nulls_as_in_training(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import DecisionTreeClassifier

    # a missing value counts as 0, which no known value of ``a`` is
    rows = [(1.0 + i % 5 if i % 3 else None, float(i), float(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    model = train.assembled(["a", "b"], DecisionTreeClassifier(maxDepth=3)).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    assert again.where("prediction <> label").count() == 0
    found = [{r["b"]: (r["prediction"], tuple(r["probability"])) for r in scored.collect()} for scored in (model.transform(df), again)]
    assert found[0] == found[1] and len(found[0]) == 90
    zeros = df.withColumn("a", F.coalesce("a", F.lit(0.0)))
    assert {r["b"]: (r["prediction"], tuple(r["probability"])) for r in model.transform(zeros).collect()} == found[0]
    nothing = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert model.transform(nothing).count() == 1


def test_selection_report_and_one_record(spark, tmp_path):
    from lotmill.operators.selection import FeatureSelector

    rows = [(float(i % 7), float(i * 31 % 11), 1.0, i % 7 // 3) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    selector = FeatureSelector("importance", rounds=2).fit(df, ["a", "b", "c"])
    assert selector.selected[0] == "a" and "c" not in selector.selected
    selector.save(spark, str(tmp_path / "chosen"))
    assert "strategy=importance" in (tmp_path / "chosen.txt").read_text()
    assert (tmp_path / "chosen_features.txt").read_text().splitlines()[3:] == selector.selected


def test_boosted_trees_see_missing_values_as_missing(spark):
    config = train.model_configs()["boosted_trees"]
    rows = [(None if i % 2 else float(i % 5 - 2), i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "a double, label int")
    model = train.assembled(["a"], config.make({"rounds": 2, "depth": 2, "rate": 0.3, "subsample": 1.0}, 80), config.scale, config.fill).fit(df)
    assert model.transform(df).where("prediction <> label").count() == 0  # with 0 for missing, rows of value 0 could not be told apart
