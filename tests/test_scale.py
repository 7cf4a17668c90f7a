"""Steps that must not carry, repeat or keep more than the result needs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lotmill.operators import metrics, profile
from lotmill.operators.sampling import stratified_split
from lotmill.plans import clean as cleaning
from lotmill.workload import evaluation, modelling
from lotmill.workload.listings import LISTING, complete, listings


@pytest.fixture
def tables(spark, tmp_path):
    """Driver tables of a few rows; part 2, order 2 and customer 2 lack a value."""
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = [(o, p, 1, n, 10.0 * n, 9000.0 * p, "F" if n % 2 else "O") for o in range(1, 5) for p in range(1, 5) for n in range(1, 5)]
    put("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_linestatus string")
    day = datetime(1995, 1, 1)
    put("orders", [(o, o, "F", None if o == 2 else float("nan") if o == 4 else 160.0 * o, day) for o in range(1, 5)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")
    put("customer", [(c, None if c == 3 else "BUILDING") for c in range(1, 5)], "c_custkey long, c_mktsegment string")
    put("part", [(p, f"name {p}", f"Brand#{p}", None if p == 2 else "SMALL", 20 + 5 * p) for p in range(1, 5)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    return str(tmp_path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_complete_rows_are_those_of_dropna(spark, tables):
    rows = listings(spark, tables, "l_orderkey", "l_partkey", "l_linenumber", *LISTING)
    ours, theirs = complete(rows).collect(), rows.dropna().collect()
    assert sorted(map(str, ours)) == sorted(map(str, theirs)) and len(ours) == 12  # order 1, parts 1, 3 and 4


def test_texts_of_parts_and_unused_columns_stay_out_of_shuffles(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = modelling._rule_rows(spark, tables)
        text = plan(rows)
        assert rows.count() == 12
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "IsNotNull(o_totalprice)" in text and "IsNotNull(c_mktsegment)" in text  # tested where they are read
    assert text.count("Exchange hashpartitioning(l_") == 2  # lines by order, then by part


def test_run_results_are_computed_once(spark, tables):
    found = evaluation.runs(spark, tables)
    assert "InMemoryTableScan" in plan(found)
    assert "lineitem" not in plan(found).split("InMemoryTableScan")[0]


def test_split_counts_copies_once_in_a_written_table(spark):
    rows = spark.range(200).select((F.col("id") % 40).alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    split = stratified_split(rows, "label")
    assert "lotmill-copies-" in plan(split)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"test": 40, "val": 40, "train": 120}


def test_predictions_are_computed_once_for_all_scores(spark):
    rows = spark.range(30).select((F.col("id") % 3).cast("int").alias("y_true"), (F.col("id") % 3).cast("int").alias("y_pred"))
    text = plan(metrics.evaluate(rows))
    assert "InMemoryTableScan" in text and "Range" not in text.split("InMemoryTableScan")[0]


def test_cleaning_keeps_its_valid_rows_in_a_written_table(spark, tables):
    found = cleaning.clean(listings(spark, tables))
    assert "lotmill-valid-" in plan(found) and found.count() > 0


def test_overviews_read_a_written_table(spark):
    rows = spark.range(100).select(F.col("id").cast("double").alias("price"), F.lit("luxury").alias("price_tier"), F.lit(1.0).alias("kilometer"))
    assert "lotmill-kpis-" in plan(profile.kpis(rows))
    assert "lotmill-overview-" in plan(profile.eda_tables(rows)["tiers"])
