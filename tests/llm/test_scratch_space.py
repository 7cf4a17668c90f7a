"""What the text operators leave on disk while they run and when they have ended."""

import os
import random

import pytest

from lotmill.llm import common, passages, shingle_join

rng = random.Random(8)


def line(n):
    return " ".join(f"w{rng.randint(0, 5_000)}" for _ in range(n))


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    monkeypatch.setattr(common, "scratch_dir", lambda spark: str(tmp_path))
    return tmp_path


@pytest.fixture(scope="module")
def copies(spark):
    shared = [line(60) for _ in range(6)]
    rows = [(i, f"{line(40)} {shared[i % 6]} {line(5)}") for i in range(30)] + [(40 + i, s) for i, s in enumerate(shared)] + [(50 + i, s + " w1") for i, s in enumerate(shared)]
    return spark.createDataFrame([*rows, (0, rows[0][1]), (1, shared[0]), (60, None), (61, ""), (None, shared[0])], "doc_id long, text string")


def tables(folder):
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(folder))


def shuffle_files(spark):
    # every block manager of a local session keeps its files in this process's folders
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark, scratch):
    before = shuffle_files(spark)
    setting = spark.conf.get(common.CLEANUP, None)
    found = common.written(spark.range(1_000).selectExpr("id", "id % 7 AS k").repartition(4, "k"), "dealt")
    assert not shuffle_files(spark) - before and found.count() == 1_000
    assert spark.conf.get(common.CLEANUP, None) == setting


def test_dropped_tables_are_deleted_and_others_stay(spark, scratch):
    one, other = common.written(spark.range(5), "one"), common.written(spark.range(3), "other")
    common.dropped(common.small(one), spark.range(2), other.where("id > 0"))
    assert tables(scratch) == ["other"] and other.count() == 3


def test_classes_leave_only_their_result(spark, scratch, copies):
    found = shingle_join.jaccard_classes(copies)
    assert [name for name in tables(scratch) if name != "gone"] == ["classes"]
    labels = {r.doc_id: r.component_id for r in found.collect()}
    assert len(labels) == 44 and all(labels[50 + i] == labels[40 + i] for i in range(1, 6))


def test_texts_of_pairs_are_not_shuffled(spark, scratch, copies, monkeypatch):
    plans = {}
    real = common.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        return real(df, name)

    monkeypatch.setattr(shingle_join, "written", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shingle_join.jaccard_classes(copies)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans["sets"] and "SortMergeJoin" not in plans["sets"]


def test_passages_leave_only_what_their_result_reads(spark, scratch, copies):
    found = passages.repeated_passages(copies, span=30)
    assert set(tables(scratch)) <= {"out", "places", "several"}
    once = sorted(found.collect())
    assert {r.doc_id for r in once if r.removed} >= set(range(6, 30))
    assert sorted(passages.repeated_passages(copies.unionByName(copies.where("doc_id % 2 = 0")), span=30).collect()) == once  # repeated rows count once


def test_ends_of_passages_are_moved_one_at_a_time(spark, scratch, copies, monkeypatch):
    names = []
    real = common.written
    monkeypatch.setattr(passages, "written", lambda df, name: names.append(name) or real(df, name))
    passages.repeated_passages(copies, span=30)
    assert names.count("extended") == 2
