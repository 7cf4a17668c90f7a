"""Types found from text columns."""

import pytest

from lotmill.sources.tables import inferred_types, read_typed_csv, with_types


@pytest.mark.parametrize("values,kind", [
    (["1", "-2", "+3", " 4 ", None], "bigint"),
    (["1", "2.5", "1e3", ".5", "5."], "double"),
    (["9223372036854775807", "-9223372036854775808"], "bigint"),
    (["9223372036854775808", "1"], "double"),
    (["True", "false", None], "boolean"),
    (["True", "1"], "string"),
    (["1", "x"], "string"),
    (["0x1F"], "string"),
    (["1d", "2f"], "string"),
    (["inf", "-Infinity", "1"], "double"),
    (["2020-01-01"], "string"),
    (["", "1"], "string"),
    ([None, None], "double"),
    (["1 000"], "string"),
])
def test_lattice(spark, values, kind):
    df = spark.createDataFrame([(v, 1) for v in values], "`a.b` string, n int").repartition(3)
    found = inferred_types(df)
    assert found == {"a.b": kind}
    typed = with_types(df, found)
    assert dict(typed.dtypes) == {"a.b": kind, "n": "int"}
    assert sum(r[0] is None for r in typed.collect()) == sum(v is None for v in values)


def test_empty_and_typed_tables(spark):
    assert inferred_types(spark.createDataFrame([], "a string")) == {"a": "double"}
    assert inferred_types(spark.range(2)) == {}


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,price,name,ok,gap\n1,2.50,a,True,\n2,N/A,\"b,c\",False,\n", "utf-8")
    rows = read_typed_csv(spark, str(tmp_path / "t.csv"))
    assert dict(rows.dtypes) == {"id": "bigint", "price": "double", "name": "string", "ok": "boolean", "gap": "double"}
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(1, 2.5, "a", True, None), (2, None, "b,c", False, None)]
