"""Smaller API paths: lookups, dimension options, projection, contracts."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallymart.operators import align, dimension, lookup_table, project
from tallymart.sources import conform
from tallymart.spec import Contract, DimSpec


def test_lookup_table_unknown_code_is_null(spark):
    df = spark.createDataFrame([(1, "01"), (2, "99")], "id int, code string")
    names = spark.createDataFrame([("01", "CAPITAL_FEDERAL")], "k string, name string")
    out = {r["id"]: r["label"] for r in lookup_table(df, "code", names, "k", "name", "label").collect()}
    assert out == {1: "CAPITAL_FEDERAL", 2: None}


def test_lookup_table_never_multiplies_rows(spark):
    df = spark.createDataFrame([(1, "01"), (2, None)], "id int, code string")
    names = spark.createDataFrame([("01", "B"), ("01", "A"), (None, "Z")], "k string, name string")
    out = [tuple(r) for r in lookup_table(df, "code", names, "k", "name", "label").orderBy("id").collect()]
    assert out == [(1, "01", "A"), (2, None, None)]


def test_dimension_filter_distinct_and_lookup(spark):
    df = spark.createDataFrame(
        [("01", "a", 1), ("01", "a", 2), ("02", None, 3), ("03", "c", 4)], "d string, s string, n int"
    )
    spec = DimSpec({"id": "d", "sec": "s"}, not_null=("s",), filter="n < 4",
                   lookups={"name": ("id", {"01": "UNO"})})
    rows = sorted(tuple(r) for r in dimension(df, spec).collect())
    assert rows == [("01", "a", "UNO")]


def test_project_list_and_mapping(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project(df, ["c", "a"]).columns == ["c", "a"]
    assert project(df, {"b": "x", "a": "y"}).columns == ["x", "y"]


def test_contract_alignment_fails_loudly(spark):
    contract = Contract("t", StructType([StructField("a", StringType()), StructField("n", IntegerType())]))
    df = spark.createDataFrame([("1", 2)], "a string, m int")
    with pytest.raises(ValueError, match="missing column"):
        conform(df, contract)
    with pytest.raises(AnalysisException):
        align(df, contract.names).collect()
    ok = spark.createDataFrame([(7, "x")], "n long, a string")
    out = conform(ok, contract)
    assert out.columns == ["a", "n"] and dict(out.dtypes) == {"a": "string", "n": "int"}
