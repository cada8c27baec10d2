"""Binding landed text to the declared schema (lenient casts, arity, order)."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.functions.casts import lenient_cast
from strata.operators.silver import cast_losses, conform, conform_observed

TEXTS = ["1", "1.0", "1.5", " 7 ", "-3.9", "abc", "", "1e3", "5-LOW", "2147483648", "12.",
         None]


def test_malformed_number_is_null(spark):
    df = spark.createDataFrame([("abc",), ("1.25",)], "x STRING")
    got = [r.x for r in conform(df, [("x", "DOUBLE")]).collect()]
    assert got == [None, 1.25]


def test_fraction_text_to_integer(spark):
    df = spark.createDataFrame([("1.0",), ("1.5",)], "x STRING")
    assert [r.x for r in conform(df, [("x", "INT")]).collect()] == [1, 1]


@pytest.mark.parametrize("type_name", ["INT", "BIGINT", "DOUBLE", "BOOLEAN", "SMALLINT"])
def test_lenient_cast_equals_non_ansi_cast(spark, type_name):
    df = spark.createDataFrame([(t,) for t in TEXTS], "x STRING")
    mine = [r.v for r in df.select(lenient_cast(F.col("x"), type_name).alias("v")).collect()]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r.v for r in df.select(F.col("x").cast(type_name).alias("v")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert mine == legacy


def test_missing_declared_column_is_typed_null_and_extra_dropped(spark):
    df = spark.createDataFrame([("1", "x", "junk")], "a STRING, b STRING, undeclared STRING")
    out = conform(df, [("a", "INT"), ("c", "DOUBLE"), ("b", "STRING")])
    assert out.columns == ["a", "c", "b"]
    assert dict(out.dtypes) == {"a": "int", "c": "double", "b": "string"}
    assert out.collect()[0].asDict() == {"a": 1, "c": None, "b": "x"}
    loose = conform(df, [("a", "INT"), ("c", "DOUBLE")], strict=False)
    assert loose.columns == ["a"]


def test_partition_column_moves_last(spark):
    df = spark.createDataFrame([("1", "s", "2")], "a STRING, state STRING, z STRING")
    out = conform(df, [("a", "INT"), ("state", "STRING"), ("z", "INT")], "state")
    assert out.columns == ["a", "z", "state"]


def test_cast_losses_and_observed_metrics(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", "1"), (None, "abc"), ("q", None)],
                               "a STRING, b STRING")
    schema = [("a", "INT"), ("b", "DOUBLE")]
    got = {r.column_name: (r.present, r.lost) for r in cast_losses(df, schema).collect()}
    assert got == {"a": (3, 1), "b": (3, 2)}
    seen = Observation("t")
    conform_observed(df, schema, None, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 4, "lost:a": 1, "lost:b": 2}
