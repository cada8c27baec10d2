"""The counting filter: same counts as the full shuffle, few values in it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import unique_filter as U
from strata.operators.quality import run_suite, stacked_values, expand


def _suite(columns):
    return {"quality_params": {"unique_vals": {"column": columns}}}


def _report(df, columns, **settings):
    return sorted(map(tuple, run_suite(df, _suite(columns), **settings).collect()))


@pytest.mark.parametrize("bits", [16, 20])
def test_same_counts(spark, bits):
    rows = [(k, f"v{k % 700}", None if k % 3 else float(k % 11), k == 5) for k in range(2000)]
    rows += [(k, None, float("nan"), None) for k in range(10)] + [(9999, "once", -0.0, False)]
    df = spark.createDataFrame(rows, "id BIGINT, name STRING, v DOUBLE, flag BOOLEAN").repartition(7)
    columns = "id,name,v,flag"
    assert _report(df, columns, unique_filter_bits=bits) == _report(df, columns)
    assert _report(df.limit(0), columns, unique_filter_bits=bits) == _report(df.limit(0), columns)


def test_unique_key_hardly_enters_the_shuffle(spark):
    df = spark.range(100_000).select(F.col("id").alias("key"), (F.col("id") / 2).cast("int").alias("two"))
    checks = expand(_suite("key"))
    stacked = stacked_values(df, checks)
    maybe, counts = U.repeated_values(stacked, ["v0"], bits=22)
    assert counts == {0: 100_000} and maybe.count() < 10_000
    maybe, _ = U.repeated_values(stacked_values(df, expand(_suite("two"))), ["v0"], bits=22)
    assert maybe.count() == 100_000  # all of them repeat
    assert _report(df, "key,two", unique_filter_bits=22) == _report(df, "key,two")


def test_places_in_different_tasks_meet(spark):
    """Each value once per task, twice over all."""
    df = spark.range(0, 500, numPartitions=1).union(spark.range(0, 500, numPartitions=1))
    assert _report(df, "id", unique_filter_bits=16)[0][4:6] == (1000, 1000)


def test_marks():
    rng = np.random.default_rng(1)
    bits = np.zeros(1 << 10, np.uint8)
    places = np.unique(rng.integers(0, 1 << 13, 900))
    U._mark(bits, places)
    every = np.arange(1 << 13)
    assert every[U._marked(bits, every)].tolist() == places.tolist()
    U._mark(bits, places[:0])
    assert U._marked(bits, every).sum() == len(places)
