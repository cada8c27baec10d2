"""Catalog tables: DDL, write by name, dynamic partition overwrite, append."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.gold import build_gold, clean_sql
from strata.operators.tables import (columns_of, create_table_sql, ensure_table,
                                     partition_columns, write_by_name)
from strata.params import GoldParams
from strata.session import fresh_name


def _table(spark, lake, cols, part):
    db = fresh_name("t")
    name = f"{db}.tbl"
    ensure_table(spark, name, cols, part, lake.location("silver", db, "tbl"))
    return name


def _rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_second_overwrite_replaces_only_its_partitions(spark, lake):
    t = _table(spark, lake, [("v", "INT"), ("p", "STRING")], "p")
    write_by_name(spark.createDataFrame([(1, "a"), (2, "b")], "v INT, p STRING"), t)
    write_by_name(spark.createDataFrame([(3, "a")], "v INT, p STRING"), t)
    assert _rows(spark, t) == [(2, "b"), (3, "a")]


def test_full_overwrite_replaces_the_table(spark, lake):
    t = _table(spark, lake, [("v", "INT"), ("p", "STRING")], "p")
    write_by_name(spark.createDataFrame([(1, "a"), (2, "b")], "v INT, p STRING"), t)
    write_by_name(spark.createDataFrame([(3, "a")], "v INT, p STRING"), t, full_overwrite=True)
    assert _rows(spark, t) == [(3, "a")]


def test_append_adds_rows(spark, lake):
    t = _table(spark, lake, [("v", "INT"), ("p", "STRING")], "p")
    df = spark.createDataFrame([(1, "a")], "v INT, p STRING")
    write_by_name(df, t, mode="append")
    write_by_name(df, t, mode="append")
    assert _rows(spark, t) == [(1, "a"), (1, "a")]


def test_null_and_empty_partition_values_read_back_as_null(spark, lake):
    t = _table(spark, lake, [("v", "INT"), ("p", "STRING")], "p")
    write_by_name(spark.createDataFrame([(1, None), (2, "")], "v INT, p STRING"), t)
    assert _rows(spark, t) == [(1, None), (2, None)]


def test_write_binds_by_name_not_position(spark, lake):
    t = _table(spark, lake, [("a", "STRING"), ("b", "STRING"), ("p", "STRING")], "p")
    # frame has the partition column in the middle and other columns swapped
    df = spark.createDataFrame([("B", "P", "A")], "b STRING, p STRING, a STRING")
    write_by_name(df, t)
    assert spark.table(t).collect()[0].asDict() == {"a": "A", "b": "B", "p": "P"}


def test_write_rejects_missing_or_extra_columns(spark, lake):
    t = _table(spark, lake, [("a", "STRING"), ("p", "STRING")], "p")
    with pytest.raises(ValueError):
        write_by_name(spark.createDataFrame([("x",)], "a STRING"), t)
    with pytest.raises(ValueError):
        write_by_name(spark.createDataFrame([("x", "y", "z")], "a STRING, p STRING, q STRING"), t)


def test_ddl_from_any_result_type(spark, lake):
    df = spark.sql("""SELECT CAST(1.5 AS DECIMAL(10,2)) AS d, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts,
                      array(1, 2) AS xs, named_struct('k', 'v') AS st, CAST(1 AS SMALLINT) AS s,
                      'x' AS p""")
    db = fresh_name("g")
    ensure_table(spark, f"{db}.any", columns_of(df.schema), "p", lake.location("gold", db, "any"))
    write_by_name(df, f"{db}.any")
    r = spark.table(f"{db}.any").collect()[0]
    assert r.ts == dt.datetime(2024, 1, 1) and r.xs == [1, 2] and r.st.k == "v"
    assert partition_columns(spark, f"{db}.any") == ["p"]
    assert spark.table(f"{db}.any").columns[-1] == "p"


def test_create_sql_quotes_names_and_puts_partition_last():
    sql = create_table_sql("db.t", [("p", "STRING"), ("we ird", "INT")], "p", "/x/y")
    assert "`we ird` INT" in sql and "PARTITIONED BY (`p`)" in sql
    assert sql.index("`we ird`") < sql.index("`p` STRING")


def test_gold_partition_column_mid_select(spark, lake):
    """The partition column stands among the others in the text and last in the table."""
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").createOrReplaceTempView("parts_now")
    sql = """SELECT p_partkey, p_size AS size_class, upper(p_brand) AS brand,
                    round(p_retailprice * 0.9, 2) AS offer
             FROM parts_now WHERE p_size BETWEEN 5 AND 7;"""
    out = build_gold(spark, sql, GoldParams(fresh_name("gold"), "offers", "size_class"), lake)
    assert out.columns == ["p_partkey", "brand", "offer", "size_class"]
    want = spark.table("parts_now").where("p_size IN (5, 6, 7)").collect()
    assert {(r.p_partkey, r.size_class, r.brand) for r in out.collect()} == {
        (r.p_partkey, r.p_size, r.p_brand.upper()) for r in want}


def test_concat_with_null_part_is_null(spark):
    assert spark.sql("SELECT concat('a', NULL, 'b') AS c").collect()[0].c is None


def test_clean_sql():
    assert clean_sql("  SELECT 1 ;; \n") == "SELECT 1"


def test_dynamic_overwrite_does_not_depend_on_session_default(spark, lake):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        t = _table(spark, lake, [("v", "INT"), ("p", "STRING")], "p")
        write_by_name(spark.createDataFrame([(1, "a"), (2, "b")], "v INT, p STRING"), t)
        write_by_name(spark.createDataFrame([(3, "a")], "v INT, p STRING"), t)
        assert _rows(spark, t) == [(2, "b"), (3, "a")]
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)


def _hot_frame(spark):
    # 8 map tasks; value 'hot' holds 95% of the rows, ten small values the rest
    return spark.range(0, 40_000, numPartitions=8).selectExpr(
        "CAST(id AS INT) AS v",
        "CASE WHEN id % 20 = 0 THEN concat('k', CAST(id DIV 20 % 10 AS STRING)) ELSE 'hot' END "
        "AS p")


def _files_of(spark, table, value):
    return {f for f in spark.table(table).where(F.col("p") == value).inputFiles()}


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_hot_partition_value_is_written_by_several_tasks(spark, lake, aqe):
    t = _table(spark, lake, [("v", "INT"), ("p", "STRING")], "p")
    df = _hot_frame(spark)
    keys = {"spark.sql.adaptive.enabled": aqe,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        write_by_name(df, t)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # the hot value is split over several writers, not funnelled into one task
    assert len(_files_of(spark, t, "hot")) > 1
    if aqe == "true":
        # ... while rows were shuffled by value: a small value is one file, not
        # one per input task (unless it shares the hot value's shuffle
        # partition, which is split as a whole); pmod(hash) is Spark's own
        # hash partitioning
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        slot = {r.p: r.s for r in spark.table(t).selectExpr(
            "p", f"pmod(hash(p), {n}) AS s").distinct().collect()}
        alone = [k for k in slot if k != "hot" and slot[k] != slot["hot"]]
        assert len(alone) >= 5
        assert all(len(_files_of(spark, t, k)) == 1 for k in alone)
    assert _rows(spark, t) == sorted(tuple(r) for r in df.collect())


def _forget(spark, table):
    spark.sql(f"DROP TABLE {table}")  # external: the files stay


def test_registered_again_with_the_recorded_types(spark, lake):
    from strata.operators.tables import register_tables

    db = fresh_name("reg")
    text_t, int_t = f"{db}.codes", f"{db}.counts"
    ensure_table(spark, text_t, [("v", "INT"), ("p", "STRING")], "p",
                 lake.location("silver", db, "codes"))
    ensure_table(spark, int_t, [("v", "STRING"), ("k", "INT")], "k",
                 lake.location("gold", db, "counts"))
    write_by_name(spark.createDataFrame([(1, "007"), (2, "20240101"), (3, None)],
                                        "v INT, p STRING"), text_t)
    write_by_name(spark.createDataFrame([("a", 5), ("b", 7)], "v STRING, k INT"), int_t)
    before = {t: (spark.table(t).schema, _rows(spark, t)) for t in (text_t, int_t)}
    _forget(spark, text_t)
    _forget(spark, int_t)
    assert sorted(register_tables(spark, lake)) == sorted([text_t, int_t])
    assert {t: (spark.table(t).schema, _rows(spark, t)) for t in (text_t, int_t)} == before
    # a later overwrite of '007' replaces that partition; it is not written as 7
    write_by_name(spark.createDataFrame([(9, "007")], "v INT, p STRING"), text_t)
    assert _rows(spark, text_t) == [(2, "20240101"), (3, None), (9, "007")]
    assert register_tables(spark, lake) == []  # nothing missing any more


def test_unrecorded_folder_keeps_partition_values_as_text(spark, lake):
    from strata.operators.tables import register_tables

    db = fresh_name("raw")
    folder = lake.location("silver", db, "landed")
    spark.createDataFrame([(1, "007"), (2, "010")], "v INT, p STRING") \
        .write.partitionBy("p").parquet(folder)
    assert register_tables(spark, lake) == [f"{db}.landed"]
    t = spark.table(f"{db}.landed")
    assert dict(t.dtypes)["p"] == "string"
    assert sorted(tuple(r) for r in t.collect()) == [(1, "007"), (2, "010")]


def test_dotted_partition_column_name(spark, lake):
    t = _table(spark, lake, [("v", "INT"), ("p.x", "STRING")], "p.x")
    write_by_name(spark.createDataFrame([(1, "a"), (2, "b")], "v INT, `p.x` STRING"), t)
    assert _rows(spark, t) == [(1, "a"), (2, "b")]


def test_created_table_without_rows_is_registered_from_its_definition(spark, lake):
    from strata.operators.tables import register_tables

    db = fresh_name("empty")
    t = f"{db}.later"
    ensure_table(spark, t, [("v", "DECIMAL(10,2)"), ("d", "DATE"), ("p", "STRING")], "p",
                 lake.location("gold", db, "later"))
    schema = spark.table(t).schema
    _forget(spark, t)
    assert register_tables(spark, lake) == [t]
    assert spark.table(t).schema == schema and spark.table(t).count() == 0


def test_definition_without_folder_is_not_registered(spark, lake):
    import json

    from strata.lake import definition_path, write_text
    from strata.operators.tables import register_tables

    db = fresh_name("gone")
    ensure_table(spark, f"{db}.kept", [("v", "INT")], None, lake.location("silver", db, "kept"))
    # a removed table: its definition is left, its folder is not
    write_text(spark, definition_path(lake.location("silver", db, "removed")),
               json.dumps({"columns": [["v", "INT"]], "partition_column": None}))
    _forget(spark, f"{db}.kept")
    assert register_tables(spark, lake) == [f"{db}.kept"]
    assert not spark.catalog.tableExists(f"{db}.removed")


def test_table_made_elsewhere_gets_its_definition_recorded(spark, lake):
    from strata.operators.tables import register_tables

    db = fresh_name("meta")
    loc = lake.location("silver", db, "made")
    spark.sql(f"CREATE DATABASE {db}")
    spark.sql(f"CREATE TABLE {db}.made (v STRING, k INT) USING parquet PARTITIONED BY (k) "
              f"LOCATION '{loc}'")
    write_by_name(spark.createDataFrame([("a", 7), ("b", 10)], "v STRING, k INT"), f"{db}.made")
    # the next job's ensure_table finds the table and records what the catalog has
    assert not ensure_table(spark, f"{db}.made", [("v", "STRING"), ("k", "INT")], "k", loc)
    _forget(spark, f"{db}.made")
    assert register_tables(spark, lake) == [f"{db}.made"]
    assert dict(spark.table(f"{db}.made").dtypes)["k"] == "int"
    assert _rows(spark, f"{db}.made") == [("a", 7), ("b", 10)]


def test_storage_root_follows_the_session(spark):
    from types import SimpleNamespace

    from strata.session import storage_root

    def session(conf, checkpoint, master):
        values = {}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda k, d=None: values.get(k, d), set=values.__setitem__),
            sparkContext=SimpleNamespace(
                getConf=lambda: conf, getCheckpointDir=lambda: checkpoint, master=master,
                setCheckpointDir=lambda d: pytest.fail("a checkpoint folder was replaced")))

    assert storage_root(session({"spark.checkpoint.dir": "hdfs://x/c/"}, None, "yarn")) == \
        "hdfs://x/c/strata"
    assert storage_root(session({}, "/set/by/caller", "local[2]")) == "/set/by/caller/strata"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage_root(session({}, None, "spark://host:7077"))
