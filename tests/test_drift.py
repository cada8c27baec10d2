"""Types that widen, keys that drift, tables that grow, gold texts in order."""

import itertools
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from strata.functions.lattice import keeps_values, merge_schemas, widest, without_void
from strata.operators import evolution as E
from strata.operators import lineage as G
from strata.operators.publish import publish_gated, table_versions
from strata.operators.tables import ensure_table, register_tables, write_by_name
from strata.params import GoldParams, IngestParams, QualityParams
from strata.plans.daily import GoldSpec
from strata.plans.jobs import bronze_to_silver, capture
from strata.session import fresh_name
from strata.sources import schema_state as S
from strata.sources.landing import day_dir, land_day

TYPES = ["TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL(5,2)", "DECIMAL(38,10)",
         "STRING", "BOOLEAN", "DATE", "TIMESTAMP", "ARRAY<INT>", "ARRAY<STRING>", "VOID",
         "MAP<STRING, INT>", "STRUCT<a: INT>", "STRUCT<a: STRING, b: INT>"]


@pytest.fixture(autouse=True)
def _session(spark):
    """Types are parsed by Spark."""


def _t(name):
    return DataType.fromDDL(name)


def test_lattice_laws():
    types = [_t(t) for t in TYPES]
    for a, b in itertools.product(types, types):
        assert widest(a, a) == a
        ab, ba = widest(a, b), widest(b, a)
        assert ab == ba or {f.name for f in ab.fields} == {f.name for f in ba.fields}
        assert widest(ab, a) == ab and widest(ab, b) == ab  # above both


def test_lattice_is_associative():
    types = [_t(t) for t in TYPES if "DECIMAL" not in t]
    for a, b, c in itertools.product(types, types, types):
        assert widest(widest(a, b), c) == widest(a, widest(b, c)), (a, b, c)


@pytest.mark.parametrize("a, b, want", [
    ("INT", "BIGINT", "BIGINT"), ("BIGINT", "DOUBLE", "DOUBLE"), ("INT", "STRING", "STRING"),
    ("DECIMAL(5,2)", "DECIMAL(6,4)", "DECIMAL(7,4)"), ("INT", "DECIMAL(5,2)", "DECIMAL(12,2)"),
    ("BOOLEAN", "INT", "STRING"), ("ARRAY<INT>", "ARRAY<DOUBLE>", "ARRAY<DOUBLE>"),
    ("STRUCT<a: INT>", "STRUCT<b: INT, a: BIGINT>", "STRUCT<a: BIGINT, b: INT>"),
    ("STRUCT<a: INT>", "INT", "STRING"), ("VOID", "STRUCT<a: INT>", "STRUCT<a: INT>")])
def test_widest(a, b, want):
    assert widest(_t(a), _t(b)) == _t(want)


def test_void_becomes_text():
    schema = merge_schemas(StructType.fromDDL("a VOID, b STRUCT<c: VOID>, d ARRAY<VOID>"))
    assert without_void(schema) == StructType.fromDDL("a STRING, b STRUCT<c: STRING>, d ARRAY<STRING>")


@pytest.mark.parametrize("old, new, ok", [
    ("INT", "BIGINT", True), ("BIGINT", "INT", False), ("INT", "DOUBLE", True),
    ("BIGINT", "DOUBLE", False), ("SMALLINT", "FLOAT", True), ("INT", "FLOAT", False),
    ("FLOAT", "DOUBLE", True), ("DOUBLE", "FLOAT", False), ("DECIMAL(5,2)", "DECIMAL(7,3)", True),
    ("DECIMAL(5,2)", "DECIMAL(5,3)", False), ("INT", "DECIMAL(12,2)", True),
    ("INT", "DECIMAL(9,0)", False), ("DATE", "STRING", True), ("STRING", "DATE", False),
    ("ARRAY<INT>", "STRING", False), ("DECIMAL(5,2)", "DOUBLE", False)])
def test_keeps_values(old, new, ok):
    assert keeps_values(_t(old), _t(new)) == ok


def _json_day(spark, base, day, lines):
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(
        day_dir(base, day))


def test_union_of_days(spark, lake, monkeypatch):
    base = lake.bronze("app", "t")
    _json_day(spark, base, "1", ['{"a": 1, "n": null, "x y": {"p.q": 1}}'])
    _json_day(spark, base, "2", ['{"a": 1.5, "x y": {"r:s": "t"}}', '{"a": 2}'])
    assert S.union_schema(spark, base).simpleString().startswith("struct<a:double,n:")
    read = []
    infer = S.infer_state
    monkeypatch.setattr(S, "infer_state", lambda *a: read.append(a[2]) or infer(*a))
    _json_day(spark, base, "3", ['{"a": "text", "new": [1]}'])
    rows = S.read_union(spark, base).orderBy("ingest_date", "a").collect()
    assert read == ["3"]  # earlier days are not read again
    assert [r.a for r in rows] == ["1", "1.5", "2", "text"]
    assert rows[0]["x y"]["p.q"] == 1 and rows[1]["x y"]["r:s"] == "t" and rows[3].new == [1]
    assert rows[0].n is None and [r.ingest_date for r in rows] == ["1", "2", "2", "3"]


def test_state_of_a_changed_day_is_not_trusted(spark, lake):
    base = lake.bronze("app", "t")
    land_day(spark.createDataFrame([(1,)], "a INT"), base, "1", ext="json")
    S.day_state(spark, base, "1")
    import time
    time.sleep(1.1)
    land_day(spark.createDataFrame([("x",)], "b STRING"), base, "1", ext="json")
    assert S.load_state(spark, base, "1") is None
    assert S.union_schema(spark, base).names == ["b"]


def test_state_travels_as_text(spark, lake):
    base = lake.bronze("app", "t")
    schema = StructType.fromDDL("`a b` INT, `c:d` STRUCT<`e.f`: ARRAY<DOUBLE>>")
    S.store_state(spark, base, "9", schema)
    assert S.load_state(spark, base, "9") == schema
    with pytest.raises(ValueError):
        S.read_union(spark, lake.bronze("app", "none"))


COLUMNS = [("id", "INT"), ("v", "FLOAT"), ("grp", "STRING")]


@pytest.fixture()
def made(spark, lake):
    name = f"{fresh_name('s')}.t"
    location = lake.location("silver", *name.split("."))
    ensure_table(spark, name, COLUMNS, "grp", location)
    write_by_name(spark.createDataFrame([(1, 0.5, "x"), (2, 1.5, None)],
                                        "id INT, v FLOAT, grp STRING"), name)
    return name, location


def test_added_and_widened(spark, lake, made):
    table, location = made
    wide = [("id", "BIGINT"), ("note", "STRING"), ("v", "DOUBLE"), ("grp", "STRING")]
    change = E.evolve_table(spark, table, wide, "grp", location)
    assert (change.added, change.widened) == ({"note": "STRING"}, {"id": "BIGINT", "v": "DOUBLE"})
    assert not E.evolve_table(spark, table, wide, "grp", location)
    write_by_name(spark.createDataFrame([(5_000_000_000, 0.1, "n", "x")],
                                        "id BIGINT, v DOUBLE, note STRING, grp STRING"), table,
                  mode="append")
    want = [(1, 0.5, None, "x"), (2, 1.5, None, None), (5_000_000_000, 0.1, "n", "x")]

    def rows():
        return sorted(map(tuple, spark.table(table).select("id", "v", "note", "grp").collect()))

    assert rows() == want
    spark.sql(f"DROP TABLE {table}")
    register_tables(spark, lake, lambda d, t: f"{d}.{t}" == table)
    assert rows() == want and dict(spark.table(table).dtypes)["id"] == "bigint"


def test_published_partitions_are_widened_too(spark, lake, made):
    table, location = made
    suite = QualityParams.from_dict({"quality_params": {"not_null": {"column": "id"}}})
    frame = spark.createDataFrame([(7, 2.5, "x")], "id INT, v FLOAT, grp STRING")
    publish_gated(frame, table, location, suite)
    E.evolve_table(spark, table, [("id", "BIGINT"), *COLUMNS[1:]], "grp", location)
    assert sorted(r.id for r in spark.table(table).collect()) == [2, 7]
    publish_gated(frame.withColumn("id", F.col("id").cast("bigint") + 1), table, location, suite)
    assert sorted(r.id for r in spark.table(table).collect()) == [2, 8]
    spark.sql(f"DROP TABLE {table}")
    register_tables(spark, lake, lambda d, t: f"{d}.{t}" == table)
    assert sorted(r.id for r in spark.table(table).collect()) == [2, 8]
    assert set(table_versions(spark, location)) == {"x", "__HIVE_DEFAULT_PARTITION__"}


@pytest.mark.parametrize("declared, partition", [
    ([("id", "SMALLINT"), *COLUMNS[1:]], "grp"), ([("id", "INT"), ("v", "INT"), COLUMNS[2]], "grp"),
    ([*COLUMNS[:2], ("grp", "INT")], "grp"), (COLUMNS, "id"), (COLUMNS, None)])
def test_refused_changes_touch_nothing(spark, made, declared, partition):
    table, location = made
    with pytest.raises(E.SchemaEvolutionError):
        E.evolve_table(spark, table, [("more", "INT"), *declared], partition, location)
    assert spark.table(table).columns == ["id", "v", "grp"] and spark.table(table).count() == 2


def test_unpartitioned_and_undeclared(spark, lake):
    db, logs = fresh_name("s"), fresh_name("l")

    def day(rows, schema, name):
        params = IngestParams(db, "t", schema, mode="append", evolve=True)
        capture(spark, rows, lake, "a", "t", name, logs_db=logs)
        return bronze_to_silver(spark, lake, "a", "t", name, params, logs_db=logs)

    one = spark.createDataFrame([(1, "a")], "id INT, name STRING")
    day(one, (("id", "INT"), ("name", "STRING")), "1")
    rows = day(spark.createDataFrame([(2, 0.5)], "id INT, score DOUBLE"),
               (("id", "BIGINT"), ("score", "DOUBLE")), "2")
    assert sorted(map(tuple, rows.select("id", "name", "score").collect())) == [
        (1, "a", None), (2, None, 0.5)]
    done = spark.table(f"{logs}.bronze_to_silver").orderBy("start_exec").collect()[1]
    assert (done.extras["added_columns"], done.extras["widened_columns"],
            done.extras["undeclared_columns"]) == ("score", "id", "name")


@pytest.mark.parametrize("sql, want", [
    ("SELECT * FROM a.t", ["a.t"]), ("select * from A.T x join b.`u v` y on x.k = y.k;", ["a.t", "b.u v"]),
    ("WITH c AS (SELECT * FROM a.t), d AS (SELECT * FROM c) SELECT * FROM d JOIN c ON true", ["a.t"]),
    ("WITH t AS (SELECT 1) SELECT * FROM t JOIN a.t ON true", ["a.t"]),
    ("WITH t AS (SELECT * FROM t) SELECT * FROM t", ["t"]),
    ("SELECT (SELECT max(k) FROM a.s) FROM a.t WHERE k IN (SELECT k FROM a.u) AND EXISTS "
     "(SELECT 1 FROM a.v WHERE v.k = t.k)", ["a.t", "a.s", "a.u", "a.v"]),
    ("SELECT * FROM (SELECT * FROM a.t UNION ALL SELECT * FROM a.u)", ["a.t", "a.u"]),
    ("SELECT 'FROM a.t'", []), ("SELECT * FROM VALUES (1)", [])])
def test_tables_read(spark, sql, want):
    assert sorted(G.tables_read(spark, sql)) == sorted(want)


def _golds(**texts):
    return [GoldSpec(sql, GoldParams("g", name)) for name, sql in texts.items()]


def test_order_and_circles(spark):
    golds = _golds(a="SELECT * FROM g.b JOIN g.c ON true", b="SELECT * FROM g.c", c="SELECT 1 AS k",
                   d="SELECT * FROM g.d", e="SELECT * FROM other.t")
    assert [g.params.target_table for g in G.in_order(spark, golds)] == ["c", "b", "a", "d", "e"]
    assert G.in_order(spark, []) == []
    with pytest.raises(G.LineageError, match="g.a -> g.b -> g.c -> g.a"):
        G.in_order(spark, _golds(z="SELECT 1", a="SELECT * FROM g.b", b="SELECT * FROM G.C",
                                 c="SELECT * FROM g.a"))
    with pytest.raises(G.LineageError):
        G.in_order(spark, _golds(a="SELECT 1") * 2)


def test_definition_is_json(spark, made):
    from strata.operators.tables import definition_of

    table, location = made
    assert json.dumps(definition_of(spark, location)["columns"]) == json.dumps(
        [list(c) for c in COLUMNS])
