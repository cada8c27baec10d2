"""The pipeline's stages, their order and effect; registered queries against their SQL."""

import duckdb
import pytest

import corpus_pipeline as C
import __spark_entry__ as E
from strata.llm import packing, quality, simhash, toxicity
from strata.llm.oracles import ORACLES
from strata.llm.queries import QUERIES

from test_entry import TABLES, _canon
from .helpers import SF, frame


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in C.STAGES:
        docs = C.materialize(stage(spark, docs, SF), "test-stage")
        out.append((name, docs))
    return out


def test_stages(spark, stages):
    names = [name for name, _ in stages]
    assert names == ["toxicity", "quality classifier", "SimHash near-dedup", "best-fit packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, kept in stages[:3]:
        assert sorted(kept.columns) == sorted(docs.columns)
        assert 0 < kept.count() <= docs.count()
        assert kept.exceptAll(docs).count() == 0


def test_every_stage_decides(spark, stages):
    """Each stage's rows against its operator applied row by row to its input."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet"), *(kept for _, kept in stages)]
    ids = [{r.doc_id for r in d.select("doc_id").distinct().collect()} for d in docs]
    texts = [{r.doc_id: r.text for r in d.collect()} for d in docs[:3]]
    machine = C.toxicity_model(spark, docs[0], SF)
    assert isinstance(machine, toxicity.FactorizationMachine)
    assert ids[1] == {k for k, t in texts[0].items() if machine.score(t) < C.THRESHOLD}
    field = C.quality_model(spark, docs[1], SF)
    assert isinstance(field, quality.QualityField)
    score = dict(zip(texts[1], field.scores(list(texts[1].values())), strict=True))
    assert ids[2] == {k for k, s in score.items() if s >= C.THRESHOLD}
    found = simhash.near_duplicates(docs[2], "doc_id", "text", 4, 4).collect()
    assert ids[3] == {r.component_id for r in found}
    assert ids[4] == ids[3]
    want = packing.pack_documents(docs[3], "doc_id", "text")
    assert docs[4].select("doc_id", "piece", "ids_crc32").exceptAll(
        want.select("doc_id", "piece", "ids_crc32")).count() == 0


def test_run_equals_the_stages(spark, stages):
    got = C.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert got.select(columns).exceptAll(stages[-1][1].select(columns)).count() == 0
    assert got.count() == stages[-1][1].count()


def test_registered():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert [n.split("_")[0] for n in names] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, got) == _canon(res.columns, res.fetchall())


def test_stages_take_odd_rows_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    new = 1_000_000
    odd = [(None, None, None, None, None), (None, "no id here", "en", "s", 10),
           (new, "", "en", None, 0), (new + 1, None, None, "s", None),
           (new + 2, "plain words " * 20_000, "en", "s", 1),
           (new + 3, "one plain line of words", "en", "s", 1),
           (new + 3, "one plain line of words", "en", "s", 1)]
    df = frame(spark, docs.limit(120).collect() + odd, docs.schema)
    for _, stage in C.STAGES[:3]:
        kept = C.materialize(stage(spark, df, SF), "odd-stage")
        assert kept.columns == df.columns and 0 < kept.count() <= df.count()
        assert kept.exceptAll(df).count() == 0
        df = kept
    ids = [r.doc_id for r in df.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named)) and new + 3 in named
    assert ids.count(None) == 2  # rows without id stay: nothing tells them apart
    assert not {new, new + 1} <= set(named)  # both are empty: one of them stays
    packed = C.pack(spark, df, SF)
    assert packed.select("doc_id").distinct().count() == len(set(ids))
    empty = frame(spark, [], docs.schema)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0
