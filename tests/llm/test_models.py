"""Toxicity and quality models: held-out rows, learnt interactions, odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality as Q
from strata.llm import queries
from strata.llm import toxicity as T

from .helpers import SF, frame

SF_MODELS = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize("query, label, least", [(queries.op1_toxicity, "toxic", 0.95),
                                                 (queries.op8_line_quality, "quality", 0.97)])
def test_held_out_rows(spark, query, label, least):
    labels = spark.read.parquet(f"{SF_MODELS}/labels.parquet")
    out = query(spark, SF_MODELS)
    assert out.count() == spark.read.parquet(f"{SF_MODELS}/documents.parquet").count()
    got = out.where("held_out").join(labels, "doc_id").toPandas()
    assert auc(got.score.to_numpy(), got[label].to_numpy()) >= least
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert got.score.between(0, 1).all()
    assert (got.predicted == got[label]).mean() >= 0.95


def test_held_out_rows_are_never_learnt(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = queries.toxicity_model(spark, docs, SF)
    changed = labels.withColumn("toxic", F.when(queries.toxicity_held_out(), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    after = T.fit_toxicity(docs, changed, "doc_id", "text", "toxic", ~queries.toxicity_held_out())
    assert np.array_equal(before.w, after.w) and np.array_equal(before.v, after.v)


def test_pairs_of_terms_are_learnt():
    """Neither word alone is toxic; the two together are."""
    rng = np.random.default_rng(0)
    rows, label = [], []
    for _ in range(2000):
        a, b = rng.integers(0, 2, 2)
        noise = [f"w{k}x" for k in rng.integers(0, 30, 5)]
        text = {*noise, *(["alpha"] if a else []), *(["bravo"] if b else [])}
        rows.append(np.array(sorted({t for w in text for t in T.terms(w)}), np.int32))
        label.append(float(a and b))
    model = T.fit(rows, np.array(label), epochs=40)
    one = [model.score(t) for t in ("alpha", "bravo", "", "alpha bravo")]
    assert max(one[:3]) < 0.5 < one[3]
    known = {int(t): k for k, t in enumerate(model.ids)}
    pairs = [model.v[known[s]] @ model.v[known[t]]
             for s, t in itertools.product(T.terms("alpha"), T.terms("bravo"))]
    assert sum(pairs) > 0.5


@pytest.mark.parametrize("toxic", [lambda a, b: a != b, lambda a, b: a == b])
def test_pairs_without_marginals_are_learnt(toxic):
    """The label depends on two words together and on neither by itself."""
    rng = np.random.default_rng(3)
    rows, label = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        text = {*(f"w{k}x" for k in rng.integers(0, 30, 5)), *(["alpha"] if a else []),
                *(["bravo"] if b else [])}
        rows.append(np.array(sorted({t for w in text for t in T.terms(w)}), np.int32))
        label.append(float(toxic(a, b)))
    label = np.array(label)
    ids, ratio = T.label_ratio(rows, label)
    assert not len(ids[ratio >= T.MIN_RATIO])
    model = T.fit(rows, label)
    for text, a, b in (("", 0, 0), ("alpha", 1, 0), ("w3x bravo", 0, 1), ("alpha w1x bravo", 1, 1)):
        score = model.score(text)
        assert score > 0.5 if toxic(a, b) else score < 0.3


def test_insult_next_to_a_group_name():
    """A rare insult is friendly by itself; the group's name is as frequent in clean texts."""
    rng = np.random.default_rng(4)
    rows, label = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.1, rng.random() < 0.1
        text = {*(f"w{k}x" for k in rng.integers(0, 50, 8)), *(["clown"] if insult else []),
                *(["zorblaxians"] if group else [])}
        rows.append(np.array(sorted({t for w in text for t in T.terms(w)}), np.int32))
        label.append(float(insult and (group or rng.random() < 0.2)))
    model = T.fit(rows, np.array(label), epochs=20)
    assert model.score("clown zorblaxians") > 0.5 > model.score("clown")
    assert model.score("zorblaxians") < 0.3


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(5)
    vocabulary = [f"word{k}" for k in range(12)]
    ids = np.array(sorted({t for w in vocabulary for t in T.terms(w)}))
    model = T.FactorizationMachine(-0.3, ids, rng.normal(size=len(ids)),
                                   rng.normal(size=(len(ids), 4)) / 3)
    row = {int(t): k for k, t in enumerate(ids)}
    for n in (0, 1, 2, 7):
        text = " ".join(rng.choice(vocabulary, n)) + " unknown"
        own = sorted({row[t] for w in T.words(text) for t in T.terms(w) if t in row})
        z = model.base + sum(model.w[i] for i in own) + sum(
            model.v[i] @ model.v[j] for i, j in itertools.combinations(own, 2))
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-z)))


def _texts(spark):
    return frame(spark, [(1, None), (2, ""), (3, "fine words"), (3, "fine words"), (None, "x"),
                         (4, "word " * 60_000), (5, "\n\n\n"), (6, "é\x00%%%!!  ")],
                 "doc_id long, text string")


def test_toxicity_odd_rows(spark):
    df = _texts(spark)
    rows = [np.array(T.terms(w), np.int32) for w in ["fine", "idiot"] * 20]
    for model in (T.fit(rows, np.array([0.0, 1.0] * 20)), T.fit([], np.zeros(0)),
                  T.fit(rows[:2], np.zeros(2))):
        got = df.select("doc_id", T.toxicity_score(spark, model, F.col("text")).alias("s")).collect()
        assert len(got) == 8 and all(0 <= r.s <= 1 for r in got)
        by = {r.doc_id: r.s for r in got}
        assert by[1] == by[2] == by[5] < 0.3 or len(model.ids)
    none = df.where("doc_id < 0")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = T.fit_toxicity(none, labels, "doc_id", "text", "toxic", F.lit(True))
    assert none.select(T.toxicity_score(spark, model, F.col("text"))).count() == 0
    field = Q.fit_quality(none, labels, "doc_id", "text", "quality", F.lit(True))
    assert none.select(Q.quality_score(spark, field, F.col("text"))).count() == 0
    assert field.scores(["anything"])[0] > 0.99


def test_labels_without_documents_and_repeats(spark):
    docs = frame(spark, [(k, "fine text" if k % 2 else "idiot text") for k in range(40)] * 2,
                 "doc_id long, text string")
    labels = frame(spark, [(k, 1 - k % 2) for k in range(60)] * 2 + [(None, 1), (3, None)],
                   "doc_id long, toxic int")
    model = T.fit_toxicity(docs, labels, "doc_id", "text", "toxic", F.lit(True))
    assert model.score("idiot text") > 0.5 > model.score("fine text")


def test_class_caps_do_not_move_the_scores(spark):
    """600 clean and 60 toxic texts, of which 60 and 60 are learnt."""
    docs = frame(spark, [(k, f"idiot maybe {k % 7}" if k % 11 == 0 else f"maybe fine {k % 7}")
                         for k in range(660)], "doc_id long, text string")
    labels = frame(spark, [(k, int(k % 11 == 0)) for k in range(660)], "doc_id long, toxic int")
    args = (docs, labels, "doc_id", "text", "toxic", F.lit(True))
    full, cut = T.fit_toxicity(*args), T.fit_toxicity(*args, positives=60, negatives=60)
    for text in ("", None, "unknown words"):
        assert full.score(text) < 0.3 and cut.score(text) < 0.3
    assert cut.score("idiot") > 0.5 > 0.3 > cut.score("fine")


def test_texts_without_kept_terms_move_the_base():
    """Half the texts are toxic, but none of those without a kept term."""
    idiot = np.array(sorted(T.terms("idiot")), np.int32)
    rows = [idiot, np.zeros(0, np.int32)] * 400
    model = T.fit(rows, np.array([1.0, 0.0] * 400))
    assert model.score("") < 0.3 < 0.5 < model.score("idiot")


def test_quality_odd_rows(spark):
    df = _texts(spark)
    good, bad = "A plain line of words.\nAnother plain line here.", "XX!! YY!! ZZ!!\nAB!! CD!!"
    parts = [Q.line_features(t) for t in [good, bad] * 20]
    label = np.array([1.0, 0.0] * 20)
    field = Q.fit([p[0] for p in parts], [p[1] for p in parts], label, 0.5)
    assert field.scores([good])[0] > 0.8 and field.scores([bad])[0] < 0.2
    got = df.select("doc_id", Q.quality_score(spark, field, F.col("text")).alias("s")).collect()
    by = {r.doc_id: r.s for r in got}
    assert len(got) == 8 and all(0 <= r.s <= 1 for r in got) and by[1] == by[2]


def test_messages_against_enumeration():
    """Marginals of short chains equal the sums over all labellings."""
    rng = np.random.default_rng(4)
    sizes = np.array([1, 4, 2, 3])
    e, t = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    forward, backward = Q.Chains(sizes).messages(e, t)
    got, at = 1 / (1 + np.exp(-(forward + backward))), 0
    for n in sizes:
        weight = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            total = sum(e[at + k] * y[k] for k in range(n))
            weight[y] = np.exp(total + sum(t[a, b] for a, b in itertools.pairwise(y)))
        for k in range(n):
            good = sum(w for y, w in weight.items() if y[k]) / sum(weight.values())
            assert got[at + k] == pytest.approx(good)
        at += n


def test_lines_of_the_fit_are_bounded(spark):
    """A labelled text with very many lines is not learnt; the rest is."""
    assert Q.within_lines([(1, 5, 60), (1, 3, 50), (1, 9, 50), (0, 1, 200), (0, 2, 100)], 100) == [
        (0, 2), (1, 3), (1, 9)]
    rows = [(k, "a fine line of words here\n" * 5 if k % 2 else "%%%% 9999 $$$$\n" * 5)
            for k in range(40)] + [(100, "%%%% 9999 $$$$\n" * 50_000)]
    docs = frame(spark, rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    args = (labels, "doc_id", "text", "quality", F.lit(True))
    bounded = Q.fit_quality(docs, *args, most_lines=1000)
    without = Q.fit_quality(docs.where("doc_id < 100"), *args)
    texts = [t for _, t in rows[:4]]
    assert np.allclose(bounded.scores(texts), without.scores(texts), atol=0.05)
    assert bounded.scores(texts)[1] > 0.5 > bounded.scores(texts)[0]
