"""Language identification and ordinal quality: held-out accuracy, edges, gradients."""

import numpy as np
import pandas as pd

from isohyet.llm import language_id as L
from isohyet.llm import ordinal_quality as O

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    got = L.op9_language_id(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/documents.parquet"), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all() and len(got) == 1000


def test_language_edges(spark):
    rows = [("en", "the cat sat on the mat"), ("de", "die katze sitzt auf der matte"), (None, "xx yy"), ("fr", None), ("es", "12 34")]
    model = L.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert model.langs == ["de", "en"]
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "12 !?", 0), (4, "katzenmatten", 0), (5, "the mats", 0), (5, "the mats", 0), (6, "本語", 0)],
                                 "doc_id long, text string, score int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "de" and got[5][0] == "en" and got[6][0] in ("de", "en") and 0 < got[6][1] <= 1
    empty = L.learn(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in L.predict(docs, empty).collect()} == {"und"}
    assert L.predict(docs.limit(0), model).count() == 0


def test_rare_languages_keep_their_words_and_grams(spark, monkeypatch):
    """What is sent to the tasks is full of one hot language; the rest is found by joins, with equal scores."""
    rows = [("en", "the cat sat on the mat and the rat ran at the hat")] * 30 + [("da", "rugbrod med smor"), ("fi", "ruisleipa voilla"), ("sv", "limpa med smor")]
    docs = spark.createDataFrame([(1, "rugbrod smor"), (2, "ruisleipa voilla"), (3, "ruisleivat"), (4, "the cat"), (5, "limporna"), (6, "rugbrodet")], "doc_id long, text string")
    train = spark.createDataFrame(rows, "lang string, text string")
    whole = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, L.learn(train)).collect()}
    assert [whole[i][0] for i in range(1, 7)] == ["da", "fi", "fi", "en", "sv", "da"]
    monkeypatch.setattr(L, "KNOWN_WORDS", 5)
    monkeypatch.setattr(L, "KNOWN_GRAMS", 5)
    cut = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, L.learn(train)).collect()}
    assert {k: v[0] for k, v in cut.items()} == {k: v[0] for k, v in whole.items()}
    assert all(abs(cut[k][1] - whole[k][1]) < 1e-5 for k in whole)


def test_gradient_of_the_ordinal_loss():
    rng = np.random.default_rng(1)
    place = rng.integers(0, 20, 200)
    owner = np.sort(rng.integers(0, 30, 200))
    grade = rng.integers(0, 3, 30)
    x = rng.normal(0, 0.3, 22)
    _, g = O._loss(x, owner, place, grade, 2)
    for i in range(22):
        e = np.zeros(22)
        e[i] = 1e-5
        assert abs((O._loss(x + e, owner, place, grade, 2)[0] - O._loss(x - e, owner, place, grade, 2)[0]) / 2e-5 - g[i]) < 1e-3


def test_quality_of_held_out_documents(spark):
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    got = O.op3_ordinal_quality(spark, SF).toPandas()
    assert len(got) == 1000 and got["tail"].between(0, 1).all() and got.expected_grade.between(0, 2).all()
    m = got.merge(labels, on="doc_id")
    m = m[m.held_out]
    good = (m.quality == 1) & (m.toxic == 0)
    assert m.selected[good].mean() > 0.85 and m.expected_grade[good].mean() > m.expected_grade[~good].mean() + 0.4


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, ("good fine " if i % 3 else "vile rot ") * 5) for i in range(60)] + [(100, None), (101, "")], "doc_id long, text string")
    rated = spark.createDataFrame([(i, 2 if i % 3 else 0) for i in range(50)] + [(None, 1), (7, None), (999, 1)], "doc_id long, grade int")
    model, shares = O.learn(docs, rated)
    got = {r.doc_id: r for r in O.score(docs, model, shares).collect()}
    assert got[55].selected and not got[57].selected and got[57].lowest > got[55].lowest and 0 <= got[100].tail <= 1
    assert np.all(np.diff(model.cuts) > 0)
    model, shares = O.learn(docs, rated.where("grade = 2"))
    assert model is None and all(r.selected for r in O.score(docs, model, shares).collect())
    model, shares = O.learn(docs, rated.limit(0))
    assert not any(r.selected for r in O.score(docs, model, shares).collect())
