"""The registered training-data queries against their SQL, and the pipeline against brute force."""

import duckdb
import numpy as np
import pytest
import sentencepiece

import corpus_pipeline as P
from isohyet.llm import decontaminate, pieces, quality_rules
from isohyet.llm.common import written
from isohyet.llm.registry import ORACLE, QUERIES
from test_minhash_dedup import _brute as near_brute
from test_substring_dedup import _exact

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = [df.columns.index(c) for c in cols]
    assert sorted(repr(tuple(r[i] for i in order)) for r in df.collect()) == sorted(map(repr, cur.fetchall()))


def test_names_and_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece"]


def test_stages_equal_brute_force(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in P.STAGES:
        out, _ = written(stage(spark, frames[-1], SF), f"test-{name}")
        if stage is not P.STAGES[-1][1]:
            assert out.columns == docs.columns
        frames.append(out)
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames]
    raw, clean, one, cut, free, last = texts

    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    assert set(clean) == kept
    assert set(one) == {d for d, (_, root) in near_brute(list(clean.items())).items() if d == root} and all(one[d] == clean[d] for d in one)

    need = _exact(list(one.items()))
    total = sum(map(len, need.values()))
    left = sum(max(0, len(cut.get(d, "").split()) - (len(one[d].split()) - len(n))) for d, n in need.items())
    assert total and left <= 0.01 * total  # what repeats word for word goes, but for a few words at edges

    items = [(str(r[0]), r[1]) for r in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    windows = set()
    for _, t in items:
        p = decontaminate.words(t)
        k = min(10, len(p))
        windows |= {tuple(p[i:i + k]) for i in range(len(p) - k + 1 if k else 0)}
    lengths = sorted({len(x) for x in windows})
    for d, t in cut.items():
        w = decontaminate.words(t)
        hit = {p for k in lengths for j in range(len(w) - k + 1) if tuple(w[j:j + k]) in windows for p in range(j, j + k)}
        if len(hit) == len(w):
            assert d not in free
        else:
            assert free[d] == decontaminate.cut_spans(t, decontaminate.spans_of(np.isin(np.arange(len(w)), sorted(hit))))

    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces.load_model(pieces.default_model_path()))
    rows = frames[-1].collect()
    assert {r.doc_id for r in rows} == set(free)
    for r in rows:
        assert r.ids == sp.encode(free[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_run_gives_the_same_rows(spark):
    out = P.run(spark, SF)
    assert out.columns[-3:] == ["ids", "n_tokens", "round_trip"] and out.count() > 50
