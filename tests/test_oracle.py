import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
CHECK = ["event_label", "target_correlation", "column_histogram", "average_precision", "roc_auc",
         "threshold_by_fold", "group_kfold", "stratified_kfold", "sample_groups", "standardize",
         "read_panel", "select_columns", "isotonic_scores", "fold_statistics"]


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def n(v):
        return round(v, 6) + 0.0 if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHECK)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.columns == ["sequia", "count", "ratio"] and out.count() == 2


def test_every_query_has_a_name_and_oracles_are_a_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
