import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isohyet.ml import prep as P
from isohyet.operators import selection as S


def data(n=900):
    rng = np.random.default_rng(2)
    d = pd.DataFrame({"fold": rng.integers(0, 4, n), "a": np.round(rng.normal(3, 2, n), 2), "b": np.exp(rng.normal(0, 30, n)), "c": 5.0, "e": np.nan, "i": rng.integers(0, 3, n)})
    d.loc[rng.random(n) < 0.2, "a"] = np.nan
    d.loc[d["fold"] != 1, "e"] = np.where(rng.random((d["fold"] != 1).sum()) < 0.5, 1.5, np.nan)
    return d


@pytest.mark.parametrize("ordered", [10_000, 30])
def test_statistics_without_a_fold_equal_separate_fits(spark, monkeypatch, ordered):
    monkeypatch.setattr(S, "ORDERED_VALUES", ordered)
    d, cols = data(), ["a", "b", "c", "e", "i"]
    df = spark.createDataFrame(d)  # NaN is missing
    got = P.fold_statistics(df, cols, "fold", range(4))
    for f in range(4):
        train = d[d["fold"] != f]
        alone = P.fold_statistics(df.where(F.col("fold") != f), cols)[None]
        for c in cols:
            med = train[c].median()
            assert got[f].medians[c] == pytest.approx(med, rel=1e-12) == pytest.approx(alone.medians[c], rel=1e-12)
            filled = train[c].fillna(med)
            assert got[f].means[c] == pytest.approx(filled.mean(), rel=1e-9) and alone.means[c] == pytest.approx(got[f].means[c], rel=1e-12)
            assert got[f].deviations[c] == pytest.approx(filled.std(ddof=0), rel=1e-9, abs=1e-12)


def test_the_table_is_read_twice_for_all_folds_and_nothing_stays(spark, tmp_path, monkeypatch):
    import os

    from isohyet.session import ensure_checkpoint_dir

    reads = []
    real = S.materialize
    monkeypatch.setattr(P, "materialize", lambda df, name: reads.append(name) or real(df, name))
    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    P.fold_statistics(spark.createDataFrame(data(200)), ["a", "b"], "fold", range(4))
    assert reads == ["values"] and set(os.listdir(folder)) <= before


def test_empty_and_missing_columns(spark):
    empty = spark.createDataFrame([], "fold int, a double")
    s = P.fold_statistics(empty, ["a"], "fold", range(2))
    assert s[0].medians == {"a": None} and s[1].deviations == {"a": 0.0} and P.fold_statistics(empty, [])[None].means == {}
    df = spark.createDataFrame([(0, None), (1, 4.0), (None, 2.0)], "fold int, a double")
    s = P.fold_statistics(df, ["a"], "fold", range(2))  # a null fold is in every train set
    assert s[0].medians["a"] == 3.0 and s[1].medians["a"] == 2.0
    out = P.impute_scale_stage(["a"], s[1]).transform(df).select("a").collect()
    assert [r.a for r in out] == [0.0] * 3
