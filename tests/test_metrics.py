import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isohyet.operators import metrics as M


def _ap_brute(y, p):
    order = np.argsort(-p, kind="stable")
    ys, ps = y[order], p[order]
    P = ys.sum()
    ap, tp, fp, i = 0.0, 0, 0, 0
    while i < len(ps):
        j = i
        while j < len(ps) and ps[j] == ps[i]:
            j += 1
        dtp = ys[i:j].sum()
        tp += dtp
        fp += (j - i) - dtp
        ap += dtp / P * tp / (tp + fp)
        i = j
    return ap


def _auc_brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=6, max_size=60))
def test_ap_auc_match_brute_force_with_ties(spark, rows):
    y = np.array([r[0] for r in rows])
    p = np.array([r[1] / 6 for r in rows])
    if y.sum() == 0 or y.sum() == len(y):
        return
    df = spark.createDataFrame(pd.DataFrame({"y": y.astype(int), "prob": p}))
    r = M.ranking_metrics(df, n_blocks=None).first() if False else M.ranking_metrics(df).first()
    assert np.isclose(r["pr_auc"], _ap_brute(y, p))
    assert np.isclose(r["roc_auc"], _auc_brute(y, p))


def test_sweep_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.uniform(0, 1, 300), 2)                 # values on the threshold grid exercise >=
    df = spark.createDataFrame(pd.DataFrame({"y": y, "prob": p, "fold": rng.integers(0, 3, 300)}))
    sw = M.threshold_sweep(df, by=["fold"]).toPandas()
    for _, r in sw.iterrows():
        m = (df.toPandas()["fold"] == r["fold"]).to_numpy()
        th = r["threshold"]
        pred = p[m] >= th
        assert r["tp"] == int((pred & (y[m] == 1)).sum())
        assert r["fp"] == int((pred & (y[m] == 0)).sum())
    assert len(sw) == 3 * 91


def test_best_threshold_is_first_maximum(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [1, 1, 0, 0], "prob": [0.9, 0.8, 0.1, 0.05], "fold": 0}))
    best = M.threshold_by_fold(df, "fold", objective="f1").first()
    assert best["best_threshold"] == 0.11 and best["f1"] == 1.0


def test_reliability_edges_go_low(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [0, 1, 1], "prob": [0.1, 0.10000001, 1.0]}))
    bins = {r["bin"]: r["count"] for r in M.reliability_curve(df).collect()}
    assert bins == {0: 1, 1: 1, 9: 1}


def test_confusion_zero_division(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [0, 0], "prob": [0.1, 0.2]}))
    r = M.confusion_metrics(df, th=0.5).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0


def test_bad_scores_and_labels_fail_everywhere(spark):
    import pytest

    from isohyet.operators import metrics as M

    bad = [[(1, 0.5), (0, None)], [(1, 0.5), (0, float("nan"))], [(1, 0.5), (2, 0.1)], [(1, 0.5), (None, 0.1)]]
    for rows in bad:
        df = spark.createDataFrame(rows, "y int, prob double")
        for metric in (M.ranking_metrics, M.confusion_metrics, M.threshold_sweep, M.reliability_curve, M.brier_score, M.pr_curve):
            with pytest.raises(Exception, match="a score is null or NaN|a label is neither"):
                metric(df).collect()


def test_counts_past_the_range_of_a_long_product(spark):
    from isohyet.operators import metrics as M

    scores = spark.createDataFrame([(0.9, 4_000_000_000, 0), (0.5, 0, 9_000_000_000)], "score double, tp long, fp long")
    r = M.ranking_of_scores(scores).first()
    assert r.roc_auc == 1.0 and r.pr_auc == 1.0


def test_no_metric_plan_has_a_nested_loop_join(spark):
    from isohyet.operators import metrics as M

    df = spark.createDataFrame([(i % 2, i / 100) for i in range(100)], "y int, prob double")
    for f in (M.ranking_metrics, M.pr_curve, M.roc_curve, M.threshold_sweep, M.holdout_metrics):
        plan = f(df)._jdf.queryExecution().optimizedPlan().toString() + f(df)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sweep_with_a_fractional_step(spark):
    from isohyet.operators import metrics as M

    df = spark.createDataFrame([(i % 2, i / 40) for i in range(41)], "y int, prob double")
    got = M.threshold_sweep(df, min_pct=2.5, max_pct=50, step_pct=2.5).orderBy("threshold").collect()
    assert len(got) == 20
    for k, r in enumerate(got):
        th = (2.5 + k * 2.5) / 100
        assert r.threshold == th and r.tp == sum(1 for i in range(41) if i % 2 and i / 40 >= th)


def test_medians_are_exact(spark):
    import numpy as np

    from isohyet.ml.prep import column_medians

    rng = np.random.default_rng(3)
    a = [5.0] * 700 + rng.normal(size=301).tolist()                     # a hot value
    b = [1.0, 2.0, 3.0, 4.0] + [None] * 996 + [float("nan")]            # an even count
    c = (rng.normal(size=1001) * 10.0 ** rng.integers(-200, 200, 1001)).tolist()
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double").withColumn("d", __import__("pyspark").sql.functions.lit(None).cast("double"))
    got = column_medians(df, ["a", "b", "c", "d"])
    assert got == {"a": float(np.median(a)), "b": 2.5, "c": float(np.median(c)), "d": None}


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from isohyet import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Fake())


def test_a_best_record_is_needed_for_a_refit():
    import pytest

    from isohyet.ml import train as T

    spec = T.spec_of_best({"model": "rf", "best_params": {"rf_max_depth": 7, "gbm_subsample": 1}})
    assert spec.params == {"n_estimators": 400, "max_depth": 7, "min_samples_leaf": 2, "max_features": 0.8} and spec.sampler == "none"
    record = T.best_record("gbm", "smote", {"n_estimators": 9, "learning_rate": 0.1}, 0.5)
    assert T.spec_of_best(record).params["n_estimators"] == 9 and T.spec_of_best(record).sampler == "smote"
    for bad in ({}, {"kind": "rf", "params": {}}, {"model": "svm", "best_params": {}}):
        with pytest.raises(ValueError):
            T.spec_of_best(bad)
