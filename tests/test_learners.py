import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from isohyet.ml import isotonic as I
from isohyet.ml import smote as SM
from isohyet.ml import train as T
from isohyet.ml.l1 import fit_l1_logistic
from isohyet.ml.models import resolve_bins
from isohyet.ml.permute import parts_of
from isohyet.operators.gram import gram


def table(n=500, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.normal(size=n), rng.integers(0, 3, n).astype(float)
    y = (a + 0.5 * b + rng.normal(scale=0.7, size=n) > 0.6).astype(int)
    b[rng.random(n) < 0.1] = np.nan
    return pd.DataFrame({"row_id": np.arange(n), "g": rng.integers(0, 25, n), "a": a, "b": b, "c": c, "y": y})


def frame(spark, d):
    return spark.createDataFrame(d).withColumn("b", F.when(~F.isnan("b"), F.col("b")))


# ---- SMOTE neighbours

@pytest.mark.parametrize("n", [2_000, 4_000, 8_000])
def test_recall_past_the_depth_limit(spark, n):
    """Eight leaves at most: parts are slices of them, and refinement finds what the slices cut apart."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 16)) + rng.integers(0, 5, (n, 1))
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(n), "x": list(x)}))
    lists = SM.neighbour_lists(pts, 5, leaf_rows=64, max_depth=3)
    got = SM.measure_recall(pts, lists, 5, queries=150).first()
    assert got["queries"] == 150 and got["recall"] >= 0.9


def odd_points(n, dims, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[:9] *= 1e4                                 # far from all others
    x[20:60] = x[20]                             # more equal rows than neighbours asked for
    x[70:80] = x[80] + rng.normal(size=(10, dims)) * 1e-9
    return x


def all_pairs(x, k):
    d = np.sqrt(np.stack([((x - row) ** 2).sum(1) for row in x]))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


def by_row(lists):
    return [[(e["_d"], e["_j"]) for e in r["nn"]] for r in lists.orderBy("_i").collect()]


@pytest.mark.parametrize("n", [900, 4_000])
def test_neighbours_are_exact_below_and_past_a_leaf(spark, n):
    x = odd_points(n, 28, n)
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(n), "x": list(x)}))
    got = by_row(SM.neighbour_lists(pts, 5))
    assert np.allclose([[e[0] for e in nn] for nn in got], all_pairs(x, 5), rtol=1e-12, atol=0)
    assert all(len({e[1] for e in nn} - {i}) == 5 for i, nn in enumerate(got))


def test_the_forest_does_not_decide_what_is_found(spark):
    n, x = 1_500, odd_points(1_500, 6, 2)
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(n), "x": list(x)}))
    whole = by_row(SM.neighbour_lists(pts, 4, leaf_rows=2_048))
    assert by_row(SM.neighbour_lists(pts, 4, leaf_rows=16, trees=1)) == whole
    assert by_row(SM.neighbour_lists(pts, 4, leaf_rows=64, refinements=1)) == whole
    none = pts.where("false").select("_i", F.array().cast("array<struct<_d:double,_j:bigint>>").alias("nn"))
    for rows in (100, 4_096):  # many blocks that meet, or one; no reach is known
        assert by_row(SM.nearest_of_all(pts, none, 4, x[::10], n, block_rows=rows)) == whole


def test_few_or_unknown_coordinates_do_not_lose_rows(spark):
    x = odd_points(300, 3, 5)
    x[100, 1] = np.nan
    for n in (1, 4, 300):
        pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(n), "x": list(x[-n:])}))
        got = by_row(SM.neighbour_lists(pts, 5))
        assert [len(nn) for nn in got] == [min(5, n - 1)] * n
    d = all_pairs(np.delete(x, 100, axis=0), 5)
    assert np.allclose([[e[0] for e in nn] for i, nn in enumerate(got) if i != 100], d, rtol=1e-12, atol=0)


def test_measured_recall_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(300), "x": list(x)}))
    lists = SM.neighbour_lists(pts, 4)
    assert SM.measure_recall(pts, lists, 4, queries=50).first()["recall"] == 1.0
    half = lists.withColumn("nn", F.slice("nn", 1, 2))
    assert SM.measure_recall(pts, half, 4, queries=50).first()["recall"] == 0.5
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    nearest = {r["_i"]: r["nn"][0]["_d"] for r in lists.collect()}
    assert all(nearest[i] == pytest.approx(d[i].min()) for i in range(300))


def test_equal_rows_do_not_all_name_the_same_neighbours(spark):
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(400), "x": [[1.0, 2.0]] * 400}))
    got = SM.knn_minority(pts, 3).toPandas()
    assert (got["_d"] == 0).all() and got["_j"].value_counts().max() < 40


# ---- L1

def l1_objective(x, y, w, c, beta):
    m = np.hstack([x, np.ones((len(x), 1))]) @ beta
    return np.abs(beta).sum() + c * (w * np.logaddexp(0, -(2 * y - 1) * m)).sum()


@pytest.mark.parametrize("c", [0.02, 1.0])
def test_l1_objective_equals_a_direct_minimiser(spark, c):
    rng = np.random.default_rng(4)
    n, d = 300, 6
    x = rng.normal(size=(n, d))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=n) > 0.8).astype(float)
    w = np.where(y == 1, 1.7, 0.8)
    df = spark.createDataFrame(pd.DataFrame({"x": list(x), "y": y, "w": w})).repartition(7)
    coef, b, value = fit_l1_logistic(df, "x", "y", "w", d, c)
    beta, z, t = np.zeros(d + 1), np.zeros(d + 1), 1.0
    x1 = np.hstack([x, np.ones((n, 1))])
    step = 1.0 / (c * 0.25 * np.linalg.eigvalsh((x1 * w[:, None]).T @ x1).max())
    for _ in range(6000):  # accelerated proximal gradient, directly
        g = c * x1.T @ (w * (1 / (1 + np.exp(-x1 @ z)) - y))
        u = z - step * g
        new = np.sign(u) * np.maximum(np.abs(u) - step, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - beta)
        beta, t = new, t2
    want = l1_objective(x, y, w, c, beta)
    assert l1_objective(x, y, w, c, np.r_[coef, b]) == pytest.approx(value, rel=1e-12)
    assert value <= want * (1 + 1e-6) and value >= want * (1 - 1e-6)


def test_l1_on_an_empty_table_and_gram(spark):
    empty = spark.createDataFrame([], "x array<double>, y double, w double")
    assert fit_l1_logistic(empty, "x", "y", "w", 2)[2] == 0.0 and gram(empty, "x", 2)[0] == 0
    x = np.random.default_rng(0).normal(size=(500, 3))
    n, s, p = gram(spark.createDataFrame(pd.DataFrame({"x": list(x)})).repartition(80), "x", 3)  # two steps of the tree
    assert n == 500 and np.allclose(s, x.sum(0)) and np.allclose(p, x.T @ x)


def test_l1_model_scores_and_importances(spark):
    df = frame(spark, table())
    m = T.fit_model(df, ["a", "b", "c"], "y", "row_id", T.ModelSpec("l1", {"C": 0.5}, sampler="class_weight", calibration=None))
    assert m.transform(df).where("prob between 0 and 1").count() == 500
    imp = T.feature_importance_cv(df, ["a", "b", "c"], "y", "row_id", group_col="g", k=3, method="l1").toPandas().set_index("feature")
    assert imp["importance_mean"]["a"] > imp["importance_mean"]["c"]


# ---- isotonic

def pav(y, w):
    out = []
    for v, u in zip(y, w):
        out.append([v * u, u, 1])
        while len(out) > 1 and out[-2][0] / out[-2][1] >= out[-1][0] / out[-1][1]:
            b = out.pop()
            out[-1] = [out[-1][0] + b[0], out[-1][1] + b[1], out[-1][2] + b[2]]
    return np.concatenate([[t / u] * k for t, u, k in out])


@pytest.mark.parametrize("kind", ["noise", "rising", "falling", "steps"])
def test_hierarchical_pooling_equals_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    n = 700
    s = np.sort(rng.random(n))
    p = {"noise": np.full(n, 0.4), "rising": s, "falling": 1 - s, "steps": np.floor(s * 5) / 5}[kind]
    w = rng.integers(1, 5, n).astype(float)
    pos = rng.binomial(w.astype(int), p).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "total": pos, "weight": w})).repartition(5)
    pools = I.pooled_scores(df, range_rows=40).toPandas().sort_values("lo").reset_index(drop=True)  # 18 ranges, five levels
    want = pav(pos / w, w)
    got = np.empty(n)
    for r in pools.itertuples():
        got[(s >= r.lo) & (s <= r.hi)] = r.total / r.weight
    assert np.allclose(got, want) and (np.diff(pools["total"] / pools["weight"]) > 0).all()
    model = I.fit_isotonic(df, "s", "cal", range_rows=40)
    cal = model.transform(spark.createDataFrame(pd.DataFrame({"s": s}))).toPandas()["cal"]
    assert np.allclose(cal, want)


def test_isotonic_of_no_rows_and_of_null_scores(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0), (0.5, 1.0, 2.0), (0.5 + 1e-9, 0.0, 0.0)], "s double, total double, weight double")
    assert [tuple(r) for r in I.pooled_scores(df).collect()] == [(0.5, 0.5, 1.0, 2.0)]
    assert I.pooled_scores(df.limit(0)).count() == 0


# ---- permutation importance

class Opaque(Transformer):
    """Hides a pipeline, so that it is scored on unfolded rows."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def _transform(self, df):
        return self.model.transform(df)


@pytest.mark.parametrize("spec", [T.ModelSpec("rf", {"n_estimators": 7, "max_depth": 6}, sampler="none", calibration="isotonic", inner_cv=2),
                                  T.ModelSpec("gbm", {"n_estimators": 5, "max_depth": 3}, sampler="none", calibration="sigmoid", inner_cv=2),
                                  T.ModelSpec("l1", {}, sampler="class_weight", calibration=None)])
def test_permutation_importance_equals_scoring_unfolded_rows(spark, spec):
    df, feats = frame(spark, table(300)), ["a", "b", "c"]
    m = T.fit_model(df, feats, "y", "row_id", spec)
    assert parts_of(m) and parts_of(Opaque(m)) is None
    fast = T.permutation_importance(m, df, feats, "y", "row_id", n_repeats=2).toPandas().set_index(["metric", "feature"]).sort_index()
    slow = T.permutation_importance(Opaque(m), df, feats, "y", "row_id", n_repeats=2).toPandas().set_index(["metric", "feature"]).sort_index()
    assert len(fast) == 6 and np.allclose(fast, slow, atol=1e-9)


# ---- exact splits

def best_split(x, y):
    """The first split of an exhaustive Gini search: (feature, threshold)."""
    gini = lambda v: 1 - ((np.bincount(v, minlength=2) / len(v)) ** 2).sum()
    best = None
    for f in range(x.shape[1]):
        vals = np.unique(x[:, f])
        for t in (vals[1:] + vals[:-1]) / 2:
            left = x[:, f] <= t
            gain = gini(y) - left.mean() * gini(y[left]) - (~left).mean() * gini(y[~left])
            if min(left.sum(), (~left).sum()) >= 2 and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, t)
    return best[1:]


def test_exact_bins_split_where_an_exhaustive_search_does(spark):
    d = table(400, 9)
    d["b"] = d["b"].fillna(0.3)
    df, feats = spark.createDataFrame(d), ["a", "b", "c"]
    params = resolve_bins({"bins": "exact"}, df, feats)
    assert params["bins"] == 402
    spec = T.ModelSpec("rf", {"n_estimators": 1, "max_depth": 1, "max_features": None, "bins": "exact", "bootstrap": False}, sampler="none", calibration=None, scale=False)
    from isohyet.ml.permute import trees_of

    m = T.fit_model(df, feats, "y", "row_id", spec)
    feature, threshold = trees_of(spark, m.stages[2])[0][:2]
    f, t = best_split(d[feats].to_numpy(), d["y"].to_numpy())
    assert feature[0] == f and threshold[0] == pytest.approx(t)
    assert resolve_bins({"bins": 64}, df, feats) == {"bins": 64}


# ---- search

def test_race_stops_the_weaker_half_and_shares_folds(spark):
    df = frame(spark, table(240))
    trials, best = T.hyperparameter_search(df, ["a", "b"], "y", "row_id", kind="gbm", n_trials=4, group_col="g", k=3, sampler="none", race=True,
                                           space={"n_estimators": (2, 6, 2), "max_depth": (1, 2)})
    t = trials.toPandas()
    assert sorted(t["state"]) == ["done", "stopped", "stopped", "stopped"] and sorted(t["folds"]) == [1, 1, 2, 3]
    assert best["best_value"] == pytest.approx(t[t["state"] == "done"]["mean_pr_auc"].iloc[0])


def test_trials_of_a_fold_share_the_rows_they_are_fitted_on(spark, monkeypatch):
    names, write = [], T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, name="stage": (names.append(name), write(df, name))[1])
    df = frame(spark, table(120))
    trials, _ = T.hyperparameter_search(df, ["a", "b"], "y", "row_id", kind="gbm", n_trials=3, group_col="g", k=2, sampler="none",
                                        space={"n_estimators": (1, 2, 1), "max_depth": (1, 2)})
    assert set(trials.toPandas()["state"]) == {"done"}
    assert names.count("prepared") == names.count("train") == 2  # a fold, not a trial and fold


def test_refit_query_makes_the_panel_once(spark, monkeypatch):
    from isohyet.plans import ml_queries as Q

    rows = table(240).assign(sequia=lambda d: d["y"], block_id=lambda d: d["g"]).drop(columns=["y", "g"])
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(len(b))
            yield b

    df = frame(spark, rows).mapInPandas(seen, frame(spark, rows).schema)
    monkeypatch.setattr(Q, "model_frame", lambda spark, sf: df)
    monkeypatch.setattr(Q, "features", lambda df: ["a", "b"])
    assert Q.q_refit_from_best(spark, "").count() == 1
    assert made.value <= 2 * len(rows)  # the sizes of the groups, and the folds that all steps read


def test_search_query_runs_every_trial_over_all_folds_and_the_whole_space(spark, monkeypatch):
    from isohyet.ml.models import GBM_SPACE
    from isohyet.plans import ml_queries as Q

    draws, fits = [], []
    sample = T.sample_params

    def drawn(kind, rng, space=None):
        draws.append((kind, {**GBM_SPACE, **(space or {})}))
        return sample(kind, rng, space)

    class Known:  # a model that gives its rows the same score
        def transform(self, df):
            return df.withColumn("prob", F.lit(0.5))

    def fitted(ready, features, label, spec, tag="0"):
        fits.append(json.dumps(spec.params, sort_keys=True))
        return Known()

    rows = table(240).assign(sequia=lambda d: d["y"], block_id=lambda d: d["g"]).drop(columns=["y", "g"])
    monkeypatch.setattr(Q, "model_frame", lambda spark, sf: frame(spark, rows))
    monkeypatch.setattr(Q, "features", lambda df: ["a", "b"])
    monkeypatch.setattr(T, "sample_params", drawn)
    monkeypatch.setattr(T, "fit_prepared", fitted)
    monkeypatch.setattr(T, "_uncalibrated", lambda base: base)
    monkeypatch.setattr(T.M, "ranking_metrics", lambda *a, **k: spark.range(1).select(F.lit(0.5).alias("pr_auc")))
    trials = Q.q_hyperparameter_search(spark, "").toPandas()
    assert draws == [("gbm", GBM_SPACE)] * 50  # the reference's trials and space
    assert set(trials["state"]) == {"done"} and (trials["folds"] == 5).all() and len(trials) == 50
    assert sorted(fits) == sorted(list(trials["params"]) * 5)


def test_a_time_limit_ends_running_trials_within_seconds(spark):
    df = frame(spark, table(240))
    T.hyperparameter_search(df, ["a"], "y", "row_id", kind="gbm", n_trials=1, k=2, sampler="none", space={"n_estimators": (1, 1, 1), "max_depth": (1, 1)})
    start = time.time()
    trials, best = T.hyperparameter_search(df, ["a", "b", "c"], "y", "row_id", kind="gbm", n_trials=3, group_col="g", k=3, sampler="none",
                                           timeout_s=6, space={"n_estimators": (3000, 3000, 100), "max_depth": (6, 6)})
    assert time.time() - start < 20 and best is None
    assert set(trials.toPandas()["state"]) == {"cancelled"}
    assert frame(spark, table(50)).count() == 50  # the session goes on
    none, best = T.hyperparameter_search(df, ["a"], "y", "row_id", kind="rf", n_trials=2, k=2, timeout_s=0.0)
    assert best is None and none.count() == 2 and array_to_vector is not None


# ---- queries

def test_neighbour_query_equals_brute_force(spark):
    """Up to a leaf the search is exact: every minority row of the small table, against all others."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from isohyet.ml.prep import standardize
    from isohyet.plans import ml_queries as Q

    sf = "/root/testdata/sf0.001"
    got = Q.q_smote_neighbours(spark, sf).toPandas().set_index("row_id").sort_index()
    df = Q.model_frame(spark, sf)
    feats = Q.features(df)
    scaled = VectorAssembler(inputCols=feats, outputCol="f").transform(standardize(df, feats).transform(df))
    d = scaled.where("sequia = 1").select("row_id", vector_to_array("f").alias("x")).toPandas().sort_values("row_id")
    x = np.stack(d["x"].to_numpy())
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(dist, np.inf)
    near = np.sort(dist, axis=1)[:, :5]
    assert list(got.index) == list(d["row_id"]) and (got["n_neighbours"] == 5).all()
    assert np.allclose(got["nearest"], near[:, 0]) and np.allclose(got["farthest"], near[:, -1])
