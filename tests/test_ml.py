import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from isohyet.ml.smote import _coder, _within, knn_minority, refine, smote
from isohyet.ml.train import ModelSpec, fit_model, load_model, save_model, score
from isohyet.session import materialize


def _knn_recall(spark, n, dims, k=5, **kw):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, dims)) + rng.integers(0, 4, (n, 1)) * 2.0
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(n), "x": list(x)}))
    got = knn_minority(pts, k, **kw).toPandas().groupby("_i")["_j"].apply(set)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2) if n <= 500 else (x * x).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * x @ x.T
    np.fill_diagonal(d, np.inf)
    want = np.argpartition(d, k, axis=1)[:, :k]
    return np.mean([len(got[i] & set(want[i].tolist())) / k for i in range(n)])


def test_neighbours_are_exact_up_to_a_leaf_and_recall_is_high_beyond(spark):
    assert _knn_recall(spark, 400, 6) == 1.0
    assert _knn_recall(spark, 2400, 24, leaf_rows=512) > 0.9


def test_tied_points_do_not_make_a_large_part(spark):
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(900), "x": [[1.0, 2.0]] * 900}))
    got = knn_minority(pts, 3, leaf_rows=64, trees=2).toPandas()
    assert (got["_d"] == 0).all() and (got.groupby("_i").size() == 3).all() and len(got) == 2700


def test_refinement_by_bytes_loses_no_nearer_row_and_sends_few_on(spark):
    rng = np.random.default_rng(3)
    n, k, keep = 500, 8, 3
    x = rng.normal(size=(n, 12)) + rng.integers(0, 3, (n, 1)) * 2.0
    x[:5] *= 40.0                                # far outside the range of the bytes
    x[5:9] = x[9]                                # equal rows
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    near = [rng.choice(np.argsort(d[i] + (np.arange(n) == i) * 1e9)[:40], k, replace=False) for i in range(n)]
    lists = [sorted((float(d[i, j]), int(j)) for j in near[i]) for i in range(n)]
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(n), "x": list(x)}))
    given = spark.createDataFrame([(i, lists[i]) for i in range(n)], "_i long, nn array<struct<_d:double,_j:bigint>>")
    sample = x[100:300]
    got = {r["_i"]: [(e["_d"], e["_j"]) for e in r["nn"]][:keep] for r in refine(pts, given, k, sample, keep).collect()}
    for i in range(n):
        reached = {j for j in near[i]} | {m for j in near[i] for m in near[j] if m != i}
        want = sorted((d[i, j], int(j)) for j in reached)[:keep]
        assert np.allclose([e[0] for e in got[i]], [e[0] for e in want], rtol=1e-12)
    step = (sample.max(0) - sample.min(0)) / 255.0
    c = next(_coder(sample.min(0), step)(iter([pd.DataFrame({"_i": np.arange(n), "x": list(x)})])))["_c"].tolist()
    rows = pa.RecordBatch.from_arrays([
        pa.array([i for i in range(n) for _ in near[i]], pa.int64()), pa.array([lists[i][keep - 1][0] for i in range(n) for _ in near[i]]),
        pa.array([c[i] for i in range(n) for _ in near[i]], pa.binary()),
        pa.array([[{"_n": int(m), "_c": c[m]} for m in near[j]] for i in range(n) for j in near[i]], pa.list_(pa.struct([("_n", pa.int64()), ("_c", pa.binary())])))],
        names=["_i", "_reach", "_c", "_far"])
    sent = sum(b.num_rows for b in _within(step)(iter([rows])))
    assert 0 < sent < n * k * k // 2


def test_smote_balances_inside_minority_box(spark):
    rng = np.random.default_rng(4)
    n_maj, n_min = 300, 40
    x = np.vstack([rng.normal(0, 1, (n_maj, 3)), rng.normal(3, 0.5, (n_min, 3))])
    y = np.r_[np.zeros(n_maj, int), np.ones(n_min, int)]
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(len(y)), "x": list(x), "label": y})) \
        .select("row_id", array_to_vector("x").alias("features"), "label")
    out = smote(df, "features", "label", "row_id", k=5, seed=1)
    pdf = out.select("label", "_synthetic", vector_to_array("features").alias("x")).toPandas()
    assert (pdf["label"] == 1).sum() == n_maj and (pdf["label"] == 0).sum() == n_maj
    syn = np.stack(pdf[pdf["_synthetic"]]["x"].to_numpy())
    mino = x[n_maj:]
    assert (syn >= mino.min(0) - 1e-9).all() and (syn <= mino.max(0) + 1e-9).all()


def test_calibrated_model_roundtrip_and_monotone(spark, tmp_path):
    rng = np.random.default_rng(6)
    n = 400
    a = rng.normal(size=n)
    y = (a + rng.normal(scale=0.8, size=n) > 0.8).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n), "a": a, "b": rng.normal(size=n), "y": y}))
    spec = ModelSpec("rf", {"n_estimators": 5, "max_depth": 3}, sampler="smote", calibration="isotonic", inner_cv=2)
    m = fit_model(df, ["a", "b"], "y", "row_id", spec)
    path = str(tmp_path / "m")
    save_model(m, path, ["a", "b"], {"k": 1})
    m2, cols, meta = load_model(path)
    s1 = score(m, df, cols).select("row_id", "prob_sequia").toPandas().sort_values("row_id")
    s2 = score(m2, df.withColumn("extra", F.lit(1)), cols).select("row_id", "prob_sequia", "`pred_sequia_th_0.50`")
    s2 = s2.toPandas().sort_values("row_id")
    assert np.allclose(s1["prob_sequia"], s2["prob_sequia"]) and meta == {"k": 1}
    assert s2["prob_sequia"].between(0, 1).all()


def test_streaming_scoring_matches_batch(spark, tmp_path):
    from isohyet.streaming.score_stream import start_scoring

    rng = np.random.default_rng(8)
    n = 200
    pdf = pd.DataFrame({"row_id": np.arange(n), "a": rng.normal(size=n), "y": (rng.random(n) < 0.3).astype(int)})
    df = spark.createDataFrame(pdf)
    m = fit_model(df, ["a"], "y", "row_id", ModelSpec("rf", {"n_estimators": 3, "max_depth": 2}, sampler="none",
                                                        calibration=None))
    mpath, src, sink = str(tmp_path / "m"), str(tmp_path / "in"), str(tmp_path / "out")
    save_model(m, mpath, ["a"])
    df.write.parquet(src)
    q = start_scoring(spark, mpath, src, sink, df.schema, name="t_score", checkpoint=str(tmp_path / "ck"),
                      trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(sink).select("row_id", "prob_sequia").toPandas().sort_values("row_id")
    want = score(m, df, ["a"]).select("row_id", "prob_sequia").toPandas().sort_values("row_id")
    assert len(got) == n and np.allclose(got["prob_sequia"].to_numpy(), want["prob_sequia"].to_numpy())


def test_isolated_points_and_tiny_leaves_still_get_neighbours(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(size=(120, 4)), rng.normal(size=(4, 4)) + 1e4])
    pts = spark.createDataFrame(pd.DataFrame({"_i": np.arange(len(x)), "x": list(x)}))
    got = knn_minority(pts, 3, leaf_rows=8).toPandas()
    assert got.groupby("_i").size().min() >= 1 and got["_i"].nunique() == len(x) and (got["_i"] != got["_j"]).all()
    d = np.sqrt(((x[got["_i"]] - x[got["_j"]]) ** 2).sum(1))
    assert np.allclose(d, got["_d"])


def test_scores_of_a_forest_can_be_written_after_the_session_used_job_tags(spark):
    # the session's tag state cannot be serialized; a fitted forest must not carry the session to the tasks
    rng = np.random.default_rng(8)
    a = rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(200), "a": a, "y": (a > 0.5).astype(int)}))
    spark.addTag("some-job")
    try:
        for calibration in (None, "isotonic"):
            spec = ModelSpec("rf", {"n_estimators": 3, "max_depth": 2}, sampler="none", calibration=calibration, inner_cv=2)
            m = fit_model(df, ["a"], "y", "row_id", spec)
            assert materialize(m.transform(df).groupBy("y").agg(F.avg("prob").alias("p"))).count() == 2
    finally:
        spark.removeTag("some-job")
