import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from isohyet.operators import profile as PR
from isohyet.operators import ranking as RK


def test_hash_rank_equals_global_window_rank(spark):
    df = spark.range(3000).withColumn("c", F.col("id") % 3)
    got = RK.hash_rank(df, "id", 7, strata=["c"], out="r", digits=2)
    ref = df.withColumn("h", RK.stable_hash("id", 7)).withColumn(
        "r2", F.row_number().over(Window.partitionBy("c").orderBy("h", "id")) - 1)
    j = got.join(ref, ["id", "c"])
    assert j.where(F.col("r") != F.col("r2")).count() == 0


def test_group_folds_never_split_and_balance(spark):
    rng = np.random.default_rng(3)
    g = rng.integers(0, 40, 2000)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "id": np.arange(2000)}))
    f = RK.group_kfold(df, "g", k=5).toPandas()
    assert (f.groupby("g")["fold"].nunique() == 1).all()
    sizes = f.groupby("fold").size()
    assert sizes.max() - sizes.min() <= np.bincount(g).max()


def greedy(sizes, k):
    """Each group to the lightest fold, one after the other."""
    loads, out = [0] * k, []
    for n in sizes:
        f = loads.index(min(loads))
        loads[f] += n
        out.append(f)
    return loads, out


def test_deal_by_size_runs_equals_the_greedy_deal():
    rng = np.random.default_rng(1)
    for _ in range(400):
        k = int(rng.integers(1, 8))
        sizes = sorted((int(x) for x in rng.choice([rng.integers(1, 6, 60), rng.integers(1, 300, 60), rng.geometric(0.2, 60)][rng.integers(3)], rng.integers(1, 60))), reverse=True)
        runs = [(s, sizes.count(s)) for s in sorted(set(sizes), reverse=True)]
        want = greedy(sizes, k)[1]
        got = []
        cycles = RK.deal_sizes(runs, k)
        for s, c in runs:
            mine = [x for x in cycles if x[0] == s]
            for r in range(c):
                _, start, folds = [x for x in mine if x[1] <= r][-1]
                got.append(folds[(r - start) % len(folds)])
        assert got == want
    assert len(RK.deal_sizes([(10 ** 6, 3), (7, 10 ** 12)], 5)) <= 10  # cycles, not groups


def test_group_folds_equal_the_greedy_deal_on_uneven_groups(spark):
    rng = np.random.default_rng(8)
    g = np.concatenate([np.full(n, i) for i, n in enumerate(np.concatenate([rng.integers(1, 9, 80), [500, 77, 77]]))])
    df = spark.createDataFrame(pd.DataFrame({"g": g, "id": np.arange(len(g))}))
    df = df.unionByName(spark.createDataFrame([(None, 1_000_000), (None, 1_000_001)], "g long, id long"))  # a null group is a group
    f = RK.group_kfold(df, "g", k=4).toPandas()
    sizes = f.groupby("g", dropna=False).size().sort_values(ascending=False)
    assert sorted(f.groupby("fold").size()) == sorted(greedy(list(sizes), 4)[0]) and len(f) == len(g) + 2
    assert (f.groupby("g", dropna=False)["fold"].nunique() == 1).all()


def test_sampling_sizes(spark):
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(100) % 10, "id": np.arange(100), "y": np.arange(100) % 4 == 0}))
    s = RK.sample_groups(df, "g", 0.35).toPandas()
    assert s["g"].nunique() == 3 and len(s) == 30
    st = RK.sample_stratified(df, "y", "id", 0.5).toPandas()
    half_up = lambda v: int(np.floor(v + 0.5))   # class sizes round half up (Spark / SQL round)
    assert (st["y"].sum(), len(st)) == (half_up(0.5 * 25), half_up(0.5 * 25) + half_up(0.5 * 75))


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(10, 3, 500), 1)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    h = PR.column_histogram(df, ["v"], 40).orderBy("bin").toPandas()
    counts, edges = np.histogram(v, bins=40)
    assert h["count"].tolist() == counts.tolist()
    assert np.allclose(h["bin_lo"], edges[:-1])


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0] * 5, "b": [1.0, 2, 3, 4, 6], "t": [0, 1, 0, 1, 1]}))
    r = {x["feature"]: x["corr_target"] for x in PR.target_correlation(df, "t", ["a", "b"]).collect()}
    assert r["a"] is None and np.isclose(r["b"], np.corrcoef([1, 2, 3, 4, 6], [0, 1, 0, 1, 1])[0, 1])


def test_target_correlation_pairs_nulls_and_constants(spark):
    rng = np.random.default_rng(12)
    n = 400
    d = pd.DataFrame({"y": (rng.random(n) < 0.3).astype(float), "a": rng.normal(1e6, 2, n), "c": 0.1, "few": np.nan, "b": rng.integers(0, 3, n).astype(float)})
    d.loc[rng.random(n) < 0.2, "a"] = np.nan
    d.loc[:9, "y"] = np.nan
    d.loc[:1, "few"] = [1.0, 2.0]
    df = spark.createDataFrame(d)
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns]).repartition(6)
    got = {r.feature: r.corr_target for r in PR.target_correlation(df, "y", ["a", "c", "few", "b"]).collect()}
    assert got["c"] is None and got["few"] is None
    assert np.isclose(got["a"], d["a"].corr(d["y"])) and np.isclose(got["b"], d["b"].corr(d["y"]))
    assert PR.target_correlation(df, "y", []).count() == 0 and PR.target_correlation(df.limit(0), "y", ["a"]).first().corr_target is None
