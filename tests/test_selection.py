import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isohyet.operators import selection as S
from isohyet.operators.panel import climatology_percentile


def table(seed, n=6000):
    rng = np.random.default_rng(seed)
    site = rng.choice(["hot"] * 6 + ["a", "b", "c"], n)
    v = np.select([rng.random(n) < 0.1, rng.random(n) < 0.3], [7.0, np.exp(rng.normal(0, 40, n))], rng.normal(0, 1, n))
    d = pd.DataFrame({"site": site, "m": rng.integers(1, 3, n), "v": v})
    d.loc[rng.random(n) < 0.05, "v"] = np.nan
    d.loc[d.index[:40], "site"] = None
    return d


def frame(spark, d):
    return spark.createDataFrame(d).withColumn("v", F.when(~F.isnan("v"), F.col("v")))


@pytest.mark.parametrize("p", [0.0, 0.2, 0.5, 0.987, 1.0])
def test_searched_groups_equal_the_plain_quantile(spark, p):
    """With at most 50 values in order at once, most groups are searched over several steps."""
    d = table(3)
    got = S.grouped_quantile(frame(spark, d), "v", ["site", "m"], p, "q", ordered_values=50).toPandas().set_index(["site", "m"])["q"]
    want = d.groupby(["site", "m"], dropna=False)["v"].quantile(p)
    assert len(got) == len(want)
    np.testing.assert_allclose(got.sort_index().to_numpy(), want.sort_index().to_numpy(), rtol=1e-12)


def test_weights_give_several_settings_at_once(spark):
    d = table(5, 3000)
    d["f"] = np.arange(len(d)) % 3
    df = frame(spark, d).where("v is not null")
    counts = df.groupBy("m", "v").agg(*[F.count(F.when(F.col("f") != i, 1)).alias(f"n{i}") for i in range(3)])
    got = S.weighted_quantiles(S.materialize(counts), ["m"], "v", ["n0", "n1", "n2"], [0.5, 0.9], ordered_values=40).toPandas().set_index("m")
    for i in range(3):
        for j, p in enumerate((0.5, 0.9)):
            want = d[d["f"] != i].groupby("m")["v"].quantile(p)
            np.testing.assert_allclose(got[f"q_n{i}_{j}"].sort_index(), want.sort_index(), rtol=1e-12)


def test_a_hot_group_is_dealt_over_tasks(spark):
    """A group with a third of the rows and continuous values: no task of the search reads it whole."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"), F.rand(4).alias("v"))
    df = S.materialize(df)
    counts = S.materialize(df.where("g = 0").groupBy("g", F.col("v").alias("_v")).agg(F.count(F.lit(1)).alias("n")))
    parts = spark.createDataFrame([(0, -1.0, 2.0, "")], "g long, _lo double, _hi double, _part string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in S._meet(counts, parts, ["g"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 10_000 and max(sizes) < 5_000
    got = S.grouped_quantile(df, "v", ["g"], 0.2, "ppt_pctl", ordered_values=500).where("g = 0").first()["ppt_pctl"]
    assert got == climatology_percentile(df, "v", ["g"], 20.0).where("g = 0").first()["ppt_pctl"]
    assert got == pytest.approx(np.quantile([r.v for r in df.where("g = 0").collect()], 0.2), rel=1e-12)


def test_edges(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert S.grouped_quantile(empty, "v", ["g"], 0.5).count() == 0
    one = spark.createDataFrame([("a", 1.0)] * 200 + [("b", None)] * 3 + [(None, 2.0)] * 90 + [(None, 4.0)] * 90, "g string, v double")
    got = {r.g: r.quantile for r in S.grouped_quantile(one, "v", ["g"], 0.5, ordered_values=1).collect()}
    assert got == {"a": 1.0, "b": None, None: 3.0}
