import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from isohyet.functions.scalar import drop_leakage, month_start_date, spatial_block
from isohyet.operators.panel import add_features, enrich_left_join, event_label


def _panel(spark, rows):
    return spark.createDataFrame(rows, "LAT double, LON double, date date, x double, MONTH int")


def test_rolling_null_inside_window_and_lags_by_row(spark):
    d = [dt.date(2000, m, 1) for m in (1, 2, 3, 5, 6)]   # a gap at April: lags are by row
    rows = [(1.0, 2.0, d[i], v, d[i].month) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0])]
    out = add_features(_panel(spark, rows), ["x"], date_col="date", lags=(1, 2, 3), windows=(2,)).orderBy("date")
    pdf = out.toPandas()
    assert pdf["x__lag1"].tolist()[1:] == [1.0, 2.0, None, 4.0] or pdf["x__lag1"].isna().tolist() == [True, False, False, True, False]
    assert pdf.loc[4, "x__lag1"] == 4.0 and pdf.loc[3, "x__lag2"] == 2.0          # row-based, not calendar
    roll = pdf["x__roll2m"].tolist()
    assert np.isnan(roll[0]) and roll[1] == 1.5 and np.isnan(roll[2]) and np.isnan(roll[3]) and roll[4] == 4.5
    # past roll of 3 skips nulls among lag1..lag3
    assert pdf.loc[4, "x__roll_prev3m"] == (4.0 + 2.0) / 2


def test_constant_group_zscore_is_zero_and_null_keys_null(spark):
    rows = [(1.0, 1.0, dt.date(2000, 1, 1), 3.0, 1), (1.0, 1.0, dt.date(2000, 2, 1), 3.0, 2),
            (1.0, 1.0, dt.date(2000, 3, 1), None, 3),
            (None, 1.0, dt.date(2000, 1, 1), 9.0, 1), (None, 1.0, dt.date(2000, 2, 1), 5.0, 2)]
    out = add_features(_panel(spark, rows), ["x"], date_col=None).toPandas()
    good = out[out["LAT"].notna()]
    assert (good["x__z"] == 0.0).all()                       # constant group: 0 for every row, null x too
    assert out[out["LAT"].isna()]["x__z"].isna().all()       # null keys -> null


def test_past_rolls_ignore_current_and_future(spark):
    rng = np.random.default_rng(0)
    base = [(0.0, 0.0, dt.date(2000 + i // 12, i % 12 + 1, 1), float(rng.integers(0, 50)), i % 12 + 1) for i in range(30)]
    changed = [r if i < 20 else (r[0], r[1], r[2], r[3] + 1000.0, r[4]) for i, r in enumerate(base)]
    a = add_features(_panel(spark, base), ["x"], lags=(1, 2, 3), windows=(3,)).orderBy("date").toPandas()
    b = add_features(_panel(spark, changed), ["x"], lags=(1, 2, 3), windows=(3,)).orderBy("date").toPandas()
    # the row 20 past roll only sees rows 17..19, which did not change
    assert a.loc[20, "x__roll_prev3m"] == b.loc[20, "x__roll_prev3m"]
    assert a.loc[20, "x__roll3m"] != b.loc[20, "x__roll3m"]


def test_event_label_ties_count_and_null_is_zero(spark):
    rows = [(0.0, 0.0, dt.date(2000 + i, 1, 1), v, 1) for i, v in enumerate([1.0, 1.0, 2.0, 3.0, None])]
    out = event_label(_panel(spark, rows), value="x", keys=("LAT", "LON"), month_col="MONTH", p=20).orderBy("date")
    pdf = out.toPandas()
    assert np.isclose(pdf["ppt_pctl"].iloc[0], np.nanpercentile([1.0, 1.0, 2.0, 3.0], 20))
    assert pdf["sequia"].tolist() == [1, 1, 0, 0, 0]


def test_left_join_keeps_rows_and_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1, 10.0), (None, 30.0), (1, 11.0)], "k long, w double")
    out = enrich_left_join(left, right, ["k"]).toPandas()
    assert len(out) == 4                                      # key 1 fans out, key 2 kept with null
    assert set(out[out["v"] == "c"]["w"]) == {30.0}           # null matches null


def test_spatial_block_values(spark):
    df = spark.createDataFrame([(13.75, -92.25), (None, 1.0)], "LAT double, LON double")
    out = df.select(spatial_block("LAT", "LON", 50.0).alias("b50"), spatial_block("LAT", "LON", 100.0).alias("b100")).collect()
    assert out[0]["b50"] == "230_189" and out[0]["b100"] == "115_94"
    assert out[1]["b50"] is None


def test_month_start_and_leakage(spark):
    df = spark.createDataFrame([(2001, 7)], "YEAR long, MONTH long").select(month_start_date().alias("d"))
    assert df.first()["d"] == dt.date(2001, 7, 1)
    cols = ["precip", "precip__z", "precip__roll3m", "precip__roll_prev3m", "ppt_pctl", "n_obs"]
    d2 = spark.createDataFrame([tuple(float(i) for i in range(6))], ", ".join(f"{c} double" for c in cols))
    assert drop_leakage(d2).columns == ["precip__roll_prev3m", "n_obs"]


def _site_panel(spark, seed=9, null_key=True):
    rng = np.random.default_rng(seed)
    rows = []
    for site in range(3):
        months = sorted(rng.choice(60, size=40, replace=False))          # gaps in the calendar
        for m in map(int, months):
            v = None if rng.random() < 0.15 else float(rng.integers(0, 20))
            rows.append((float(site), 0.0, dt.date(2000 + m // 12, m % 12 + 1, 1), v, m % 12 + 1))
    if null_key:
        rows.append((None, 0.0, dt.date(2001, 1, 1), 3.0, 1))
    return _panel(spark, rows)


def _rounded(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_features_do_not_depend_on_runs_or_partitions(spark):
    """Against plain windows over a whole site, with many runs a site and with 4 and 400 partitions."""
    from isohyet.operators import panel as P

    lags = (1, 2, 3, 4, 5, 6)
    df = _site_panel(spark)
    z = P.zscore_by_group(df, ["x"], ["LAT", "LON"])
    want = z.select("*", *P.lag_columns(["x"], ["LAT", "LON"], ["date"], lags), *P.rolling_mean_columns(["x"], ["LAT", "LON"], ["date"]),
                    *P.rolling_mean_past_columns(["x"], ["LAT", "LON"], ["date"], lags))
    got = add_features(df, ["x"], lags=lags, run_rows=7)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert _rounded(got) == _rounded(want)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "400")
        assert _rounded(add_features(df, ["x"], lags=lags, run_rows=7)) == _rounded(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_site_decimals_and_an_integer_order_column(spark):
    n = 500
    df = spark.createDataFrame([(1.0, 2.0, i, i * 3 % 101) for i in range(n)], "LAT double, LON double, t int, v int") \
        .select("LAT", "LON", "t", F.col("v").cast("decimal(10,2)").alias("x"))
    out = add_features(df, None, date_col="t", lags=(1, 2, 3), windows=(3,), run_rows=50)
    assert [t for c, t in out.dtypes if c in ("x", "x__lag1")] == ["decimal(10,2)"] * 2
    rows = out.orderBy("t").collect()
    assert len(rows) == n and all(rows[i].x__lag2 == rows[i - 2].x for i in range(2, n)) and rows[1].x__lag2 is None
    assert all(abs(float(rows[i].x__roll3m) - sum(float(rows[j].x) for j in (i, i - 1, i - 2)) / 3) < 1e-4 for i in range(2, n))


def test_a_hot_site_with_a_text_order_column_is_dealt_over_ranges(spark):
    from isohyet.operators.ordered import number_rows

    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("LAT"), F.lit(0.0).alias("LON"),
                               F.concat(F.lit("é-"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("when"), F.col("id").cast("double").alias("x"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = number_rows(df, ["LAT", "LON"], ["when"])
        parts = [spark.read.parquet(f).where("LAT = 0").count() for f in rows.inputFiles() if "/ordered-" in f]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(parts) == -(-n // 3) and sum(p > 0 for p in parts) > 1
    hot = [r.x for r in rows.where("LAT = 0").orderBy("_rn").collect()]
    assert hot == [float(i) for i in range(0, n, 3)]
    out = add_features(df, ["x"], date_col="when", lags=(1,), windows=(3,), run_rows=100).where("LAT = 0").orderBy("when").collect()
    assert out[0]["x__lag1"] is None and all(r["x__lag1"] == r.x - 3 for r in out[1:]) and all(r["x__roll3m"] == r.x - 3 for r in out[2:])


def test_null_dates_fail(spark):
    import pytest

    df = _panel(spark, [(0.0, 0.0, None, 1.0, 1)])
    with pytest.raises(Exception, match="without a value in the order column"):
        add_features(df, ["x"]).count()


def test_all_null_values_fail(spark):
    import pytest

    df = spark.createDataFrame([(0.0, 0.0, 1, None)], "LAT double, LON double, MONTH int, x double")
    with pytest.raises(ValueError, match="null in every row"):
        event_label(df, value="x")


def test_month_from_date_when_no_month_column(spark):
    rows = [(0.0, 0.0, dt.date(2000 + i, 1 + (i % 2), 1), float(i), 1) for i in range(8)]
    df = _panel(spark, rows).drop("MONTH")
    out = event_label(df, value="x", month_col="MONTH", date_col="date", p=50).orderBy("date").toPandas()
    jan = out[out["date"].map(lambda d: d.month) == 1]
    assert np.isclose(jan["ppt_pctl"].iloc[0], np.percentile([0.0, 2.0, 4.0, 6.0], 50))


def test_parse_date_strict_rejects_bad_values(spark):
    import pytest

    from isohyet.functions.scalar import parse_date_strict
    assert parse_date_strict(spark.createDataFrame([("2001-02-01",)], "d string"), "d").where("d is not null").count() == 1
    with pytest.raises(ValueError):
        parse_date_strict(spark.createDataFrame([("2001-02-01",), (None,)], "d string"), "d")
    bad = spark.createDataFrame([("2001-02-01",), ("not a date",)], "d string")
    with pytest.raises(ValueError):
        parse_date_strict(bad, "d")
