"""Profiling aggregates: schema, missingness, balance, correlations, histograms, summaries.

Each profile is ONE wide aggregate pass over the table (all columns in one ``agg``), then a
tiny unpivot of the one-row result via ``explode(array(struct...))``. No per-column jobs and
no driver loop over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import NUMERIC_TYPES

# Fixed values that must equal the reference's for identical results.
HIST_BINS = 40
HIST_COLUMNS = ("PRECTOTCORR", "T2M", "T2M_MIN", "T2M_MAX", "RH2M")
MIN_NONNULL_FOR_CORR = 3
EDA_EXCLUDE = ("LAT", "LON", "YEAR", "MONTH")


def _unpivot_row(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _null_share(c: str) -> Column:
    return F.avg(F.col(c).isNull().cast("double"))


def schema_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, na_frac), sorted by column."""
    cols = df.columns
    one = df.agg(*[_null_share(c).alias(f"_n{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(f"_n{i}").alias("na_frac"))
               for i, c in enumerate(cols)]
    return _unpivot_row(one, entries).orderBy("column")


def missingness_profile(df: DataFrame) -> DataFrame:
    """(feature, na_frac), most missing first; ties by name."""
    cols = df.columns
    one = df.agg(*[_null_share(c).alias(f"_n{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"_n{i}").alias("na_frac")) for i, c in enumerate(cols)]
    return _unpivot_row(one, entries).orderBy(F.desc("na_frac"), "feature")


def missing_fraction_avg(df: DataFrame) -> DataFrame:
    """Mean over columns of each column's null share, with the table's shape."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[_null_share(c).alias(f"_n{i}") for i, c in enumerate(cols)])
    mean = sum((F.col(f"_n{i}") for i in range(len(cols))), F.lit(0.0)) / F.lit(float(len(cols)))
    return one.select("n_rows", F.lit(len(cols)).cast("bigint").alias("n_cols"), mean.alias("avg_na_frac"))


def target_balance(df: DataFrame, target: str = "sequia") -> DataFrame:
    """(class, count, ratio) ordered by class. The per-class table has two rows."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select(target, "count", (F.col("count") / total).alias("ratio")).orderBy(target)


def eda_numeric_columns(df: DataFrame, target: str, group_col: str | None = "block_id",
                        date_col: str | None = "date") -> list[str]:
    ex = {target, *EDA_EXCLUDE}
    if group_col:
        ex.add(group_col)
    if date_col:
        ex.add(date_col)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def target_correlation(df: DataFrame, target: str = "sequia", cols: Sequence[str] | None = None) -> DataFrame:
    """Point-biserial (Pearson) correlation of each numeric column with the 0/1 target.

    Over the rows where both are non-null; null when the column has fewer than 3 non-null values or is
    constant. Sorted by |r| descending, nulls last. Two passes: counts and means, then the pairwise
    moments around them, added up in blocks of rows; only column-sized sums reach the driver.
    """
    import numpy as np

    from .gram import array_sum

    cols = list(cols) if cols is not None else eda_numeric_columns(df, target)
    spark = df.sparkSession
    schema = "feature string, corr_target double"
    if not cols:
        return spark.createDataFrame([], schema)
    y = F.col(target).cast("double")
    pair = [F.when(y.isNotNull(), F.col(c).cast("double")) for c in cols]
    first = df.agg(F.avg(y).alias("_y"), *[F.count(c).alias(f"_k{i}") for i, c in enumerate(cols)],
                   *[f(e).alias(f"_{n}{i}") for n, f in (("m", F.avg), ("lo", F.min), ("hi", F.max)) for i, e in enumerate(pair)]).first()
    missing = F.lit(float("nan"))
    around = F.array(*[F.coalesce(F.col(c).cast("double") - F.lit(float(first[f"_m{i}"] or 0.0)), missing) for i, c in enumerate(cols)])
    rows = df.where(y.isNotNull()).select(around.alias("_x"), (y - F.lit(float(first["_y"] or 0.0))).alias("_y"))
    k = len(cols)

    def moments(x, t):
        there = ~np.isnan(x)
        v, w = np.where(there, x, 0.0), there.astype(np.float64)
        return np.concatenate([w.sum(0), v.sum(0), (v * v).sum(0), w.T @ t, w.T @ (t * t), v.T @ t])

    n, sx, sxx, sy, syy, sxy = array_sum(rows, "_x", ["_y"], 6 * k, moments).reshape(6, k)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    out = []
    for i, c in enumerate(cols):
        varied = first[f"_lo{i}"] != first[f"_hi{i}"] and vx[i] > 0 and vy[i] > 0
        enough = first[f"_k{i}"] >= MIN_NONNULL_FOR_CORR
        out.append((c, float((n[i] * sxy[i] - sx[i] * sy[i]) / np.sqrt(vx[i] * vy[i])) if varied and enough else None))
    return spark.createDataFrame(out, schema).orderBy(F.abs("corr_target").desc_nulls_last(), "feature")


def topk_by_abs_corr(corr: DataFrame, k: int = 30) -> DataFrame:
    """First k rows by |r| (TakeOrdered: a bounded top-k, the feature)."""
    return corr.orderBy(F.abs("corr_target").desc_nulls_last(), "feature").limit(k)


def correlation_matrix_topk(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Median-impute the features, then the full Pearson matrix in long form (a, b, r).

    Two passes over the table: medians, then the Gram matrix of the median-centred values (centring
    keeps the moment formula well conditioned), added up in blocks of rows and in a tree of tasks.
    Only those feature-sized sums reach the driver. A constant column gives null.
    """
    import numpy as np

    from ..ml.prep import column_medians
    from .gram import gram

    feats = list(features)
    k = len(feats)
    spark = df.sparkSession
    schema = "feature_a string, feature_b string, r double"
    if k == 0:
        return spark.createDataFrame([], schema)
    med = column_medians(df, feats)
    d = [F.coalesce(F.col(c).cast("double") - F.lit(float(med[c])), F.lit(0.0)) if med[c] is not None
         else F.lit(0.0) for c in feats]
    n, sums, products = gram(df.select(F.array(*d).alias("_d")), "_d", k)
    if n == 0:
        return spark.createDataFrame([(a, b, None) for a in feats for b in feats], schema)
    mean = sums / n
    cov = products / n - np.outer(mean, mean)
    sd = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    out = []
    for i, a in enumerate(feats):
        for j, b in enumerate(feats):
            ok = sd[i] > 0 and sd[j] > 0 and cov[i, i] > 0 and cov[j, j] > 0
            out.append((a, b, float(cov[i, j] / (sd[i] * sd[j])) if ok else None))
    return spark.createDataFrame(out, schema)


def column_histogram(df: DataFrame, cols: Sequence[str] = HIST_COLUMNS, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins between each column's min and max, last bin closed; every bin kept.

    Bin edges are ``min + i * (max - min) / bins`` with the last edge exactly ``max``; a value
    goes to the bin whose half-open range holds it. Rows: (feature, bin, bin_lo, bin_hi, count).
    Columns absent from ``df`` or entirely null are skipped.
    """
    present = [c for c in cols if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "feature string, bin int, bin_lo double, bin_hi double, count bigint")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in present
    ])).alias("e")).select("e.*").where(F.col("v").isNotNull())
    mm = long.groupBy("feature").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    # a constant column gets the range (v - 0.5, v + 0.5), as numpy does
    rng = mm.select("feature",
                    F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                    F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    nb = F.lit(bins)
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    norm = F.lit(float(bins)) / (F.col("hi") - F.col("lo"))

    def edge(i: Column) -> Column:
        return F.when(i >= nb, F.col("hi")).otherwise(i.cast("double") * step + F.col("lo"))

    i0 = F.least(F.floor((F.col("v") - F.col("lo")) * norm).cast("int"), nb - 1)
    # exact placement against the edges (the scaled float can land one bin off)
    i1 = F.when(F.col("v") < edge(i0), i0 - 1).otherwise(i0)
    i2 = F.when((i1 != nb - 1) & (F.col("v") >= edge(i1 + 1)), i1 + 1).otherwise(i1)
    # the range table has one row per column: its size is bounded by the column list
    binned = long.join(F.broadcast(rng), "feature").select("feature", i2.alias("bin"))
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), nb - 1)).alias("bin"))
    out = grid.join(counts, ["feature", "bin"], "left")
    return out.select("feature", F.col("bin").cast("int").alias("bin"), edge(F.col("bin")).alias("bin_lo"),
                      edge(F.col("bin") + 1).alias("bin_hi"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def cv_summary(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std over folds per metric: rows (metric, mean, std)."""
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics
    ])).alias("e")).select(*by, "e.*")
    return long.groupBy(*by, "metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def importance_summary(df: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    """Mean / population std of per-fold importances, highest mean first."""
    return (df.groupBy(feature)
            .agg(F.avg(value).alias("importance_mean"), F.stddev_pop(value).alias("importance_std"))
            .orderBy(F.desc("importance_mean"), feature))
