"""Train-fold preprocessing: median imputation, ddof-0 standardisation, class weights.

Statistics are computed on the TRAIN rows only and frozen into a ``SQLTransformer`` whose statement
carries them as literals, so the fitted stage is a built-in, persistable, codegen'd projection.
Spark's own ``Imputer`` returns a data point for the median and ``StandardScaler`` uses the sample
std; neither matches the reference, hence this stage.

A cross-validation needs K sets of statistics, each without one fold. ``fold_statistics`` takes all of
them from one count of the values, with a weight column a train set, and one table of moments a fold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.selection import weighted_quantiles
from ..session import materialize, temporary_tables


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class Statistics:
    """What a train set gives a column: its median (None: no value), and mean and ddof-0 deviation after imputation."""

    medians: dict[str, float | None]
    means: dict[str, float]
    deviations: dict[str, float]


def _value(c: str):
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _train_medians(df: DataFrame, cols: list[str], fold: str | None, folds: list) -> dict:
    """{fold: {column: median of the rows outside that fold}}; without a fold column, {None: ...} of all rows."""
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _value(c).alias("v")) for i, c in enumerate(cols)])).alias("e")
    values = df.select(entry, (F.col(fold) if fold else F.lit(None)).alias("f")).select("e.*", "f").where("v is not null")
    train = [F.count(F.lit(1)).alias("n0")] if fold is None else [
        F.count(F.when(~F.col("f").eqNullSafe(F.lit(x)), F.lit(1))).alias(f"n{k}") for k, x in enumerate(folds)]
    counts = materialize(values.groupBy("i", "v").agg(*train), "values")
    names = [f"n{k}" for k in range(len(train))]
    rows = {r["i"]: r for r in weighted_quantiles(counts, ["i"], "v", names, [0.5]).collect()}   # one row a column
    return {x: {c: rows[i][f"q_n{k}_0"] if i in rows else None for i, c in enumerate(cols)} for k, x in enumerate(folds if fold else [None])}


def _together(parts: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Mean and ddof-0 deviation of the union of parts (rows, mean, squared deviations from it)."""
    n = mean = m2 = 0.0
    for rows, mu, sq in parts:
        if rows:
            d = mu - mean
            m2 += sq + d * d * n * rows / (n + rows)
            mean += d * rows / (n + rows)
            n += rows
    return (mean, math.sqrt(m2 / n)) if n else (0.0, 0.0)


def fold_statistics(df: DataFrame, cols: Sequence[str], fold: str | None = None, folds: Sequence = ()) -> dict:
    """{f: Statistics of the rows whose ``fold`` is not f} for all f; without a fold column, {None: of all rows}.

    The table is read twice, however many folds there are: once to count values, once for the moments
    of each fold. Rows with a null fold belong to every train set. Nulls and NaN are missing.
    """
    cols, folds = list(cols), list(folds)
    keys = folds if fold else [None]
    if not cols:
        return {f: Statistics({}, {}, {}) for f in keys}
    with temporary_tables(df.sparkSession):
        medians = _train_medians(df, cols, fold, folds)
    moments = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        moments += [F.count(_value(c)).alias(f"_c{i}"), F.avg(_value(c)).alias(f"_a{i}"), F.var_pop(_value(c)).alias(f"_v{i}")]
    by_fold = df.groupBy(*([F.col(fold).alias("_f")] if fold else [])).agg(*moments).collect()   # one row a fold
    out = {}
    for f in keys:
        train = [r for r in by_fold if not fold or r["_f"] is None or r["_f"] != f]
        stats = Statistics(medians[f], {}, {})
        for i, c in enumerate(cols):
            missing = sum(r["_n"] - r[f"_c{i}"] for r in train)
            parts = [(float(r[f"_c{i}"]), r[f"_a{i}"], r[f"_v{i}"] * r[f"_c{i}"]) for r in train if r[f"_c{i}"]]
            stats.means[c], stats.deviations[c] = _together([*parts, (float(missing), medians[f][c] or 0.0, 0.0)])
        out[f] = stats
    return out


def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact interpolated medians of all columns, nulls and NaN skipped, at every size (see ``selection.py``)."""
    cols = list(cols)
    if not cols:
        return {}
    with temporary_tables(df.sparkSession):
        return _train_medians(df, cols, None, [])[None]


def impute_scale_stage(cols: Sequence[str], stats: Statistics, scale: bool = True, suffix: str = "") -> SQLTransformer:
    """The frozen stage: fill with the median, then (x - mean) / deviation when asked.

    An all-null column imputes to 0.0; a constant column scales to 0.0. Outputs replace the
    inputs (or get ``suffix``).
    """
    cols = list(cols)
    exprs = {}
    for c in cols:
        exprs[c] = f"COALESCE(CAST({_q(c)} AS DOUBLE), {float(stats.medians[c] or 0.0)!r})"
        if scale:
            mu, sd = stats.means[c], stats.deviations[c]
            exprs[c] = f"({exprs[c]} - {mu!r}) / {sd!r}" if sd > 0 else "CAST(0.0 AS DOUBLE)"
    if suffix:
        sel = ", ".join(f"{e} AS {_q(c + suffix)}" for c, e in exprs.items())
        stmt = f"SELECT *, {sel} FROM __THIS__"
    else:
        keep = f"* EXCEPT ({', '.join(_q(c) for c in cols)})"
        sel = ", ".join(f"{e} AS {_q(c)}" for c, e in exprs.items())
        stmt = f"SELECT {keep}, {sel} FROM __THIS__"
    return SQLTransformer(statement=stmt)


def fit_impute_scale(train: DataFrame, cols: Sequence[str], scale: bool = True,
                     suffix: str = "") -> SQLTransformer:
    """Fit median-impute (+ optional ddof-0 standardise) on ``train``; returns the frozen stage."""
    return impute_scale_stage(cols, fold_statistics(train, cols)[None], scale, suffix)


def impute_median(train: DataFrame, cols: Sequence[str], **kw) -> SQLTransformer:
    return fit_impute_scale(train, cols, scale=False, **kw)


def standardize(train: DataFrame, cols: Sequence[str], **kw) -> SQLTransformer:
    return fit_impute_scale(train, cols, scale=True, **kw)


def balanced_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``weight = n / (n_classes * n_c)`` for each row of class c."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k")).first()
    w = counts.select(label, (F.lit(float(tot["_n"])) / (F.lit(float(tot["_k"])) * F.col("_nc"))).alias(out))
    # one row per class
    return df.join(F.broadcast(w), label, "left")
