"""Panel operators: enrichment join, per-site anomalies, lags, rolling means, climatology labels.

One path at every size: anomalies and climatology percentiles are partial aggregates joined back
(adaptive execution broadcasts or skew-splits those joins from run-time sizes), and ordered
features are windows over bounded runs of a site (see ``ordered.py``), so no task ever has to
hold or order a whole site.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import extract_month, numeric_columns, require_columns
from ..session import materialize
from .ordered import number_rows, over_runs, site_moments
from .selection import grouped_quantile
from .strategy import null_safe_keys

DEFAULT_KEYS = ("LAT", "LON")
DEFAULT_LAGS = (1, 2, 3)
DEFAULT_WINDOWS = (3, 6)
PAST_ROLL_K = (3, 6)


def _keys_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


# --------------------------------------------------------------------------- joins

def enrich_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Keep every left row, attach right attributes; duplicate right keys fan out.

    Keys match null-to-null (as the reference's in-memory merge does). Non-key columns present
    on both sides get the two suffixes. No hint is given: adaptive execution broadcasts the right
    side when its measured size allows, and otherwise splits hot keys of the shuffle join.
    """
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    l = left.select(*[F.col(c).alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    r = right.select(*[F.col(c).alias(c + suffixes[1] if c in clash else c) for c in right.columns])
    la, ra = l.alias("_l"), r.alias("_r")
    joined = la.join(ra, null_safe_keys(la, ra, keys), "left")
    right_cols = [c for c in r.columns if c not in keys]
    return joined.select(*[F.col(f"_l.{c}") for c in l.columns], *[F.col(f"_r.{c}") for c in right_cols])


def group_semi_join(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows whose group is in ``groups`` (a one-column table of group ids)."""
    return df.join(groups.select(key).distinct(), key, "left_semi")


# --------------------------------------------------------------------------- window features

def zscore_by_group(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``(x - mean) / std`` per group, population std, nulls skipped.

    A group whose std is 0 or undefined gets 0.0 on every row (null rows included). Rows with
    a null key get null (their group is dropped by the reference's group-by).
    """
    # written: its size decides whether it is broadcast
    a, s = df.alias("_a"), materialize(site_moments(df, cols, keys), "moments").alias("_s")
    joined = a.join(s, null_safe_keys(a, s, list(keys)), "left")
    out = []
    for i, c in enumerate(cols):
        mu, sd = F.col(f"_s._mu_{i}"), F.col(f"_s._sd_{i}")
        z = F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise((F.col(f"_a.{c}") - mu) / sd)
        present = F.lit(True)
        for k in keys:
            present = present & F.col(f"_a.{k}").isNotNull()
        out.append(F.when(present, z).alias(f"{c}__z"))
    return joined.select("_a.*", *out)


def lag_columns(cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                lags: Sequence[int] = DEFAULT_LAGS) -> list[Column]:
    """Value k ROWS earlier in the site's date order (gaps in the calendar are skipped over)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return [F.when(_keys_present(keys), F.lag(c, k).over(w)).alias(f"{c}__lag{k}")
            for k in lags for c in cols]


def rolling_mean_columns(cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                         windows: Sequence[int] = DEFAULT_WINDOWS) -> list[Column]:
    """Mean of the last w rows including the current one; null unless all w are non-null."""
    out = []
    for wsize in windows:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(wsize - 1), 0)
        for c in cols:
            full = F.count(c).over(w) == F.lit(wsize)
            out.append(F.when(_keys_present(keys) & full, F.avg(c).over(w)).alias(f"{c}__roll{wsize}m"))
    return out


def rolling_mean_past_columns(cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                              lags: Sequence[int] = DEFAULT_LAGS, ks: Sequence[int] = PAST_ROLL_K) -> list[Column]:
    """Mean of lag1..lagK skipping nulls, built only when lags 1..K were all requested."""
    have = set(lags)
    out = []
    for k in ks:
        if not all(i in have for i in range(1, k + 1)):
            continue
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-k, -1)
        for c in cols:
            out.append(F.when(_keys_present(keys), F.avg(c).over(w)).alias(f"{c}__roll_prev{k}m"))
    return out


def lag_features(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                 lags: Sequence[int] = DEFAULT_LAGS) -> DataFrame:
    return over_runs(df, keys, order, max(lags, default=0), lambda k, o: lag_columns(cols, k, o, lags))


def rolling_mean(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                 windows: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    return over_runs(df, keys, order, max(windows, default=1) - 1, lambda k, o: rolling_mean_columns(cols, k, o, windows))


def rolling_mean_past(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                      lags: Sequence[int] = DEFAULT_LAGS, ks: Sequence[int] = PAST_ROLL_K) -> DataFrame:
    return over_runs(df, keys, order, max(ks, default=0), lambda k, o: rolling_mean_past_columns(cols, k, o, lags, ks))


def add_features(df: DataFrame, cols: Sequence[str] | None = None, keys: Sequence[str] = DEFAULT_KEYS,
                 date_col: str | None = "date", tiebreak: Sequence[str] = (),
                 lags: Sequence[int] = DEFAULT_LAGS, windows: Sequence[int] = DEFAULT_WINDOWS,
                 run_rows: int | None = None) -> DataFrame:
    """z-scores always; lags, rolling and past-rolling means when an order column is given.

    Without ``cols``, every numeric column but the keys, YEAR, MONTH and the order columns is taken.
    ``tiebreak`` columns make the row order total when a site has duplicate dates; a null in the
    order column fails, since it would shift every lag of its site.
    Column order: input, ``__z`` block, then per lag, per window, then past rolls.
    """
    keys = list(keys)
    order = [date_col, *tiebreak] if date_col is not None else []
    require_columns(df, [*keys, *order, *(cols or [])], "panel")
    if cols is None:
        cols = numeric_columns(df, [*keys, "YEAR", "MONTH", *order])
    if not order:
        return zscore_by_group(materialize(df, "features"), cols, keys)
    unset = F.raise_error(F.lit(f"a row without a value in the order column {date_col!r}"))
    checked = F.when(F.col(date_col).isNull(), unset.cast(df.schema[date_col].dataType)).otherwise(F.col(date_col))
    df = number_rows(df.withColumn(date_col, checked), keys, order)
    depth = max([*lags, *[w - 1 for w in windows], *(k for k in PAST_ROLL_K if set(range(1, k + 1)) <= set(lags)), 0])
    return over_runs(zscore_by_group(df, cols, keys), keys, order, depth, lambda k, o: [
        *lag_columns(cols, k, o, lags), *rolling_mean_columns(cols, k, o, windows),
        *rolling_mean_past_columns(cols, k, o, lags)], run_rows)


# --------------------------------------------------------------------------- climatology labels

def climatology_percentile(df: DataFrame, value: str, keys: Sequence[str], p: float) -> DataFrame:
    """Per-group exact percentile (linear interpolation, nulls skipped); null keys form a group.

    A group of up to ``selection.ORDERED_VALUES`` rows is a plain aggregate; the values of larger ones are
    searched in many tasks, see ``selection.py``.
    """
    if not 0 <= p <= 100:
        raise ValueError("percentile must be in [0, 100]")
    return grouped_quantile(df, value, keys, p / 100.0, out="ppt_pctl")


def event_label(df: DataFrame, value: str = "precip", keys: Sequence[str] = DEFAULT_KEYS,
                month_col: str | None = "MONTH", date_col: str | None = None, p: float = 20.0,
                label: str = "sequia") -> DataFrame:
    """``label = value <= percentile_p(value | site, calendar month)``; ties count, null -> 0.

    Adds ``ppt_pctl`` and ``label``. Fails if the value column holds nothing but nulls. The
    percentile of each (site, month) is joined back; a group with many values is searched, not gathered.
    """
    require_columns(df, [value, *keys], "panel")
    mkey = "_month_resolved_"
    base = df.withColumn(mkey, extract_month(df, month_col, date_col))
    gkeys = [*keys, mkey]
    clim = materialize(climatology_percentile(base, value, gkeys, p), "climatology")
    seen = clim.agg(F.count(F.lit(1)).alias("groups"), F.count("ppt_pctl").alias("known")).first()
    if seen["groups"] and not seen["known"]:
        raise ValueError(f"nothing to rank: {value!r} is null in every row")
    a, b = base.alias("_a"), clim.alias("_b")
    joined = a.join(b, null_safe_keys(a, b, gkeys), "left")
    out = joined.select(*[F.col(f"_a.{c}") for c in df.columns], F.col("_b.ppt_pctl"))
    return out.withColumn(label, F.coalesce((F.col(value) <= F.col("ppt_pctl")).cast("bigint"), F.lit(0).cast("bigint")))


def label_prevalence(df: DataFrame, label: str = "sequia") -> DataFrame:
    return df.agg(
        F.sum(F.col(label)).cast("bigint").alias("positives"),
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).cast("double")).alias("prevalence"),
    )
