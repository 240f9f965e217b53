"""Registered queries: one per operator of the inventory, each reading the shared test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose floating columns are
rounded to 6 digits (the oracle twin in ``oracle.py`` rounds the same way).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import drop_leakage, month_start_date, round_doubles, select_columns, spatial_block, threshold_predict
from ..operators import metrics as M
from ..operators import panel as P
from ..operators import profile as PR
from ..operators import ranking as RK
from ..session import materialize, scratch_path
from ..sources import fixtures
from ..sources.io import read_metrics, write_metrics
from . import labelled_panel as LP

Query = Callable[[SparkSession, str], DataFrame]
FEAT = LP.FEATURE_COLS
HIST_COLS = ("precip", "n_obs", "humid")


def _r(fn: Query) -> Query:
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(spark, sf_dir))
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    return wrapped


def _dated(spark, sf):
    return fixtures.panel(spark, sf).withColumn("date", month_start_date("YEAR", "MONTH"))


def q_read_panel(spark, sf):
    """The panel as headered CSV, read with its schema."""
    from ..sources.io import read_panel, write_panel
    panel = fixtures.panel(spark, sf)
    path = scratch_path(spark, "panel_in")
    write_panel(panel, path, fmt="csv")
    return read_panel(spark, path, schema=panel.schema, fmt="csv")


def q_enrich_left_join(spark, sf):
    return P.enrich_left_join(fixtures.panel(spark, sf), fixtures.site(spark, sf), ["loc_id"])


def q_month_start_date(spark, sf):
    return _dated(spark, sf)


def q_parse_date_strict(spark, sf):
    """Dates written as text (as a CSV round trip leaves them) parsed back; fails on bad values."""
    from ..functions.scalar import parse_date_strict
    text = _dated(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return parse_date_strict(text, "date").withColumn("date", F.col("date").cast("timestamp_ntz"))


def q_spatial_block(spark, sf):
    return fixtures.panel(spark, sf).select(
        "loc_id", "LAT", "LON", "YEAR", "MONTH",
        spatial_block("LAT", "LON", 50.0).alias("block_id"),
        spatial_block("LAT", "LON", 100.0).alias("block_id_100"))


def q_zscore_by_group(spark, sf):
    return P.add_features(fixtures.panel(spark, sf), FEAT, date_col=None)


def q_lag_features(spark, sf):
    d = _dated(spark, sf)
    return P.lag_features(d, FEAT, ["LAT", "LON"], ["date"], (1, 2, 3))


def q_rolling_mean(spark, sf):
    d = _dated(spark, sf)
    return P.rolling_mean(d, FEAT, ["LAT", "LON"], ["date"], (3, 6))


def q_rolling_mean_past(spark, sf):
    d = _dated(spark, sf)
    return P.rolling_mean_past(d, FEAT, ["LAT", "LON"], ["date"], (1, 2, 3, 4, 5, 6))


def q_add_features(spark, sf):
    return LP.featured_panel(spark, sf)


def q_add_features_skew_safe(spark, sf):
    """The same features with runs far shorter than a site, so that every site is cut into several."""
    return P.add_features(LP.blocked_panel(spark, sf), FEAT, keys=("LAT", "LON"), date_col="date", run_rows=16)


def q_climatology_percentile(spark, sf):
    d = fixtures.panel(spark, sf)
    return P.climatology_percentile(d, "precip", ["LAT", "LON", "MONTH"], 20.0)


def q_event_label(spark, sf):
    return LP.labelled_panel(spark, sf)


def q_drop_leakage(spark, sf):
    return drop_leakage(LP.labelled_panel(spark, sf), source="precip", threshold_col="ppt_pctl")


def q_write_panel(spark, sf):
    """CSV round trip of the labelled panel (the reference's step boundary), read back with
    its schema; NaN -> null on load."""
    from ..sources.io import read_panel, write_panel
    lab = LP.labelled_panel(spark, sf)
    path = scratch_path(spark, "panel_csv")
    write_panel(lab, path, fmt="csv")
    return read_panel(spark, path, schema=lab.schema, fmt="csv")


def q_target_balance(spark, sf):
    return PR.target_balance(LP.labelled_panel(spark, sf), "sequia")


def q_label_prevalence(spark, sf):
    return P.label_prevalence(LP.labelled_panel(spark, sf), "sequia")


def q_schema_profile(spark, sf):
    return PR.schema_profile(LP.labelled_panel(spark, sf))


def q_missingness_profile(spark, sf):
    return PR.missingness_profile(LP.labelled_panel(spark, sf))


def q_missing_fraction_avg(spark, sf):
    return PR.missing_fraction_avg(LP.labelled_panel(spark, sf))


def q_target_correlation(spark, sf):
    return PR.target_correlation(LP.labelled_panel(spark, sf), "sequia")


def q_topk_by_abs_corr(spark, sf):
    return PR.topk_by_abs_corr(PR.target_correlation(LP.labelled_panel(spark, sf), "sequia"), 30)


def q_correlation_matrix_topk(spark, sf):
    # read three times (top-k, medians, moments): write it once, as the reference reads a file
    lab = materialize(LP.labelled_panel(spark, sf), "labelled_panel")
    top = PR.topk_by_abs_corr(PR.target_correlation(lab, "sequia"), 30)
    feats = [r["feature"] for r in top.select("feature").collect()]  # feature-sized list
    return PR.correlation_matrix_topk(lab, feats)


def q_column_histogram(spark, sf):
    return PR.column_histogram(LP.labelled_panel(spark, sf), HIST_COLS, 40)


def _scored(spark, sf):
    return fixtures.scored(spark, sf)


def _scored_folds(spark, sf):
    return RK.group_kfold(_scored(spark, sf), "grp", k=5)


def q_threshold_predict(spark, sf):
    return _scored(spark, sf).withColumn("pred", threshold_predict("prob", 0.5))


def q_average_precision(spark, sf):
    return M.average_precision(_scored(spark, sf))


def q_roc_auc(spark, sf):
    return M.roc_auc(_scored(spark, sf))


def q_confusion_metrics(spark, sf):
    return M.confusion_metrics(_scored(spark, sf), th=0.5)


def q_brier_score(spark, sf):
    return M.brier_score(_scored(spark, sf))


def q_cumulative_counts(spark, sf):
    return M.cumulative_counts(M.score_table(_scored(spark, sf)))


def q_fold_ranking_metrics(spark, sf):
    return M.ranking_metrics(_scored_folds(spark, sf), by=["fold"])


def q_write_metrics(spark, sf):
    m = M.holdout_metrics(_scored(spark, sf), th=0.5)
    path = scratch_path(spark, "holdout_metrics")
    write_metrics(m, path)
    return read_metrics(spark, path, m.schema)


def q_pr_curve(spark, sf):
    return M.pr_curve(_scored(spark, sf))


def q_roc_curve(spark, sf):
    return M.roc_curve(_scored(spark, sf))


def q_reliability_curve(spark, sf):
    return M.reliability_curve(_scored(spark, sf), n_bins=10)


def q_threshold_sweep(spark, sf):
    return M.threshold_sweep(_scored_folds(spark, sf), by=["fold"], objective="f1")


def q_threshold_by_fold(spark, sf):
    return M.threshold_by_fold(_scored_folds(spark, sf), "fold", objective="f1")


def q_threshold_by_fold_youden(spark, sf):
    return M.threshold_by_fold(_scored_folds(spark, sf), "fold", objective="youden")


def q_threshold_by_fold_cost(spark, sf):
    return M.threshold_by_fold(_scored_folds(spark, sf), "fold", objective="cost")


def q_cv_summary(spark, sf):
    per_fold = M.threshold_by_fold(_scored_folds(spark, sf), "fold", objective="f1")
    return PR.cv_summary(per_fold, ["best_threshold", "pr_auc", "roc_auc", "f1", "recall", "precision"])


def q_group_kfold(spark, sf):
    return RK.group_fold_table(_scored(spark, sf), "grp", k=5)


def q_stratified_kfold(spark, sf):
    return RK.stratified_kfold(_scored(spark, sf), "y", "row_id", k=5, seed=42).select("row_id", "y", "fold")


def q_shuffled_kfold(spark, sf):
    return RK.shuffled_kfold(_scored(spark, sf), "row_id", k=5, seed=42).select("row_id", "fold")


def q_sample_groups(spark, sf):
    return RK.sample_groups(_scored(spark, sf), "grp", 0.35, seed=42)


def q_sample_stratified(spark, sf):
    return RK.sample_stratified(_scored(spark, sf), "y", "row_id", 0.35, seed=42)


def q_select_columns(spark, sf):
    lab = LP.labelled_panel(spark, sf)
    return select_columns(lab, ["precip__lag1", "n_obs", "humid__roll3m"], "sequia", ids=("row_id", "block_id", "LAT", "LON", "date"))


def q_isotonic_scores(spark, sf):
    """Every distinct score with its isotonic value, pooled in ranges and merged."""
    from ..ml.isotonic import fit_isotonic
    d = _scored(spark, sf).groupBy(F.col("prob").alias("s")).agg(F.sum("y").alias("total"), F.count(F.lit(1)).alias("weight"))
    d = materialize(d, "scores")
    return fit_isotonic(d, "s", "calibrated", range_rows=256).transform(d.select("s")).select("s", "calibrated")


def q_group_semi_join(spark, sf):
    return P.group_semi_join(fixtures.panel(spark, sf), fixtures.site(spark, sf).where("elev is not null"), "loc_id")


QUERIES: dict[str, Query] = {}


def register(name: str, fn: Query) -> None:
    QUERIES[name] = _r(fn)


for _name, _fn in [
    ("read_panel", q_read_panel),
    ("enrich_left_join", q_enrich_left_join),
    ("month_start_date", q_month_start_date),
    ("parse_date_strict", q_parse_date_strict),
    ("spatial_block", q_spatial_block),
    ("zscore_by_group", q_zscore_by_group),
    ("lag_features", q_lag_features),
    ("rolling_mean", q_rolling_mean),
    ("rolling_mean_past", q_rolling_mean_past),
    ("add_features", q_add_features),
    ("add_features_skew_safe", q_add_features_skew_safe),
    ("climatology_percentile", q_climatology_percentile),
    ("event_label", q_event_label),
    ("drop_leakage", q_drop_leakage),
    ("write_panel", q_write_panel),
    ("target_balance", q_target_balance),
    ("label_prevalence", q_label_prevalence),
    ("schema_profile", q_schema_profile),
    ("missingness_profile", q_missingness_profile),
    ("missing_fraction_avg", q_missing_fraction_avg),
    ("target_correlation", q_target_correlation),
    ("topk_by_abs_corr", q_topk_by_abs_corr),
    ("correlation_matrix_topk", q_correlation_matrix_topk),
    ("column_histogram", q_column_histogram),
    ("threshold_predict", q_threshold_predict),
    ("average_precision", q_average_precision),
    ("roc_auc", q_roc_auc),
    ("confusion_metrics", q_confusion_metrics),
    ("brier_score", q_brier_score),
    ("cumulative_counts", q_cumulative_counts),
    ("fold_ranking_metrics", q_fold_ranking_metrics),
    ("write_metrics", q_write_metrics),
    ("pr_curve", q_pr_curve),
    ("roc_curve", q_roc_curve),
    ("reliability_curve", q_reliability_curve),
    ("threshold_sweep", q_threshold_sweep),
    ("threshold_by_fold", q_threshold_by_fold),
    ("threshold_by_fold_youden", q_threshold_by_fold_youden),
    ("threshold_by_fold_cost", q_threshold_by_fold_cost),
    ("cv_summary", q_cv_summary),
    ("group_kfold", q_group_kfold),
    ("stratified_kfold", q_stratified_kfold),
    ("shuffled_kfold", q_shuffled_kfold),
    ("sample_groups", q_sample_groups),
    ("sample_stratified", q_sample_stratified),
    ("group_semi_join", q_group_semi_join),
    ("select_columns", q_select_columns),
    ("isotonic_scores", q_isotonic_scores),
]:
    register(_name, _fn)

from .ml_queries import ML_QUERIES  # noqa: E402

for _name, _fn in ML_QUERIES:
    register(_name, _fn)
