"""Exact ranking, calibration and threshold metrics over a scored table.

All ranking metrics start from the score table: one row per (by..., distinct score) with
positive / negative counts, a partial aggregate whatever the skew of the scores. The
cumulative counts in descending-score order are built with a two-level prefix sum: distinct
scores are cut into quantile blocks (deterministic, from one approximate-quantile pass), summed
inside each (group, block), and a small table of block totals supplies the offsets and the
overall totals. No window ever orders the whole table in one task, and the score table is written
once to the shared folder, since the quantile pass, the sums and the totals all read it.

Scores that are null or NaN, and labels other than 0 and 1, fail in every metric.

Average precision is the step-wise sum over distinct scores (not the trapezoidal PR area);
ROC AUC is the trapezoid over distinct scores (tie-aware Mann-Whitney).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Fixed values that must equal the reference's for identical results.
SWEEP_MIN_PCT, SWEEP_MAX_PCT = 5, 95       # thresholds 0.05 .. 0.95 step 0.01
COST_W_RECALL, COST_W_PRECISION = 0.7, 0.3
RELIABILITY_BINS = 10
OBJECTIVES = ("f1", "recall", "precision", "youden", "cost")


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 when b is 0 (zero-division -> 0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _score(prob: str) -> Column:
    """The score, failing on null and NaN."""
    c = F.col(prob).cast("double")
    return F.when(c.isNull() | F.isnan(c), F.raise_error(F.lit("a score is null or NaN")).cast("double")).otherwise(c)


def _truth(y: str) -> Column:
    """The label as 0 or 1, failing on anything else."""
    c = F.col(y).cast("double")
    return F.when(c.isin(0.0, 1.0), c.cast("int")).otherwise(F.raise_error(F.lit("a label is neither 0 nor 1")).cast("int"))


def score_table(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    return (df.select(*by, _score(prob).alias("score"), _truth(y).alias("_y")).groupBy(*by, "score")
            .agg(F.sum("_y").cast("bigint").alias("tp"), (F.count(F.lit(1)) - F.sum("_y")).cast("bigint").alias("fp")))


def score_blocks(scores: DataFrame, n_blocks: int | None = None, rel_err: float = 1e-3) -> DataFrame:
    """Add ``_blk``: a deterministic block of the score range, from approximate quantiles of
    the distinct scores (one pass; the boundary list has at most ``n_blocks`` entries)."""
    from pyspark.ml.feature import Bucketizer

    spark = scores.sparkSession
    n = n_blocks or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    qs = scores.approxQuantile("score", [i / n for i in range(1, n)], min(rel_err, 0.25 / n))
    cuts = sorted({q for q in qs if q is not None and q == q})
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol="score", outputCol="_blk", handleInvalid="keep").transform(scores)


def _cumulative(scores: DataFrame, by: Sequence[str] = (), n_blocks: int | None = None) -> DataFrame:
    """``cumulative_counts`` with the totals ``_P`` and ``_N`` of the group, carried by the block table."""
    by = list(by)
    blk = score_blocks(scores, n_blocks)
    wl = Window.partitionBy(*by, "_blk").orderBy(F.col("score").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blk.select("*", F.sum("tp").over(wl).alias("_ltp"), F.sum("fp").over(wl).alias("_lfp"))
    totals = blk.groupBy(*by, "_blk").agg(F.sum("tp").alias("_btp"), F.sum("fp").alias("_bfp"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # over the block table: one row a block
    wo = group.orderBy(F.col("_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_blk",
                            F.coalesce(F.sum("_btp").over(wo), F.lit(0)).alias("_otp"),
                            F.coalesce(F.sum("_bfp").over(wo), F.lit(0)).alias("_ofp"),
                            F.sum("_btp").over(group).alias("_P"), F.sum("_bfp").over(group).alias("_N"))
    out = local.join(offsets, [*by, "_blk"], "inner")
    return out.select(*by, "score", "tp", "fp",
                      (F.col("_ltp") + F.col("_otp")).cast("bigint").alias("cum_tp"),
                      (F.col("_lfp") + F.col("_ofp")).cast("bigint").alias("cum_fp"), "_P", "_N")


def cumulative_counts(scores: DataFrame, by: Sequence[str] = (), n_blocks: int | None = None) -> DataFrame:
    """Add ``cum_tp`` / ``cum_fp``: counts with score >= this score, within ``by``.

    Two-level prefix sum: running sums inside each (by, score block), plus the totals of the
    higher-score blocks of the same group. Blocks are quantile ranges of the distinct scores,
    so the work is spread evenly however the scores cluster.
    """
    return _cumulative(scores, by, n_blocks).drop("_P", "_N")


def _written_scores(df: DataFrame, y: str, prob: str, by: Sequence[str]) -> DataFrame:
    return materialize(score_table(df, y, prob, by), "scores")


def ranking_of_scores(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., pr_auc, roc_auc) of a score table (by..., score, tp, fp); sums are doubles, so no count overflows."""
    cum = _cumulative(scores, by)
    tp, fp, ctp, cfp = (F.col(c).cast("double") for c in ("tp", "fp", "cum_tp", "cum_fp"))
    agg = cum.groupBy(*by).agg(F.max("_P").cast("double").alias("_P"), F.max("_N").cast("double").alias("_N"),
                               F.sum(tp * (ctp / (ctp + cfp))).alias("_ap"), F.sum(fp * (F.lit(2.0) * ctp - tp)).alias("_auc"))
    return agg.select(*by, F.try_divide(F.col("_ap"), F.col("_P")).alias("pr_auc"),
                      F.try_divide(F.col("_auc"), F.lit(2.0) * F.col("_P") * F.col("_N")).alias("roc_auc"))


def ranking_metrics(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """(by..., pr_auc, roc_auc): exact, tie-aware."""
    return ranking_of_scores(_written_scores(df, y, prob, by), by)


def average_precision(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, y, prob, by).select(*by, "pr_auc")


def roc_auc(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, y, prob, by).select(*by, "roc_auc")


def confusion_metrics(df: DataFrame, y: str = "y", prob: str = "prob", th: float = 0.5,
                      by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn, precision, recall, f1 (zero division -> 0), positive rates, n, brier."""
    df = df.select(*by, _score(prob).alias("_p"), _truth(y).alias("_y"))
    pred, yy = (F.col("_p") >= F.lit(float(th))).cast("int"), F.col("_y")
    a = df.groupBy(*by).agg(
        F.sum(F.when((pred == 1) & (yy == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when((pred == 1) & (yy == 0), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when((pred == 0) & (yy == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
        F.sum(F.when((pred == 0) & (yy == 1), 1).otherwise(0)).cast("bigint").alias("fn"),
        F.count(F.lit(1)).alias("n"),
        F.avg(pred.cast("double")).alias("positive_rate_pred"),
        F.avg(yy.cast("double")).alias("positive_rate_true"),
        F.avg(F.pow(F.col("_p") - yy, 2)).alias("brier"),
    )
    return a.select(*by, F.lit(float(th)).alias("threshold"), "tp", "fp", "tn", "fn", "n",
                    _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    _div0(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
                    "positive_rate_pred", "positive_rate_true", "brier")


def brier_score(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.pow(_score(prob) - _truth(y), 2)).alias("brier"))


def holdout_metrics(df: DataFrame, y: str = "y", prob: str = "prob", th: float = 0.5) -> DataFrame:
    """One row: threshold, pr_auc, roc_auc, f1, recall, precision, brier, counts, rates."""
    both = confusion_metrics(df, y, prob, th).unionByName(ranking_metrics(df, y, prob), allowMissingColumns=True)
    names = ["threshold", "pr_auc", "roc_auc", "f1", "recall", "precision", "brier", "tp", "fp", "tn", "fn", "n",
             "positive_rate_pred", "positive_rate_true"]
    return both.agg(*[F.max(c).alias(c) for c in names])   # two rows, each with the other's columns null


def pr_curve(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, precision, recall) per distinct score, plus the end point (null, 1, 0)."""
    scores = _written_scores(df, y, prob, by)
    cum, tot = _cumulative(scores, by), scores.groupBy(*by).agg(F.sum("tp").alias("_P"))
    pts = cum.select(*by, F.col("score").alias("threshold"),
                     _div0(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
                     F.when(F.col("_P") == 0, F.lit(1.0)).otherwise(F.col("cum_tp") / F.col("_P")).alias("recall"))
    end = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                     F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def roc_curve(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, fpr, tpr) per distinct score, plus the start point (null, 0, 0). All points kept."""
    scores = _written_scores(df, y, prob, by)
    cum, tot = _cumulative(scores, by), scores.groupBy(*by).agg(F.sum("tp").alias("_P"))
    pts = cum.select(*by, F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_fp").cast("double"), F.col("_N")).alias("fpr"),
                     F.try_divide(F.col("cum_tp").cast("double"), F.col("_P")).alias("tpr"))
    start = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                       F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def reliability_edges(n_bins: int = RELIABILITY_BINS) -> list[float]:
    """Interior edges of ``n_bins`` uniform bins on [0, 1] (i * (1 / n_bins), as linspace gives)."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def reliability_curve(df: DataFrame, y: str = "y", prob: str = "prob", n_bins: int = RELIABILITY_BINS,
                      by: Sequence[str] = ()) -> DataFrame:
    """Per non-empty uniform bin: share of positives and mean score. A score equal to an edge
    goes to the lower bin."""
    df = df.select(*by, _score(prob).alias("_p"), _truth(y).alias("_y"))
    b = sum((F.when(F.col("_p") > F.lit(e), 1).otherwise(0) for e in reliability_edges(n_bins)), F.lit(0))
    return (df.groupBy(*by, b.cast("int").alias("bin"))
            .agg(F.avg(F.col("_y").cast("double")).alias("prob_true"), F.avg("_p").alias("prob_pred"),
                 F.count(F.lit(1)).alias("count")))


#: What a sweep can maximise, as expressions over its columns; w_r and w_p are the cost weights.
OBJECTIVE_EXPRS = {"f1": "f1", "recall": "recall", "precision": "precision", "youden": "recall - fpr",
                   "cost": "{w_r} * recall + {w_p} * precision"}


def threshold_sweep(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = (),
                    min_pct: float = SWEEP_MIN_PCT, max_pct: float = SWEEP_MAX_PCT, objective: str = "f1",
                    w_recall: float = COST_W_RECALL, w_precision: float = COST_W_PRECISION, step_pct: float = 1) -> DataFrame:
    """Confusion counts and objective at the thresholds min_pct, min_pct + step_pct, ... max_pct percent.

    Each row is placed once, in the bucket of the highest threshold it reaches (by comparison with
    the thresholds themselves); counts per (by, bucket) are then summed from the top. No cross join
    with the grid: the work is one pass plus a table of one row for each threshold and group.
    """
    if objective not in OBJECTIVE_EXPRS:
        raise ValueError(f"objective {objective!r} is none of {sorted(OBJECTIVE_EXPRS)}")
    by = list(by)
    n = int((max_pct - min_pct) / step_pct + 1e-9) + 1
    grid = [(min_pct + i * step_pct) / 100.0 for i in range(n)]
    ths = F.array(*[F.lit(t) for t in grid])
    p = F.col("_p")
    # An estimate of the bucket, put right by comparing with the thresholds next to it (-1: reaches none).
    est = F.least(F.greatest(F.floor((p * 100 - F.lit(float(min_pct))) / F.lit(float(step_pct))).cast("int"), F.lit(-1)), F.lit(n - 1))
    up = F.coalesce(p >= F.get(ths, est + 1), F.lit(False))
    down = F.coalesce(p < F.get(ths, est), F.lit(False))
    bucket = F.when(up, est + 1).when(down, est - 1).otherwise(est)
    cnt = (df.select(*by, _score(prob).alias("_p"), _truth(y).alias("_y")).select(*by, bucket.alias("k"), "_y")
           .groupBy(*by, "k").agg(F.sum("_y").cast("bigint").alias("pos"),
                                  (F.count(F.lit(1)) - F.sum("_y")).cast("bigint").alias("neg")))
    every = cnt.groupBy(*by).agg(F.count(F.lit(1))).select(
        *by, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg"))
    u = cnt.unionByName(every).groupBy(*by, "k").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # at most n + 1 rows a group
    w = group.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = u.select(*by, "k", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                   F.sum("pos").over(group).alias("P"), F.sum("neg").over(group).alias("N")).where("k >= 0")
    out = cum.select(
        *by, F.get(ths, F.col("k")).alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        (F.col("N") - F.col("fp")).cast("bigint").alias("tn"), (F.col("P") - F.col("tp")).cast("bigint").alias("fn"),
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _div0(F.col("tp"), F.col("P")).alias("recall"),
        _div0(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + (F.col("P") - F.col("tp"))).alias("f1"),
        _div0(F.col("fp"), F.col("N")).alias("fpr"))
    return out.withColumn("objective", F.expr(OBJECTIVE_EXPRS[objective].format(w_r=repr(float(w_recall)) + "D", w_p=repr(float(w_precision)) + "D")))


def threshold_by_fold(df: DataFrame, fold: str = "fold", y: str = "y", prob: str = "prob",
                      objective: str = "f1", **kw) -> DataFrame:
    """Best threshold per fold (first maximum = lowest threshold on ties) with the metrics there."""
    sw = threshold_sweep(df, y, prob, by=[fold], objective=objective, **kw)
    w = Window.partitionBy(fold).orderBy(F.col("objective").desc(), F.col("threshold").asc())
    best = sw.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r", "fpr")
    rk = ranking_metrics(df, y, prob, by=[fold])
    return best.join(rk, fold).select(
        fold, F.col("threshold").alias("best_threshold"), "pr_auc", "roc_auc", "f1", "recall", "precision",
        "tp", "fp", "tn", "fn")
