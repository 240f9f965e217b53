"""Model fitting, calibration, cross-validation, importance, tuning, refit, scoring, persistence.

A fitted model is ONE ``PipelineModel`` of built-in and expression-only stages:
``[impute+scale (SQL), assemble, classifier, positive-probability, (calibrator), ...] x K`` then
the mean of the K calibrated probabilities. Scoring is a narrow projection: no shuffle.
The driver loops only over folds / trials / repeats (a handful); every fit and every metric
is a distributed Spark job.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import require_binary, require_columns
from ..operators import metrics as M
from ..operators.profile import cv_summary, importance_summary
from ..operators.ranking import group_kfold, hash_rank, stratified_kfold
from ..session import materialize, temporary_tables
from .isotonic import fit_isotonic
from .l1 import fit_l1_logistic
from .models import GBM_REFIT_DEFAULTS, L1_DEFAULTS, RF_REFIT_DEFAULTS, make_classifier, resolve_bins, sample_params
from .permute import parts_of, permuted_scores
from .prep import Statistics, balanced_class_weight, fold_statistics, impute_scale_stage
from .smote import smote
from .stages import DropColumns, LogisticProbability, MeanOfColumns, PlattScaler, PositiveProbability

METRIC_NAMES = ("pr_auc", "roc_auc", "f1", "recall", "precision")
# Independent fits (folds, trials) submitted concurrently, as Spark's CrossValidator does with
# its ``parallelism``: each fit is a set of small distributed jobs that alone does not fill
# the cluster. Results are collected in fold / trial order, so outputs do not depend on it.
DEFAULT_PARALLEL_FITS = 3


def _in_parallel(fn, items, parallelism: int):
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


@dataclass
class ModelSpec:
    kind: str = "rf"                       # rf | gbm | l1
    params: dict[str, Any] = field(default_factory=dict)
    sampler: str = "smote"                 # smote | class_weight | none
    calibration: str | None = "isotonic"   # sigmoid | isotonic | None
    inner_cv: int = 3
    scale: bool = True
    seed: int = 42

    @staticmethod
    def from_dict(d: dict[str, Any]) -> "ModelSpec":
        known = {k: d[k] for k in ("kind", "params", "sampler", "calibration", "inner_cv", "scale", "seed") if k in d}
        return ModelSpec(**known)


# --------------------------------------------------------------------------- fitting

@dataclass
class Prepared:
    """The written rows that a classifier is fitted on, and the stages that make them."""
    train: DataFrame
    stages: list[Transformer]
    rows: DataFrame
    vec: str
    weight_col: str | None
    scaled: list[str]


def prepare_rows(train: DataFrame, features: list[str], label: str, id_col: str, spec: ModelSpec,
                 tag: str = "0", stats: Statistics | None = None) -> Prepared:
    """impute/scale (train statistics) -> assemble -> [SMOTE | class weights], written. Of ``spec`` only scale, sampler and
    seed count, so fits that differ in the rest can share it. The tables belong to the caller's ``temporary_tables``."""
    sfx, vec = f"__s{tag}", f"_feat{tag}"
    train = materialize(train.select(id_col, label, *features), "train")   # read by every statistic and the fit
    prep = impute_scale_stage(features, stats or fold_statistics(train, features)[None], spec.scale, sfx)
    asm = VectorAssembler(inputCols=[c + sfx for c in features], outputCol=vec)
    prepared = asm.transform(prep.transform(train)).select(id_col, vec, label)
    weight_col = None
    if spec.sampler == "smote":
        prepared = smote(prepared, features=vec, label=label, id_col=id_col, seed=spec.seed)
    elif spec.sampler == "class_weight":
        prepared = balanced_class_weight(prepared, label, out="_w")
        weight_col = "_w"
    prepared = materialize(prepared.select(vec, label, *([weight_col] if weight_col else [])), "prepared")
    return Prepared(train, [prep, asm], prepared, vec, weight_col, [c + sfx for c in features])


def fit_prepared(ready: Prepared, features: list[str], label: str, spec: ModelSpec, tag: str = "0") -> PipelineModel:
    """The classifier of ``spec`` on prepared rows, behind the stages that made them."""
    prepared, vec, weight_col = ready.rows, ready.vec, ready.weight_col
    middle = [f"_raw{tag}", f"_pred{tag}", f"_prob{tag}"]
    if spec.kind == "l1":
        p = {**L1_DEFAULTS, **spec.params}
        rows = prepared.select(vector_to_array(vec).alias("x"), F.col(label).cast("double").alias("y"),
                               (F.col(weight_col) if weight_col else F.lit(1.0)).alias("w"))
        w, b, _ = fit_l1_logistic(rows, "x", "y", "w", len(features), float(p["C"]), int(p["max_iter"]))
        stages, middle = [LogisticProbability(inputCol=vec, outputCol=f"_p{tag}", weights=[float(v) for v in w], intercept=b)], []
    else:
        params = resolve_bins(spec.params, ready.train, features) if spec.kind == "rf" else spec.params
        clf = make_classifier(spec.kind, params, spec.seed, features_col=vec, label_col=label, weight_col=weight_col,
                              raw_col=middle[0], pred_col=middle[1], prob_col=middle[2])
        # a copy drops the training summary: it holds the session, which cannot be sent to tasks once its tags were used
        stages = [clf.fit(prepared).copy(), PositiveProbability(inputCol=f"_prob{tag}", outputCol=f"_p{tag}")]
    return PipelineModel(stages=[*ready.stages, *stages, DropColumns(cols=[*ready.scaled, vec, *middle])])


def fit_base(train: DataFrame, features: list[str], label: str, id_col: str, spec: ModelSpec,
             tag: str = "0", stats: Statistics | None = None) -> PipelineModel:
    """impute/scale (train statistics) -> assemble -> [SMOTE | class weights] -> classifier.

    Output column of the fitted model: ``_p{tag}`` = positive-class probability. ``stats`` are the
    statistics of ``train`` when they are known already (see ``fold_statistics``).
    """
    with temporary_tables(train.sparkSession):
        return fit_prepared(prepare_rows(train, features, label, id_col, spec, tag, stats), features, label, spec, tag)


def _uncalibrated(base: PipelineModel) -> PipelineModel:
    return PipelineModel(stages=[*base.stages, MeanOfColumns(inputCols=["_p0"], outputCol="prob")])


def fit_calibrator(scored: DataFrame, raw: str, label: str, method: str, out: str):
    """Isotonic (clipped outside the fitted range) or Platt scaling with smoothed targets.

    Both are fitted on weighted distinct scores: a partial aggregate first, so rows that share a
    score travel and are held once.
    """
    by_score = materialize(scored.groupBy(F.col(raw).alias("s")).agg(F.sum(F.col(label)).cast("double").alias("pos"), F.count(F.lit(1)).cast("double").alias("n")), "scores")
    if method == "isotonic":
        return fit_isotonic(by_score.select("s", F.col("pos").alias("total"), F.col("n").alias("weight")), raw, out)
    if method == "sigmoid":
        cnt = by_score.agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).first()
        pos, neg = float(cnt["pos"] or 0), float((cnt["n"] or 0) - (cnt["pos"] or 0))
        hi, lo = (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)
        weight = F.col("pos") * F.lit(hi) + (F.col("n") - F.col("pos")) * F.lit(lo)   # of the target 1 at this score
        soft = by_score.select("s", F.lit(1.0).alias("y"), weight.alias("w")).unionByName(
            by_score.select("s", F.lit(0.0).alias("y"), (F.col("n") - weight).alias("w")))
        soft = VectorAssembler(inputCols=["s"], outputCol="v").transform(soft)
        lr = LogisticRegression(featuresCol="v", labelCol="y", weightCol="w", regParam=0.0,
                                standardization=False, maxIter=200).fit(soft)
        return PlattScaler(inputCol=raw, outputCol=out, a=float(lr.coefficients[0]), b=float(lr.intercept))
    raise ValueError(f"calibration {method!r} is neither 'isotonic' nor 'sigmoid'")


def fit_model(train: DataFrame, features: list[str], label: str, id_col: str, spec: ModelSpec,
              parallelism: int = DEFAULT_PARALLEL_FITS, stats: Statistics | None = None) -> PipelineModel:
    """Uncalibrated: one base model (``stats``: the train statistics, if known). Calibrated: K inner
    stratified folds, each fits the base model on K-1 parts and a calibrator on the held-out part;
    the output averages the K. The statistics of the K train parts come from one pass."""
    if not spec.calibration:
        return _uncalibrated(fit_base(train, features, label, id_col, spec, tag="0", stats=stats))
    spark = train.sparkSession
    with temporary_tables(spark):
        inner = materialize(stratified_kfold(train.select(id_col, label, *features), label, id_col, k=spec.inner_cv, seed=spec.seed, out="_inner"), "inner")
        known = fold_statistics(inner, features, "_inner", range(spec.inner_cv))

        def one(i: int):
            tr = inner.where(F.col("_inner") != i).drop("_inner")
            ho = inner.where(F.col("_inner") == i).drop("_inner")
            base = fit_base(tr, features, label, id_col, spec, tag=str(i), stats=known[i])
            with temporary_tables(spark):
                cal = fit_calibrator(base.transform(ho), f"_p{i}", label, spec.calibration, f"_c{i}")
            return [*base.stages, cal, DropColumns(cols=[f"_p{i}"])]

        fitted = _in_parallel(one, list(range(spec.inner_cv)), parallelism)
    outs = [f"_c{i}" for i in range(spec.inner_cv)]
    return PipelineModel(stages=[*[st for part in fitted for st in part], MeanOfColumns(inputCols=outs, outputCol="prob")])


# --------------------------------------------------------------------------- evaluation

def assign_folds(df: DataFrame, label: str, id_col: str, group_col: str | None, k: int, seed: int) -> DataFrame:
    if group_col:
        return group_kfold(df, group_col, k=k, out="fold")
    return stratified_kfold(df, label, id_col, k=k, seed=seed, out="fold")


def oof_predictions(df: DataFrame, features: list[str], label: str, id_col: str, spec: ModelSpec,
                    group_col: str | None = None, k: int = 5, parallelism: int = DEFAULT_PARALLEL_FITS) -> DataFrame:
    """Every row scored by the model that did not see its fold: (id, fold, label, prob)."""
    require_binary(df, label)
    folded = materialize(assign_folds(df, label, id_col, group_col, k, spec.seed).select(id_col, label, "fold", *features), "folded")
    # the inner folds of a calibrated model have train parts of their own
    known = {} if spec.calibration else fold_statistics(folded, features, "fold", range(k))

    def one(f: int):
        # inner calibration folds run serially here: the outer folds already run side by side
        model = fit_model(folded.where(F.col("fold") != f), features, label, id_col, spec, parallelism=1, stats=known.get(f))
        return model.transform(folded.where(F.col("fold") == f)).select(id_col, "fold", label, "prob")

    parts = _in_parallel(one, list(range(k)), parallelism)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_metrics(oof: DataFrame, label: str, th: float = 0.5) -> DataFrame:
    rk = M.ranking_metrics(oof, y=label, prob="prob", by=["fold"])
    cm = M.confusion_metrics(oof, y=label, prob="prob", th=th, by=["fold"]).select("fold", "f1", "recall", "precision")
    return rk.join(cm, "fold")


def cross_validate(df: DataFrame, features: list[str], label: str, id_col: str, spec: ModelSpec,
                   group_col: str | None = None, k: int = 5, th: float = 0.5,
                   parallelism: int = DEFAULT_PARALLEL_FITS) -> tuple[DataFrame, DataFrame]:
    """(per-fold metrics, mean/std summary)."""
    per_fold = fold_metrics(oof_predictions(df, features, label, id_col, spec, group_col, k, parallelism), label, th)
    return per_fold, cv_summary(per_fold, list(METRIC_NAMES))


def feature_importance_cv(df: DataFrame, features: list[str], label: str, id_col: str,
                          group_col: str | None = None, k: int = 5, method: str = "rf",
                          params: dict | None = None, seed: int = 42) -> DataFrame:
    """Per-fold RF impurity importances or |L1 coefficients|, summarised (mean, std ddof 0)."""
    folded = materialize(assign_folds(df, label, id_col, group_col, k, seed).select(id_col, label, "fold", *features), "folded")
    spark = df.sparkSession
    rows = []
    known = fold_statistics(folded, features, "fold", range(k))
    for f in range(k):
        spec = ModelSpec(kind=method, params=params or {}, sampler="class_weight", calibration=None,
                         scale=True, seed=seed)
        model = fit_base(folded.where(F.col("fold") != f), features, label, id_col, spec, stats=known[f])
        clf = model.stages[2]
        vals = clf.featureImportances.toArray() if method == "rf" else np.abs(np.array(clf.coefficients))
        rows += [(f, feat, float(v)) for feat, v in zip(features, vals)]   # feature-sized
    imp = spark.createDataFrame(rows, "fold int, feature string, importance double")
    return importance_summary(imp)


def select_topk_features(summary: DataFrame, topk: int = 50, min_importance: float = 0.0,
                         fallback: int = 20) -> list[str]:
    """Keep importance >= min if min > 0, then the top k if k > 0; if nothing is left, top 20."""
    s = summary
    if min_importance > 0:
        s = s.where(F.col("importance_mean") >= min_importance)
    s = s.orderBy(F.desc("importance_mean"), "feature")
    if topk > 0:
        s = s.limit(topk)
    feats = [r["feature"] for r in s.select("feature").collect()]   # feature-sized
    if not feats:
        feats = [r["feature"] for r in summary.orderBy(F.desc("importance_mean"), "feature").limit(fallback).collect()]
    return feats


def permuted_rows(df: DataFrame, features: list[str], label: str, id_col: str, n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """(id, label, features, _f, _rep): every feature, in every repeat, taken from another row.

    Rows are ranked once, and once more for each repeat under its own seed; the row of equal rank is
    the donor of all features in that repeat. One join for each repeat carries the donors' features
    as a struct, and the features are unfolded after it, which is narrow.
    """
    base = materialize(hash_rank(df.select(id_col, label, *features), id_col, seed, out="_r"), "ranked")
    own = F.struct(*[F.col(f).cast("double").alias(f) for f in features])
    parts = []
    for r in range(n_repeats):
        donors = hash_rank(base.drop("_r"), id_col, seed + 1 + r, out="_r").select("_r", own.alias("_donor"))
        parts.append(base.join(donors, "_r").withColumn("_rep", F.lit(r)))
    wide = parts[0]
    for p in parts[1:]:
        wide = wide.unionByName(p)
    wide = wide.withColumn("_f", F.explode(F.array(*[F.lit(f) for f in features])))
    return wide.select(id_col, label, "_f", "_rep", *[
        F.when(F.col("_f") == f, F.col(f"_donor.{f}")).otherwise(F.col(f).cast("double")).alias(f) for f in features])


def permutation_importance(model: Transformer, df: DataFrame, features: list[str], label: str, id_col: str,
                           n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """Drop in AP and ROC AUC when one feature's values are shuffled across rows: (metric, feature,
    importance_mean, importance_std). A pipeline of this module is scored by ``permute.py``, one pass a repeat;
    anything else with a ``transform`` that adds ``prob`` scores the unfolded rows."""
    parts = parts_of(model)
    if parts:
        scored = permuted_scores(parts, df, features, label, id_col, n_repeats, seed)
    else:
        scored = model.transform(permuted_rows(df, features, label, id_col, n_repeats, seed)).select("_f", "_rep", label, "prob")
    perm = M.ranking_metrics(scored, y=label, prob="prob", by=["_f", "_rep"])
    ref = M.ranking_metrics(model.transform(df), y=label, prob="prob").first()
    drops = perm.select(F.col("_f").alias("feature"), "_rep",
                        (F.lit(ref["pr_auc"]) - F.col("pr_auc")).alias("average_precision"),
                        (F.lit(ref["roc_auc"]) - F.col("roc_auc")).alias("roc_auc"))
    long_m = drops.select("feature", F.explode(F.array(
        F.struct(F.lit("average_precision").alias("metric"), F.col("average_precision").alias("v")),
        F.struct(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("v")))).alias("e")).select("feature", "e.*")
    return long_m.groupBy("metric", "feature").agg(F.avg("v").alias("importance_mean"),
                                                   F.stddev_pop("v").alias("importance_std"))


TRIALS = "trial int, params string, state string, folds int, mean_pr_auc double, std_pr_auc double"


def hyperparameter_search(df: DataFrame, features: list[str], label: str, id_col: str, kind: str = "rf",
                          n_trials: int = 20, timeout_s: float | None = None, group_col: str | None = None,
                          k: int = 5, sampler: str = "smote", seed: int = 42, space: dict | None = None,
                          parallelism: int = DEFAULT_PARALLEL_FITS, race: bool = False) -> tuple[DataFrame, dict | None]:
    """Seeded random search maximising mean CV average precision. Returns (trials, best).

    Folds, the statistics of their train parts and the rows to fit on are made once for all trials. With ``race``, trials are
    judged fold by fold and the weaker half of those still running stops after each; without, all trials
    run all folds. At ``timeout_s`` the running jobs are cancelled by their job tag, so the call ends
    within seconds of the limit. The table has a row a trial: ``state`` is done (all folds), stopped (lost
    the race) or cancelled (the limit), and the mean and deviation are over the ``folds`` it finished. The best
    is the best done trial, or None if no trial was done in time.
    """
    rng = np.random.default_rng(seed)
    draws = [sample_params(kind, rng, space) for _ in range(n_trials)]   # fixed by the seed
    scores: list[list[float]] = [[] for _ in draws]
    running, stopped = list(range(n_trials)), set()
    with temporary_tables(df.sparkSession), TimeLimit(df.sparkSession, timeout_s) as limit:
        known, folded = {}, None

        def prepare(_):
            whole = assign_folds(df, label, id_col, group_col, k, seed).select(id_col, label, "fold", *features)
            return materialize(whole, "folded")

        def spec_of(params: dict) -> ModelSpec:
            return ModelSpec(kind=kind, params=params, sampler=sampler, calibration=None, seed=seed)

        def train_rows(f: int) -> Prepared:
            return prepare_rows(folded.where(F.col("fold") != f), features, label, id_col, spec_of({}), stats=known[f])

        def trial_fold(job: tuple[int, int, Prepared]):
            t, f, ready = job
            model = _uncalibrated(fit_prepared(ready, features, label, spec_of(draws[t])))
            scored = model.transform(folded.where(F.col("fold") == f)).select(label, "prob")
            scores[t].append(float(M.ranking_metrics(scored, y=label, prob="prob").first()["pr_auc"]))

        folded = limit.run(prepare, None)
        known = limit.run(lambda _: fold_statistics(folded, features, "fold", range(k)), None) or {}
        for f in range(k):
            if limit.over or folded is None:
                break
            with temporary_tables(df.sparkSession):
                ready = limit.run(train_rows, f)
                if ready is not None:
                    _in_parallel(lambda job: limit.run(trial_fold, job), [(t, f, ready) for t in running], parallelism)
            if race and f + 1 < k and not limit.over and len(running) > 1:
                ranked = sorted(running, key=lambda t: (-float(np.mean(scores[t])), t))
                stopped |= set(ranked[-(-len(ranked) // 2):])
                running = [t for t in running if t not in stopped]
    rows = []
    for t, got in enumerate(scores):
        state = "done" if len(got) == k else "stopped" if t in stopped else "cancelled"
        rows.append((t, json.dumps(draws[t], sort_keys=True), state, len(got), float(np.mean(got)) if got else None, float(np.std(got)) if got else None))
    table = df.sparkSession.createDataFrame(rows, TRIALS)
    done = [r for r in rows if r[2] == "done"]
    if not done:
        return table, None
    best = max(done, key=lambda r: (r[4], -r[0]))
    return table, best_record(kind, sampler, json.loads(best[1]), best[4])


class TimeLimit:
    """Work in tagged Spark jobs that are cancelled once the limit is over."""

    def __init__(self, spark, seconds: float | None):
        self.sc, self.seconds, self.tag = spark.sparkContext, seconds, f"limit-{uuid.uuid4().hex}"
        self.ended = threading.Event()
        self.end = None if seconds is None else time.monotonic() + seconds

    @property
    def over(self) -> bool:
        return self.end is not None and time.monotonic() >= self.end

    def __enter__(self) -> "TimeLimit":
        if self.end is not None:
            threading.Thread(target=self._watch, daemon=True).start()
        return self

    def __exit__(self, *exc) -> None:
        self.ended.set()

    def _watch(self) -> None:
        self.ended.wait(max(0.0, self.end - time.monotonic()))
        while not self.ended.wait(0.25):  # a fit goes on from job to job: each next one is cancelled too
            self.sc.cancelJobsWithTag(self.tag)

    def run(self, fn, arg):
        """``fn(arg)``, or None when the limit ended it or was over before."""
        if self.over:
            return None
        self.sc.addJobTag(self.tag)
        try:
            return fn(arg)
        except Exception:
            if self.over:
                return None
            raise
        finally:
            self.sc.removeJobTag(self.tag)


#: The names that a stored best trial gives the settings of each model.
RECORD_PREFIX = {"rf": "rf_", "gbm": "gbm_"}
RECORD_NAMES = {"n_estimators": "n_estimators", "max_depth": "max_depth", "min_samples_leaf": "min_samples_leaf",
                "max_features": "max_features", "learning_rate": "learning_rate", "subsample": "subsample"}


def best_record(kind: str, sampler: str, params: dict, value: float) -> dict:
    """The stored form of a best trial: model, best_value, sampler, best_params with prefixed names."""
    return {"model": kind, "best_value": value, "sampler": sampler,
            "best_params": {RECORD_PREFIX[kind] + RECORD_NAMES[k]: v for k, v in params.items()}}


def write_best(spark, record: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_best(spark, path: str) -> dict:
    return json.loads("".join(r["value"] for r in spark.read.text(path).collect()))   # one small record


def spec_of_best(best: dict, sampler: str | None = None, calibration: str | None = "isotonic", inner_cv: int = 3, seed: int = 42) -> ModelSpec:
    """The model of a stored record; what it leaves out takes the refit's own defaults."""
    kind, stored = best.get("model"), best.get("best_params")
    if kind not in RECORD_PREFIX or not isinstance(stored, dict):
        raise ValueError(f"no best trial: a record needs 'model' ({sorted(RECORD_PREFIX)}) and 'best_params', this one has {sorted(best)}")
    names = {RECORD_PREFIX[kind] + v: k for k, v in RECORD_NAMES.items()}
    params = dict(RF_REFIT_DEFAULTS if kind == "rf" else GBM_REFIT_DEFAULTS)
    params |= {names[k]: v for k, v in stored.items() if k in names and names[k] in params}
    return ModelSpec(kind=kind, params=params, sampler=sampler or best.get("sampler") or "none", calibration=calibration, inner_cv=inner_cv, seed=seed)


def refit_from_best(df: DataFrame, features: list[str], label: str, id_col: str, best: dict,
                    sampler: str | None = None, calibration: str = "isotonic", inner_cv: int = 3,
                    seed: int = 42) -> PipelineModel:
    """Rebuild the pipeline from a stored best trial (its sampler unless one is given)."""
    return fit_model(df, features, label, id_col, spec_of_best(best, sampler, calibration, inner_cv, seed))


# --------------------------------------------------------------------------- scoring / persistence

def score(model: PipelineModel, df: DataFrame, feature_cols: list[str], th: float = 0.5,
          prob_col: str = "prob_sequia", pred_prefix: str = "pred_sequia_th_") -> DataFrame:
    """Append the probability and the thresholded label; extra input columns pass through.
    Stateless and narrow, so it also accepts a streaming DataFrame."""
    require_columns(df, feature_cols, "input")
    out = model.transform(df).withColumnRenamed("prob", prob_col)
    return out.withColumn(f"{pred_prefix}{th:.2f}", (F.col(prob_col) >= F.lit(float(th))).cast("int"))


def save_model(model: PipelineModel, path: str, feature_cols: list[str], meta: dict | None = None) -> None:
    """The pipeline plus its feature list and metadata (JSON text under the same folder)."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(path)

    s = SparkSession.getActiveSession()
    payload = json.dumps({"feature_columns": list(feature_cols), "meta": meta or {}}, sort_keys=True)
    s.createDataFrame([(payload,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_isohyet_meta")


def load_model(path: str) -> tuple[PipelineModel, list[str], dict]:
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    model = PipelineModel.load(path)
    payload = json.loads(s.read.text(f"{path}/_isohyet_meta").first()["value"])
    return model, payload["feature_columns"], payload.get("meta", {})


def spec_dict(spec: ModelSpec) -> dict:
    return asdict(spec)
