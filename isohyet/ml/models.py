"""Classifier construction from reference-style parameter dictionaries.

The reference's knobs map onto Spark ML estimators:
trees -> numTrees / maxIter, depth None -> 30 (Spark's cap), min leaf -> minInstancesPerNode,
max_features sqrt / fraction -> featureSubsetStrategy, class_weight balanced -> weightCol.
Spark forests bin continuous features (maxBins). With ``bins="exact"`` a column's candidate splits are the
middles between all its distinct values, as in the reference's trees, for up to ``MAX_EXACT_BINS`` values;
a column with more has that many quantile bins. The deepest tree has 30 levels. The L1 model is
``l1.py``, with the reference's objective.
"""

from __future__ import annotations

import math
from typing import Any

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

SPARK_MAX_DEPTH = 30
#: Bins that exact splits may take: a node's histogram has features x bins entries.
MAX_EXACT_BINS = 4096

# Fixed values that must equal the reference's for identical results (default model settings).
RF_DEFAULTS = {"n_estimators": 400, "max_depth": None, "min_samples_leaf": 2, "max_features": "sqrt"}
GBM_DEFAULTS = {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 3, "min_samples_leaf": 1, "subsample": 1.0}
L1_DEFAULTS = {"C": 1.0, "max_iter": 2000}
# Fixed values that must equal the reference's: search spaces of the tuning step, and the settings
# that a refit takes for what a stored trial leaves out.
RF_SPACE = {"n_estimators": (200, 1000, 100), "max_depth": (4, 24), "min_samples_leaf": (1, 10),
            "max_features": (0.3, 1.0)}
GBM_SPACE = {"n_estimators": (100, 800, 100), "learning_rate": (0.01, 0.2), "max_depth": (2, 6),
             "min_samples_leaf": (1, 10), "subsample": (0.6, 1.0)}
RF_REFIT_DEFAULTS = {"n_estimators": 400, "max_depth": 12, "min_samples_leaf": 2, "max_features": 0.8}
GBM_REFIT_DEFAULTS = {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 3, "min_samples_leaf": 2, "subsample": 1.0}


def _depth(d) -> int:
    """Unlimited depth is the deepest that the tree learner has; a deeper one than that is refused."""
    if d is not None and not 0 <= int(d) <= SPARK_MAX_DEPTH:
        raise ValueError(f"max_depth {d} is outside 0 .. {SPARK_MAX_DEPTH}")
    return SPARK_MAX_DEPTH if d is None else int(d)


def _subset(mf) -> str:
    if mf is None:
        return "all"
    if isinstance(mf, str):
        return mf
    if isinstance(mf, int):  # so many features; 1.0 as a float is all of them
        return str(mf)
    return repr(float(mf)) if float(mf) < 1.0 else "all"


def make_classifier(kind: str = "rf", params: dict[str, Any] | None = None, seed: int = 42,
                    features_col: str = "features", label_col: str = "label", weight_col: str | None = None,
                    prob_col: str = "probability", raw_col: str = "rawPrediction", pred_col: str = "prediction"):
    p = dict(params or {})
    common = dict(featuresCol=features_col, labelCol=label_col, predictionCol=pred_col)
    if kind == "rf":
        q = {**RF_DEFAULTS, **p}
        est = RandomForestClassifier(
            numTrees=int(q["n_estimators"]), maxDepth=_depth(q["max_depth"]),
            minInstancesPerNode=int(q["min_samples_leaf"]), featureSubsetStrategy=_subset(q["max_features"]),
            seed=seed, probabilityCol=prob_col, rawPredictionCol=raw_col, maxBins=int(q.get("bins") or 32),
            bootstrap=bool(q.get("bootstrap", True)), **common)
    elif kind == "gbm":
        q = {**GBM_DEFAULTS, **p}
        est = GBTClassifier(
            maxIter=int(q["n_estimators"]), stepSize=float(q["learning_rate"]), maxDepth=_depth(q["max_depth"]),
            minInstancesPerNode=int(q["min_samples_leaf"]), subsamplingRate=float(q["subsample"]), seed=seed,
            **common)
        est._set(probabilityCol=prob_col, rawPredictionCol=raw_col)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    if weight_col:
        est = est.setWeightCol(weight_col)
    return est


def resolve_bins(params: dict[str, Any], train, features) -> dict[str, Any]:
    """``bins="exact"`` as a number: one more than the most distinct values that a column of ``train`` has.

    Values are counted exactly when the approximate count is near the limit or below it.
    """
    if params.get("bins") != "exact" or not features:
        return params
    rough = train.agg(*[F.approx_count_distinct(c, 0.02).alias(f"_{i}") for i, c in enumerate(features)]).first()
    near = [c for i, c in enumerate(features) if rough[f"_{i}"] <= 1.2 * MAX_EXACT_BINS]
    most = MAX_EXACT_BINS if len(near) < len(features) else 0
    if near and not most:
        values = train.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(near)])).alias("e"))
        counts = values.select("e.*").where("v is not null").distinct().groupBy("i").count().agg(F.max("count").alias("m")).first()["m"]
        most = min(MAX_EXACT_BINS, (counts or 0) + 2)   # the imputed median may be a value of its own
    return {**params, "bins": max(2, most)}


def sample_params(kind: str, rng, space: dict | None = None) -> dict[str, Any]:
    """One draw from the tuning space (numpy Generator ``rng``); ``space`` overrides ranges."""
    RF = {**RF_SPACE, **(space or {})}
    GB = {**GBM_SPACE, **(space or {})}
    if kind == "rf":
        lo, hi, st = RF["n_estimators"]
        return {"n_estimators": int(rng.choice(range(lo, hi + 1, st))),
                "max_depth": int(rng.integers(RF["max_depth"][0], RF["max_depth"][1] + 1)),
                "min_samples_leaf": int(rng.integers(RF["min_samples_leaf"][0], RF["min_samples_leaf"][1] + 1)),
                "max_features": float(rng.uniform(*RF["max_features"]))}
    if kind == "gbm":
        lo, hi, st = GB["n_estimators"]
        llo, lhi = GB["learning_rate"]
        return {"n_estimators": int(rng.choice(range(lo, hi + 1, st))),
                "learning_rate": float(math.exp(rng.uniform(math.log(llo), math.log(lhi)))),
                "max_depth": int(rng.integers(GB["max_depth"][0], GB["max_depth"][1] + 1)),
                "min_samples_leaf": int(rng.integers(GB["min_samples_leaf"][0], GB["min_samples_leaf"][1] + 1)),
                "subsample": float(rng.uniform(*GB["subsample"]))}
    raise ValueError(f"no search space for {kind!r}")
