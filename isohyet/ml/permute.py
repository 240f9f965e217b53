"""Scores after permuting one feature, for fitted pipelines of trees or linear models, without unfolding rows.

A row and its donor meet once a repeat. One pass over the pair scores all features: a tree is walked
once for the row as it is, and again for a feature only where the row's path tests that feature; everywhere
else its leaf stands. The result is one array of probabilities a row, a number for each feature, added
up in the order in which the model itself adds them, so equal scores stay equal.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import hash_rank
from ..session import materialize, scratch_path
from .stages import DropColumns, LogisticProbability, MeanOfColumns, PlattScaler, PositiveProbability


@dataclass
class Part:
    """One base model: its preparing stages, its form and its calibrator."""

    prepare: list
    vector: str
    model: Any = None
    calibrator: Any = None


def parts_of(model) -> list[Part] | None:
    """The base models of a pipeline made by ``train.fit_model``; None for any other transformer."""
    if not isinstance(model, PipelineModel):
        return None
    parts: list[Part] = []
    before = None
    for st in model.stages:
        if isinstance(st, VectorAssembler):
            parts.append(Part([before, st], st.getOutputCol()))
        elif isinstance(st, (RandomForestClassificationModel, GBTClassificationModel, LogisticProbability)):
            parts[-1].model = st
        elif isinstance(st, (PlattScaler, IsotonicRegressionModel)):
            parts[-1].calibrator = st
        elif not isinstance(st, (PositiveProbability, DropColumns, MeanOfColumns)) and st.__class__.__name__ != "SQLTransformer":
            return None
        before = st
    return parts if parts and all(p.model is not None for p in parts) else None


def trees_of(spark, model) -> list[tuple]:
    """(feature, threshold, left, right, value of class 0, value of class 1, weight) of each tree, as arrays by node.

    Read from the model's saved form, which is a table of nodes; feature -1 marks a leaf.
    """
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    stats = node["impurityStats"]
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", node["id"].alias("id"), node["prediction"].alias("prediction"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.get(stats, F.lit(0)).alias("c0"), F.get(stats, F.lit(1)).alias("c1")).toPandas()   # the model itself
    forest = isinstance(model, RandomForestClassificationModel)
    weights = model.treeWeights
    out = []
    for t, g in rows.sort_values(["treeID", "id"]).groupby("treeID"):
        if forest:
            total = g["c0"] + g["c1"]
            v0, v1 = (g["c0"] / total).to_numpy(np.float64), (g["c1"] / total).to_numpy(np.float64)
        else:
            v0, v1 = np.zeros(len(g)), g["prediction"].to_numpy(np.float64)
        out.append((np.where(g["left"] < 0, -1, g["feature"]).astype(np.int64), g["threshold"].fillna(0.0).to_numpy(np.float64), g["left"].to_numpy(np.int64),
                    g["right"].to_numpy(np.int64), v0, v1, 1.0 if forest else float(weights[int(t)])))
    return out


def _calibration(stage) -> tuple | None:
    if stage is None:
        return None
    if isinstance(stage, PlattScaler):
        return "sigmoid", float(stage.getOrDefault("a")), float(stage.getOrDefault("b"))
    return "isotonic", np.array(stage.boundaries.toArray()), np.array(stage.predictions.toArray())


def _forms(spark, parts: list[Part]) -> list[dict]:
    out = []
    for p in parts:
        if isinstance(p.model, LogisticProbability):
            form = {"kind": "linear", "weights": np.array(p.model.coefficients), "intercept": float(p.model.getOrDefault("intercept"))}
        else:
            form = {"kind": "forest" if isinstance(p.model, RandomForestClassificationModel) else "boosted", "trees": trees_of(spark, p.model)}
        out.append(form | {"calibration": _calibration(p.calibrator)})
    return out


def _scorer(shared, n_features: int, label: str):
    """Batches of (label, _x0, _y0, _x1, ...) to (label, p): the probability after each feature is permuted."""

    def walk(tree, x, y, own, f):
        feature, threshold, left, right = tree[:4]
        node = np.zeros(len(own), np.int64)
        open_ = np.flatnonzero(feature[node] >= 0)
        while len(open_):
            at = node[open_]
            test = feature[at]
            v = np.where(test == f, y[own[open_], f], x[own[open_], test])
            node[open_] = np.where(v <= threshold[at], left[at], right[at])
            open_ = open_[feature[node[open_]] >= 0]
        return node

    def trees_score(form, x, y):
        n = len(x)
        sum0, sum1 = np.zeros((n, n_features)), np.zeros((n, n_features))
        for tree in form["trees"]:
            feature, threshold, left, right, v0, v1, weight = tree
            node, used = np.zeros(n, np.int64), np.zeros((n, n_features), bool)
            open_ = np.flatnonzero(feature[node] >= 0)
            while len(open_):
                at = node[open_]
                test = feature[at]
                used[open_, test] = True
                node[open_] = np.where(x[open_, test] <= threshold[at], left[at], right[at])
                open_ = open_[feature[node[open_]] >= 0]
            leaf = np.repeat(node[:, None], n_features, axis=1)
            for f in np.unique(feature[feature >= 0]):
                own = np.flatnonzero(used[:, f])
                if len(own):
                    leaf[own, f] = walk(tree, x, y, own, f)
            sum0 += weight * v0[leaf]
            sum1 += weight * v1[leaf]
        return sum1 / (sum0 + sum1) if form["kind"] == "forest" else 1.0 / (1.0 + np.exp(-2.0 * sum1))

    def linear_score(form, x, y):
        margin = x @ form["weights"] + form["intercept"]
        return 1.0 / (1.0 + np.exp(-(margin[:, None] + (y - x) * form["weights"][None, :])))

    def calibrated(p, calibration):
        if calibration is None:
            return p
        kind, a, b = calibration
        return 1.0 / (1.0 + np.exp(-(a * p + b))) if kind == "sigmoid" else np.interp(p, a, b)

    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            total = np.zeros((len(pdf), n_features))
            for b, form in enumerate(shared.value):
                x, y = (np.stack(pdf[f"_{c}{b}"].to_numpy()).astype(np.float64) for c in "xy")
                total += calibrated((linear_score if form["kind"] == "linear" else trees_score)(form, x, y), form["calibration"])
            yield pd.DataFrame({label: pdf[label].to_numpy(), "p": list(total / len(shared.value))})

    return run


def permuted_scores(parts: list[Part], df: DataFrame, features: list[str], label: str, id_col: str, n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """(label, _f, _rep, prob): the score of every row with each feature taken from its donor of each repeat.

    Rows are ranked once, and once more for each repeat under its own seed; the row of equal rank is
    the donor of all features in that repeat.
    """
    spark = df.sparkSession
    d = df.select(id_col, label, *features)
    for p in parts:
        for st in p.prepare:
            d = st.transform(d)
    vectors = [vector_to_array(p.vector).alias(f"_x{b}") for b, p in enumerate(parts)]
    base = materialize(hash_rank(d.select(id_col, F.col(label).cast("int").alias(label), *vectors), id_col, seed, out="_r"), "ranked")
    shared = spark.sparkContext.broadcast(_forms(spark, parts))
    own = [f"_x{b}" for b in range(len(parts))]
    out = None
    for r in range(n_repeats):
        donors = hash_rank(base.drop("_r", label), id_col, seed + 1 + r, out="_r").select("_r", *[F.col(c).alias(c.replace("x", "y")) for c in own])
        pairs = base.join(donors, "_r").select(label, *own, *[c.replace("x", "y") for c in own])
        scored = pairs.mapInPandas(_scorer(shared, len(features), label), f"`{label}` int, p array<double>").withColumn("_rep", F.lit(r))
        out = scored if out is None else out.unionByName(scored)
    names = F.array(*[F.lit(f) for f in features])
    return out.select(label, "_rep", F.explode(F.arrays_zip(names.alias("f"), F.col("p").alias("p"))).alias("e")) \
        .select(label, F.col("e.f").alias("_f"), "_rep", F.col("e.p").alias("prob"))
