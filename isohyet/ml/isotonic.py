"""Isotonic regression by hierarchical pooling of adjacent violators.

Distinct scores are dealt into ranges of the score; a task pools its range in order, which leaves a
stack of (lo, hi, sum, weight) with rising means. Neighbouring stacks are then merged in a tree. Two
rising stacks only meet where they violate the order: left entries whose mean reaches the first of the
right stack, and right entries whose mean is not above the last of the left one. Only those are sent to the
task of the pair; the rest of both stacks stays as it is. Pooling in any order of merges gives the
same, unique solution.

What a range holds follows ``RANGE_ROWS``, so tasks stay small at every size and the tree grows by one
level when the scores double. The driver receives the finished pools alone, which are the model;
with 0/1 labels their means are distinct rising fractions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Distinct scores that a range is meant to hold.
RANGE_ROWS = 65_536

_STACK = "node long, lo double, hi double, total double, weight double"


def _pooling():
    """The pooling of rows in score order: arrays in, arrays of pools out. Self-contained, for workers."""

    def pool(lo, hi, total, weight):
        out: list[list[float]] = []
        for row in zip(lo, hi, total, weight):
            row = list(row)
            while out and out[-1][2] * row[3] >= row[2] * out[-1][3]:  # the mean before is not below
                last = out.pop()
                row = [last[0], row[1], last[2] + row[2], last[3] + row[3]]
            out.append(row)
        return out

    return pool


def _pool_range(rows: DataFrame) -> DataFrame:
    """Each partition (one range, sorted) as a stack; node: the number of the range."""
    pool = _pooling()

    def run(batches):
        held, node = [], None
        for rb in batches:
            if rb.num_rows:
                node = rb.column(0)[0].as_py()
                s, t, w = (rb.column(i).to_numpy() for i in (1, 2, 3))
                before = [np.array(c) for c in zip(*held)] if held else [np.zeros(0)] * 4
                held = pool(*[np.concatenate([b, c]).tolist() for b, c in zip(before, (s, s, t, w))])
        for at in range(0, len(held), 10_000):
            part = list(zip(*held[at:at + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array([node] * len(part[0]), pa.int64()), *[pa.array(c, pa.float64()) for c in part]],
                                             names=["node", "lo", "hi", "total", "weight"])

    numbered = rows.withColumn("node", F.spark_partition_id().cast("long"))
    return numbered.select("node", "s", "total", "weight").mapInArrow(run, _STACK)


def pooled_scores(by_score: DataFrame, range_rows: int | None = None) -> DataFrame:
    """(lo, hi, total, weight) of the pools of ``by_score`` (s, total, weight; one row a score), rising in total / weight.

    Rows of null or NaN scores or of no weight are left out; an empty table gives no pools.
    """
    rows = by_score.select(F.col("s").cast("double").alias("s"), F.col("total").cast("double").alias("total"), F.col("weight").cast("double").alias("weight"))
    rows = materialize(rows.where("s is not null and not isnan(s) and weight > 0"), "isotonic_scores")
    ranges = max(1, -(-rows.count() // (range_rows or RANGE_ROWS)))
    dealt = rows.repartitionByRange(ranges, "s").sortWithinPartitions("s")
    stacks = materialize(_pool_range(dealt), "isotonic_stacks")
    pool = _pooling()

    def merge(pdf):
        pdf = pdf.sort_values("lo")
        out = pd.DataFrame(pool(pdf["lo"].tolist(), pdf["hi"].tolist(), pdf["total"].tolist(), pdf["weight"].tolist()), columns=["lo", "hi", "total", "weight"])
        out.insert(0, "node", pdf["node"].iloc[0] // 2)
        return out

    nodes = stacks.agg(F.max("node")).first()[0] or 0
    while nodes > 0:
        pair, mean = F.floor(F.col("node") / 2), F.col("total") / F.col("weight")
        left = F.col("node") % 2 == 0
        ends = stacks.groupBy(pair.alias("_pair")).agg(F.max(F.when(left, mean)).alias("_last"), F.min(F.when(~left, mean)).alias("_first"))
        met = stacks.withColumn("_pair", pair).join(ends, "_pair")
        meets = F.coalesce(F.when(left, mean >= F.col("_first")).otherwise(mean <= F.col("_last")), F.lit(False))
        met = materialize(met.select("node", "lo", "hi", "total", "weight", meets.alias("_meets")), "isotonic_met")
        rest = met.where("not _meets").select(pair.alias("node"), "lo", "hi", "total", "weight")
        merged = met.where("_meets").drop("_meets").groupBy(pair.alias("_p")).applyInPandas(merge, _STACK)
        stacks = materialize(rest.unionByName(merged), "isotonic_stacks")
        nodes //= 2
    return stacks.drop("node")


def fit_isotonic(by_score: DataFrame, features_col: str, prediction_col: str, range_rows: int | None = None):
    """A fitted isotonic stage (linear between pools, clipped outside) for ``by_score`` (s, total, weight).

    The pools rise already, so the estimator that makes the persistable stage has nothing left to pool.
    """
    pools = pooled_scores(by_score, range_rows)
    mean = F.col("total") / F.col("weight")
    ends = F.array(F.struct(F.col("lo").alias("s")), F.struct(F.col("hi").alias("s")))
    rows = pools.select(F.explode(F.array_distinct(ends)).alias("e"), mean.alias("_y"), F.col("weight").alias("_w")).select(F.col("e.s").alias(features_col), "_y", "_w")
    return IsotonicRegression(featuresCol=features_col, labelCol="_y", weightCol="_w", predictionCol=prediction_col, isotonic=True).fit(rows)
