"""Exact quantiles of many groups at once by distributed selection of ranks.

Spark's ``percentile`` keeps the distinct values of a group in one task. Here a group with many
distinct values is searched instead: its values are counted once into a table of (group, value,
weights); each step cuts every open interval of a group into ``PIECES`` by approximate quantiles,
counts the pieces exactly, and goes on in the pieces that hold a wanted rank. An interval of at
most ``ORDERED_VALUES`` distinct values is put in order by one task. The cuts only steer the
search: the counts decide, so the result is exact whatever the cuts are.

A step reduces the open values by about ``PIECES``, so steps grow with the logarithm of the largest
group. Rows meet the intervals of their group through a salted key, so no group is one task, and
intervals live in a written table: the driver reads one number a step.

A weight column counts each value in one setting (one train set of a cross-validation, say), so the
quantiles of all settings come from the same passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .strategy import null_safe_keys

#: Distinct values of an interval that one task puts in order.
ORDERED_VALUES = 100_000
#: Pieces that an interval is cut into at each step.
PIECES = 32
#: Parts that the rows of a group are dealt into when they meet its intervals.
SALTS = 64

_ACCURACY = 2_000


def _wanted(total: Column, p: float) -> tuple[Column, Column, Column]:
    """(position, lower rank, upper rank) of a quantile with linear interpolation."""
    position = (total - 1).cast("double") * F.lit(float(p))
    return position, F.floor(position), F.ceil(position)


def _meet(counts: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each counted value with the interval of its group that it lies in."""
    wide = parts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    a = counts.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int")).alias("_a")
    b = wide.alias("_b")
    inside = (F.col("_a._v") >= F.col("_b._lo")) & (F.col("_a._v") <= F.col("_b._hi"))
    extra = [c for c in parts.columns if c not in keys]
    return a.join(b, null_safe_keys(a, b, [*keys, "_salt"]) & inside).select("_a.*", *[F.col(f"_b.{c}") for c in extra]).drop("_salt")


def _holds(totals: list[Column], befores: list[Column], sizes: list[Column], probs: Sequence[float]) -> Column:
    """Whether a piece holds a wanted rank of any weight."""
    hit = F.lit(False)
    for t, b, s in zip(totals, befores, sizes):
        for p in probs:
            for rank in _wanted(t, p)[1:]:
                hit = hit | ((rank >= b) & (rank < b + s))
    return hit


def _running(c: str, keys: Sequence[str], order: str) -> Column:
    w = Window.partitionBy(*keys, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(c).over(w), F.lit(0))


def weighted_quantiles(counts: DataFrame, keys: Sequence[str], value: str, weights: Sequence[str], probs: Sequence[float],
                       ordered_values: int | None = None) -> DataFrame:
    """Interpolated quantiles of every group: keys, and ``q_{weight}_{i}`` (double) for each weight and probability.

    ``counts`` has one row for each key and value, with a count in each weight column; it is read several
    times, so give it a written table. Null values are not counted, NaN is the largest value, null
    keys are a group; a weight that sums to zero in a group has null quantiles.
    """
    most = ordered_values or ORDERED_VALUES
    keys, weights = list(keys), list(weights)
    counts = counts.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"), *weights)
    total = {w: f"_t_{w}" for w in weights}
    before = {w: f"_b_{w}" for w in weights}
    parts = counts.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_d"),
                                      *[F.sum(w).alias(total[w]) for w in weights])
    parts = materialize(parts.select("*", F.lit("").alias("_part"), *[F.lit(0).cast("long").alias(b) for b in before.values()]), "intervals")
    columns, open_ = parts.columns, None
    while True:
        largest = parts.agg(F.max("_d")).first()[0] or 0
        if largest <= most or (open_ is not None and largest >= open_):
            break
        open_ = largest
        todo = parts.where(F.col("_d") > most)
        cuts = _meet(counts, todo, keys).groupBy(*keys, "_part").agg(
            F.percentile_approx("_v", [i / PIECES for i in range(1, PIECES)], _ACCURACY).alias("_cuts"))
        a, b = todo.alias("_t"), cuts.alias("_c")
        todo = materialize(a.join(b, null_safe_keys(a, b, [*keys, "_part"])).select("_t.*", "_c._cuts"), "cuts")
        piece = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
        names = [c for c in columns if c not in ("_lo", "_hi", "_d", *keys)]
        cells = _meet(counts, todo, keys).groupBy(*keys, "_part", piece.alias("_piece")).agg(
            F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_d"),
            *[F.first(c).alias(c) for c in names if c != "_part"], *[F.sum(w).alias(w) for w in weights])
        cells = cells.select("*", *[(F.col(before[w]) + _running(w, keys, "_piece")).alias(f"_now_{w}") for w in weights])
        cells = cells.where(_holds([F.col(total[w]) for w in weights], [F.col(f"_now_{w}") for w in weights], [F.col(w) for w in weights], probs))
        cells = cells.withColumn("_part", F.concat_ws(".", "_part", F.col("_piece").cast("string"))) \
            .drop(*before.values()).withColumnsRenamed({f"_now_{w}": before[w] for w in weights})
        parts = materialize(parts.where(F.col("_d") <= most).unionByName(cells.select(*columns)), "intervals")
    rows = _meet(counts, parts, keys).select("*", *[(F.col(before[w]) + _running(w, keys, "_v")).alias(f"_now_{w}") for w in weights])
    found, out = [], []
    for w in weights:
        first, last = F.col(f"_now_{w}"), F.col(f"_now_{w}") + F.col(w)
        for i, p in enumerate(probs):
            position, lower, upper = _wanted(F.col(total[w]), p)
            found += [F.max(F.when((rank >= first) & (rank < last), F.col("_v"))).alias(f"_{half}_{w}_{i}") for half, rank in (("l", lower), ("u", upper))]
            lo, hi = F.col(f"_l_{w}_{i}"), F.col(f"_u_{w}_{i}")
            mixed = (upper.cast("double") - position) * lo + (position - lower.cast("double")) * hi
            out.append(F.when(lo == hi, lo).otherwise(mixed).alias(f"q_{w}_{i}"))
    return rows.groupBy(*keys).agg(*found, *[F.first(t).alias(t) for t in total.values()]).select(*keys, *out)


def grouped_quantile(df: DataFrame, value: str, keys: Sequence[str], p: float, out: str = "quantile",
                     ordered_values: int | None = None) -> DataFrame:
    """Exact quantile of ``value`` in every group, linear between ranks; nulls skipped, null keys form a group.

    Groups of at most ``ordered_values`` rows are one aggregate; the values of larger groups are counted
    and searched, which no task sees whole.
    """
    most = ordered_values or ORDERED_VALUES
    keys = list(keys)
    plain = F.percentile(F.col(value), F.lit(float(p))).alias(out)
    sizes = df.groupBy(*keys).agg(F.count(value).alias("_n")).where(F.col("_n") > most).drop("_n")
    if sizes.isEmpty():
        return df.groupBy(*keys).agg(plain)
    large = materialize(sizes, "large_groups")
    a, b = df.select(*keys, value).alias("_d"), large.alias("_g")
    same = null_safe_keys(a, b, keys)
    small = a.join(b, same, "left_anti").groupBy(*keys).agg(plain)
    counts = a.join(b, same, "left_semi").where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    found = weighted_quantiles(materialize(counts, "values"), keys, "_value", ["n"], [p], most)
    return small.unionByName(found.withColumnRenamed("q_n_0", out))
