"""Ordered features by runs: lags, rolling and past-rolling means that no hot site can stall.

A window over (site) ordered by date puts a whole site into one task. Here every site is cut into
runs of ``RUN_ROWS`` rows, whatever its size, and a run also gets copies of the last rows of the
run before it, as many as the deepest look-back needs. The window is then over (site, run), so a
site that holds a third of all rows is spread over many tasks and n (1 + H / RUN_ROWS) rows move.

Row numbers within a site come from ranges of (site, order columns), which any orderable type has: the
rows are dealt into ranges, sorted, and written once to the shared checkpoint folder with their place;
a row's number is its place in its range and the site's rows in the ranges before. So a hot site is
many ranges whatever its order column is, and moments and features read the same written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .strategy import null_safe_keys

RUN_ROWS = 65_536


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "_rn") -> DataFrame:
    """``df``, written, with the 0-based row number per site in ``order`` (nulls first).

    The range table has a row for each range and site in it, and is written so that its size decides
    whether it is broadcast.
    """
    by = [*keys, *order]
    at, part = "_at", F.shiftright("_at", 33)
    d = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(at, F.monotonically_increasing_id()), "ordered")
    ranges = d.groupBy(*keys, part.alias("_part")).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)   # one row a range
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    ranges = materialize(ranges.select(*keys, "_part", shift.alias("_shift")), "ranges")
    a, o = d.withColumn("_part", part).alias("_d"), ranges.alias("_o")
    joined = a.join(o, null_safe_keys(a, o, [*keys, "_part"])).select("_d.*", F.col("_o._shift"))
    return joined.withColumn(out, F.col(at) + F.col("_shift")).drop(at, "_part", "_shift")


def over_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int, features,
              run_rows: int | None = None) -> DataFrame:
    """``df`` with ``features(keys, order)``: window columns that look back at most ``depth`` rows of a site.

    ``df`` is numbered by :func:`number_rows` first, unless it already has its column ``_rn``.
    """
    size = max(run_rows or RUN_ROWS, depth + 1)
    base = [c for c in df.columns if c != "_rn"]
    d = df if "_rn" in df.columns else number_rows(df, keys, order)
    run = F.floor(F.col("_rn") / size)
    into_next = (F.col("_rn") % size >= size - depth) if depth else F.lit(False)
    d = d.withColumn("_own", run).withColumn(
        "_run", F.explode(F.when(into_next, F.array(run, run + 1)).otherwise(F.array(run))))
    out = d.select(*base, "_own", "_run", *features([*keys, "_run"], ["_rn"]))
    return out.where("_own = _run").drop("_own", "_run")


def site_moments(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Mean and population deviation per site: a partial aggregate, so a hot site is one row a task."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"_mu_{i}") for i, c in enumerate(cols)],
                                 *[F.stddev_pop(c).alias(f"_sd_{i}") for i, c in enumerate(cols)])
