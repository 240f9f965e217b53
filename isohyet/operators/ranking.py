"""Deterministic sampling and fold assignment.

Everything is keyed by a stable hash (md5 of ``"<id>:<seed>"``) so a run is reproducible, and
an exact rank by that hash is computed WITHOUT a single-task window: rows are first spread
over 16^d hash buckets (uniform because the hash is), ranks are taken per (stratum, bucket),
and a small per-bucket count table supplies the offsets. A stratum holding a third of all
rows is therefore still ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .strategy import null_safe_keys

HASH_BUCKET_HEX_DIGITS = 3          # 4096 buckets per stratum


def stable_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def hash_rank(df: DataFrame, id_col: str, seed: int, strata: Sequence[str] = (),
              out: str = "_rank", digits: int = HASH_BUCKET_HEX_DIGITS) -> DataFrame:
    """Add ``out`` = 0-based rank of each row by (hash(id, seed), id) within ``strata``."""
    strata = list(strata)
    h = df.withColumn("_h", stable_hash(id_col, seed)).withColumn(
        "_b", F.coalesce(F.conv(F.substring("_h", 1, digits), 16, 10).cast("int"), F.lit(-1)))
    counts = h.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    # offsets over the count table only (<= 16^digits rows per stratum, never the data rows);
    # without strata the whole table is one such small group
    wo = (Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))).orderBy("_b") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*strata, "_b", F.coalesce(F.sum("_nb").over(wo), F.lit(0)).alias("_off"))
    # at most 16^digits rows per stratum. It is an aggregate, so AQE sees its exact size when the
    # shuffle stage completes and broadcasts it then; counting it first would cost a full pass.
    local = F.row_number().over(Window.partitionBy(*strata, "_b").orderBy("_h", id_col)) - 1
    ranked = h.withColumn("_loc", local)
    a, o = ranked.alias("_a"), offsets.alias("_o")
    ranked = a.join(o, null_safe_keys(a, o, [*strata, "_b"]), "inner").select("_a.*", "_o._off")
    return ranked.withColumn(out, (F.col("_off") + F.col("_loc")).cast("bigint")).drop("_h", "_b", "_loc", "_off")


# --------------------------------------------------------------------------- sampling

def sample_groups(df: DataFrame, group: str, frac: float, seed: int = 42) -> DataFrame:
    """Keep ``max(1, int(n_groups * frac))`` whole groups (null groups never chosen).

    Returned whole if ``frac >= 0.999``. Groups are chosen by hash rank (deterministic).
    """
    if frac >= 0.999:
        return df
    groups = df.where(F.col(group).isNotNull()).select(group).distinct()
    n_groups = groups.count()
    n_keep = max(1, int(n_groups * frac))
    chosen = hash_rank(groups, group, seed).where(F.col("_rank") < n_keep).select(group)
    return df.join(chosen, group, "left_semi")


def sample_stratified(df: DataFrame, label: str, id_col: str, frac: float, seed: int = 42) -> DataFrame:
    """Keep ``round(frac * n_c)`` rows of every class c (exact sizes, hash-chosen)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    sizes = sizes.select(label, F.round(F.col("_nc") * F.lit(float(frac))).cast("bigint").alias("_keep"))
    ranked = hash_rank(df, id_col, seed, strata=[label])
    # one row per class: bounded by the number of classes
    return ranked.join(F.broadcast(sizes), label).where(F.col("_rank") < F.col("_keep")).drop("_rank", "_keep")


# --------------------------------------------------------------------------- folds

def shuffled_kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """k nearly equal folds in hash order (no groups, no strata)."""
    return hash_rank(df, id_col, seed, out="_r").withColumn(out, (F.col("_r") % k).cast("int")).drop("_r")


def stratified_kfold(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Each class dealt round-robin over k folds in hash order: equal class ratios per fold."""
    return (hash_rank(df, id_col, seed, strata=[label], out="_r")
            .withColumn(out, (F.col("_r") % k).cast("int")).drop("_r"))


def deal_sizes(sizes: Sequence[tuple[int, int]], k: int) -> list[tuple[int, int, list[int]]]:
    """The greedy deal of groups to the lightest fold, for (size, number of groups) from the largest size on.

    Returns (size, start, folds): from the start-th group of that size on, groups go to ``folds`` in turn.
    Among groups of one size s, fold f of load L takes a group at the levels L, L + s, L + 2s, ..., and
    the deal follows the levels upwards, lower fold numbers first. Between the loads of two folds
    that is one cycle over the lighter folds, so a size needs k cycles at most, however many groups it has.
    """
    loads = [0] * k
    out = []
    for size, count in sizes:
        if size <= 0:
            raise ValueError("a group has at least one row")
        taken = [0] * k
        by_load = sorted(range(k), key=lambda f: (loads[f], f))
        start = 0
        for i in range(k):
            level = loads[by_load[i]]
            span = loads[by_load[i + 1]] - level if i + 1 < k else None
            if span == 0:
                continue
            cycle = sorted(by_load[:i + 1], key=lambda f: ((loads[f] - level) % size, f))
            left = count - start
            if span is None:
                here = left
            else:
                rest = span % size
                here = min(left, span // size * len(cycle) + sum((loads[f] - level) % size < rest for f in cycle))
            if here:
                out.append((size, start, cycle))
                for at, f in enumerate(cycle):
                    taken[f] += here // len(cycle) + (at < here % len(cycle))
                start += here
            if start == count:
                break
        loads = [x + size * n for x, n in zip(loads, taken)]
    return out


def group_fold_table(df: DataFrame, group: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(group, n, fold): groups never split; from the largest on, each goes to the lightest fold.

    The deal runs over the distinct sizes, not the groups: n rows have fewer than sqrt(2n) of them, and
    only those and their numbers of groups reach the driver. It gives each size a few cycles of folds;
    a group's fold follows from its rank among the groups of its size, which are ranked by hash in
    many tasks. Of equally light folds the lowest takes the group.
    """
    spark = df.sparkSession
    sizes = materialize(df.groupBy(group).agg(F.count(F.lit(1)).alias("n")), "groups")
    runs = [(r["n"], r["c"]) for r in sizes.groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("n")).collect()]   # distinct sizes
    cycles: dict[int, list] = {}
    for size, start, folds in deal_sizes(runs, k):
        cycles.setdefault(size, []).append((start, folds))
    deal = spark.createDataFrame(list(cycles.items()), "n bigint, cycles array<struct<start: bigint, folds: array<int>>>")
    ranked = hash_rank(sizes, group, seed, strata=["n"]).join(deal, "n")
    own = F.element_at(F.filter("cycles", lambda c: c["start"] <= F.col("_rank")), -1)
    ranked = ranked.withColumn("_own", own)
    place = (F.col("_rank") - F.col("_own.start")) % F.size("_own.folds")
    return ranked.select(group, "n", F.element_at(F.col("_own.folds"), (place + 1).cast("int")).alias("fold"))


def group_kfold(df: DataFrame, group: str, k: int = 5, out: str = "fold", seed: int = 42) -> DataFrame:
    folds = group_fold_table(df, group, k, seed).select(group, F.col("fold").alias(out))
    a, b = df.alias("_d"), folds.alias("_f")   # AQE broadcasts or skew-splits by the measured sizes
    return a.join(b, a[group].eqNullSafe(b[group]), "left").select("_d.*", F.col(f"_f.{out}"))


def sample_subset(df: DataFrame, group: str | None, label: str, id_col: str, frac: float, seed: int = 42) -> DataFrame:
    """Whole groups when there is more than one, rows of every class otherwise."""
    if group is not None and group in df.columns and df.select(group).where(F.col(group).isNotNull()).distinct().limit(2).count() > 1:
        return sample_groups(df, group, frac, seed)
    return df if frac >= 0.999 else sample_stratified(df, label, id_col, frac, seed)
