"""SMOTE minority oversampling as Spark jobs.

1. The k nearest minority neighbours are exact at every size: blocks of rows that lie near each other meet all
   blocks, and a block is left out only for rows whose k nearest are surely nearer than its box. Products in single
   precision, less their rounding, choose the few pairs whose distances are computed, so a pair of blocks takes bounded memory
   and no list of pairs exists. The work grows with the square of the minority rows where boxes leave nothing out.
2. How far a row has to look comes from a forest of random-projection trees: each of ``TREES`` trees halves the rows by
   random directions until a leaf is expected to hold ``LEAF_ROWS`` (cuts are medians of a bounded sample), and a leaf that came
   out larger is cut along one more direction into even parts, ties or not. Rows are compared inside their part, and a
   row's best over all trees are merged. ``refine`` compares a row with the neighbours of its neighbours as well, in lists
   ``WIDTH_TIMES`` as wide as asked for. Both decide how much is compared, never what is found. ``measure_recall``
   holds the lists of a hashed set of rows against all rows.
3. ``n_major - n_minor`` synthetic rows ``x + u * (nn - x)``: sample j picks its base row,
   neighbour and gap from seeded hashes of j, so generation is an equi-join spread over all
   tasks, never a driver loop.

The functions that run in Python workers hold all they need, so workers need not import this package.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import hash_rank
from ..session import materialize

DEFAULT_K = 5
#: Trees that the first reaches come from. More of them, or a refinement, shorten the reaches and do not change the result.
TREES = 2
#: Passes over the neighbours of neighbours, when there is more than one leaf, and the lists' width in them.
REFINEMENTS = 0
WIDTH_TIMES = 3
#: Rows that a leaf is expected to hold; no part of a leaf holds more than twice as many.
LEAF_ROWS = 1024
#: Rows of a block when all blocks meet, and blocks of a file.
BLOCK_ROWS = 4096
FILE_BLOCKS = 4
#: Pairs whose distances are computed at a time, and found pairs held before only the best are kept.
PAIRS_AT_ONCE = 1 << 16
PAIRS_HELD = 1 << 20
#: Rows that the cuts of a tree are learnt from, and its depth at most.
SAMPLE_ROWS = 20_000
MAX_DEPTH = 10


def _grow(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Directions, and for each level the cuts of its nodes (medians of the sample's rows there)."""
    rng = np.random.default_rng(seed)
    ways = rng.normal(size=(depth + 1, sample.shape[1]))
    node, cuts = np.zeros(len(sample), np.int64), []
    for level in range(depth):
        p = sample @ ways[level]
        cut = np.array([np.median(p[node == v]) if (node == v).any() else 0.0 for v in range(1 << level)])
        cuts.append(cut)
        node = node * 2 + (p > cut[node])
    return ways, cuts


def _plant(trees: list[tuple[np.ndarray, list[np.ndarray]]]):
    """Every row once for each tree, with its leaf and its place along the leaf's last direction."""

    def run(frames):
        for pdf in frames:
            x = np.stack(pdf["x"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, len(trees[0][0][0])))
            for t, (ways, cuts) in enumerate(trees):
                node = np.zeros(len(x), np.int64)
                for level, cut in enumerate(cuts):
                    node = node * 2 + (x @ ways[level] > cut[node])
                yield pd.DataFrame({"_t": np.int32(t), "_leaf": node, "_p": x @ ways[-1], "_i": pdf["_i"].to_numpy(), "x": pdf["x"].to_numpy()})
    return run


def _tie_hash():
    """A function of row numbers a, b: the hash that decides between equal distances. A closure, so tasks need no import of this package."""

    def tie(a, b):
        with np.errstate(over="ignore"):
            h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return tie


def _nearest(k: int, block: int = 256):
    """The k nearest other rows of every row of a part, by exact distances; ties by a hash of the pair.

    By index, all of many equal rows would name the same few neighbours, a hot key of every later join.
    """
    tie = _tie_hash()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, i = np.stack(pdf["x"].to_numpy()).astype(np.float64), pdf["_i"].to_numpy()
        n, kk = len(i), min(k, len(i) - 1)
        ids, found, far = [], [], []
        sq = (x * x).sum(1)
        span = 1e-13 * (sq.max() if n else 0.0) + 1e-300
        for b in range(0, n if kk > 0 else 0, block):
            q = x[b:b + block]
            ties = tie(i[b:b + block, None], i[None, :])
            # the hash decides between distances that the expanded form cannot tell apart
            d2 = sq[b:b + block, None] + sq[None, :] - 2.0 * q @ x.T + ties * (span / 2.0 ** 64)
            d2[np.arange(len(q)), np.arange(b, b + len(q))] = np.inf
            m = min(n - 1, kk + 8)  # a few more by the expanded form, then exact distances decide
            near = np.argpartition(d2, m - 1, axis=1)[:, :m]
            exact = np.sqrt(((x[near] - q[:, None, :]) ** 2).sum(2))
            for r in range(len(q)):
                best = np.lexsort((ties[r, near[r]], exact[r]))[:kk]
                ids.append(i[b + r]), found.append(i[near[r][best]]), far.append(exact[r][best])
        return pd.DataFrame({"_i": np.array(ids, np.int64), "_d": pd.Series(far, dtype=object), "_j": pd.Series(found, dtype=object)})
    return run


_LIST = "array<struct<_d:double,_j:bigint>>"


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k nearest of every row from its lists (_i, _d, _j), a row each; what is merged is a list a tree."""
    whole = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("_d", "_j"))))
    merged = lists.groupBy("_i").agg(whole.alias("_s"))
    return merged.select("_i", F.slice(F.filter("_s", lambda e, at: (at == 0) | (e != F.get("_s", at - 1))), 1, k).alias("nn"))


def _distance(a: str, b: str):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def _coder(low: np.ndarray, step: np.ndarray):
    """Every row as a byte a dimension, followed by how far the bytes are from it (a float, never too small)."""

    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            x = np.stack(pdf["x"].to_numpy()).astype(np.float64)
            c = np.clip(np.rint(np.nan_to_num((x - low) / step)), 0, 255)
            off = np.sqrt(((x - (low + c * step)) ** 2).sum(1)) * (1 + 1e-6) + 1e-30
            raw = np.hstack([c.astype(np.uint8), off.astype(np.float32)[:, None].view(np.uint8)])
            yield pd.DataFrame({"_i": pdf["_i"].to_numpy(), "_c": [r.tobytes() for r in raw]})
    return run


def _within(step: np.ndarray):
    """Pairs (_i, _j) of a row and the neighbours of its neighbour that may be no farther than _reach, by their bytes."""

    def codes(column, n):
        column = column.cast(pa.binary())
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
        raw = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].reshape(n, len(step) + 4)
        return raw[:, :-4], np.ascontiguousarray(raw[:, -4:]).view(np.float32)[:, 0].astype(np.float64)

    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            far = rb.column(3)
            each = far.flatten()
            of = np.repeat(np.arange(rb.num_rows), far.value_lengths().to_numpy())
            i, reach = rb.column(0).to_numpy()[of], rb.column(1).to_numpy()[of]
            j = each.field(0).to_numpy()
            mine, my_off = codes(rb.column(2), rb.num_rows)
            theirs, their_off = codes(each.field(1), len(each))
            least = np.sqrt((((mine[of].astype(np.int16) - theirs) * step) ** 2).sum(1)) * (1 - 1e-9) - my_off[of] - their_off
            keep = (i != j) & ~(least > reach)
            yield pa.RecordBatch.from_arrays([pa.array(i[keep]), pa.array(j[keep])], names=["_i", "_j"])
    return run


def refine(pts: DataFrame, lists: DataFrame, k: int, sample: np.ndarray, keep: int | None = None) -> DataFrame:
    """``lists`` (_i, nn) after each row met the neighbours of its neighbours (pts: _i, x), of which the first ``keep`` count.

    A row has k * k new candidates at most. They meet as a byte a dimension, whose distance less their
    rounding is never above the true one, so a candidate that cannot come among the first ``keep`` is left
    out by it, and whole rows travel for the few others only. ``sample`` gives the range of the bytes, not the
    result. Equal rows are spread over each other by the tie hash, and a row that very many name is one key of
    an equi-join, which adaptive execution splits.
    """
    keep = keep or k
    low, high = np.nanmin(sample, axis=0), np.nanmax(sample, axis=0)
    step = np.maximum(high - low, 1e-12) / 255.0
    coded = materialize(pts.mapInPandas(_coder(low, step), "_i long, _c binary"), "knn_codes")
    named = lists.select(F.col("_i").alias("_j"), F.explode(F.transform("nn", lambda e: e["_j"])).alias("_n"))
    far = named.join(coded.select(F.col("_i").alias("_n"), "_c"), "_n").groupBy("_j").agg(F.collect_list(F.struct("_n", "_c")).alias("_far"))
    reach = F.when(F.size("nn") >= keep, F.get("nn", F.lit(keep - 1))["_d"]).otherwise(F.lit(float("inf")))
    edges = lists.join(coded, "_i").select("_i", reach.alias("_reach"), "_c", F.explode(F.transform("nn", lambda e: e["_j"])).alias("_j"))
    near = edges.join(far, "_j").select("_i", "_reach", "_c", "_far").mapInArrow(_within(step), "_i long, _j long")
    known = lists.select("_i", F.transform("nn", lambda e: e["_j"]).alias("_known"))
    step_2 = near.groupBy("_i").agg(F.collect_set("_j").alias("_new"))
    fresh = step_2.join(known, "_i").select("_i", F.explode(F.array_except("_new", "_known")).alias("_j"))
    met = fresh.join(pts, "_i").join(pts.select(F.col("_i").alias("_j"), F.col("x").alias("y")), "_j")
    met = met.select("_i", F.struct(_distance("x", "y").alias("_d"), "_j").alias("e")).groupBy("_i").agg(F.collect_list("e").alias("_new"))
    more = F.concat("nn", F.coalesce("_new", F.array().cast(_LIST)))
    return lists.join(met, "_i", "left").select("_i", F.slice(F.array_sort(more), 1, k).alias("nn"))


def _axes(sample: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The main axes of the sample, and for each level the axis and cut (the sample's median there) of its nodes."""
    z = sample[np.isfinite(sample).all(axis=1)]
    turn = np.linalg.eigh(np.atleast_2d(np.cov(z.T)))[1] if len(z) > 1 else np.eye(sample.shape[1])
    z = z @ turn
    node, levels = np.zeros(len(z), np.int64), []
    for level in range(depth + 1):
        axis, cut = np.zeros(1 << level, np.int64), np.zeros(1 << level)
        for v in range(1 << level):
            part = z[node == v]
            if len(part) > 1:
                axis[v] = part.var(axis=0).argmax()
                cut[v] = np.median(part[:, axis[v]])
        levels.append((axis, cut))
        node = node * 2 + (z[np.arange(len(z)), axis[node]] > cut[node])
    return turn, levels


def _place(turn: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
    """Every row with its cell and its place along the cell's longest axis."""

    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            z = np.stack(pdf["x"].to_numpy()).astype(np.float64) @ turn
            each, node = np.arange(len(z)), np.zeros(len(z), np.int64)
            for axis, cut in levels[:-1]:
                node = node * 2 + (z[each, axis[node]] > cut[node])
            yield pdf.assign(_cell=node, _p=z[each, levels[-1][0][node]])
    return run


_BLOCK = "_n int, _ids binary, _x binary, _reach binary, _box array<struct<c:double,h:double>>, _far double"


def _blocks(turn: np.ndarray, rows: int):
    """Rows in order as blocks of ``rows`` at most: numbers, coordinates, reaches, the box along the main axes, the farthest reach."""

    def block(i, x, far):
        z = x @ turn
        box = [{"c": float(c), "h": float(h)} for c, h in zip((z.min(0) + z.max(0)) / 2, (z.max(0) - z.min(0)) / 2 * (1 + 1e-9) + 1e-30)] \
            if np.isfinite(z).all() else [{"c": 0.0, "h": float("inf")}] * z.shape[1]
        return len(i), i.tobytes(), x.tobytes(), far.tobytes(), box, float(far.max())

    def run(frames):
        held, n = [], 0
        for pdf in frames:
            if not len(pdf):
                continue
            far = pdf["_reach"].to_numpy(np.float64)
            held.append((pdf["_i"].to_numpy(np.int64), np.stack(pdf["x"].to_numpy()).astype(np.float64), np.where(np.isnan(far), np.inf, far)))
            n += len(pdf)
            while n >= rows:
                whole = [np.concatenate(c) for c in zip(*held)]
                yield pd.DataFrame([block(*(c[:rows] for c in whole))], columns=["_n", "_ids", "_x", "_reach", "_box", "_far"])
                held, n = [tuple(c[rows:] for c in whole)], n - rows
        if n:
            yield pd.DataFrame([block(*(np.concatenate(c) for c in zip(*held)))], columns=["_n", "_ids", "_x", "_reach", "_box", "_far"])
    return run


def _meet(k: int, turn: np.ndarray, at_once: int, most: int, chunk: int = 256):
    """The k nearest that each row of a block finds in the blocks it meets, no farther than its reach: (_i, _d, _t, _j).

    Pairs of one block follow one another, so what it has found shortens its reaches. A product of single precision is
    made smaller by more than its rounding, so it never leaves out a pair within reach; NaN leaves out nothing.
    """
    tie = _tie_hash()

    def best(row, d, t, j):
        order = np.lexsort((j, t, d, row))
        new = np.concatenate(([True], row[order][1:] != row[order][:-1]))
        place = np.arange(len(order))
        return order[place - np.maximum.accumulate(np.where(new, place, 0)) < k]

    def matrix(value, n):
        return np.frombuffer(value.as_buffer(), np.float64).reshape(n, -1)

    class Block:
        room = [np.empty((0, 0), np.float32), np.empty((0, 0), bool)]

        def __init__(self, i, x, reach):
            self.i, self.x, self.z, self.mid = i, x, x @ turn, x.mean(axis=0)
            self.reach = reach * (1 + 1e-9) + 1e-150
            self.found, self.n = [], 0

        def cut(self):
            row, d, t, j = (np.concatenate(c) for c in zip(*self.found))
            keep = best(row, d, t, j)
            row, d, t, j = row[keep], d[keep], t[keep], j[keep]
            last = np.flatnonzero(np.bincount(row, minlength=len(self.i))[row] == k)
            worst = np.full(len(self.i), -np.inf)
            np.maximum.at(worst, row[last], d[last])
            self.reach = np.where(worst >= 0, np.fmin(self.reach, worst * (1 + 1e-9) + 1e-150), self.reach)
            self.found, self.n = [(row, d, t, j)], 0

        def meet(self, j, y, centre, half):
            gap = np.maximum(np.abs(self.z - centre) - half, 0.0)
            rows = np.flatnonzero(~((gap * gap).sum(axis=1) * (1 - 1e-9) > self.reach ** 2))
            if not len(rows):
                return
            small = 4.0 * (y.shape[1] + 8) * np.finfo(np.float32).eps
            q = y - self.mid
            right = np.hstack([q, ((q * q).sum(axis=1) * (1 - small))[:, None], np.ones((len(q), 1))]).astype(np.float32).T
            if self.room[0].shape[1] != len(q):  # written over and over: new memory costs more than the products
                self.room[:] = [np.empty((chunk, len(q)), np.float32), np.empty((chunk, len(q)), bool)]
            for at in range(0, len(rows), chunk):
                r = rows[at:at + chunk]
                p = self.x[r] - self.mid
                own = (p * p).sum(axis=1) * (1 - small) - self.reach[r] ** 2 * (1 + small)
                least, out = (v[:len(r)] for v in self.room)
                with np.errstate(all="ignore"):
                    np.matmul(np.hstack([-2.0 * p, np.ones((len(p), 1)), own[:, None]]).astype(np.float32), right, out=least)
                    np.greater(least, 0, out=out)
                near = np.flatnonzero(np.logical_not(out, out=out))
                for c in range(0, len(near), at_once):
                    a, b = np.divmod(near[c:c + at_once], len(q))
                    a = r[a]
                    other = self.i[a] != j[b]
                    a, b = a[other], b[other]
                    d = np.sqrt(((self.x[a] - y[b]) ** 2).sum(axis=1))
                    ok = ~(d > self.reach[a])
                    a, b = a[ok], b[ok]
                    self.found.append((a, d[ok], (tie(self.i[a], j[b]) >> np.uint64(1)).astype(np.int64), j[b]))
                    self.n += len(a)
                    if self.n > most:
                        self.cut()

        def rows(self):
            if not self.found:
                return
            self.cut()
            row, d, t, j = self.found[0]
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (self.i[row], d, t, j)], names=["_i", "_d", "_t", "_j"])

    def run(batches):
        block = None
        for rb in batches:
            for r in range(rb.num_rows):
                n, ids, x, reach, m, js, y, box = (rb.column(c)[r] for c in range(8))
                i = np.frombuffer(ids.as_buffer(), np.int64)
                if block is None or not np.array_equal(block.i, i):
                    if block is not None:
                        yield from block.rows()
                    block = Block(i, matrix(x, n.as_py()), np.frombuffer(reach.as_buffer(), np.float64))
                sides = box.values
                block.meet(np.frombuffer(js.as_buffer(), np.int64), matrix(y, m.as_py()), sides.field(0).to_numpy(), sides.field(1).to_numpy())
                if block.n > most >> 2:
                    block.cut()
        if block is not None:
            yield from block.rows()
    return run


def nearest_of_all(pts: DataFrame, lists: DataFrame, k: int, sample: np.ndarray, n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(_i, nn)``: the exact k nearest other rows of every row (pts: _i, x), ties by a hash of the pair.

    ``lists`` (_i, nn) hold true distances to other rows, so the k-th nearest is no farther than their k-th entry. ``sample`` and
    ``lists`` decide what need not be compared, not the result. Blocks meet in a Cartesian product, which
    is not shuffled, and a row of a block sends on the few rows that are within its reach.
    """
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(n, 1) / block_rows))))
    turn, levels = _axes(sample, depth)
    reach = F.coalesce(F.get("nn", F.lit(k - 1))["_d"], F.lit(float("inf")))
    rows = pts.join(lists.select("_i", reach.alias("_reach")), "_i", "left").select("_i", "x", F.coalesce("_reach", F.lit(float("inf"))).alias("_reach"))
    placed = rows.mapInPandas(_place(turn, levels), "_i long, x array<double>, _reach double, _cell long, _p double")
    files = -(-n // (FILE_BLOCKS * block_rows)) or 1
    ordered = placed.repartitionByRange(files, "_cell", "_p", "_i").sortWithinPartitions("_cell", "_p", "_i")
    own = materialize(ordered.select("_i", "x", "_reach").mapInPandas(_blocks(turn, block_rows), _BLOCK), "knn_blocks")
    other = own.select(*[F.col(c).alias(f"{c}2") for c in ("_n", "_ids", "_x", "_box")])
    gaps = F.zip_with("_box", "_box2", lambda a, b: F.greatest(F.abs(a["c"] - b["c"]) - a["h"] - b["h"], F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) * F.lit(1 - 1e-9)
    met = own.hint("shuffle_replicate_nl").join(other, apart <= F.col("_far") * F.col("_far") * F.lit(1 + 1e-6) + F.lit(1e-290))
    pairs = met.select("_n", "_ids", "_x", "_reach", "_n2", "_ids2", "_x2", "_box2") \
        .mapInArrow(_meet(k, turn, PAIRS_AT_ONCE, PAIRS_HELD), "_i long, _d double, _t long, _j long")
    best = F.slice(F.array_sort(F.collect_list(F.struct("_d", "_t", "_j"))), 1, k)
    merged = pairs.groupBy("_i").agg(best.alias("_s"))
    return merged.select("_i", F.array_sort(F.transform("_s", lambda e: F.struct(e["_d"].alias("_d"), e["_j"].alias("_j")))).alias("nn"))


def neighbour_lists(pts: DataFrame, k: int = DEFAULT_K, n_rows: int | None = None, leaf_rows: int = LEAF_ROWS,
                    trees: int = TREES, seed: int = 42, refinements: int = REFINEMENTS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``pts(_i, x array<double>)`` -> ``(_i, nn)``: the k nearest other rows (fewer if there are fewer), array of (_d, _j).

    The result is the same for all settings of the forest; they decide how much is compared.
    """
    pts = materialize(pts.select(F.col("_i").cast("bigint").alias("_i"), "x"), "knn_points")
    n = n_rows if n_rows is not None else pts.count()
    depth = min(max_depth, max(0, math.ceil(math.log2(max(n, 1) / leaf_rows))))
    sample = [r["x"] for r in pts.orderBy(F.xxhash64("_i"), "_i").limit(SAMPLE_ROWS).collect()]   # bounded
    if not sample:
        return pts.select("_i", F.array().cast(_LIST).alias("nn"))
    wide = k * WIDTH_TIMES if depth and refinements else k
    forest = [_grow(np.array(sample, np.float64), depth, seed + t) for t in range(trees if depth else 1)]
    leaves = pts.mapInPandas(_plant(forest), "_t int, _leaf long, _p double, _i long, x array<double>")
    w = Window.partitionBy("_t", "_leaf")
    parts = F.ceil(F.count(F.lit(1)).over(w) / F.lit(2 * leaf_rows))
    at = (F.row_number().over(w.orderBy("_p", "_i")) - 1) * parts / F.count(F.lit(1)).over(w)
    pairs = leaves.withColumn("_part", F.floor(at)).select("_t", "_leaf", "_part", "_i", "x") \
        .groupBy("_t", "_leaf", "_part").applyInPandas(_nearest(wide), "_i long, _d array<double>, _j array<bigint>")
    lists = _merged(pairs, wide)
    rounds = refinements if depth else 0
    for r in range(rounds):  # only the last one knows how many entries count
        lists = refine(pts, materialize(lists, "knn_lists"), wide, np.array(sample, np.float64), k if r + 1 == rounds else wide)
    lists = nearest_of_all(pts, lists, k, np.array(sample, np.float64), n)
    return pts.select("_i").join(lists, "_i", "left").select("_i", F.coalesce("nn", F.array().cast(_LIST)).alias("nn"))


def measure_recall(pts: DataFrame, lists: DataFrame, k: int = DEFAULT_K, queries: int = 200, seed: int = 7) -> DataFrame:
    """(queries, wanted, found, recall): the lists of about ``queries`` rows, chosen by hash, against all rows.

    An entry is found if it is as near as the exact k-th neighbour, so ties count. ``queries`` bounds
    what is sent to the tasks; every row is compared with all of them, and each task keeps k a query.
    """
    spark = pts.sparkSession
    chosen = [(r["_i"], list(r["x"])) for r in pts.orderBy(F.xxhash64("_i", F.lit(seed)), "_i").limit(queries).collect()]   # bounded
    if not chosen:
        return spark.createDataFrame([], "queries long, wanted long, found long, recall double")

    def run(frames):
        ids, q = np.array([i for i, _ in chosen]), np.array([x for _, x in chosen], np.float64)
        best = np.full((len(q), k), np.inf)
        for pdf in frames:
            x, i = np.stack(pdf["x"].to_numpy()).astype(np.float64), pdf["_i"].to_numpy()
            for at in range(0, len(x), 512):
                d = np.sqrt(((q[:, None, :] - x[None, at:at + 512, :]) ** 2).sum(2))
                d[ids[:, None] == i[None, at:at + 512]] = np.inf
                best = np.sort(np.concatenate([best, d], axis=1), axis=1)[:, :k]
        yield pd.DataFrame({"_i": np.repeat(ids, k), "_d": best.ravel()})

    exact = pts.select("_i", "x").mapInPandas(run, "_i long, _d double").where("_d < double('infinity')")
    exact = exact.groupBy("_i").agg(F.slice(F.array_sort(F.collect_list("_d")), 1, k).alias("near"))   # k a task
    both = exact.join(lists, "_i", "left").withColumn("_reach", F.element_at("near", -1) * (1 + 1e-9))
    found = F.coalesce(F.size(F.filter("nn", lambda e: e["_d"] <= F.col("_reach"))), F.lit(0))
    out = both.agg(F.count(F.lit(1)).alias("queries"), F.sum(F.size("near")).alias("wanted"), F.sum(F.least(found, F.size("near"))).alias("found"))
    return out.withColumn("recall", F.col("found") / F.col("wanted"))


def knn_minority(pts: DataFrame, k: int = DEFAULT_K, n_rows: int | None = None, **kw) -> DataFrame:
    """``(_i, _slot, _j, _d)``: the neighbour lists, one row a neighbour."""
    return neighbour_lists(pts, k, n_rows, **kw).select("_i", F.posexplode("nn").alias("_slot", "e")).select("_i", "_slot", "e._j", "e._d")


def smote(df: DataFrame, features: str = "features", label: str = "label", id_col: str = "row_id",
          k: int = DEFAULT_K, seed: int = 42) -> DataFrame:
    """Raise the minority class to the majority count with synthetic rows (train rows only).

    Output keeps ``df``'s columns for real rows; synthetic rows carry ``features``, ``label``
    and a null id, with ``_synthetic`` = true.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return df.withColumn("_synthetic", F.lit(False))
    minority = min(counts, key=lambda c: (counts[c], c))
    n_min = counts[minority]
    n_new = max(counts.values()) - n_min
    base = df.withColumn("_synthetic", F.lit(False))
    if n_new <= 0:
        return base
    pts = hash_rank(df.where(F.col(label) == minority).select(id_col, vector_to_array(features).alias("x")),
                    id_col, seed, out="_i").select("_i", "x")
    pts = materialize(pts, "minority")
    kk = min(k, n_min - 1)
    spark = df.sparkSession
    gen = spark.range(n_new).select(
        F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(n_min)).alias("_i"),
        F.pmod(F.xxhash64(F.col("id"), F.lit(seed + 1)), F.lit(2 ** 31)).alias("_pick"),
        (F.pmod(F.xxhash64(F.col("id"), F.lit(seed + 2)), F.lit(2 ** 53)).cast("double") / float(2 ** 53)).alias("_u"))
    nb = neighbour_lists(pts, kk, n_min, seed=seed) if kk else pts.select("_i", F.array().cast("array<struct<_d:double,_j:bigint>>").alias("nn"))
    slot = F.when(F.size("nn") > 0, F.pmod("_pick", F.size("nn"))).cast("int")
    # a row without neighbours is its own, so no synthetic row is lost
    gen = gen.join(nb, "_i").select("_i", "_u", F.coalesce(F.get("nn", slot)["_j"], F.col("_i")).alias("_j"))
    g = gen.join(pts, "_i").join(pts.select(F.col("_i").alias("_j"), F.col("x").alias("xn")), "_j")
    new_x = F.zip_with("x", "xn", lambda a, b: a + F.col("_u") * (b - a))
    synth = g.select(array_to_vector(new_x).alias(features), F.lit(minority).cast(df.schema[label].dataType).alias(label))
    others = [f for f in df.schema.fields if f.name not in (features, label)]
    synth = synth.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in others], features, label,
                         F.lit(True).alias("_synthetic"))
    return base.unionByName(synth.select(*base.columns))
