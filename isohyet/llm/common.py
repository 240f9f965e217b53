"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isohyet.session import ensure_checkpoint_dir, materialize, scratch_path

__all__ = ["drop_written", "ensure_checkpoint_dir", "lower_words", "materialize", "mix64", "positions", "scratch_path",
           "ship_package", "table", "window_hashes", "word_hashes", "written"]

#: Largest side, in bytes, that any operator here ships whole to every task.
BROADCAST_BYTES = 64 << 20

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package even when it is only on the driver's path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="isohyet-pkg-"), "isohyet_pkg.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for what runs inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write to the shared folder and read back; the path comes along so it can be dropped.

    The shuffle files of the writing job go as soon as it ends, so no step holds those of the steps before it.
    """
    path = scratch_path(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of so many rows for what runs inside: rows that carry sets or long texts."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def drop_written(spark: SparkSession, *paths: str) -> None:
    """Delete tables made by :func:`written` whose readers have all finished."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)


def positions(df: DataFrame, order: list[Column], group: str | None = None, name: str = "ranked") -> tuple[DataFrame, str]:
    """Adds ``pos``, the 0-based place in ``order`` within the (never null) ``group``, and ``total``, the group's rows.

    The rows are dealt into ranges of (group, order) and written sorted, so a hot group is many ranges;
    a row's place is its place in its range and the group's rows in the ranges before. The window runs
    over one row for each range that a group has rows in. Rows that are equal in ``order`` share a range.
    """
    by = [*([F.col(group)] if group else []), *order]
    g = F.col(group) if group else F.lit(0)
    dealt, path = written(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    runs = dealt.groupBy(g.alias("_g"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g")
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("_g", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("total"))
    out = dealt.join(runs, (g == F.col("_g")) & (part == F.col("_part")))
    return out.select(*df.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "total"), path


def crc_of_id(col: str | Column) -> Column:
    """crc32 of an id written as decimal text; a null id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordIds(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:  # bounds memory; a dropped entry is only hashed again
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def word_hashes(words: list[bytes], cache: dict) -> np.ndarray:
    """64-bit hash of each word. cache: a ``_WordIds`` of the calling task."""
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def new_cache() -> dict:
    return _WordIds()


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; a shorter text counts as one run."""
    n = len(h)
    if n == 0:
        return h
    k = min(width, n)
    acc = np.full(n - k + 1, np.uint64(0x9E3779B97F4A7C15 * k & (2**64 - 1)), dtype=np.uint64)
    for j in range(k):
        acc = mix64(acc ^ h[j:n - k + 1 + j]) + np.uint64(j + 1)
    return acc
