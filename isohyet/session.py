"""Session construction and shared-storage helpers.

Library functions never create their own session; they take DataFrames. These helpers are
for tests, the bench and ad-hoc use. On a cluster the session comes from the launcher, and
``spark.checkpoint.dir`` names the shared folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app_name: str = "isohyet", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it has to name a folder that all executors share")
    # Unset (tests, local runs): a private folder is fine because there is only one machine.
    local = tempfile.mkdtemp(prefix="isohyet-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


_OPEN: ContextVar[list | None] = ContextVar("open_scope", default=None)


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that :func:`materialize` writes inside are deleted at the end; results have to be collected or written by then."""
    token = _OPEN.set([])
    try:
        yield
    finally:
        paths = _OPEN.get()
        _OPEN.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing Parquet to the shared folder and reading it back.

    Survives executor loss (unlike local checkpoints) and lets later stages reuse the
    result without recomputing upstream shuffles.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _OPEN.get() is not None:
        _OPEN.get().append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
