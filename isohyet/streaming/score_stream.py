"""Scoring a stream of new panel rows with a saved model.

Scoring is a stateless, narrow projection (no shuffle, no state), so the same fitted
``PipelineModel`` applies to a streaming DataFrame unchanged: new files arriving in a folder
are scored as micro-batches and appended to a sink. Progress is kept in a checkpoint folder
under ``spark.checkpoint.dir`` so a restarted query resumes without re-scoring.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..ml.train import load_model, score
from ..session import ensure_checkpoint_dir


def scored_stream(spark: SparkSession, model_path: str, source_dir: str, schema: T.StructType,
                  th: float = 0.5, max_files_per_trigger: int | None = None) -> DataFrame:
    model, feature_cols, _ = load_model(model_path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return score(model, reader.parquet(source_dir), feature_cols, th=th)


def start_scoring(spark: SparkSession, model_path: str, source_dir: str, sink_dir: str, schema: T.StructType,
                  name: str = "score", th: float = 0.5, checkpoint: str | None = None,
                  trigger_once: bool = False) -> StreamingQuery:
    """Append scored rows to Parquet at ``sink_dir``; returns the running query."""
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    w = (scored_stream(spark, model_path, source_dir, schema, th)
         .writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", ckpt)
         .outputMode("append").queryName(name))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
