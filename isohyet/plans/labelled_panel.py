"""The panel-building chain: merge -> spatial blocks -> features -> label, as one Spark DAG.

The reference runs these as separate processes with a CSV between each; here they compose, and
only what several steps read is written, to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalar import month_start_date, spatial_block
from ..operators.panel import add_features, enrich_left_join, event_label
from ..session import materialize
from ..sources import fixtures

FEATURE_COLS = ("precip", "n_obs", "humid")


def enriched_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel left-joined to site attributes, with a month-start ``date``."""
    p = fixtures.panel(spark, sf_dir)
    s = fixtures.site(spark, sf_dir)
    merged = enrich_left_join(p, s, ["loc_id"])
    return merged.withColumn("date", month_start_date("YEAR", "MONTH"))


def blocked_panel(spark: SparkSession, sf_dir: str, km: float = 50.0) -> DataFrame:
    return enriched_panel(spark, sf_dir).withColumn("block_id", spatial_block("LAT", "LON", km))


def featured_panel(spark: SparkSession, sf_dir: str, cols: Sequence[str] = FEATURE_COLS,
                   lags: Sequence[int] = (1, 2, 3), windows: Sequence[int] = (3, 6)) -> DataFrame:
    return add_features(blocked_panel(spark, sf_dir), cols, keys=("LAT", "LON"), date_col="date", lags=lags, windows=windows)


def labelled_panel(spark: SparkSession, sf_dir: str, p: float = 20.0, **kw) -> DataFrame:
    """The finished features are written once: the label's percentiles and its join both read them."""
    df = materialize(featured_panel(spark, sf_dir, **kw), "featured")
    return event_label(df, value="precip", keys=("LAT", "LON"), month_col="MONTH", p=p, label="sequia")
