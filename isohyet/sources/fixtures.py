"""Stand-in inputs built from the shared test tables.

The reference works on a location x month climate panel, a static site table and a scored
holdout. None of those ship, so each is derived from the TPC-H-like test tables. Every
builder has a DuckDB SQL twin (``*_SQL``) so the oracle computes the same input
independently. All builders are plain aggregations / projections: their work grows with
the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier ("site") and calendar month of ship date.

    ``precip`` is the label source, ``n_obs`` a second variable, ``humid`` a variable with
    nulls. Map-side partial aggregation keeps the shuffle at one row per
    (site, month) per input partition, whatever the skew of ``l_suppkey``.
    """
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    agg = (
        li.groupBy(
            F.col("l_suppkey").alias("loc_id"),
            F.year("l_shipdate").cast("bigint").alias("YEAR"),
            F.month("l_shipdate").cast("bigint").alias("MONTH"),
        )
        .agg(
            F.sum("l_quantity").alias("precip"),
            F.count(F.lit(1)).alias("n_obs"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))).alias("_r"),
        )
    )
    return agg.select(
        "loc_id",
        (F.lit(13.75) + F.lit(0.5) * (F.col("loc_id") % 10)).cast("double").alias("LAT"),
        (F.lit(-92.25) + F.lit(0.5) * F.floor(F.col("loc_id") / 10)).cast("double").alias("LON"),
        "YEAR",
        "MONTH",
        "precip",
        "n_obs",
        F.nullif(F.col("_r"), F.lit(0.0)).alias("humid"),
    )


def site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static site attributes; the elevation of every 7th is unknown."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("loc_id"),
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal").cast("double")).alias("elev"),
        F.col("s_nationkey").cast("bigint").alias("soil_class"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored holdout: one row per event, label = purchase, score from the value."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("grp"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.least(F.lit(1.0), F.col("value") / F.lit(500.0)).alias("prob"),
    )


# ---- DuckDB twins (pre-registered views: lineitem, supplier, events, ...) ----

PANEL_SQL = """
SELECT loc_id,
       CAST(13.75 + 0.5 * (loc_id % 10) AS DOUBLE) AS LAT,
       CAST(-92.25 + 0.5 * floor(loc_id / 10) AS DOUBLE) AS LON,
       YEAR, MONTH, precip, n_obs, NULLIF(r_sum, 0.0) AS humid
FROM (
  SELECT l_suppkey AS loc_id,
         CAST(year(l_shipdate) AS BIGINT) AS YEAR,
         CAST(month(l_shipdate) AS BIGINT) AS MONTH,
         SUM(l_quantity) AS precip,
         COUNT(*) AS n_obs,
         SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS r_sum
  FROM lineitem
  GROUP BY 1, 2, 3
) t
"""

SITE_SQL = """
SELECT s_suppkey AS loc_id, CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_acctbal AS DOUBLE) END AS elev,
       CAST(s_nationkey AS BIGINT) AS soil_class
FROM supplier
"""

SCORED_SQL = """
SELECT event_id AS row_id, user_id AS grp,
       CAST(event_type = 'purchase' AS INTEGER) AS y,
       least(1.0, value / 500.0) AS prob
FROM events
"""
