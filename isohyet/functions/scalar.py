"""Row-level expressions and schema-level column choices.

Everything here is a native Catalyst expression (stays inside whole-stage codegen) or a
decision made from ``df.schema`` at plan time, which runs no job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for identical results.
KM_PER_DEGREE_LAT = 111.32          # km per degree of latitude
MIN_COS_LAT = 1e-6                  # floor on cos(lat) before dividing
DEFAULT_BLOCK_KM = 50.0

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """pandas treats NaN as missing; Spark does not. Map NaN -> null once, on load."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    targets = set(fl if cols is None else [c for c in cols if c in fl])
    if not targets:
        return df
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name) if f.name in targets else F.col(f.name)
        for f in df.schema.fields
    ])


def spatial_block(lat="LAT", lon="LON", km: float = DEFAULT_BLOCK_KM) -> Column:
    """Grid cell id ``"<lat_idx>_<lon_idx>"`` for cells of about ``km`` kilometres.

    Longitude width shrinks with latitude and is computed per row. A null coordinate gives a
    null block.
    """
    lat_c, lon_c = _c(lat).cast("double"), _c(lon).cast("double")
    dlat = F.lit(km / KM_PER_DEGREE_LAT)
    dlon = F.lit(float(km)) / (F.lit(KM_PER_DEGREE_LAT) * F.greatest(F.lit(MIN_COS_LAT), F.cos(F.radians(lat_c))))
    lat_idx = F.floor((lat_c + F.lit(90.0)) / dlat).cast("bigint")
    lon_idx = F.floor((lon_c + F.lit(180.0)) / dlon).cast("bigint")
    return F.concat(lat_idx.cast("string"), F.lit("_"), lon_idx.cast("string"))


def month_start_date(year="YEAR", month="MONTH") -> Column:
    """First day of the month; an impossible month raises under ANSI mode."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def parse_date_strict(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Parse ``col`` to a timestamp; fail if any value, null included, is not a date.

    The check is one aggregate job over the column (pruned to that column by the scan).
    """
    src = F.col(col)
    parsed = F.try_to_timestamp(src.cast("string"), F.lit(fmt)) if fmt else F.try_to_timestamp(src.cast("string"))
    out = df.withColumn(col, parsed)
    bad = (
        df.select(src.alias("v"), parsed.alias("p"))
        .where(F.col("p").isNull())
        .limit(1)
        .count()
    )
    if bad:
        raise ValueError(f"column {col!r} holds values that are no dates")
    return out


def extract_month(df: DataFrame, month_col: str | None = "MONTH", date_col: str | None = None) -> Column:
    """Calendar month from a month column if present, else from a date column."""
    if month_col and month_col in df.columns:
        return F.col(month_col).cast("int")
    if date_col and date_col in df.columns:
        return F.month(F.col(date_col))
    raise ValueError(f"no calendar month: neither {month_col!r} nor {date_col!r} is a column")


def threshold_predict(prob="prob", th: float = 0.5) -> Column:
    return (_c(prob) >= F.lit(float(th))).cast("int")


def require_columns(df: DataFrame, required: Sequence[str], what: str = "dataset") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {missing}; it has {df.columns}")
    return df


def require_binary(df: DataFrame, target: str) -> DataFrame:
    """Fail unless every target value is 0 or 1 (one short-circuiting scan)."""
    require_columns(df, [target])
    bad = df.where(~F.col(target).isin(0, 1) | F.col(target).isNull()).limit(1).count()
    if bad:
        raise ValueError(f"labels in {target!r} have to be 0 or 1")
    return df


def select_columns(df: DataFrame, features: Sequence[str], target: str, ids: Iterable[str] = ("block_id", "LAT", "LON", "date")) -> DataFrame:
    """The chosen features, the target and those ids that ``df`` has, in this order and each once."""
    require_columns(df, [*features, target])
    return df.select(*dict.fromkeys([*features, target, *(c for c in ids if c in df.columns)]))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def leakage_columns(df: DataFrame, source: str = "precip", threshold_col: str = "ppt_pctl") -> list[str]:
    """Same-month columns derived from the label source: the source itself, its z-score,
    its rolling means that include the current month, and the percentile threshold."""
    leak = [source, f"{source}__z", threshold_col]
    leak += [c for c in df.columns if c.startswith(f"{source}__roll") and not c.startswith(f"{source}__roll_prev")]
    return [c for c in df.columns if c in set(leak)]


def drop_leakage(df: DataFrame, source: str = "precip", threshold_col: str = "ppt_pctl") -> DataFrame:
    return df.drop(*leakage_columns(df, source, threshold_col))


def feature_columns(df: DataFrame, target: str, extra_exclude: Iterable[str] = (),
                    source: str = "precip", threshold_col: str = "ppt_pctl") -> list[str]:
    """The one shared feature list: numeric, minus target, ids, coordinates and leakage."""
    ex = {target, "LAT", "LON", "loc_id", "block_id", "date", "fold", *extra_exclude}
    ex |= set(leakage_columns(df, source, threshold_col))
    return numeric_columns(df, ex)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns (and fold -0.0 into 0.0) for stable cross-engine hashing."""
    def q(n: str) -> Column:
        return F.col("`" + n.replace("`", "``") + "`")
    return df.select(*[
        (F.round(q(f.name), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else q(f.name)
        for f in df.schema.fields
    ])
