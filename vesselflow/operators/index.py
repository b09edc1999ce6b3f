"""Minute bucket and grid-cell columns (blocking keys for the pair join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.params import DEFAULT, Params

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def minute_bucket(ts, minutes: int = 1) -> Column:
    """Start of the ``minutes``-wide bucket holding a TIMESTAMP_NTZ, without a time-zone round trip. Buckets start at
    the full hour, so ``minutes`` divides 60."""
    if 60 % minutes:
        raise ValueError(f"bucket width of {minutes} minutes: expected a divisor of 60")
    t = _c(ts)
    over = F.pmod(epoch_minutes(t), F.lit(minutes)).cast("int") if minutes > 1 else F.lit(0)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), over, F.date_part(F.lit("SECOND"), t))


def epoch_minutes(ts) -> Column:
    """Whole minutes since 1970-01-01 for a TIMESTAMP_NTZ (long)."""
    return F.timestamp_diff("MINUTE", F.expr(EPOCH_NTZ), _c(ts))


def window_bucket(ts, minutes: int) -> Column:
    """Index of the ``minutes``-wide time slot holding ``ts`` (long)."""
    return F.floor(epoch_minutes(ts) / F.lit(minutes)).cast("long")


#: Helper column that splits per-vessel work; hidden from results.
HOUR = "_hour"
#: Helper column that splits flooded vessel-hours; 0 in the others. Only there where a vessel-hour is flooded.
SLICE = "_slice"


def hour_bucket(ts) -> Column:
    """Whole hours since 1970-01-01 (long)."""
    return window_bucket(ts, 60)


def cell_index(x, size_deg: float) -> Column:
    return F.floor(_c(x) / F.lit(size_deg)).cast("long")


def cell_label(lat_idx: Column, lon_idx: Column) -> Column:
    """``"latIdx_lonIdx"`` text, as the grid cell is shown."""
    return F.concat(lat_idx.cast("string"), F.lit("_"), lon_idx.cast("string"))


def add_grid_index(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Adds ``grid_lat``/``grid_lon`` (bigint keys used for joining) and the
    ``GridCell`` label."""
    df = df.withColumn("grid_lat", cell_index("Latitude", p.grid_deg)).withColumn(
        "grid_lon", cell_index("Longitude", p.grid_deg)
    )
    return df.withColumn("GridCell", cell_label(F.col("grid_lat"), F.col("grid_lon")))


def add_fine_index(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Fine square cell (``p.fine_cell_deg``) standing in for a hexagon index."""
    df = df.withColumn("fine_lat", cell_index("Latitude", p.fine_cell_deg)).withColumn(
        "fine_lon", cell_index("Longitude", p.fine_cell_deg)
    )
    return df.withColumn("FineCell", cell_label(F.col("fine_lat"), F.col("fine_lon")))
