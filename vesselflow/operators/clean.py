"""Ping cleaning: ten ``DataFrame -> DataFrame`` filters and the fixed chain.

Order matters (the jump filter compares each ping with the previous *valid
Class A* ping anywhere, before region and type filters), so ``clean_pings``
applies them in the original order. Each filter is also usable alone.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from vesselflow.functions.geo import acos_distance_sql
from vesselflow.functions.sqltext import col, one_of, num, ref, strings
from vesselflow.operators.index import HOUR, SLICE, cell_index, hour_bucket, minute_bucket
from vesselflow.operators.sequence import with_previous
from vesselflow.params import DEFAULT, Params

#: Finest grid for zones (8 ** -4, exact in binary), the factor to the next coarser one, and the zones whose cells are
#: broadcast at most.
ZONE_CELL_DEG = 2.0**-12
ZONE_GRID_STEP = 8.0
ZONE_BROADCAST = 100_000
#: Fixed-width parts of a timestamp format, in ISO order.
_PARTS = ("yyyy", "MM", "dd", "HH", "mm", "ss")


def parse_timestamp_text(text: Column, fmt: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    """Timestamp text -> TIMESTAMP_NTZ, NULL when it does not parse.

    The fixed-width parts of ``fmt`` (each of yyyy, MM, dd, HH, mm, ss once) are
    put in ISO order and cast without a time zone, so the result is the same wall
    clock in any session zone.
    """
    if any(fmt.count(part) != 1 for part in _PARTS) or re.search("[A-Za-z]", re.sub("|".join(_PARTS), "", fmt)):
        raise ValueError(f"timestamp format {fmt!r}: expected each of {', '.join(_PARTS)} once")
    found = re.split("(" + "|".join(_PARTS) + ")", fmt)
    pattern = "^" + "".join(f"(\\d{{{len(x)}}})" if x in _PARTS else re.escape(x) for x in found) + "$"
    y, mo, d, h, mi, s = (f"${1 + [x for x in found if x in _PARTS].index(part)}" for part in _PARTS)
    trimmed = F.trim(text)
    iso = F.regexp_replace(trimmed, F.lit(pattern), F.lit(f"{y}-{mo}-{d}T{h}:{mi}:{s}"))
    return F.when(trimmed.rlike(pattern), iso.try_cast("timestamp_ntz"))


# --- C1 -----------------------------------------------------------------------
def parse_timestamp(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``Timestamp`` text -> TIMESTAMP_NTZ; rows that do not parse are dropped.
    A column that is already a timestamp is cast to NTZ."""
    dtype = df.schema["Timestamp"].dataType
    if isinstance(dtype, StringType):
        ts = parse_timestamp_text(F.col("Timestamp"), p.ts_format)
    elif isinstance(dtype, (TimestampType, TimestampNTZType)):
        ts = F.col("Timestamp").cast("timestamp_ntz")
    else:
        raise TypeError(f"Timestamp column has unsupported type {dtype}")
    return df.withColumn("Timestamp", ts).filter(F.col("Timestamp").isNotNull())


# --- C2 / C3 ------------------------------------------------------------------
# Predicates are written as SQL text (one JVM call each, see functions.sqltext).
def mobile_type_ok(p: Params = DEFAULT) -> Column:
    return col(one_of("TypeOfMobile", p.mobile_types))


def class_a_ok(p: Params = DEFAULT) -> Column:
    return col(f"`TypeOfMobile` = {strings([p.vessel_class])}")


def filter_mobile_type(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Class A or Class B transponders only."""
    return df.filter(mobile_type_ok(p))


def filter_class_a(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Class A only."""
    return df.filter(class_a_ok(p))


# --- C4 -----------------------------------------------------------------------
def _mmsi_in_range_sql(mmsi: str, p: Params) -> str:
    m = ref(mmsi)
    sql = f"{m} IS NOT NULL AND {m} BETWEEN {p.mmsi_min} AND {p.mmsi_max}"
    for lo, hi in p.excluded_mmsi_ranges:
        sql += f" AND NOT ({m} BETWEEN {lo} AND {hi})"
    return f"({sql})"


def mmsi_in_range(mmsi: str = "MMSI", p: Params = DEFAULT) -> Column:
    """Nine-digit range and not in an excluded block (no pattern rules)."""
    return col(_mmsi_in_range_sql(mmsi, p))


def mmsi_valid(mmsi: str = "MMSI", p: Params = DEFAULT) -> Column:
    """C4 predicate: range rules + no repeated-digit pattern + not the test id."""
    m = ref(mmsi)
    return col(
        f"{_mmsi_in_range_sql(mmsi, p)} AND {m} % {p.repeated_digit_mmsi} <> 0 AND {m} <> {p.test_mmsi}"
    )


def filter_valid_mmsi(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return df.filter(mmsi_valid("MMSI", p))


# --- C5 -----------------------------------------------------------------------
def coordinates_ok(p: Params = DEFAULT) -> Column:
    return col(
        f"`Latitude` BETWEEN {num(-90)} AND {num(90)} AND `Longitude` BETWEEN {num(-180)} AND {num(180)}"
        " AND `Latitude` IS NOT NULL AND `Longitude` IS NOT NULL"
    )


def filter_valid_coordinates(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return df.filter(coordinates_ok(p))


# --- W1 -----------------------------------------------------------------------
def with_implied_speed(df: DataFrame, p: Params = DEFAULT, chunk: str | None = None) -> DataFrame:
    """Adds ``implied_speed_kn``: distance from the vessel's previous ping over
    the time between them (NULL for its first ping or a zero/negative gap).

    Previous ping = previous row by (Timestamp, Latitude, Longitude) within
    MMSI, found by ``with_previous`` split by hour, and flooded hours in
    slices, so neither a vessel nor one of its hours bounds a task. ``chunk``
    names an existing hour column to reuse; then ``SLICE`` stays too, where an
    hour is flooded. Reads ``df`` twice.
    """
    tmp = chunk is None
    if tmp:
        chunk = HOUR
        df = df.withColumn(chunk, hour_bucket("Timestamp"))
    df = with_previous(
        df,
        keys=["MMSI"],
        chunk=chunk,
        order=["Timestamp", "Latitude", "Longitude"],
        values=["Latitude", "Longitude", "Timestamp"],
        prefix="prev_",
        limit=p.flood_rows,
        keep_slice=not tmp,
    )
    hours = col(f"timestampdiff(SECOND, `prev_Timestamp`, `Timestamp`) / {num(3600)}")
    dist = acos_distance_sql("prev_Latitude", "prev_Longitude", "Latitude", "Longitude", p)
    df = df.withColumn("_hours", hours)
    df = df.withColumn("implied_speed_kn", col(f"CASE WHEN `_hours` > 0 THEN {dist} / `_hours` END")).drop(
        "_hours", "prev_Latitude", "prev_Longitude", "prev_Timestamp"
    )
    return df.drop(chunk) if tmp else df


def plausible_speed(p: Params = DEFAULT) -> Column:
    return col(f"(`implied_speed_kn` IS NULL OR `implied_speed_kn` <= {num(p.max_sog)})")


def filter_gps_jumps(df: DataFrame, p: Params = DEFAULT, chunk: str | None = None) -> DataFrame:
    """Drop pings whose implied speed from the previous ping exceeds ``max_sog``."""
    return with_implied_speed(df, p, chunk).filter(plausible_speed(p)).drop("implied_speed_kn")


# --- C6 -----------------------------------------------------------------------
def distance_from_center_nm(p: Params = DEFAULT) -> Column:
    return col(acos_distance_sql(p.center_lat, p.center_lon, "Latitude", "Longitude", p))


def region_ok(p: Params = DEFAULT) -> Column:
    lat_lo, lat_hi, lon_lo, lon_hi = p.box
    dist = acos_distance_sql(p.center_lat, p.center_lon, "Latitude", "Longitude", p)
    return col(
        f"(`Latitude` BETWEEN {num(lat_lo)} AND {num(lat_hi)} AND `Longitude` BETWEEN {num(lon_lo)} AND {num(lon_hi)}"
        f" AND {dist} <= {num(p.radius_nm)})"
    )


def filter_region(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Inside the lat/lon box AND within ``radius_nm`` of the centre.
    Both apply; the box is tighter than the circle east-west and north-south."""
    return df.filter(region_ok(p))


# --- C7 -----------------------------------------------------------------------
def _port_box_sql(la, lb, oa, ob) -> str:
    return f"(`Latitude` BETWEEN {num(la)} AND {num(lb)} AND `Longitude` BETWEEN {num(oa)} AND {num(ob)})"


def outside_ports(p: Params = DEFAULT) -> Column:
    """Outside every box, as one predicate; TRUE for an empty list."""
    return col("(" + (" AND ".join(f"NOT {_port_box_sql(la, lb, oa, ob)}" for _, la, lb, oa, ob in p.port_zones) or "TRUE") + ")")


def zone_cells(spark: SparkSession, p: Params = DEFAULT) -> dict[float, DataFrame]:
    """The boxes by cell size, each as the cells it covers: ``zone_lat``, ``zone_lon`` and the bounds. A box is put in the
    finest grid whose cells are as large as the box, so it covers four of them at most, and a cell is at most
    ``ZONE_GRID_STEP`` times as wide as its boxes (those above the finest grid): boxes that don't overlap are few in a cell,
    however small they are."""
    by_size: dict[float, list[tuple]] = {}
    for _, la, lb, oa, ob in p.port_zones:
        size = ZONE_CELL_DEG
        while size < max(lb - la, ob - oa):
            size *= ZONE_GRID_STEP
        by_size.setdefault(size, []).append((float(la), float(lb), float(oa), float(ob)))
    out = {}
    for size, boxes in sorted(by_size.items()):
        zones = spark.createDataFrame(pd.DataFrame(boxes, columns=["lat_min", "lat_max", "lon_min", "lon_max"]))
        span = lambda lo, hi, size=size: F.explode(F.sequence(cell_index(lo, size), cell_index(hi, size)))
        out[size] = zones.withColumn("zone_lat", span("lat_min", "lat_max")).withColumn("zone_lon", span("lon_min", "lon_max"))
    return out


def filter_port_zones(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Drop pings inside any port box (bounds inclusive).

    Boxes and pings meet by grid cell (an anti join for each grid in use), then the exact test decides, so a list of
    ten thousand boxes costs a ping as much as a short one. The cells, four for a box at most, are broadcast
    up to ``ZONE_BROADCAST`` boxes; beyond that Spark chooses the join. An empty list keeps all. Pings without a
    position (which C5 drops) are dropped.
    """
    if not p.port_zones:
        return df
    out = df.filter(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())
    for size, cells in zone_cells(df.sparkSession, p).items():
        cells = F.broadcast(cells) if len(p.port_zones) <= ZONE_BROADCAST else cells
        inside = (
            (cell_index("Latitude", size) == F.col("zone_lat"))
            & (cell_index("Longitude", size) == F.col("zone_lon"))
            & F.col("Latitude").between(F.col("lat_min"), F.col("lat_max"))
            & F.col("Longitude").between(F.col("lon_min"), F.col("lon_max"))
        )
        out = out.join(cells, inside, "left_anti")
    return out


# --- C8 -----------------------------------------------------------------------
def ship_type_ok(p: Params = DEFAULT) -> Column:
    return col(
        f"(NOT {one_of('ShipType', p.excluded_ship_types)} AND `ShipType` IS NOT NULL AND `ShipType` <> '')"
    )


def filter_ship_types(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Ship type known and not an excluded kind (NULL is dropped)."""
    return df.filter(ship_type_ok(p))


# --- C9 -----------------------------------------------------------------------
def moving_ok(p: Params = DEFAULT) -> Column:
    return col(f"(`SOG` > {num(p.min_sog)} AND NOT {one_of('NavigationalStatus', p.stationary_statuses)})")


def filter_moving(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """SOG above ``min_sog`` and status not stationary (NULL status dropped)."""
    return df.filter(moving_ok(p))


# --- C10 ----------------------------------------------------------------------
def clean_until_coordinates(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """C1 -> C5 (the four row filters after parsing run as one predicate)."""
    return parse_timestamp(df, p).filter(
        mobile_type_ok(p) & class_a_ok(p) & mmsi_valid("MMSI", p) & coordinates_ok(p)
    )


def clean_pings(df: DataFrame, p: Params = DEFAULT, keep_bucket: bool = False) -> DataFrame:
    """The full chain C1..C5, W1, C6..C9 on raw pings.

    Returns the input columns with ``Timestamp`` as TIMESTAMP_NTZ. Filters
    within a phase are ANDed into one predicate (same rows, fewer plan
    nodes); the jump filter still sees every valid Class A ping, as the
    region, port, type and motion filters only apply after it. With
    ``keep_bucket`` the minute is kept as ``TimeBucket`` and the hour that
    splits the jump filter as ``HOUR``; rows then stay hash-partitioned by
    (MMSI, hour), which per-vessel-minute windows that include the hour reuse
    without another shuffle (``SLICE`` too, where a vessel-hour is flooded).
    """
    base = clean_until_coordinates(df, p).withColumns(
        {"TimeBucket": minute_bucket("Timestamp", p.bucket_minutes), HOUR: hour_bucket("Timestamp")}
    )
    after = with_implied_speed(base, p, HOUR)
    out = after.filter(plausible_speed(p) & region_ok(p) & ship_type_ok(p) & moving_ok(p)).drop("implied_speed_kn")
    out = filter_port_zones(out, p)
    return out if keep_bucket else out.drop("TimeBucket", HOUR, SLICE)
