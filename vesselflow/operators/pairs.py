"""Vessel pairing: self-join, closest approach, close-event filter, validation,
best event per pair, convoy filters and fine-cell pair rules.

Pair join strategy
------------------
The original pairs every two pings of different vessels in the same minute
and the same 0.5 degree cell. That is quadratic in the pings of a busy cell,
while only pairs within ``max_distance_nm`` survive the close-event filter.
``pair_join="subgrid"`` (default) keeps the minute and 0.5 degree cell in the
join key (so the answer is identical) and adds a sub-cell key: latitude bins
of twice the largest possible latitude gap, longitude bins of twice the
largest possible longitude gap at the highest latitude of the cell row. Each
left ping is sent to its own sub-cell and the nearer latitude neighbour, each
right ping to its own sub-cell and the nearer longitude neighbour (2 + 2
copies), so every pair within the distance bound meets exactly once. ``pair_join="plain"`` runs the original
join (used to test the equivalence).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesselflow.functions.geo import acos_distance_nm, haversine_distance_nm
from vesselflow.functions.sqltext import col, num, ref
from vesselflow.functions.kinematics import dcpa_nm, fine_pair_dcpa, relative_position, relative_velocity, tcpa_hours
from vesselflow.operators.index import HOUR, SLICE, add_fine_index, add_grid_index
from vesselflow.operators.skew import attach, largest_group, split_join
from vesselflow.params import DEFAULT, Params
from vesselflow.plans.checkpoint import materialize

SIDE_COLUMNS = (
    "MMSI",
    "Timestamp",
    "Latitude",
    "Longitude",
    "SOG",
    "COG",
    "Heading",
    "Name",
    "ShipType",
    "Length",
)
_MARGIN = 1.01  # slack over the exact bound, far above floating-point noise


# --- A1 -----------------------------------------------------------------------
def pings_per_vessel_minute(indexed: DataFrame) -> DataFrame:
    """A1: ``MMSI, TimeBucket, count``."""
    return indexed.groupBy(*_minute_keys(indexed)).agg(F.count(F.lit(1)).alias("count")).drop(HOUR)


def _minute_keys(indexed: DataFrame) -> list[str]:
    """(MMSI, time bucket), with the hour where the rows are still partitioned by (MMSI, hour)."""
    return ["MMSI", *([HOUR] if HOUR in indexed.columns else []), "TimeBucket"]


def with_minute_counts(indexed: DataFrame) -> DataFrame:
    """Pings of the same vessel in the same time bucket, as column ``n_pings``.

    A window on (MMSI, hour, TimeBucket); after ``clean_pings(keep_bucket=True)``
    the rows are already partitioned by (MMSI, hour), so no shuffle is added.
    Rows of flooded vessel-hours (``SLICE`` above 0) get the counts of a partial
    aggregate instead, which no bucket's size bounds.
    """
    keys = _minute_keys(indexed)
    counted = F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("n_pings")
    if SLICE not in indexed.columns:
        return indexed.select("*", counted)
    stored = materialize(indexed)
    hot = stored.where(F.col(SLICE) > 0)
    counts = materialize(hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pings")))
    return stored.where(F.col(SLICE) == 0).select("*", counted).unionByName(attach(hot, counts, keys, "n_pings"))


# --- J1 -----------------------------------------------------------------------
def _subcell_columns(block_lat: str, block_deg: float, max_dist_nm: float, p: Params) -> dict[str, Column]:
    """Sub-cell keys and the direction of the nearer neighbour on each axis.

    Latitude bins are twice the largest latitude gap of a pair within
    ``max_dist_nm``; longitude bins twice the largest longitude gap at the
    highest |latitude| of the block row (one bin when that reaches a pole).
    """
    ang = max_dist_nm / p.earth_radius_nm  # radians
    h = 2.0 * math.degrees(ang) * _MARGIN
    lo = f"(CAST({ref(block_lat)} AS DOUBLE) * {num(block_deg)})"
    maxabs = f"least({num(90)}, greatest(abs({lo}), abs({lo} + {num(block_deg)})))"
    s = f"({num(math.sin(ang / 2.0))} / cos(radians({maxabs})))"
    half_w = f"CASE WHEN {s} >= {num(1)} THEN {num(180)} ELSE degrees({num(2)} * asin({s})) END"
    w = f"least({num(360)}, {num(2.0 * _MARGIN)} * ({half_w}))"
    y = f"(`Latitude` / {num(h)})"
    x = f"(`Longitude` / {w})"
    return {
        "sub_lat": col(f"CAST(floor({y}) AS BIGINT)"),
        "sub_lon": col(f"CAST(floor({x}) AS BIGINT)"),
        "_sub_dy": col(f"CASE WHEN {y} - floor({y}) >= 0.5 THEN 1 ELSE -1 END"),
        "_sub_dx": col(f"CASE WHEN {x} - floor({x}) >= 0.5 THEN 1 ELSE -1 END"),
    }


def _subcell_keys(df: DataFrame, block_lat: str, block_deg: float, max_dist_nm: float, p: Params) -> DataFrame:
    return df.withColumns(_subcell_columns(block_lat, block_deg, max_dist_nm, p))


def _side(df: DataFrame, suffix: str, extra: tuple[str, ...], carry: tuple[str, ...] = ()) -> DataFrame:
    have = set(df.columns)
    cols = [F.col(c).alias(f"{c}_{suffix}") for c in SIDE_COLUMNS if c in have]
    missing = [F.lit(None).cast("double").alias(f"{c}_{suffix}") for c in SIDE_COLUMNS if c not in have]
    carried = [F.col(c).alias(f"{c}_{suffix}") for c in carry]
    return df.select(*cols, *missing, *carried, *[F.col(c) for c in extra])


def _explode_axis(df: DataFrame, axis: str) -> DataFrame:
    """Two rows per ping: its own sub-cell and the nearer neighbour along one
    axis (``"lat"`` or ``"lon"``). The left side spreads along latitude, the
    right side along longitude: for a pair within the bound exactly one left
    copy and one right copy share (sub_lat, sub_lon), so it meets once, and
    each ping is shuffled twice (4 rows per pair of sides instead of 5)."""
    key, d = ("sub_lat", "_sub_dy") if axis == "lat" else ("sub_lon", "_sub_dx")
    keep = [c for c in df.columns if c not in (key, "_sub_dy", "_sub_dx")]
    return df.select(*keep, F.explode(F.array(F.col(key), F.col(key) + F.col(d))).alias(key))


def candidate_pairs(indexed: DataFrame, p: Params = DEFAULT, carry: tuple[str, ...] = ()) -> DataFrame:
    """Ping pairs of different vessels (``MMSI_A < MMSI_B``) in the same
    minute and 0.5 degree cell.

    ``indexed`` needs ``TimeBucket``. With ``p.pair_join == "subgrid"`` only
    pairs that can be within ``p.max_distance_nm`` are produced (exactly
    those the close-event filter can keep). Where a (minute, cell) has more than
    ``p.flood_cell_rows`` pings, the sub-cells that have are split in blocks
    (``split_join``), so they don't bound a task. Runs a job for the largest
    cell, and reads ``indexed`` several times: pass a stored table. ``carry`` lists extra per-ping
    columns to bring along, suffixed. Output columns: ``<col>_A``,
    ``<col>_B`` for the side columns and carried ones, plus ``TimeBucket``,
    ``grid_lat``, ``grid_lon``.
    """
    keyed = {
        "grid_lat": F.floor(F.col("Latitude") / F.lit(p.grid_deg)).cast("long"),
        "grid_lon": F.floor(F.col("Longitude") / F.lit(p.grid_deg)).cast("long"),
    }
    keys = ("TimeBucket", "grid_lat", "grid_lon")
    sub: tuple[str, ...] = ()
    if p.pair_join == "subgrid":
        sub = ("sub_lat", "sub_lon")
    elif p.pair_join != "plain":
        raise ValueError(f"unknown pair_join {p.pair_join!r}")
    indexed = indexed.withColumns(keyed)
    if sub:
        indexed = _subcell_keys(indexed, "grid_lat", p.grid_deg, p.max_distance_nm, p)
    dirs = ("_sub_dy", "_sub_dx") if sub else ()
    a = _side(indexed, "A", keys + sub + dirs, carry)
    b = _side(indexed, "B", keys + sub + dirs, carry)
    if sub:
        a, b = _explode_axis(a, "lat"), _explode_axis(b, "lon")
    if largest_group(indexed, list(keys)) > p.flood_cell_rows:
        pairs = split_join(a, b, list(keys + sub), p.flood_cell_rows)
    else:
        pairs = a.join(b, on=list(keys + sub), how="inner")
    pairs = pairs.filter(F.col("MMSI_A") < F.col("MMSI_B"))
    return pairs.drop(*sub) if sub else pairs


def candidate_pair_counts(indexed: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Number of J1 (plain) candidate ping pairs per minute, without forming them.

    In one (minute, cell) with ``n`` pings, ``n_m`` of them from vessel ``m``,
    the pairs with ``MMSI_A < MMSI_B`` number ``(n^2 - sum n_m^2) / 2``. Two
    partial aggregations, no join, so a crowded cell costs nothing extra.
    """
    if "grid_lat" not in indexed.columns:
        indexed = add_grid_index(indexed, p)
    per_vessel = indexed.groupBy("TimeBucket", "grid_lat", "grid_lon", "MMSI").agg(F.count(F.lit(1)).alias("n_m"))
    per_cell = per_vessel.groupBy("TimeBucket", "grid_lat", "grid_lon").agg(
        F.sum("n_m").alias("n"), F.sum(F.col("n_m") * F.col("n_m")).alias("n2")
    )
    return (
        per_cell.withColumn("pairs", F.expr("(n * n - n2) div 2"))
        .groupBy("TimeBucket")
        .agg(F.sum("pairs").cast("long").alias("candidate_pairs"))
        .filter(F.col("candidate_pairs") > 0)
    )


# --- M1, M4-M7 ------------------------------------------------------------------
def with_cpa(pairs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Adds ``vessel_distance_nm`` (acos form), ``tcpa_hours`` and ``dcpa``."""
    dist = acos_distance_nm("Latitude_A", "Longitude_A", "Latitude_B", "Longitude_B", p)
    pairs = pairs.withColumn("vessel_distance_nm", dist)
    ve, vn = relative_velocity("SOG_A", "COG_A", "SOG_B", "COG_B")
    pe, pn = relative_position("Latitude_A", "Longitude_A", "Latitude_B", "Longitude_B", p)
    pairs = pairs.withColumns({"_ve": ve, "_vn": vn, "_pe": pe, "_pn": pn})
    pairs = pairs.withColumn("tcpa_hours", tcpa_hours("_pe", "_pn", "_ve", "_vn", p))
    dcpa = dcpa_nm("_pe", "_pn", "_ve", "_vn", "tcpa_hours", "vessel_distance_nm", p)
    return pairs.withColumn("dcpa", dcpa).drop("_ve", "_vn", "_pe", "_pn")


# --- F1 / F2 --------------------------------------------------------------------
def close_condition(p: Params = DEFAULT) -> Column:
    return (
        (F.col("dcpa") <= F.lit(p.dcpa_limit_nm))
        & (F.col("tcpa_hours") >= F.lit(p.tcpa_floor_h))
        & (F.col("SOG_A") > F.lit(p.min_sog))
        & (F.col("SOG_B") > F.lit(p.min_sog))
        & (F.col("vessel_distance_nm") > F.lit(0.0))
        & (F.col("vessel_distance_nm") <= F.lit(p.max_distance_nm))
    )


EVENT_COLUMNS = (
    "MMSI_A",
    "MMSI_B",
    "first_ts",
    "Timestamp",
    "Timestamp_B",
    "TimeBucket",
    "Lat_A",
    "Lon_A",
    "Lat_B",
    "Lon_B",
    "SOG_A",
    "SOG_B",
    "COG_A",
    "COG_B",
    "HDG_A",
    "HDG_B",
    "Name_A",
    "Name_B",
    "ShipType_A",
    "ShipType_B",
    "Length_A",
    "Length_B",
    "vessel_distance_nm",
    "TCPA",
    "DCPA",
    "duration_seconds",
    "ping_count",
)


def close_events(pairs_cpa: DataFrame, p: Params = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """F1 + F2: keep close pairs and project the event table.

    ``first_ts``/``Timestamp``/``TimeBucket`` come from side A; side B's time
    is kept as ``Timestamp_B``, and courses and lengths are carried for the
    verification step. ``duration_seconds`` and ``ping_count`` are 0
    placeholders, as in the original event table.
    """
    sel = [
        F.col("MMSI_A"),
        F.col("MMSI_B"),
        F.col("Timestamp_A").alias("first_ts"),
        F.col("Timestamp_A").alias("Timestamp"),
        F.col("Timestamp_B"),
        F.col("TimeBucket"),
        F.col("Latitude_A").alias("Lat_A"),
        F.col("Longitude_A").alias("Lon_A"),
        F.col("Latitude_B").alias("Lat_B"),
        F.col("Longitude_B").alias("Lon_B"),
        F.col("SOG_A"),
        F.col("SOG_B"),
        F.col("COG_A"),
        F.col("COG_B"),
        F.col("Heading_A").alias("HDG_A"),
        F.col("Heading_B").alias("HDG_B"),
        F.col("Name_A"),
        F.col("Name_B"),
        F.col("ShipType_A"),
        F.col("ShipType_B"),
        F.col("Length_A").cast("double").alias("Length_A"),
        F.col("Length_B").cast("double").alias("Length_B"),
        F.col("vessel_distance_nm"),
        F.col("tcpa_hours").alias("TCPA"),
        F.col("dcpa").alias("DCPA"),
        F.lit(0).alias("duration_seconds"),
        F.lit(0).alias("ping_count"),
    ]
    return pairs_cpa.filter(close_condition(p)).select(*sel, *[F.col(c) for c in keep])


# --- A2 -----------------------------------------------------------------------
def validate_proximity(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A2: keep events whose two vessels each have at least
    ``min_pings_per_minute`` pings in the event minute (columns ``n_pings_A``,
    ``n_pings_B`` from ``with_minute_counts``). If that keeps nothing, all
    events are returned unchanged (the original failsafe), decided with an
    EXISTS subquery. The events are read twice: pass a stored table. With
    ``p.validate`` off, all events are kept.
    """
    if not p.validate:
        return events.drop("n_pings_A", "n_pings_B")
    ok = F.least(F.col("n_pings_A"), F.col("n_pings_B")) >= p.min_pings_per_minute
    any_ok = events.filter(ok).exists()
    return events.filter(ok | ~any_ok).drop("n_pings_A", "n_pings_B")


# --- W2 -----------------------------------------------------------------------
def best_event_per_pair(events: DataFrame) -> DataFrame:
    """One event per (MMSI_A, MMSI_B), the smallest DCPA.

    Ties are broken by distance, then side A time, then side B time, so the
    pick is deterministic. A ``min(struct(...))`` aggregate: Spark sorts for it
    (a struct buffer isn't fixed-width), but partial aggregation runs before the
    shuffle, so a pair with very many events costs one row per map task.
    """
    cols = events.columns
    order = ["DCPA", "vessel_distance_nm", "Timestamp", "Timestamp_B"]
    rest = [c for c in cols if c not in ["MMSI_A", "MMSI_B"] + order]
    best = events.groupBy("MMSI_A", "MMSI_B").agg(
        F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    )
    return best.select(*[F.col(c) if c in ("MMSI_A", "MMSI_B") else F.col(f"_best.{c}").alias(c) for c in cols])


# --- F4 -----------------------------------------------------------------------
def convoy_filters(
    events: DataFrame,
    p: Params = DEFAULT,
    sog_diff: bool = True,
    sog_max: bool = True,
    pair_buckets: bool = True,
) -> DataFrame:
    """drop pairs that look like convoys.

    ``|SOG_A - SOG_B| >= min_sog_diff``; ``greatest(SOG_A, SOG_B) >= min_sog_max``;
    the pair appears in at most ``max_pair_buckets`` distinct minutes (counted
    by a partial aggregate and joined back on the pair key).
    """
    out = events
    if sog_diff:
        out = out.filter(F.abs(F.col("SOG_A") - F.col("SOG_B")) >= p.min_sog_diff)
    if sog_max:
        out = out.filter(F.greatest(F.col("SOG_A"), F.col("SOG_B")) >= p.min_sog_max)
    if pair_buckets:
        minutes = (
            events.select("MMSI_A", "MMSI_B", "TimeBucket")
            .distinct()
            .groupBy("MMSI_A", "MMSI_B")
            .agg(F.count(F.lit(1)).alias("_pair_minutes"))
            .filter(F.col("_pair_minutes") <= p.max_pair_buckets)
        )
        out = out.join(minutes, ["MMSI_A", "MMSI_B"], "left_semi")
    return out


# --- P1-P3 --------------------------------------------------------------------
def fine_pairs(clean_bucketed: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Pairs in the same fine cell and minute that pass the fine rules.

    Fine cell = ``fine_cell_deg`` square (stands in for a hexagon index).
    Rules: haversine distance <= ``fallback_reject_factor * dcpa_limit_nm``;
    speed difference not below ``min_sog_diff``; cos-mid-latitude DCPA not
    above ``dcpa_limit_nm`` (a NULL course leaves DCPA NULL and the pair is
    kept, as NaN was). Pairs are canonical (``MMSI_A < MMSI_B``); distance and
    DCPA are symmetric, so this only fixes the output order.
    """
    reject_nm = p.fallback_reject_factor * p.dcpa_limit_nm
    df = add_fine_index(clean_bucketed, p)
    keys = ("TimeBucket", "fine_lat", "fine_lon")
    df = _subcell_keys(df, "fine_lat", p.fine_cell_deg, reject_nm, p)
    sub = ("sub_lat", "sub_lon")
    a = _explode_axis(_side(df, "A", keys + sub + ("_sub_dy", "_sub_dx", "FineCell")), "lat")
    b = _explode_axis(_side(df, "B", keys + sub + ("_sub_dy", "_sub_dx")), "lon")
    if largest_group(df, list(keys)) > p.flood_cell_rows:
        pr = split_join(a, b, list(keys + sub), p.flood_cell_rows)
    else:
        pr = a.join(b, on=list(keys + sub), how="inner")
    pr = pr.filter(F.col("MMSI_A") < F.col("MMSI_B"))
    dist = haversine_distance_nm("Latitude_A", "Longitude_A", "Latitude_B", "Longitude_B", p)
    dcpa = fine_pair_dcpa(
        "Latitude_A", "Longitude_A", "Latitude_B", "Longitude_B", "SOG_A", "COG_A", "SOG_B", "COG_B", p
    )
    pr = (
        pr.withColumn("Distance_NM", dist)
        .filter(~(F.col("Distance_NM") > reject_nm))
        .filter(~F.coalesce(F.abs(F.col("SOG_A") - F.col("SOG_B")) < p.min_sog_diff, F.lit(False)))
        .withColumn("DCPA_NM", dcpa)
        .filter(~F.coalesce(F.col("DCPA_NM") > p.dcpa_limit_nm, F.lit(False)))
    )
    return pr.select(
        "MMSI_A",
        "MMSI_B",
        "Name_A",
        "Name_B",
        F.col("Latitude_A").alias("Lat_A"),
        F.col("Longitude_A").alias("Lon_A"),
        F.col("Latitude_B").alias("Lat_B"),
        F.col("Longitude_B").alias("Lon_B"),
        "SOG_A",
        "SOG_B",
        "COG_A",
        "COG_B",
        "Distance_NM",
        "DCPA_NM",
        F.col("Timestamp_A").alias("Timestamp"),
        "Timestamp_B",
        "TimeBucket",
        "FineCell",
    )
