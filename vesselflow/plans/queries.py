"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

All read the driver's ``events`` table through the derived ping table
(``sources.fixture.stored_pings``), so their work grows with the input. Double
outputs are rounded (``ROUND_DIGITS``) only at the query boundary, so two
engines whose trig functions differ in the last bit still agree; the
operators themselves never round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType

from vesselflow.operators import clean as C
from vesselflow.operators import index as I
from vesselflow.operators import pairs as P
from vesselflow.operators import report as R
from vesselflow.operators import trajectory as T
from vesselflow.operators import verify as V
from vesselflow.plans import detect as D
from vesselflow.params import DEFAULT
from vesselflow.plans.checkpoint import delete_path, materialize, stage_dir
from vesselflow.functions.numbertext import fixed_text
from vesselflow.functions.sqltext import ref
from vesselflow.operators.index import hour_bucket
from vesselflow.operators.sequence import with_rank
from vesselflow.sources import csv as S
from vesselflow.sources.fixture import raw_pings, stored_pings
from vesselflow.sources.schema import required_columns
from vesselflow.sources.sinks import write_days

ROUND_DIGITS = 5

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every DOUBLE column (one projection, written as SQL text)."""
    return df.selectExpr(
        *[
            f"round({ref(f.name)}, {int(digits)}) AS {ref(f.name)}" if isinstance(f.dataType, DoubleType) else ref(f.name)
            for f in df.schema.fields
        ]
    )


def _raw(spark, sf_dir, p=DEFAULT):
    return stored_pings(spark, sf_dir, p)


def _parsed(spark, sf_dir, p=DEFAULT):
    return C.parse_timestamp(_raw(spark, sf_dir, p), p)


def _clean_b(spark, sf_dir, p=DEFAULT):
    return D.clean_bucketed(_raw(spark, sf_dir, p), p)


def _shared(spark, sf_dir, p=DEFAULT):
    """Cleaned pings read several times by one plan: materialised once."""
    return D.shared_clean(_raw(spark, sf_dir, p), p)


def _clean(spark, sf_dir, p=DEFAULT):
    return C.clean_pings(_raw(spark, sf_dir, p), p)


def _events(spark, sf_dir, p=DEFAULT):
    return D.detect(_shared(spark, sf_dir, p), p)


def _validated(spark, sf_dir, p=DEFAULT):
    return D.validated_events(_shared(spark, sf_dir, p), p)


def _events_shared(spark, sf_dir, p=DEFAULT):
    """Best event per pair on top of materialised validated events."""
    return P.best_event_per_pair(D.shared_validated(_shared(spark, sf_dir, p), p))


# --- sources and cleaning -------------------------------------------------------
@query("csv_roundtrip_scan")
def q_csv_roundtrip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S3 + C1: write the raw pings as one day of AIS CSV in the shared
    folder, read them back by day with the fixed schema, parse the timestamp;
    the CSV is deleted once the parsed pings are stored."""
    folder = f"{stage_dir(spark)}/vesselflow-csv-{uuid.uuid4().hex}"
    try:
        S.write_pings_csv(raw_pings(spark, sf_dir, as_text=True), S.day_path(folder, 13))
        return materialize(rounded(C.parse_timestamp(S.load_pings(spark, folder, 13))))
    finally:
        delete_path(spark, folder)


@query("clean_class_filter")
def q_clean_class_filter(spark, sf_dir):
    """C2 + C3 after C1."""
    return rounded(_parsed(spark, sf_dir).transform(C.filter_mobile_type).transform(C.filter_class_a))


@query("clean_mmsi")
def q_clean_mmsi(spark, sf_dir):
    return rounded(_parsed(spark, sf_dir).transform(C.filter_valid_mmsi))


@query("mmsi_flags")
def q_mmsi_flags(spark, sf_dir):
    """C4b next to C4 for every parsed ping."""
    return _parsed(spark, sf_dir).select(
        "MMSI",
        "Timestamp",
        F.coalesce(C.mmsi_in_range("MMSI"), F.lit(False)).alias("mmsi_in_range"),
        F.coalesce(C.mmsi_valid("MMSI"), F.lit(False)).alias("mmsi_valid"),
    )


@query("clean_coordinates")
def q_clean_coordinates(spark, sf_dir):
    return rounded(_parsed(spark, sf_dir).transform(C.filter_valid_coordinates))


@query("gps_jump_filter")
def q_gps_jump_filter(spark, sf_dir):
    """C1-C5 then W1."""
    return rounded(C.clean_until_coordinates(_raw(spark, sf_dir)).transform(C.filter_gps_jumps))


@query("implied_speed")
def q_implied_speed(spark, sf_dir):
    """W1's implied speed (knots) for every ping after C1-C5, unfiltered."""
    df = C.with_implied_speed(C.clean_until_coordinates(_raw(spark, sf_dir)))
    return rounded(df.select("MMSI", "Timestamp", "implied_speed_kn"), 3)


@query("region_filter")
def q_region_filter(spark, sf_dir):
    return rounded(_parsed(spark, sf_dir).transform(C.filter_region))


@query("exclusion_zones")
def q_exclusion_zones(spark, sf_dir):
    return rounded(_parsed(spark, sf_dir).transform(C.filter_port_zones))


@query("ship_type_filter")
def q_ship_type_filter(spark, sf_dir):
    return rounded(_parsed(spark, sf_dir).transform(C.filter_ship_types))


@query("moving_vessels")
def q_moving_vessels(spark, sf_dir):
    return rounded(_parsed(spark, sf_dir).transform(C.filter_moving))


@query("cleaned_pings")
def q_cleaned_pings(spark, sf_dir):
    """The whole cleaning chain."""
    return rounded(_clean(spark, sf_dir))


# --- indexing and counts -----------------------------------------------------------
@query("minute_grid_counts")
def q_minute_grid_counts(spark, sf_dir):
    """I1 + I2: pings per (minute, 0.5 degree cell)."""
    df = I.add_grid_index(_clean_b(spark, sf_dir))
    return df.groupBy("TimeBucket", "GridCell").agg(F.count(F.lit(1)).alias("pings"))


@query("fine_cell_counts")
def q_fine_cell_counts(spark, sf_dir):
    """Pings per (minute, fine cell)."""
    df = I.add_fine_index(_clean_b(spark, sf_dir))
    return df.groupBy("TimeBucket", "FineCell").agg(F.count(F.lit(1)).alias("pings"))


@query("pings_per_vessel_minute")
def q_pings_per_vessel_minute(spark, sf_dir):
    return P.pings_per_vessel_minute(_clean_b(spark, sf_dir))


@query("candidate_pairs_per_minute")
def q_candidate_pairs_per_minute(spark, sf_dir):
    """J1 (original blocking) candidate count per minute, by counting formula."""
    return P.candidate_pair_counts(_clean_b(spark, sf_dir))


# --- pairs --------------------------------------------------------------------------
def _near_pairs(spark, sf_dir, p=DEFAULT):
    pr = D.close_pairs(_shared(spark, sf_dir, p), p)
    return pr.filter((F.col("vessel_distance_nm") > 0) & (F.col("vessel_distance_nm") <= p.max_distance_nm))


@query("pair_distance")
def q_pair_distance(spark, sf_dir):
    """M1 + M2 for every candidate pair within the distance limit."""
    from vesselflow.functions.geo import haversine_distance_nm

    pr = _near_pairs(spark, sf_dir)
    return rounded(
        pr.select(
            "MMSI_A",
            "MMSI_B",
            F.col("Timestamp_A").alias("ts_A"),
            F.col("Timestamp_B").alias("ts_B"),
            F.col("vessel_distance_nm").alias("distance_acos_nm"),
            haversine_distance_nm("Latitude_A", "Longitude_A", "Latitude_B", "Longitude_B").alias(
                "distance_haversine_nm"
            ),
        )
    )


@query("pair_tcpa_dcpa")
def q_pair_tcpa_dcpa(spark, sf_dir):
    """M4-M7 for every candidate pair within the distance limit."""
    pr = _near_pairs(spark, sf_dir)
    return rounded(
        pr.select(
            "MMSI_A",
            "MMSI_B",
            F.col("Timestamp_A").alias("ts_A"),
            F.col("Timestamp_B").alias("ts_B"),
            F.col("tcpa_hours").alias("TCPA"),
            F.col("dcpa").alias("DCPA"),
        )
    )


@query("close_events")
def q_close_events(spark, sf_dir):
    """F1 + F2."""
    ev = D.close_events(_shared(spark, sf_dir)).drop("n_pings_A", "n_pings_B")
    return rounded(ev)


@query("validated_events")
def q_validated_events(spark, sf_dir):
    """A2 with failsafe."""
    return rounded(_validated(spark, sf_dir))


@query("closest_event_per_pair")
def q_closest_event_per_pair(spark, sf_dir):
    """The detection result, one event per vessel pair."""
    return rounded(_events(spark, sf_dir))


@query("convoy_filters")
def q_convoy_filters(spark, sf_dir):
    """F4 on the validated events."""
    return rounded(P.convoy_filters(_validated(spark, sf_dir)))


@query("fine_pairs")
def q_fine_pairs(spark, sf_dir):
    """Fine-cell pair rules."""
    return rounded(P.fine_pairs(_shared(spark, sf_dir)))


# --- verification ---------------------------------------------------------------
@query("pair_duration")
def q_pair_duration(spark, sf_dir):
    return rounded(V.pair_duration(_validated(spark, sf_dir)))


@query("short_encounters")
def q_short_encounters(spark, sf_dir):
    return rounded(V.short_encounters(V.pair_duration(_validated(spark, sf_dir))))


@query("course_steadiness")
def q_course_steadiness(spark, sf_dir):
    """A4 for every validated pair, look-back from its first event."""
    clean_b = _shared(spark, sf_dir)
    pairs = V.pair_duration(D.validated_events(clean_b)).select("MMSI_A", "MMSI_B", "first_ts")
    return rounded(V.course_steadiness(pairs, D.pings_of(clean_b)))


@query("verified_pairs")
def q_verified_pairs(spark, sf_dir):
    """V3: the whole verification chain on the validated events."""
    clean_b = _shared(spark, sf_dir)
    return rounded(V.verified_pairs(D.shared_validated(clean_b), D.pings_of(clean_b)))


# --- selection, trajectories, reports ------------------------------------------------
@query("priority_pairs")
def q_priority_pairs(spark, sf_dir):
    return rounded(T.priority_events(_events_shared(spark, sf_dir)))


@query("five_closest_pairs")
def q_five_closest_pairs(spark, sf_dir):
    return rounded(T.closest_pairs(_events(spark, sf_dir)))


@query("event_trajectories")
def q_event_trajectories(spark, sf_dir):
    clean_b = _shared(spark, sf_dir)
    return rounded(T.event_trajectories(materialize(D.detect(clean_b)), D.pings_of(clean_b)))


@query("trajectory_endpoints")
def q_trajectory_endpoints(spark, sf_dir):
    clean_b = _shared(spark, sf_dir)
    ev = materialize(D.detect(clean_b))
    return rounded(T.trajectory_endpoints(T.event_trajectories(ev, D.pings_of(clean_b)), ev))


@query("trajectory_wkt")
def q_trajectory_wkt(spark, sf_dir):
    clean_b = _shared(spark, sf_dir)
    events = materialize(D.detect(clean_b))
    return T.trajectory_segments(materialize(T.event_trajectories(events, D.pings_of(clean_b))))


@query("ordered_tracks")
def q_ordered_tracks(spark, sf_dir):
    """Each track's pings with their place in time order."""
    clean_b = _shared(spark, sf_dir)
    return rounded(T.numbered_tracks(T.event_trajectories(materialize(D.detect(clean_b)), D.pings_of(clean_b))))


@query("unvalidated_closest_event_per_pair")
def q_unvalidated(spark, sf_dir):
    """W2 with the proximity validation (A2) switched off."""
    return rounded(_events(spark, sf_dir, DEFAULT.with_(validate=False)))


@query("track_lines")
def q_track_lines(spark, sf_dir):
    """Each track as one WKT line."""
    clean_b = _shared(spark, sf_dir)
    events = materialize(D.detect(clean_b))
    return T.trajectory_lines(T.event_trajectories(events, D.pings_of(clean_b)))


@query("track_islands")
def q_track_islands(spark, sf_dir):
    """The disjoint times for which each vessel's pings are read, over all validated events."""
    return T.track_islands(_validated(spark, sf_dir))


@query("event_bearings")
def q_event_bearings(spark, sf_dir):
    return rounded(R.event_bearings(_events(spark, sf_dir)), 3)


@query("result_table")
def q_result_table(spark, sf_dir):
    return rounded(R.result_table(_events(spark, sf_dir)))


@query("event_report_text")
def q_event_report_text(spark, sf_dir):
    return R.report_text(_events(spark, sf_dir))


@query("fixed_decimal_text")
def q_fixed_decimal_text(spark, sf_dir):
    """R1/M8 number text for every ping: positions, speed and course with one, two and six decimals."""
    df = _raw(spark, sf_dir).select("MMSI", "Latitude", "Longitude", "SOG", "COG")
    text = [fixed_text(c, n).alias(f"{c.lower()}_{n}") for c in ("Latitude", "Longitude", "SOG", "COG") for n in (1, 2, 6)]
    return df.select("MMSI", *text)


@query("stage_counts")
def q_stage_counts(spark, sf_dir):
    """A5: rows after each stage (raw, clean, candidates, close, validated, final)."""
    return R.stage_counts(spark, D.counted_stages(_raw(spark, sf_dir))[1])


# --- other bucket widths, long zone lists, sinks, checks -----------------------------
FIVE_MINUTES = DEFAULT.with_(bucket_minutes=5)


@query("five_minute_counts")
def q_five_minute_counts(spark, sf_dir):
    """I1, A1 and J1's candidate counts in buckets of five minutes."""
    df = materialize(_clean_b(spark, sf_dir, FIVE_MINUTES))
    pings = P.pings_per_vessel_minute(df).groupBy("TimeBucket").agg(F.count(F.lit(1)).alias("vessels"), F.sum("count").alias("pings"))
    pairs = P.candidate_pair_counts(df, FIVE_MINUTES)
    return pings.join(pairs, "TimeBucket", "left").na.fill(0, ["candidate_pairs"])


@query("five_minute_events")
def q_five_minute_events(spark, sf_dir):
    """E1 in buckets of five minutes: I1, A1, A2 and J1 share the width."""
    return rounded(_events(spark, sf_dir, FIVE_MINUTES))


def many_zones(n: int = 10_000) -> tuple:
    """``n`` small boxes in rows of a hundred over the pings' waters, some of which overlap."""
    return tuple((f"zone {k}", 55.0 + (k // 100) * 0.009, 55.004 + (k // 100) * 0.009, 14.0 + (k % 100) * 0.007, 14.003 + (k % 100) * 0.007 + (k % 5) * 0.001) for k in range(n))


@query("many_exclusion_zones")
def q_many_exclusion_zones(spark, sf_dir):
    """C7 with ten thousand boxes."""
    p = DEFAULT.with_(port_zones=many_zones())
    kept = C.filter_port_zones(_parsed(spark, sf_dir).where("Latitude IS NOT NULL"), p)
    return rounded(kept.select("MMSI", "Timestamp", "Latitude", "Longitude"))


@query("events_by_day")
def q_events_by_day(spark, sf_dir):
    """Validated events written by day and hour, the first hour written again, and all read back."""
    folder = f"{stage_dir(spark)}/vesselflow-days-{uuid.uuid4().hex}"
    events = materialize(_validated(spark, sf_dir))
    first = events.agg(F.min("first_ts")).first()[0]
    try:
        write_days(events, folder, "first_ts", unit="hour")
        if first is not None:
            hour = events.where(hour_bucket("first_ts") == hour_bucket(F.lit(first).cast("timestamp_ntz")))
            write_days(hour, folder, "first_ts", unit="hour")
        stored = spark.read.schema(events.schema.add("day", DateType()).add("hour", IntegerType())).parquet(folder) if first is not None else events.selectExpr("*", "CAST(NULL AS DATE) AS day", "0 AS hour")
        return materialize(rounded(stored.withColumn("day", F.col("day").cast("string"))))
    finally:
        delete_path(spark, folder)


@query("required_columns")
def q_required_columns(spark, sf_dir):
    """The required columns of a table without headings."""
    return required_columns(_raw(spark, sf_dir).drop("Heading"))


@query("verified_by_distance")
def q_verified_by_distance(spark, sf_dir):
    """Verified pairs with their place in the order by distance."""
    clean_b = _shared(spark, sf_dir)
    rows = V.verified_pairs(D.shared_validated(clean_b), D.pings_of(clean_b))
    order = ["vessel_distance_nm", "MMSI_A", "MMSI_B", "DCPA", "Lat_A", "Lon_A", "Lat_B", "Lon_B", "SOG_A", "SOG_B", "COG_A", "COG_B", "HDG_A", "HDG_B"]
    ranked = with_rank(rows, [F.col(c).asc_nulls_first() for c in order])
    return rounded(ranked.select("MMSI_A", "MMSI_B", "vessel_distance_nm", "DCPA", "rank"))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
