"""Post-detection verification: pair duration, course steadiness before the
event, and the verified-pair table.

Input is the validated event table *before* the one-per-pair step (the
duration test needs several events per pair).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.operators.index import window_bucket
from vesselflow.params import DEFAULT, Params

PAIR = ["MMSI_A", "MMSI_B"]
DETAIL_COLUMNS = (
    "Name_A",
    "Name_B",
    "ShipType_A",
    "ShipType_B",
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
    "Length_A",
    "Length_B",
    "vessel_distance_nm",
    "TCPA",
    "DCPA",
)


# --- A3 -----------------------------------------------------------------------
def pair_duration(events: DataFrame) -> DataFrame:
    """A3: per pair first/last event time, event count, seconds between them
    and the smallest distance. Hash aggregate with partial aggregation."""
    return events.groupBy(*PAIR).agg(
        F.min("Timestamp").alias("first_ts"),
        F.max("Timestamp").alias("last_ts"),
        F.count("Timestamp").alias("ping_count"),
        F.timestamp_diff("SECOND", F.min("Timestamp"), F.max("Timestamp")).alias("duration_seconds"),
        F.min("vessel_distance_nm").alias("min_distance"),
    )


# --- V1 -----------------------------------------------------------------------
def short_encounters(durations: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """V1: at most ``max_duration_s`` long and at least ``min_ping_count`` events."""
    return durations.filter(
        (F.col("duration_seconds") <= p.max_duration_s) & (F.col("ping_count") >= p.min_ping_count)
    )


# --- J4 + A4 ------------------------------------------------------------------
def _time_slots(lo, hi, minutes: int):
    """Array of slot ids covering [lo, hi] (both timestamps)."""
    return F.sequence(window_bucket(lo, minutes), window_bucket(hi, minutes))


def course_steadiness(pairs: DataFrame, clean: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A4 (J4): sample standard deviation of COG of each vessel over the
    ``lookback_min`` minutes before ``first_ts`` (``first_ts`` excluded).

    ``pairs`` has ``MMSI_A, MMSI_B, first_ts``. Both sides go through one
    interval join: each (pair, side) row is keyed by (MMSI, time slot) for
    the slots its look-back window touches (at most 2 with slot width =
    look-back), the pings by their own (MMSI, slot), then the range is
    checked. No vessel's whole history meets in one task; the pair side is
    small and AQE broadcasts it when its measured size allows.
    Output: ``MMSI_A, MMSI_B, cog_stddev_A, cog_stddev_B`` (NULL when a side
    has fewer than two pings with a course in the window).
    """
    width = p.lookback_min
    look = F.expr(f"INTERVAL {int(p.lookback_min)} MINUTES")
    sides = pairs.select(
        *PAIR,
        "first_ts",
        F.explode(
            F.array(
                F.struct(F.lit("A").alias("side"), F.col("MMSI_A").alias("MMSI")),
                F.struct(F.lit("B").alias("side"), F.col("MMSI_B").alias("MMSI")),
            )
        ).alias("_s"),
    ).select(*PAIR, "first_ts", "_s.side", "_s.MMSI")
    sides = sides.withColumn("_slot", F.explode(_time_slots(F.col("first_ts") - look, F.col("first_ts"), width)))
    pings = clean.select(
        "MMSI", F.col("Timestamp").alias("pre_ts"), F.col("COG").alias("pre_COG")
    ).withColumn("_slot", window_bucket("pre_ts", width))
    j = sides.join(pings, ["MMSI", "_slot"], "inner").filter(
        (F.col("pre_ts") < F.col("first_ts")) & (F.col("pre_ts") >= F.col("first_ts") - look)
    )
    return j.groupBy(*PAIR).agg(
        F.stddev_samp(F.when(F.col("side") == "A", F.col("pre_COG"))).alias("cog_stddev_A"),
        F.stddev_samp(F.when(F.col("side") == "B", F.col("pre_COG"))).alias("cog_stddev_B"),
    )


# --- V2 -----------------------------------------------------------------------
def straight_course(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """V2: at least one vessel held its course (stddev <= ``max_cog_stddev``);
    a missing stddev counts as 999."""
    return df.withColumn(
        "min_cog_stddev",
        F.least(F.coalesce(F.col("cog_stddev_A"), F.lit(999.0)), F.coalesce(F.col("cog_stddev_B"), F.lit(999.0))),
    ).filter(F.col("min_cog_stddev") <= p.max_cog_stddev)


# --- V3 -----------------------------------------------------------------------
def verified_pairs(events: DataFrame, clean: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """V3: V1 -> A4 (both sides) -> J5 -> V2 -> J6 (A6 distinct details) -> T1.

    A pair with several distinct detail rows yields one row per detail row,
    as in the original. Ordered by ``vessel_distance_nm``.
    """
    short = short_encounters(pair_duration(events), p)
    steady = course_steadiness(short.select(*PAIR, "first_ts"), clean, p)
    checked = straight_course(short.join(steady, PAIR, "left"), p)
    details = events.select(*PAIR, *DETAIL_COLUMNS).distinct()
    return checked.join(details, PAIR, "inner").orderBy("vessel_distance_nm", *PAIR, "DCPA")
