"""Result table, report text, bearings and per-stage row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.functions.geo import bearing_text, encounter_class, initial_bearing_deg, relative_bearing_deg
from vesselflow.functions.numbertext import fixed_text_sql
from vesselflow.functions.sqltext import col, num, ref
from vesselflow.params import DEFAULT, METRES_PER_NM, Params

# The report's wording and its numbers' decimals, as the original prints them.
RULE = "─" * 70


# --- R2 -----------------------------------------------------------------------
def result_table(events: DataFrame) -> DataFrame:
    """R2: the 8 result columns plus the distance in metres (1 decimal)."""
    return events.select(
        "MMSI_A",
        "MMSI_B",
        "Name_A",
        "Name_B",
        "first_ts",
        "Lat_A",
        "Lon_A",
        "vessel_distance_nm",
        F.round(F.col("vessel_distance_nm") * F.lit(METRES_PER_NM), 1).alias("distance_m"),
    )


# --- R1 -----------------------------------------------------------------------
def report_text(events: DataFrame) -> DataFrame:
    """One multi-line report per event (metres = nm * 1852, TCPA in
    minutes, speeds to one decimal). Numbers are rounded from their exact
    binary values (``fixed_text``)."""
    na = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("N/A"))
    fixed = lambda c, digits, factor=1.0: col(
        fixed_text_sql(f"(coalesce({ref(c)}, 0D) * {num(factor)})", digits)
    )
    text = F.format_string(
        "\n" + RULE + "\nCOLLISION EVENT DETAILS\n" + RULE + "\n"
        "Vessel A:        %s (MMSI: %s)\n"
        "Vessel B:        %s (MMSI: %s)\n"
        "Timestamp:       %s UTC\n"
        "Location:        %s°N, %s°E\n"
        "Distance:        %s meters\n"
        "DCPA:            %s meters\n"
        "TCPA:            %s minutes\n"
        "SOG A / B:       %s / %s knots\n"
        "Ship Type A/B:   %s / %s\n\n" + RULE + "\n",
        na("Name_A"),
        F.col("MMSI_A").cast("string"),
        na("Name_B"),
        F.col("MMSI_B").cast("string"),
        F.col("first_ts").cast("string"),
        fixed("Lat_A", 6),
        fixed("Lon_A", 6),
        fixed("vessel_distance_nm", 1, METRES_PER_NM),
        fixed("DCPA", 1, METRES_PER_NM),
        fixed("TCPA", 1, 60.0),
        fixed("SOG_A", 1),
        fixed("SOG_B", 1),
        na("ShipType_A"),
        na("ShipType_B"),
    )
    return events.select("MMSI_A", "MMSI_B", "first_ts", text.alias("report"))


# --- M3 / M8 ------------------------------------------------------------------
def event_bearings(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M3/M8: bearing from A to B, bearing relative to A's heading, encounter
    class (head-on / overtaking / crossing) and the display text."""
    brg = initial_bearing_deg("Lat_A", "Lon_A", "Lat_B", "Lon_B")
    out = events.select("MMSI_A", "MMSI_B", "first_ts", "HDG_A", brg.alias("bearing_deg"))
    out = out.withColumn("relative_bearing_deg", relative_bearing_deg("bearing_deg", "HDG_A"))
    return out.withColumn("encounter", encounter_class("relative_bearing_deg", p)).withColumn(
        "scenario", bearing_text("relative_bearing_deg", "HDG_A")
    )


# --- A5 -----------------------------------------------------------------------
def stage_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """A5: ``stage, stage_order, row_count`` of a run's counts, in the order given.

    The counts come from the jobs that made the stages (``plans.counted``), so
    no stage is read again for its number.
    """
    rows = [(name, i, n) for i, (name, n) in enumerate(counts.items())]
    return spark.createDataFrame(rows, "stage string, stage_order int, row_count long")
