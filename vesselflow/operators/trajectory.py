"""Event trajectories (+/- window around each event), their geometry and
end points, and the event selection the map step uses (priority pairs, else
the closest pairs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesselflow.operators.index import HOUR, hour_bucket, window_bucket
from vesselflow.operators.sequence import with_previous
from vesselflow.operators.skew import largest_group, split_join
from vesselflow.params import DEFAULT, Params

EVENT_KEY = ["MMSI_A", "MMSI_B", "event_ts"]
TRAJ_COLUMNS = ["MMSI", "Name", "Timestamp", "Latitude", "Longitude", "SOG", "COG"]


# --- T2 -----------------------------------------------------------------------
def closest_pairs(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The ``top_k`` pairs with the smallest distance, one event per pair.

    One row per pair is taken by a partial ``min(struct)`` aggregate; the
    top-k is a ``TakeOrderedAndProject`` (per-partition top-k, then merge).
    Ties broken by the pair ids.
    """
    rest = [c for c in events.columns if c not in ("MMSI_A", "MMSI_B", "vessel_distance_nm")]
    one = events.groupBy("MMSI_A", "MMSI_B").agg(
        F.min(F.struct(F.col("vessel_distance_nm"), *[F.col(c) for c in rest])).alias("_e")
    )
    one = one.select("MMSI_A", "MMSI_B", "_e.*").select(*events.columns)
    return one.orderBy("vessel_distance_nm", "MMSI_A", "MMSI_B").limit(p.top_k)


# --- F3 -----------------------------------------------------------------------
def priority_events(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """the events of the configured priority pairs (either MMSI order),
    one per pair (smallest distance); if none is present, the ``top_k``
    closest pairs instead. The fallback is decided lazily (EXISTS subquery).

    The pair list is a fixed parameter of a few rows, so it is broadcast.
    """
    spark = events.sparkSession
    wanted = spark.createDataFrame(
        [(min(a, b), max(a, b)) for a, b in p.priority_pairs], "lo long, hi long"
    )
    keyed = events.withColumn("_lo", F.least("MMSI_A", "MMSI_B")).withColumn("_hi", F.greatest("MMSI_A", "MMSI_B"))
    hit = keyed.join(F.broadcast(wanted), (keyed["_lo"] == wanted["lo"]) & (keyed["_hi"] == wanted["hi"]), "left_semi")
    hit = hit.drop("_lo", "_hi")
    rest = [c for c in events.columns if c not in ("MMSI_A", "MMSI_B", "vessel_distance_nm")]
    hit = (
        hit.groupBy("MMSI_A", "MMSI_B")
        .agg(F.min(F.struct(F.col("vessel_distance_nm"), *[F.col(c) for c in rest])).alias("_e"))
        .select("MMSI_A", "MMSI_B", "_e.*")
        .select(*events.columns)
    )
    fallback = closest_pairs(events, p).filter(~hit.exists())
    return hit.unionByName(fallback)


# --- J7 / E2 --------------------------------------------------------------------
def event_trajectories(events: DataFrame, clean: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Pings of both vessels within +/- ``trajectory_half_window_min``
    minutes (inclusive) of each event's ``first_ts``, for all events at once.

    Overlapping windows of a vessel are merged first (``track_islands``), and
    each ping meets its one island or goes (``island_pings``); only those are
    expanded to the events: (vessel side, MMSI, time slot) for the slots a
    window touches (slot width = half window, so at most 3), then the exact
    range test. Where a vessel's slot has more than ``p.flood_rows`` pings, the
    joins split it in blocks. Output: ``MMSI_A, MMSI_B, event_ts, vessel``
    (A/B) and the ping columns. Runs a job for the largest slot, and reads both
    inputs several times: pass stored tables.
    """
    width, half = p.trajectory_half_window_min, _half_window(p)
    ev = _sides(events).withColumn("_slot", _slots(F.col("event_ts") - half, F.col("event_ts") + half, width))
    pings = island_pings(track_islands(events, p), clean, p)
    j = _slot_join(pings, ev, clean, p).filter(F.col("Timestamp").between(F.col("event_ts") - half, F.col("event_ts") + half))
    return j.select(*EVENT_KEY, "vessel", *TRAJ_COLUMNS)


def _half_window(p: Params) -> Column:
    return F.expr(f"INTERVAL {int(p.trajectory_half_window_min)} MINUTES")


def _slots(lo: Column, hi: Column, width: int) -> Column:
    """A row for each time slot from ``lo`` to ``hi``."""
    return F.explode(F.sequence(window_bucket(lo, width), window_bucket(hi, width)))


def _sides(events: DataFrame) -> DataFrame:
    """The events' keys, one row for each of the two vessels."""
    side = lambda s: F.struct(F.lit(s).alias("vessel"), F.col(f"MMSI_{s}").alias("MMSI"))
    both = events.select("MMSI_A", "MMSI_B", F.col("first_ts").alias("event_ts"), F.explode(F.array(side("A"), side("B"))).alias("_s"))
    return both.select(*EVENT_KEY, "_s.vessel", "_s.MMSI")


def _slot_join(pings: DataFrame, others: DataFrame, clean: DataFrame, p: Params) -> DataFrame:
    """The join on (MMSI, time slot); flooded slots of ``clean`` are split."""
    keys = ["MMSI", "_slot"]
    slots = clean.select("MMSI", window_bucket("Timestamp", p.trajectory_half_window_min).alias("_slot"))
    if largest_group(slots, keys) > p.flood_rows:
        return split_join(pings, others, keys, p.flood_rows)
    return pings.join(others, keys, "inner")


def track_islands(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``MMSI, island_lo, island_hi``: the union of each vessel's windows as disjoint intervals.

    Windows that start in the same slot overlap, since a slot is half as wide as a window: a partial aggregate merges
    them first, so what is sorted for a vessel is bounded by the time span, not by its events.
    """
    half = _half_window(p)
    windows = _sides(events).select("MMSI", (F.col("event_ts") - half).alias("lo"), (F.col("event_ts") + half).alias("hi"))
    windows = windows.groupBy("MMSI", window_bucket("lo", p.trajectory_half_window_min).alias("_slot")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    along = Window.partitionBy("MMSI").orderBy("_slot")
    reached = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    starts = windows.withColumn("_new", F.when(F.col("lo") <= reached, 0).otherwise(1))
    numbered = starts.withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("MMSI", "_island").agg(F.min("lo").alias("island_lo"), F.max("hi").alias("island_hi")).drop("_island")


def island_pings(islands: DataFrame, clean: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The pings inside an island, each once, with their time slot."""
    width = p.trajectory_half_window_min
    cover = islands.withColumn("_slot", _slots(F.col("island_lo"), F.col("island_hi"), width))
    pings = clean.select(*TRAJ_COLUMNS).withColumn("_slot", window_bucket("Timestamp", width))
    inside = F.col("Timestamp").between(F.col("island_lo"), F.col("island_hi"))
    return _slot_join(pings, cover, clean, p).filter(inside).select(*TRAJ_COLUMNS, "_slot")


# --- T3 -----------------------------------------------------------------------
def ordered_tracks(traj: DataFrame) -> DataFrame:
    """Tracks in time order, each (event, vessel) track whole in one
    partition and sorted inside it (no global sort; a track is bounded by its
    +/- window). Writers and per-partition consumers then see every track as
    one ordered run of rows."""
    keys = EVENT_KEY + ["vessel"]
    return traj.repartition(*keys).sortWithinPartitions(*keys, "Timestamp", "Latitude", "Longitude")


def numbered_tracks(traj: DataFrame) -> DataFrame:
    """T3 with the place of each ping in its track (``seq``, from 1)."""
    keys = EVENT_KEY + ["vessel"]
    w = Window.partitionBy(*keys).orderBy("Timestamp", "Latitude", "Longitude", "SOG", "COG")
    return traj.withColumn("seq", F.row_number().over(w))


# --- E3 -----------------------------------------------------------------------
def trajectory_segments(traj: DataFrame) -> DataFrame:
    """Each track as ordered line segments with WKT text.

    A polyline is the chain of segments from each ping to the next one of
    the same (event, vessel); a track of one ping is one POINT row with the
    same start and end time. Segments are rows, so no track is gathered into
    one array; the previous-ping look-up is split by hour
    (``with_previous``). Reads ``traj`` more than once: pass a stored table.
    """
    keys = EVENT_KEY + ["vessel"]
    t = traj.withColumn(HOUR, hour_bucket("Timestamp"))
    t = with_previous(
        t, keys=keys, chunk=HOUR, order=["Timestamp", "Latitude", "Longitude"],
        values=["Timestamp", "Latitude", "Longitude"], prefix="from_",
    )
    single = traj.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").drop("_n")
    points = traj.join(single, keys, "left_semi").withColumns(
        {f"from_{c}": F.col(c) for c in ("Timestamp", "Latitude", "Longitude")}
    )
    at = F.format_string("POINT (%s %s)", F.col("Longitude").cast("string"), F.col("Latitude").cast("string"))
    line = F.format_string(
        "LINESTRING (%s %s, %s %s)",
        F.col("from_Longitude").cast("string"),
        F.col("from_Latitude").cast("string"),
        F.col("Longitude").cast("string"),
        F.col("Latitude").cast("string"),
    )
    t = t.filter(F.col("from_Timestamp").isNotNull()).drop(HOUR).withColumn("wkt", line)
    t = t.unionByName(points.withColumn("wkt", at))
    return t.select(
        *keys,
        "MMSI",
        F.col("from_Timestamp").alias("from_ts"),
        F.col("Timestamp").alias("to_ts"),
        "wkt",
    )


def trajectory_lines(traj: DataFrame) -> DataFrame:
    """One row for each track with its whole line as WKT, pings in time order (ties by position); a track of one
    ping is a POINT.

    The line is one value, gathered for each (event, vessel): its size is bounded by the pings that a vessel sends in
    a window. For tracks too long for one value use ``trajectory_segments``.
    """
    point = lambda x: F.concat_ws(" ", x["Longitude"].cast("string"), x["Latitude"].cast("string"))
    tracks = traj.groupBy(*EVENT_KEY, "vessel", "MMSI").agg(
        F.array_sort(F.collect_list(F.struct("Timestamp", "Latitude", "Longitude"))).alias("_points")
    )
    kind = F.when(F.size("_points") == 1, "POINT (").otherwise("LINESTRING (")
    return tracks.select(
        *EVENT_KEY,
        "vessel",
        "MMSI",
        F.size("_points").cast("long").alias("n_points"),
        F.col("_points")[0]["Timestamp"].alias("start_ts"),
        F.element_at("_points", -1)["Timestamp"].alias("end_ts"),
        F.concat(kind, F.array_join(F.transform("_points", point), ", "), F.lit(")")).alias("wkt"),
    )


# --- E4 -----------------------------------------------------------------------
def trajectory_endpoints(traj: DataFrame, events: DataFrame) -> DataFrame:
    """First and last point of each vessel's track plus the event point.

    ``min``/``max`` of ``struct(Timestamp, lat, lon)`` per (event, vessel):
    partial aggregation before the shuffle (Spark sorts for a struct buffer).
    """
    keys = EVENT_KEY + ["vessel"]
    pt = F.struct("Timestamp", "Latitude", "Longitude")
    ends = traj.groupBy(*keys, "MMSI").agg(
        F.min(pt).alias("_first"), F.max(pt).alias("_last"), F.count(F.lit(1)).alias("n_points")
    )
    ev = events.select("MMSI_A", "MMSI_B", F.col("first_ts").alias("event_ts"), F.col("Lat_A").alias("event_lat"), F.col("Lon_A").alias("event_lon"))
    return ends.join(ev, EVENT_KEY, "inner").select(
        *keys,
        "MMSI",
        "n_points",
        F.col("_first.Timestamp").alias("start_ts"),
        F.col("_first.Latitude").alias("start_lat"),
        F.col("_first.Longitude").alias("start_lon"),
        F.col("_last.Timestamp").alias("end_ts"),
        F.col("_last.Latitude").alias("end_lat"),
        F.col("_last.Longitude").alias("end_lon"),
        "event_lat",
        "event_lon",
    )
