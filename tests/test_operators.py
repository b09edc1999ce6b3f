import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, crossing, ping, pings_df
from vesselflow.functions import geo
from vesselflow.operators import clean as C
from vesselflow.operators import pairs as P
from vesselflow.operators import trajectory as T
from vesselflow.operators import verify as V
from vesselflow.operators.index import minute_bucket
from vesselflow.operators.sequence import with_previous
from vesselflow.params import DEFAULT
from vesselflow.plans import detect as D
from vesselflow.plans.queries import _clean_b
from conftest import SF_MID


def test_parse_timestamp_text_bad_rows_dropped(spark):
    df = spark.createDataFrame(
        [("13/12/2021 02:27:09",), ("garbage",), ("32/12/2021 00:00:00",), (None,)], "Timestamp string"
    )
    out = C.parse_timestamp(df).collect()
    assert [r.Timestamp for r in out] == [dt.datetime(2021, 12, 13, 2, 27, 9)]


@pytest.mark.parametrize(
    "mmsi,ok,in_range",
    [
        (219000001, True, True),
        (None, False, False),
        (99999999, False, False),
        (111000005, False, False),
        (970000001, False, False),
        (222222222, False, True),
        (123456789, False, True),
        (999999999, False, False),
        (232018267, True, True),
    ],
)
def test_mmsi_rules(spark, mmsi, ok, in_range):
    df = spark.createDataFrame([(mmsi,)], "MMSI long")
    r = df.select(
        F.coalesce(C.mmsi_valid("MMSI"), F.lit(False)).alias("ok"),
        F.coalesce(C.mmsi_in_range("MMSI"), F.lit(False)).alias("rng"),
    ).first()
    assert (r.ok, r.rng) == (ok, in_range)


def test_null_status_and_type_dropped(spark):
    rows = [
        ping(219000001, 0, 55.2, 14.2),
        ping(219000002, 0, 55.2, 14.2, NavigationalStatus=None),
        ping(219000003, 0, 55.2, 14.2, ShipType=None),
        ping(219000004, 0, 55.2, 14.2, ShipType=""),
        ping(219000005, 0, 55.2, 14.2, NavigationalStatus="Moored"),
        ping(219000006, 0, 55.2, 14.2, SOG=1.0),
    ]
    df = pings_df(spark, rows)
    out = df.transform(C.filter_ship_types).transform(C.filter_moving)
    assert [r.MMSI for r in out.collect()] == [219000001]


def test_port_zone_inclusive_bounds(spark):
    rows = [ping(219000001, 0, 55.5, 12.9), ping(219000002, 0, 55.49, 12.95)]
    out = pings_df(spark, rows).transform(C.filter_port_zones)
    assert [r.MMSI for r in out.collect()] == [219000002]


def test_region_box_and_circle(spark):
    p = DEFAULT
    rows = [
        ping(1, 0, p.center_lat, p.center_lon),  # exact centre: kept (acos clamped)
        ping(2, 0, p.center_lat + 0.79, p.center_lon),  # inside both
        ping(3, 0, p.center_lat + 0.81, p.center_lon),  # outside the box
        ping(4, 0, p.center_lat + 0.7, p.center_lon + 1.1),  # in the box, beyond 50 nm
    ]
    out = pings_df(spark, rows).transform(C.filter_region)
    assert sorted(r.MMSI for r in out.collect()) == [1, 2]


def test_gps_jump_filter_semantics(spark):
    rows = [
        ping(219000001, 0, 55.2, 14.2),
        ping(219000001, 10, 55.2, 14.2),  # repeated position: speed 0, kept
        ping(219000001, 20, 55.5, 14.2),  # 18 nm in 10 s: dropped
        ping(219000001, 30, 55.2, 14.2),  # compared with the dropped raw row: also dropped
        ping(219000001, 40, 55.2001, 14.2),  # normal
        ping(219000001, 40, 55.2002, 14.2),  # same second: no speed, kept
    ]
    out = pings_df(spark, rows).transform(C.filter_gps_jumps).orderBy("Timestamp", "Latitude").collect()
    assert [(r.Timestamp - T0).seconds for r in out] == [0, 10, 40, 40]


def test_with_previous_matches_plain_lag_on_hot_key(spark):
    rng = np.random.default_rng(7)
    n = 3000
    # one vessel holds most rows, with gaps of several minutes between bursts
    secs = np.sort(rng.choice(np.arange(0, 6 * 3600), size=n, replace=False))
    keys = np.where(rng.random(n) < 0.7, 1, rng.integers(2, 6, n))
    pdf = pd.DataFrame({"k": keys, "t": [T0 + dt.timedelta(seconds=int(s)) for s in secs], "x": rng.random(n)})
    df = spark.createDataFrame(pdf, "k long, t timestamp_ntz, x double").withColumn("m", minute_bucket("t"))
    got = with_previous(df, ["k"], "m", ["t", "x"], ["x", "t"], prefix="p_")
    w = Window.partitionBy("k").orderBy("t", "x")
    want = df.select("k", "t", "x", F.lag("x").over(w).alias("p_x"), F.lag("t").over(w).alias("p_t"))
    a = got.select("k", "t", "x", "p_x", "p_t").exceptAll(want).count()
    b = want.exceptAll(got.select("k", "t", "x", "p_x", "p_t")).count()
    assert a == 0 and b == 0


def test_cpa_symmetry_and_values(spark):
    rng = np.random.default_rng(3)
    n = 200
    pdf = pd.DataFrame(
        {
            "Latitude_A": 55 + rng.random(n) * 0.01,
            "Longitude_A": 14 + rng.random(n) * 0.01,
            "Latitude_B": 55 + rng.random(n) * 0.01,
            "Longitude_B": 14 + rng.random(n) * 0.01,
            "SOG_A": rng.random(n) * 20,
            "COG_A": rng.random(n) * 360,
            "SOG_B": rng.random(n) * 20,
            "COG_B": rng.random(n) * 360,
        }
    )
    df = spark.createDataFrame(pdf)
    fwd = P.with_cpa(df).toPandas()
    swapped = df.select(*[F.col(c).alias(c[:-1] + ("B" if c.endswith("A") else "A")) for c in df.columns])
    bwd = P.with_cpa(swapped).toPandas()
    for c in ("vessel_distance_nm", "tcpa_hours", "dcpa"):
        assert np.allclose(fwd[c], bwd[c], rtol=1e-9, atol=1e-9)
    # brute force for TCPA/DCPA in numpy (flat east offset, as configured)
    r = pdf
    ve = r.SOG_B * np.sin(np.radians(r.COG_B)) - r.SOG_A * np.sin(np.radians(r.COG_A))
    vn = r.SOG_B * np.cos(np.radians(r.COG_B)) - r.SOG_A * np.cos(np.radians(r.COG_A))
    pe, pn = (r.Longitude_B - r.Longitude_A) * 60, (r.Latitude_B - r.Latitude_A) * 60
    v2 = ve * ve + vn * vn
    t = np.where(v2 > 0.01, -(pe * ve + pn * vn) / v2, 0.0)
    assert np.allclose(fwd.tcpa_hours, t, rtol=1e-9, atol=1e-12)
    d = np.where(v2 > 0.01, np.hypot(pe + ve * t, pn + vn * t), fwd.vessel_distance_nm)
    assert np.allclose(fwd.dcpa, d, rtol=1e-9, atol=1e-12)


def test_null_course_uses_distance(spark):
    df = spark.createDataFrame(
        [(55.2, 14.2, 55.2003, 14.2, 10.0, None, 12.0, 0.0)],
        "Latitude_A double, Longitude_A double, Latitude_B double, Longitude_B double,"
        " SOG_A double, COG_A double, SOG_B double, COG_B double",
    )
    r = P.with_cpa(df).first()
    assert r.tcpa_hours == 0.0 and r.dcpa == r.vessel_distance_nm


def test_subgrid_join_equals_plain_join(spark):
    clean_b = _clean_b(spark, SF_MID)
    cols = ["MMSI_A", "MMSI_B", "Timestamp_A", "Timestamp_B"]
    near = (F.col("vessel_distance_nm") > 0) & (F.col("vessel_distance_nm") <= DEFAULT.max_distance_nm)
    sub = P.with_cpa(P.candidate_pairs(clean_b, DEFAULT)).filter(near).select(*cols)
    plain = P.with_cpa(P.candidate_pairs(clean_b, DEFAULT.with_(pair_join="plain"))).filter(near).select(*cols)
    assert sub.count() == plain.count() > 0
    assert sub.exceptAll(plain).count() == 0


def test_subgrid_never_duplicates(spark):
    clean_b = _clean_b(spark, SF_MID)
    pr = P.candidate_pairs(clean_b, DEFAULT)
    dup = pr.groupBy("MMSI_A", "MMSI_B", "Timestamp_A", "Timestamp_B", "Latitude_A", "Latitude_B").count().filter("count > 1").count()
    assert dup == 0


def test_candidate_count_formula_equals_join(spark):
    clean_b = _clean_b(spark, SF_MID)
    formula = P.candidate_pair_counts(clean_b).agg(F.sum("candidate_pairs")).first()[0]
    joined = P.candidate_pairs(clean_b, DEFAULT.with_(pair_join="plain")).count()
    assert formula == joined


def _events(spark, rows):
    return spark.createDataFrame(rows, "MMSI_A long, MMSI_B long, n_pings_A long, n_pings_B long, x int")


def test_validation_failsafe(spark):
    none_ok = _events(spark, [(1, 2, 1, 5, 1), (1, 3, 3, 1, 2)])
    assert P.validate_proximity(none_ok).count() == 2
    some_ok = _events(spark, [(1, 2, 2, 5, 1), (1, 3, 3, 1, 2)])
    assert [r.x for r in P.validate_proximity(some_ok).collect()] == [1]


def test_best_event_tie_break(spark):
    ev = spark.createDataFrame(
        [(1, 2, 0.01, 0.05, T0, T0, "a"), (1, 2, 0.01, 0.04, T0, T0, "b"), (1, 2, 0.02, 0.01, T0, T0, "c")],
        "MMSI_A long, MMSI_B long, DCPA double, vessel_distance_nm double, Timestamp timestamp_ntz,"
        " Timestamp_B timestamp_ntz, tag string",
    )
    assert P.best_event_per_pair(ev).first().tag == "b"


def test_known_crossing_detected_and_prioritised(spark):
    raw = pings_df(spark, crossing())
    events = D.detect_from_raw(raw)
    assert tuple(events.columns) == P.EVENT_COLUMNS
    rows = events.collect()
    assert [(r.MMSI_A, r.MMSI_B) for r in rows] == [(219021240, 232018267)]
    e = rows[0]
    # brute-force distance at the chosen pair of pings (law of cosines)
    f1, f2 = math.radians(e.Lat_A), math.radians(e.Lat_B)
    d = math.acos(
        min(1.0, math.sin(f1) * math.sin(f2) + math.cos(f1) * math.cos(f2) * math.cos(math.radians(e.Lon_B - e.Lon_A)))
    ) * DEFAULT.earth_radius_nm
    assert abs(d - e.vessel_distance_nm) < 1e-9
    assert e.DCPA <= DEFAULT.dcpa_limit_nm and e.vessel_distance_nm <= DEFAULT.max_distance_nm
    pri = T.priority_events(events).collect()
    assert [(r.MMSI_A, r.MMSI_B) for r in pri] == [(219021240, 232018267)]


def test_trajectory_window_inclusive(spark):
    rows = [ping(219000001, s, 55.2 + s * 1e-6, 14.2) for s in (0, 60, 600, 1200, 1201)]
    rows += [ping(219000002, 600, 55.2, 14.2001)]
    clean = C.parse_timestamp(pings_df(spark, rows))
    ev = spark.createDataFrame(
        [(219000001, 219000002, T0 + dt.timedelta(seconds=600), 55.2, 14.2)],
        "MMSI_A long, MMSI_B long, first_ts timestamp_ntz, Lat_A double, Lon_A double",
    )
    tr = T.event_trajectories(ev, clean)
    a = sorted((r.Timestamp - T0).seconds for r in tr.filter("vessel = 'A'").collect())
    assert a == [0, 60, 600, 1200]
    ends = T.trajectory_endpoints(tr, ev).filter("vessel = 'A'").first()
    assert ends.n_points == 4 and (ends.end_ts - T0).seconds == 1200
    segs = T.trajectory_segments(tr).filter("vessel = 'A'").count()
    assert segs == 3
    # Within each partition every track is one time-ordered run
    runs = T.ordered_tracks(tr).rdd.glom().collect()
    for part in runs:
        for a, b in zip(part, part[1:]):
            if (a.vessel, a.MMSI) == (b.vessel, b.MMSI):
                assert a.Timestamp <= b.Timestamp


def test_verification_on_hand_made_events(spark):
    # clean pings: vessel 1 steady course, vessel 2 zig-zag, before the event
    pre = [ping(1, s, 55.2, 14.2 + s * 1e-5, COG=90.0) for s in range(0, 600, 60)]
    pre += [ping(2, s, 55.21, 14.2, COG=float(0 if (s // 60) % 2 else 90)) for s in range(0, 600, 60)]
    clean = C.parse_timestamp(pings_df(spark, pre))
    t = T0 + dt.timedelta(seconds=600)
    ev = spark.createDataFrame(
        [(1, 2, t, 0.02), (1, 2, t + dt.timedelta(seconds=20), 0.01), (1, 3, t, 0.03)],
        "MMSI_A long, MMSI_B long, Timestamp timestamp_ntz, vessel_distance_nm double",
    )
    dur = {(r.MMSI_A, r.MMSI_B): r for r in V.pair_duration(ev).collect()}
    assert dur[(1, 2)].duration_seconds == 20 and dur[(1, 2)].ping_count == 2
    short = V.short_encounters(V.pair_duration(ev)).collect()
    assert [(r.MMSI_A, r.MMSI_B) for r in short] == [(1, 2)]
    st = V.course_steadiness(V.pair_duration(ev).select("MMSI_A", "MMSI_B", "first_ts"), clean).collect()
    s12 = [r for r in st if r.MMSI_B == 2][0]
    assert s12.cog_stddev_A == 0.0 and s12.cog_stddev_B > 40


def test_fine_pair_reference_sign(spark):
    # B directly north of A, both closing head-on: corrected DCPA ~0, reference
    # sign makes time negative and keeps the current distance
    df = spark.createDataFrame([(55.2, 14.2, 55.2005, 14.2, 10.0, 0.0, 10.0, 180.0)],
                               "la double, loa double, lb double, lob double, sa double, ca double, sb double, cb double")
    from vesselflow.functions.kinematics import fine_pair_dcpa

    args = ("la", "loa", "lb", "lob", "sa", "ca", "sb", "cb")
    ref = df.select(fine_pair_dcpa(*args).alias("d")).first().d
    cor = df.select(fine_pair_dcpa(*args, p=DEFAULT.with_(fallback_sign="corrected")).alias("d")).first().d
    assert abs(ref - 0.0005 * 60) < 1e-9
    assert cor < 1e-9


def test_geo_functions(spark):
    df = spark.createDataFrame([(55.0, 14.0, 55.0, 14.01)], "a double, b double, c double, d double")
    r = df.select(
        geo.acos_distance_nm("a", "b", "c", "d").alias("acos"),
        geo.haversine_distance_nm("a", "b", "c", "d").alias("hav"),
        geo.initial_bearing_deg("a", "b", "c", "d").alias("brg"),
    ).first()
    assert abs(r.acos - r.hav) < 1e-6
    assert 89.0 < r.brg < 90.0


def test_lon_scale_option_changes_only_east_offset(spark):
    # B due east of A: flat scale overstates the east offset by 1/cos(lat)
    df = spark.createDataFrame(
        [(55.2, 14.2, 55.2, 14.2005, 10.0, 0.0, 10.0, 0.0)],
        "Latitude_A double, Longitude_A double, Latitude_B double, Longitude_B double,"
        " SOG_A double, COG_A double, SOG_B double, COG_B double",
    )
    flat = P.with_cpa(df).first()
    cos = P.with_cpa(df, DEFAULT.with_(lon_scale="cos_mid")).first()
    # parallel courses, equal speed: no relative motion -> DCPA = current distance
    assert flat.dcpa == cos.dcpa == flat.vessel_distance_nm
    moving = df.withColumn("SOG_B", F.lit(12.0)).withColumn("COG_B", F.lit(270.0))
    f2, c2 = P.with_cpa(moving).first(), P.with_cpa(moving, DEFAULT.with_(lon_scale="cos_mid")).first()
    ratio = f2.tcpa_hours / c2.tcpa_hours
    assert abs(ratio - 1 / math.cos(math.radians(55.2))) < 1e-9


def test_jump_filter_runs_before_region_filter(spark):
    # the second ping sits far outside the region; it is still the "previous
    # ping" of the third, whose implied speed from it is a jump
    rows = [
        ping(219000001, 0, 55.2, 14.2),
        ping(219000001, 600, 58.0, 14.2),  # outside the region, plausible over 10 min? no: 168 nm
        ping(219000001, 1200, 55.2, 14.2),
        ping(219000001, 1800, 55.201, 14.2),
    ]
    out = C.clean_pings(pings_df(spark, rows)).orderBy("Timestamp").collect()
    assert [(r.Timestamp - T0).seconds for r in out] == [0, 1800]


@pytest.mark.parametrize("lat0,lon0", [(55.5, 14.5), (74.99, 20.0), (-60.0, -0.0004)])
def test_subgrid_join_exact_on_dense_clusters(spark, lat0, lon0):
    """Many vessels packed around a 0.5 degree corner (and at high latitude,
    where longitude bins widen): the sub-grid join finds exactly the pairs the
    plain join finds within the distance limit."""
    rng = np.random.default_rng(11)
    rows = []
    for v in range(40):
        for k in range(6):
            lat = lat0 + rng.normal(0, 0.0006)
            lon = lon0 + rng.normal(0, 0.0006 / max(0.2, math.cos(math.radians(lat0))))
            rows.append((219000000 + v, T0 + dt.timedelta(seconds=int(rng.integers(0, 60))), lat, lon))
    df = spark.createDataFrame(rows, "MMSI long, Timestamp timestamp_ntz, Latitude double, Longitude double")
    df = df.withColumn("TimeBucket", minute_bucket("Timestamp")).withColumns(
        {"SOG": F.lit(5.0), "COG": F.lit(0.0), "Heading": F.lit(0.0), "Name": F.lit("x"), "ShipType": F.lit("Cargo")}
    )
    near = (F.col("vessel_distance_nm") > 0) & (F.col("vessel_distance_nm") <= DEFAULT.max_distance_nm)
    cols = ["MMSI_A", "MMSI_B", "Timestamp_A", "Timestamp_B", "Latitude_A", "Latitude_B"]
    sub = P.with_cpa(P.candidate_pairs(df, DEFAULT)).filter(near).select(*cols)
    plain = P.with_cpa(P.candidate_pairs(df, DEFAULT.with_(pair_join="plain"))).filter(near).select(*cols)
    n = plain.count()
    assert n > 50
    assert sub.count() == n
    assert sub.exceptAll(plain).count() == 0 and plain.exceptAll(sub).count() == 0


def test_report_text_layout(spark):
    from vesselflow.operators import report as R

    ev = spark.createDataFrame(
        [(219021240, 232018267, "KARIN HOEJ", "MV SCOT CARRIER", T0, 55.223427, 14.24463, 0.0291, 0.0123, 0.0371,
          12.34, 15.67, "Cargo", "Cargo")],
        "MMSI_A long, MMSI_B long, Name_A string, Name_B string, first_ts timestamp_ntz, Lat_A double,"
        " Lon_A double, vessel_distance_nm double, DCPA double, TCPA double, SOG_A double, SOG_B double,"
        " ShipType_A string, ShipType_B string",
    )
    got = R.report_text(ev).first().report
    rule = "─" * 70
    want = f"""
{rule}
COLLISION EVENT DETAILS
{rule}
Vessel A:        KARIN HOEJ (MMSI: 219021240)
Vessel B:        MV SCOT CARRIER (MMSI: 232018267)
Timestamp:       {T0} UTC
Location:        {55.223427:.6f}°N, {14.24463:.6f}°E
Distance:        {0.0291 * 1852:.1f} meters
DCPA:            {0.0123 * 1852:.1f} meters
TCPA:            {0.0371 * 60:.1f} minutes
SOG A / B:       {12.34:.1f} / {15.67:.1f} knots
Ship Type A/B:   Cargo / Cargo

{rule}
"""
    assert got == want


@pytest.mark.parametrize(
    ("name", "kept"),
    [("port_zones", 2), ("excluded_ship_types", 2), ("stationary_statuses", 2), ("excluded_mmsi_ranges", 2), ("mobile_types", 0)],
)
def test_empty_parameter_list_switches_the_filter_off(spark, name, kept):
    df = pings_df(spark, [ping(219000001, 0, 55.5, 13.0, ShipType="Pilot", NavigationalStatus="At anchor"), ping(219000002, 1, 55.2, 14.2)])
    run = {
        "port_zones": C.filter_port_zones,
        "excluded_ship_types": C.filter_ship_types,
        "stationary_statuses": C.filter_moving,
        "excluded_mmsi_ranges": C.filter_valid_mmsi,
        "mobile_types": C.filter_mobile_type,
    }[name]
    assert run(df, DEFAULT.with_(**{name: ()})).count() == kept


def test_timestamp_text_is_the_same_wall_clock_in_any_zone(spark):
    texts = ["28/03/2021 02:30:00", " 31/12/2021 23:59:59 ", "31/02/2021 00:00:00", "2021-12-13 00:00:00", "no time", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
        got = [r[0] for r in df.select(C.parse_timestamp_text(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [dt.datetime(2021, 3, 28, 2, 30), dt.datetime(2021, 12, 31, 23, 59, 59), None, None, None, None, None]


def test_jump_filter_does_not_depend_on_input_order(spark):
    rows = [ping(219000001, 59, 55.0, 14.0), ping(219000001, 59, 55.3, 14.0), ping(219000001, 3600 - 1200, 55.0, 14.0)]
    got = [
        sorted(map(str, C.with_implied_speed(pings_df(spark, some)).select("Timestamp", "Latitude", "implied_speed_kn").collect()))
        for some in (rows, rows[::-1], [rows[1], rows[2], rows[0]])
    ]
    assert got[0] == got[1] == got[2]


def test_track_of_one_ping_is_a_point(spark):
    rows = [(1, 2, T0, "A", 1, "x", T0, 55.5, 14.25, 1.0, 2.0), (1, 2, T0, "B", 2, "y", T0, 55.0, 14.0, 1.0, 2.0), (1, 2, T0, "B", 2, "y", T0 + dt.timedelta(minutes=1), 55.5, 14.0, 1.0, 2.0)]
    schema = "MMSI_A long, MMSI_B long, event_ts timestamp_ntz, vessel string, MMSI long, Name string, Timestamp timestamp_ntz, Latitude double, Longitude double, SOG double, COG double"
    got = {r["vessel"]: r["wkt"] for r in T.trajectory_segments(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"A": "POINT (14.25 55.5)", "B": "LINESTRING (14.0 55.0, 14.0 55.5)"}


def test_candidate_counts_stay_exact_integers(spark):
    df = spark.createDataFrame([(T0, 0, 0, m, n) for m, n in ((1, 3), (2, 5))], "TimeBucket timestamp_ntz, grid_lat long, grid_lon long, MMSI long, n int")
    df = df.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    assert [r["candidate_pairs"] for r in P.candidate_pair_counts(df).collect()] == [15]


def test_verified_pairs_on_hand_made_crossing(spark):
    events = D.validated_events(D.shared_clean(pings_df(spark, crossing(span=300))))
    pings = D.pings_of(D.shared_clean(pings_df(spark, crossing(span=300))))
    got = V.verified_pairs(events, pings).select("MMSI_A", "MMSI_B", "cog_stddev_A").distinct().collect()
    assert [(r[0], r[1]) for r in got] == [(219021240, 232018267)]
    assert got[0][2] == 0.0
