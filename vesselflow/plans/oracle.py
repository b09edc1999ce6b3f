"""DuckDB SQL for each registered query (the correctness oracle).

The SQL is deliberately the plain, brute-force form of each step: a window
``lag`` over MMSI for the jump filter (no minute split), the original minute
x 0.5 degree self-join for pairs (no sub-grid), correlated EXISTS for the
failsafe. It runs on the driver's ``events`` view. Every literal is a DOUBLE
so both engines do the same IEEE arithmetic, and double outputs are rounded
exactly where the Spark query rounds them.
"""

from __future__ import annotations

from vesselflow.params import DEFAULT, Params
from vesselflow.sources.fixture import raw_pings_sql
from vesselflow.sources.schema import AIS_FIELDS, REQUIRED_COLUMNS

R5 = 5


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _q(name: str) -> str:
    return f'"{name}"'


def _strs(xs) -> str:
    return ", ".join("'" + s.replace("'", "''") + "'" for s in xs)


def _acos_nm(lat1: str, lon1: str, lat2: str, lon2: str, p: Params) -> str:
    arg = (
        f"sin(radians({lat1})) * sin(radians({lat2})) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * cos(radians({lon2}) - radians({lon1}))"
    )
    if p.clamp_acos:
        arg = f"least({_d(1.0)}, greatest({_d(-1.0)}, {arg}))"
    return f"(acos({arg}) * {_d(p.earth_radius_nm)})"


def _haversine_nm(lat1, lon1, lat2, lon2, p: Params) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / {_d(2.0)}), {_d(2.0)})"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / {_d(2.0)}), {_d(2.0)})"
    )
    return f"({_d(p.earth_radius_nm)} * ({_d(2.0)} * asin(sqrt({a}))))"


def _r(expr: str, digits: int = R5) -> str:
    return f"round({expr}, {digits})"


def _ais_select(alias: str = "", digits: int = R5) -> str:
    pre = f"{alias}." if alias else ""
    out = []
    for n, t in AIS_FIELDS:
        col = pre + _q(n)
        out.append(f"{_r(col, digits)} AS {_q(n)}" if repr(t) == "DoubleType()" else f"{col} AS {_q(n)}")
    return ", ".join(out)


def _pmod360(x: str) -> str:
    m = f"fmod({x}, {_d(360.0)})"
    return f"(CASE WHEN {m} < 0 THEN fmod({m} + {_d(360.0)}, {_d(360.0)}) ELSE {m} END)"


def ctes(p: Params = DEFAULT) -> list[tuple[str, str]]:
    lat_lo, lat_hi, lon_lo, lon_hi = p.box
    mmsi_range = (
        f'"MMSI" IS NOT NULL AND "MMSI" BETWEEN {p.mmsi_min} AND {p.mmsi_max}'
        + "".join(f' AND NOT ("MMSI" BETWEEN {lo} AND {hi})' for lo, hi in p.excluded_mmsi_ranges)
    )
    mmsi_ok = f'({mmsi_range} AND "MMSI" % {p.repeated_digit_mmsi} <> 0 AND "MMSI" <> {p.test_mmsi})'
    port = " AND ".join(
        f'NOT ("Latitude" BETWEEN {_d(la)} AND {_d(lb)} AND "Longitude" BETWEEN {_d(oa)} AND {_d(ob)})'
        for _, la, lb, oa, ob in p.port_zones
    )
    hours = 'CAST(date_diff(\'second\', prev_ts, "Timestamp") AS DOUBLE) / CAST(3600.0 AS DOUBLE)'
    ais = ", ".join(_q(n) for n, _ in AIS_FIELDS)
    side_cols = ["MMSI", "Timestamp", "Latitude", "Longitude", "SOG", "COG", "Heading", "Name", "ShipType", "Length"]
    a_cols = ", ".join(f'a.{_q(c)} AS "{c}_A"' for c in side_cols)
    b_cols = ", ".join(f'b.{_q(c)} AS "{c}_B"' for c in side_cols)
    ve = 'SOG_B * sin(radians(COG_B)) - SOG_A * sin(radians(COG_A))'
    vn = 'SOG_B * cos(radians(COG_B)) - SOG_A * cos(radians(COG_A))'
    pe = f'(Longitude_B - Longitude_A) * {_d(p.nm_per_deg)}'
    if p.lon_scale == "cos_mid":
        pe = f"{pe} * cos(radians((Latitude_A + Latitude_B) / {_d(2.0)}))"
    pn = f'(Latitude_B - Latitude_A) * {_d(p.nm_per_deg)}'
    return [
        ("raw", raw_pings_sql()),
        ("parsed", 'SELECT * FROM raw WHERE "Timestamp" IS NOT NULL'),
        ("c3", f"SELECT * FROM parsed WHERE \"TypeOfMobile\" IN ({_strs(p.mobile_types)}) AND \"TypeOfMobile\" = '{p.vessel_class}'"),
        ("c4", f"SELECT * FROM c3 WHERE {mmsi_ok}"),
        ("c5", 'SELECT * FROM c4 WHERE "Latitude" BETWEEN -90.0 AND 90.0 AND "Longitude" BETWEEN -180.0 AND 180.0'
               ' AND "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL'),
        ("w1a", 'SELECT *, lag("Latitude") OVER w AS prev_lat, lag("Longitude") OVER w AS prev_lon,'
                ' lag("Timestamp") OVER w AS prev_ts FROM c5'
                ' WINDOW w AS (PARTITION BY "MMSI" ORDER BY "Timestamp", "Latitude", "Longitude")'),
        ("w1b", f"SELECT *, CASE WHEN {hours} > 0 THEN "
                f"{_acos_nm('prev_lat', 'prev_lon', 'Latitude', 'Longitude', p)} / ({hours}) END AS implied_speed_kn FROM w1a"),
        ("w1", f"SELECT {ais} FROM w1b WHERE implied_speed_kn IS NULL OR implied_speed_kn <= {_d(p.max_sog)}"),
        ("c6", f'SELECT * FROM w1 WHERE "Latitude" BETWEEN {_d(lat_lo)} AND {_d(lat_hi)}'
               f' AND "Longitude" BETWEEN {_d(lon_lo)} AND {_d(lon_hi)}'
               f" AND {_acos_nm(_d(p.center_lat), _d(p.center_lon), 'Latitude', 'Longitude', p)} <= {_d(p.radius_nm)}"),
        ("c7", f"SELECT * FROM c6 WHERE {port}"),
        ("c8", f'SELECT * FROM c7 WHERE "ShipType" NOT IN ({_strs(p.excluded_ship_types)})'
               ' AND "ShipType" IS NOT NULL AND "ShipType" <> \'\''),
        ("clean", f'SELECT * FROM c8 WHERE "SOG" > {_d(p.min_sog)} AND "NavigationalStatus" NOT IN ({_strs(p.stationary_statuses)})'),
        ("ib", f'SELECT *, time_bucket(INTERVAL {p.bucket_minutes} MINUTE, "Timestamp", TIMESTAMP \'1970-01-01\') AS "TimeBucket",'
               f' CAST(floor("Latitude" / {_d(p.grid_deg)}) AS BIGINT) AS glat,'
               f' CAST(floor("Longitude" / {_d(p.grid_deg)}) AS BIGINT) AS glon,'
               f' CAST(floor("Latitude" / {_d(p.fine_cell_deg)}) AS BIGINT) AS flat,'
               f' CAST(floor("Longitude" / {_d(p.fine_cell_deg)}) AS BIGINT) AS flon FROM clean'),
        ("cnt", 'SELECT "MMSI", "TimeBucket", count(*) AS n FROM ib GROUP BY "MMSI", "TimeBucket"'),
        ("cand", f'SELECT {a_cols}, {b_cols}, a."TimeBucket" AS "TimeBucket" FROM ib a JOIN ib b'
                 ' ON a."TimeBucket" = b."TimeBucket" AND a.glat = b.glat AND a.glon = b.glon AND a."MMSI" < b."MMSI"'),
        ("cpa0", f"SELECT *, {_acos_nm('Latitude_A', 'Longitude_A', 'Latitude_B', 'Longitude_B', p)} AS vessel_distance_nm,"
                 f" {ve} AS _ve, {vn} AS _vn, {pe} AS _pe, {pn} AS _pn FROM cand"),
        ("cpa1", f"SELECT *, CASE WHEN _ve * _ve + _vn * _vn > {_d(p.rel_speed_sq_floor)}"
                 f" THEN -(_pe * _ve + _pn * _vn) / (_ve * _ve + _vn * _vn) ELSE {_d(0.0)} END AS tcpa_hours FROM cpa0"),
        ("cpa", f"SELECT *, CASE WHEN _ve * _ve + _vn * _vn > {_d(p.rel_speed_sq_floor)}"
                f" THEN sqrt(pow(_pe + _ve * tcpa_hours, {_d(2.0)}) + pow(_pn + _vn * tcpa_hours, {_d(2.0)}))"
                f" ELSE vessel_distance_nm END AS dcpa FROM cpa1"),
        ("close", f"""SELECT MMSI_A, MMSI_B, Timestamp_A AS first_ts, Timestamp_A AS "Timestamp", Timestamp_B,
  "TimeBucket", Latitude_A AS Lat_A, Longitude_A AS Lon_A, Latitude_B AS Lat_B, Longitude_B AS Lon_B,
  SOG_A, SOG_B, COG_A, COG_B, Heading_A AS HDG_A, Heading_B AS HDG_B, Name_A, Name_B, ShipType_A, ShipType_B,
  CAST(Length_A AS DOUBLE) AS Length_A, CAST(Length_B AS DOUBLE) AS Length_B, vessel_distance_nm,
  tcpa_hours AS "TCPA", dcpa AS "DCPA", CAST(0 AS INTEGER) AS duration_seconds, CAST(0 AS INTEGER) AS ping_count
FROM cpa WHERE dcpa <= {_d(p.dcpa_limit_nm)} AND tcpa_hours >= {_d(p.tcpa_floor_h)} AND SOG_A > {_d(p.min_sog)}
  AND SOG_B > {_d(p.min_sog)} AND vessel_distance_nm > {_d(0.0)} AND vessel_distance_nm <= {_d(p.max_distance_nm)}"""),
        ("closen", 'SELECT e.*, ca.n AS n_a, cb.n AS n_b FROM close e'
                   ' JOIN cnt ca ON ca."MMSI" = e.MMSI_A AND ca."TimeBucket" = e."TimeBucket"'
                   ' JOIN cnt cb ON cb."MMSI" = e.MMSI_B AND cb."TimeBucket" = e."TimeBucket"'),
        ("valid", f"SELECT * EXCLUDE (n_a, n_b) FROM closen WHERE (n_a >= {p.min_pings_per_minute} AND n_b >= {p.min_pings_per_minute})"
                  f" OR NOT EXISTS (SELECT 1 FROM closen WHERE n_a >= {p.min_pings_per_minute} AND n_b >= {p.min_pings_per_minute})"),
        ("best", 'SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY MMSI_A, MMSI_B'
                 ' ORDER BY "DCPA", vessel_distance_nm, "Timestamp", Timestamp_B) AS rn FROM valid) WHERE rn = 1'),
    ]


def _with(upto: str, p: Params = DEFAULT, extra: list[tuple[str, str]] = ()) -> str:
    out = []
    for name, sql in ctes(p):
        out.append((name, sql))
        if name == upto:
            break
    out.extend(extra)
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in out) + "\n"


EVENT_COLS = [
    "MMSI_A", "MMSI_B", "first_ts", "Timestamp", "Timestamp_B", "TimeBucket", "Lat_A", "Lon_A", "Lat_B", "Lon_B",
    "SOG_A", "SOG_B", "COG_A", "COG_B", "HDG_A", "HDG_B", "Name_A", "Name_B", "ShipType_A", "ShipType_B",
    "Length_A", "Length_B", "vessel_distance_nm", "TCPA", "DCPA", "duration_seconds", "ping_count",
]
_EVENT_DOUBLES = {"Lat_A", "Lon_A", "Lat_B", "Lon_B", "SOG_A", "SOG_B", "COG_A", "COG_B", "HDG_A", "HDG_B",
                  "Length_A", "Length_B", "vessel_distance_nm", "TCPA", "DCPA"}


def _event_select(alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return ", ".join(
        f"{_r(pre + _q(c))} AS {_q(c)}" if c in _EVENT_DOUBLES else f"{pre}{_q(c)} AS {_q(c)}" for c in EVENT_COLS
    )


def _steady(pairs: str, p: Params) -> str:
    look = f"INTERVAL {int(p.lookback_min)} MINUTE"
    return f"""SELECT MMSI_A, MMSI_B,
  stddev_samp(CASE WHEN side = 'A' THEN cog END) AS cog_stddev_A,
  stddev_samp(CASE WHEN side = 'B' THEN cog END) AS cog_stddev_B
FROM (
  SELECT d.MMSI_A, d.MMSI_B, 'A' AS side, c."COG" AS cog FROM {pairs} d JOIN clean c
    ON c."MMSI" = d.MMSI_A AND c."Timestamp" < d.first_ts AND c."Timestamp" >= d.first_ts - {look}
  UNION ALL
  SELECT d.MMSI_A, d.MMSI_B, 'B' AS side, c."COG" AS cog FROM {pairs} d JOIN clean c
    ON c."MMSI" = d.MMSI_B AND c."Timestamp" < d.first_ts AND c."Timestamp" >= d.first_ts - {look}
) GROUP BY MMSI_A, MMSI_B"""


def _dur() -> str:
    return """SELECT MMSI_A, MMSI_B, min("Timestamp") AS first_ts, max("Timestamp") AS last_ts,
  count("Timestamp") AS ping_count, CAST(date_diff('second', min("Timestamp"), max("Timestamp")) AS BIGINT) AS duration_seconds,
  min(vessel_distance_nm) AS min_distance FROM valid GROUP BY MMSI_A, MMSI_B"""


def _traj(p: Params) -> str:
    half = f"INTERVAL {int(p.trajectory_half_window_min)} MINUTE"
    parts = []
    for side in ("A", "B"):
        parts.append(
            f"""SELECT e.MMSI_A, e.MMSI_B, e.first_ts AS event_ts, '{side}' AS vessel, c."MMSI", c."Name", c."Timestamp",
  c."Latitude", c."Longitude", c."SOG", c."COG" FROM best e JOIN clean c ON c."MMSI" = e.MMSI_{side}
  AND c."Timestamp" BETWEEN e.first_ts - {half} AND e.first_ts + {half}"""
        )
    return "\nUNION ALL\n".join(parts)


def oracle_sql(p: Params = DEFAULT) -> dict[str, str]:
    ais_r = _ais_select()
    lat_lo, lat_hi, lon_lo, lon_hi = p.box
    q: dict[str, str] = {}
    q["csv_roundtrip_scan"] = _with("parsed", p) + f"SELECT {ais_r} FROM parsed"
    q["clean_class_filter"] = _with("c3", p) + f"SELECT {ais_r} FROM c3"
    mmsi_range = (
        f'"MMSI" IS NOT NULL AND "MMSI" BETWEEN {p.mmsi_min} AND {p.mmsi_max}'
        + "".join(f' AND NOT ("MMSI" BETWEEN {lo} AND {hi})' for lo, hi in p.excluded_mmsi_ranges)
    )
    mmsi_ok = f'({mmsi_range} AND "MMSI" % {p.repeated_digit_mmsi} <> 0 AND "MMSI" <> {p.test_mmsi})'
    q["clean_mmsi"] = _with("parsed", p) + f"SELECT {ais_r} FROM parsed WHERE {mmsi_ok}"
    q["mmsi_flags"] = _with("parsed", p) + (
        f'SELECT "MMSI", "Timestamp", coalesce({mmsi_range}, false) AS mmsi_in_range,'
        f" coalesce({mmsi_ok}, false) AS mmsi_valid FROM parsed"
    )
    q["clean_coordinates"] = _with("parsed", p) + (
        f'SELECT {ais_r} FROM parsed WHERE "Latitude" BETWEEN -90.0 AND 90.0 AND "Longitude" BETWEEN -180.0 AND 180.0'
    )
    q["gps_jump_filter"] = _with("w1", p) + f"SELECT {ais_r} FROM w1"
    q["implied_speed"] = _with("w1b", p) + f'SELECT "MMSI", "Timestamp", {_r("implied_speed_kn", 3)} AS implied_speed_kn FROM w1b'
    q["region_filter"] = _with("parsed", p) + (
        f'SELECT {ais_r} FROM parsed WHERE "Latitude" BETWEEN {_d(lat_lo)} AND {_d(lat_hi)}'
        f' AND "Longitude" BETWEEN {_d(lon_lo)} AND {_d(lon_hi)}'
        f" AND {_acos_nm(_d(p.center_lat), _d(p.center_lon), 'Latitude', 'Longitude', p)} <= {_d(p.radius_nm)}"
    )
    port = " AND ".join(
        f'NOT ("Latitude" BETWEEN {_d(la)} AND {_d(lb)} AND "Longitude" BETWEEN {_d(oa)} AND {_d(ob)})'
        for _, la, lb, oa, ob in p.port_zones
    )
    q["exclusion_zones"] = _with("parsed", p) + f"SELECT {ais_r} FROM parsed WHERE {port}"
    q["ship_type_filter"] = _with("parsed", p) + (
        f'SELECT {ais_r} FROM parsed WHERE "ShipType" NOT IN ({_strs(p.excluded_ship_types)})'
        " AND \"ShipType\" IS NOT NULL AND \"ShipType\" <> ''"
    )
    q["moving_vessels"] = _with("parsed", p) + (
        f'SELECT {ais_r} FROM parsed WHERE "SOG" > {_d(p.min_sog)}'
        f' AND "NavigationalStatus" NOT IN ({_strs(p.stationary_statuses)})'
    )
    q["cleaned_pings"] = _with("clean", p) + f"SELECT {ais_r} FROM clean"
    q["minute_grid_counts"] = _with("ib", p) + (
        "SELECT \"TimeBucket\", CAST(glat AS VARCHAR) || '_' || CAST(glon AS VARCHAR) AS \"GridCell\","
        ' count(*) AS pings FROM ib GROUP BY ALL'
    )
    q["fine_cell_counts"] = _with("ib", p) + (
        "SELECT \"TimeBucket\", CAST(flat AS VARCHAR) || '_' || CAST(flon AS VARCHAR) AS \"FineCell\","
        ' count(*) AS pings FROM ib GROUP BY ALL'
    )
    q["pings_per_vessel_minute"] = _with("ib", p) + 'SELECT "MMSI", "TimeBucket", count(*) AS "count" FROM ib GROUP BY ALL'
    q["candidate_pairs_per_minute"] = _with("cand", p) + (
        'SELECT "TimeBucket", count(*) AS candidate_pairs FROM cand GROUP BY "TimeBucket"'
    )
    near = f"vessel_distance_nm > {_d(0.0)} AND vessel_distance_nm <= {_d(p.max_distance_nm)}"
    q["pair_distance"] = _with("cpa", p) + (
        f"SELECT MMSI_A, MMSI_B, Timestamp_A AS ts_A, Timestamp_B AS ts_B, {_r('vessel_distance_nm')} AS distance_acos_nm,"
        f" {_r(_haversine_nm('Latitude_A', 'Longitude_A', 'Latitude_B', 'Longitude_B', p))} AS distance_haversine_nm"
        f" FROM cpa WHERE {near}"
    )
    q["pair_tcpa_dcpa"] = _with("cpa", p) + (
        f'SELECT MMSI_A, MMSI_B, Timestamp_A AS ts_A, Timestamp_B AS ts_B, {_r("tcpa_hours")} AS "TCPA",'
        f' {_r("dcpa")} AS "DCPA" FROM cpa WHERE {near}'
    )
    q["close_events"] = _with("close", p) + f"SELECT {_event_select()} FROM close"
    q["validated_events"] = _with("valid", p) + f"SELECT {_event_select()} FROM valid"
    q["closest_event_per_pair"] = _with("best", p) + f"SELECT {_event_select()} FROM best"
    q["convoy_filters"] = _with("valid", p) + (
        f"SELECT {_event_select()} FROM valid WHERE abs(SOG_A - SOG_B) >= {_d(p.min_sog_diff)}"
        f" AND greatest(SOG_A, SOG_B) >= {_d(p.min_sog_max)} AND (MMSI_A, MMSI_B) IN ("
        f' SELECT MMSI_A, MMSI_B FROM valid GROUP BY MMSI_A, MMSI_B HAVING count(DISTINCT "TimeBucket") <= {p.max_pair_buckets})'
    )
    # fine-cell pair rules
    reject = p.fallback_reject_factor * p.dcpa_limit_nm
    dy = f"(Latitude_B - Latitude_A) * {_d(p.nm_per_deg)}"
    dx = f"(Longitude_B - Longitude_A) * {_d(p.nm_per_deg)} * cos(radians((Latitude_A + Latitude_B) / {_d(2.0)}))"
    vx1, vy1 = "SOG_A * sin(radians(COG_A))", "SOG_A * cos(radians(COG_A))"
    vx2, vy2 = "SOG_B * sin(radians(COG_B))", "SOG_B * cos(radians(COG_B))"
    if p.fallback_sign == "corrected":
        dvx, dvy = f"({vx2} - {vx1})", f"({vy2} - {vy1})"
    else:
        dvx, dvy = f"({vx1} - {vx2})", f"({vy1} - {vy2})"
    fine_extra = [
        ("fp0", f"""SELECT a."MMSI" AS MMSI_A, b."MMSI" AS MMSI_B, a."Name" AS Name_A, b."Name" AS Name_B,
  a."Latitude" AS Latitude_A, a."Longitude" AS Longitude_A, b."Latitude" AS Latitude_B, b."Longitude" AS Longitude_B,
  a."SOG" AS SOG_A, b."SOG" AS SOG_B, a."COG" AS COG_A, b."COG" AS COG_B, a."Timestamp" AS Timestamp_A,
  b."Timestamp" AS Timestamp_B, a."TimeBucket" AS "TimeBucket",
  CAST(a.flat AS VARCHAR) || '_' || CAST(a.flon AS VARCHAR) AS "FineCell"
FROM ib a JOIN ib b ON a."TimeBucket" = b."TimeBucket" AND a.flat = b.flat AND a.flon = b.flon AND a."MMSI" < b."MMSI\""""),
        ("fp1", f"SELECT *, {_haversine_nm('Latitude_A', 'Longitude_A', 'Latitude_B', 'Longitude_B', p)} AS dist,"
                f" {dx} AS dx, {dy} AS dy, {dvx} AS dvx, {dvy} AS dvy FROM fp0"),
        ("fp2", f"SELECT *, pow(dvx, {_d(2.0)}) + pow(dvy, {_d(2.0)}) AS s,"
                f" -(dx * dvx + dy * dvy) / (pow(dvx, {_d(2.0)}) + pow(dvy, {_d(2.0)})) AS t FROM fp1"
                f" WHERE NOT (dist > {_d(reject)}) AND NOT coalesce(abs(SOG_A - SOG_B) < {_d(p.min_sog_diff)}, false)"),
        ("fp3", f"SELECT *, CASE WHEN s < {_d(p.fallback_speed_sq_floor)} THEN sqrt(pow(dx, {_d(2.0)}) + pow(dy, {_d(2.0)}))"
                f" WHEN t < {_d(0.0)} THEN sqrt(pow(dx, {_d(2.0)}) + pow(dy, {_d(2.0)}))"
                f" ELSE sqrt(pow(dx + dvx * t, {_d(2.0)}) + pow(dy + dvy * t, {_d(2.0)})) END AS dcpa FROM fp2"),
    ]
    q["fine_pairs"] = _with("ib", p, fine_extra) + (
        f"SELECT MMSI_A, MMSI_B, Name_A, Name_B, {_r('Latitude_A')} AS Lat_A, {_r('Longitude_A')} AS Lon_A,"
        f" {_r('Latitude_B')} AS Lat_B, {_r('Longitude_B')} AS Lon_B, {_r('SOG_A')} AS SOG_A, {_r('SOG_B')} AS SOG_B,"
        f" {_r('COG_A')} AS COG_A, {_r('COG_B')} AS COG_B, {_r('dist')} AS \"Distance_NM\", {_r('dcpa')} AS \"DCPA_NM\","
        f' Timestamp_A AS "Timestamp", Timestamp_B, "TimeBucket", "FineCell"'
        f" FROM fp3 WHERE NOT coalesce(dcpa > {_d(p.dcpa_limit_nm)}, false)"
    )
    # verification
    dur = [("dur", _dur())]
    q["pair_duration"] = _with("valid", p, dur) + (
        f"SELECT MMSI_A, MMSI_B, first_ts, last_ts, ping_count, duration_seconds, {_r('min_distance')} AS min_distance FROM dur"
    )
    short_sql = f"SELECT * FROM dur WHERE duration_seconds <= {p.max_duration_s} AND ping_count >= {p.min_ping_count}"
    q["short_encounters"] = _with("valid", p, dur + [("short", short_sql)]) + (
        f"SELECT MMSI_A, MMSI_B, first_ts, last_ts, ping_count, duration_seconds, {_r('min_distance')} AS min_distance FROM short"
    )
    q["course_steadiness"] = _with("valid", p, dur + [("steady", _steady("dur", p))]) + (
        f"SELECT MMSI_A, MMSI_B, {_r('cog_stddev_A')} AS cog_stddev_A, {_r('cog_stddev_B')} AS cog_stddev_B FROM steady"
    )
    detail = ["Name_A", "Name_B", "ShipType_A", "ShipType_B", "Lat_A", "Lon_A", "Lat_B", "Lon_B", "SOG_A", "SOG_B",
              "COG_A", "COG_B", "HDG_A", "HDG_B", "Length_A", "Length_B", "vessel_distance_nm", "TCPA", "DCPA"]
    ver = dur + [
        ("short", short_sql),
        ("steady", _steady("short", p)),
        ("checked", f"""SELECT s.*, st.cog_stddev_A, st.cog_stddev_B,
  least(coalesce(st.cog_stddev_A, {_d(999.0)}), coalesce(st.cog_stddev_B, {_d(999.0)})) AS min_cog_stddev
FROM short s LEFT JOIN steady st ON st.MMSI_A = s.MMSI_A AND st.MMSI_B = s.MMSI_B"""),
        ("details", "SELECT DISTINCT MMSI_A, MMSI_B, " + ", ".join(_q(c) for c in detail) + " FROM valid"),
    ]
    det_sel = ", ".join(f"{_r('d.' + _q(c))} AS {_q(c)}" if c in _EVENT_DOUBLES else f"d.{_q(c)} AS {_q(c)}" for c in detail)
    q["verified_pairs"] = _with("valid", p, ver) + (
        f"SELECT c.MMSI_A, c.MMSI_B, c.first_ts, c.last_ts, c.ping_count, c.duration_seconds, {_r('c.min_distance')} AS min_distance,"
        f" {_r('c.cog_stddev_A')} AS cog_stddev_A, {_r('c.cog_stddev_B')} AS cog_stddev_B,"
        f" {_r('c.min_cog_stddev')} AS min_cog_stddev, {det_sel}"
        f" FROM checked c JOIN details d ON d.MMSI_A = c.MMSI_A AND d.MMSI_B = c.MMSI_B"
        f" WHERE c.min_cog_stddev <= {_d(p.max_cog_stddev)}"
    )
    # selection
    pairs_list = ", ".join(f"({min(a, b)}, {max(a, b)})" for a, b in p.priority_pairs)
    sel = [
        ("hit", f"SELECT * FROM best WHERE (least(MMSI_A, MMSI_B), greatest(MMSI_A, MMSI_B)) IN ({pairs_list})"),
        ("topk", f"SELECT * FROM best ORDER BY vessel_distance_nm, MMSI_A, MMSI_B LIMIT {p.top_k}"),
    ]
    q["priority_pairs"] = _with("best", p, sel) + (
        f"SELECT {_event_select()} FROM hit UNION ALL SELECT {_event_select()} FROM topk WHERE NOT EXISTS (SELECT 1 FROM hit)"
    )
    q["five_closest_pairs"] = _with("best", p, sel[1:]) + f"SELECT {_event_select()} FROM topk"
    traj = [("traj", _traj(p))]
    q["event_trajectories"] = _with("best", p, traj) + (
        'SELECT MMSI_A, MMSI_B, event_ts, vessel, "MMSI", "Name", "Timestamp", '
        + ", ".join(f"{_r(_q(c))} AS {_q(c)}" for c in ["Latitude", "Longitude", "SOG", "COG"])
        + " FROM traj"
    )
    pt = """{'ts': t."Timestamp", 'la': t."Latitude", 'lo': t."Longitude"}"""
    q["trajectory_endpoints"] = _with("best", p, traj) + f"""SELECT t.MMSI_A, t.MMSI_B, t.event_ts, t.vessel, t."MMSI",
  count(*) AS n_points, min(t."Timestamp") AS start_ts, {_r(f'min({pt}).la')} AS start_lat,
  {_r(f'min({pt}).lo')} AS start_lon, max(t."Timestamp") AS end_ts,
  {_r(f'max({pt}).la')} AS end_lat, {_r(f'max({pt}).lo')} AS end_lon,
  {_r('any_value(e.Lat_A)')} AS event_lat, {_r('any_value(e.Lon_A)')} AS event_lon
FROM traj t JOIN best e ON e.MMSI_A = t.MMSI_A AND e.MMSI_B = t.MMSI_B AND e.first_ts = t.event_ts
GROUP BY t.MMSI_A, t.MMSI_B, t.event_ts, t.vessel, t."MMSI\""""
    q["trajectory_wkt"] = _with("best", p, traj) + """SELECT MMSI_A, MMSI_B, event_ts, vessel, "MMSI", from_ts, to_ts,
  'LINESTRING (' || CAST(from_lon AS VARCHAR) || ' ' || CAST(from_lat AS VARCHAR) || ', '
  || CAST("Longitude" AS VARCHAR) || ' ' || CAST("Latitude" AS VARCHAR) || ')' AS wkt
FROM (SELECT *, "Timestamp" AS to_ts,
  lag("Timestamp") OVER w AS from_ts, lag("Latitude") OVER w AS from_lat, lag("Longitude") OVER w AS from_lon
  FROM traj WINDOW w AS (PARTITION BY MMSI_A, MMSI_B, event_ts, vessel ORDER BY "Timestamp", "Latitude", "Longitude"))
WHERE from_ts IS NOT NULL
UNION ALL
SELECT MMSI_A, MMSI_B, event_ts, vessel, any_value("MMSI"), any_value("Timestamp"), any_value("Timestamp"),
  'POINT (' || CAST(any_value("Longitude") AS VARCHAR) || ' ' || CAST(any_value("Latitude") AS VARCHAR) || ')'
FROM traj GROUP BY MMSI_A, MMSI_B, event_ts, vessel HAVING count(*) = 1"""
    q["ordered_tracks"] = _with("best", p, traj) + (
        'SELECT MMSI_A, MMSI_B, event_ts, vessel, "MMSI", "Name", "Timestamp", '
        + ", ".join(f"{_r(_q(c))} AS {_q(c)}" for c in ["Latitude", "Longitude", "SOG", "COG"])
        + ', CAST(row_number() OVER (PARTITION BY MMSI_A, MMSI_B, event_ts, vessel'
        ' ORDER BY "Timestamp", "Latitude", "Longitude", "SOG", "COG") AS INTEGER) AS seq FROM traj'
    )
    q["unvalidated_closest_event_per_pair"] = _with("close", p) + (
        f'SELECT {_event_select()} FROM (SELECT *, row_number() OVER (PARTITION BY MMSI_A, MMSI_B'
        ' ORDER BY "DCPA", vessel_distance_nm, "Timestamp", Timestamp_B) AS rn FROM close) WHERE rn = 1'
    )
    # bearings and reports
    x = "sin(radians(Lon_B - Lon_A)) * cos(radians(Lat_B))"
    y = "cos(radians(Lat_A)) * sin(radians(Lat_B)) - sin(radians(Lat_A)) * cos(radians(Lat_B)) * cos(radians(Lon_B - Lon_A))"
    brg = _pmod360(f"degrees(atan2({x}, {y})) + {_d(360.0)}")
    rel = _pmod360("bearing_deg - HDG_A")
    bear = [
        ("b0", f"SELECT MMSI_A, MMSI_B, first_ts, HDG_A, {brg} AS bearing_deg FROM best"),
        ("b1", f"SELECT *, {rel} AS relative_bearing_deg FROM b0"),
    ]
    q["event_bearings"] = _with("best", p, bear) + f"""SELECT MMSI_A, MMSI_B, first_ts, {_r('HDG_A', 3)} AS HDG_A,
  {_r('bearing_deg', 3)} AS bearing_deg, {_r('relative_bearing_deg', 3)} AS relative_bearing_deg,
  CASE WHEN relative_bearing_deg IS NULL THEN NULL
       WHEN relative_bearing_deg < {_d(p.headon_deg)} OR relative_bearing_deg > {_d(360.0 - p.headon_deg)} THEN 'head-on'
       WHEN relative_bearing_deg BETWEEN {_d(p.overtaking_min_deg)} AND {_d(p.overtaking_max_deg)} THEN 'overtaking'
       ELSE 'crossing' END AS encounter,
  CASE WHEN HDG_A IS NULL THEN 'Unknown (missing heading)' ELSE printf('relative bearing %.1f°', relative_bearing_deg) END AS scenario
FROM b1"""
    q["result_table"] = _with("best", p) + (
        f"SELECT MMSI_A, MMSI_B, Name_A, Name_B, first_ts, {_r('Lat_A')} AS Lat_A, {_r('Lon_A')} AS Lon_A,"
        f" {_r('vessel_distance_nm')} AS vessel_distance_nm,"
        f" {_r(_r('vessel_distance_nm * CAST(1852.0 AS DOUBLE)', 1))} AS distance_m FROM best"
    )
    rule = "─" * 70

    fixed = lambda x, n: f"printf('%.{n}f', coalesce({x}, {_d(0.0)}))"
    metres = lambda x: fixed(f"{x} * {_d(1852.0)}", 1)
    lines = [
        "chr(10) || '" + rule + "' || chr(10) || 'COLLISION EVENT DETAILS' || chr(10) || '" + rule + "' || chr(10)",
        "'Vessel A:        ' || coalesce(Name_A, 'N/A') || ' (MMSI: ' || MMSI_A || ')' || chr(10)",
        "'Vessel B:        ' || coalesce(Name_B, 'N/A') || ' (MMSI: ' || MMSI_B || ')' || chr(10)",
        "'Timestamp:       ' || strftime(first_ts, '%Y-%m-%d %H:%M:%S') || ' UTC' || chr(10)",
        f"'Location:        ' || {fixed('Lat_A', 6)} || '°N, ' || {fixed('Lon_A', 6)} || '°E' || chr(10)",
        f"'Distance:        ' || {metres('vessel_distance_nm')} || ' meters' || chr(10)",
        f"'DCPA:            ' || {metres('"DCPA"')} || ' meters' || chr(10)",
        f"'TCPA:            ' || {fixed(f'"TCPA" * {_d(60.0)}', 1)} || ' minutes' || chr(10)",
        f"'SOG A / B:       ' || {fixed('SOG_A', 1)} || ' / ' || {fixed('SOG_B', 1)} || ' knots' || chr(10)",
        "'Ship Type A/B:   ' || coalesce(ShipType_A, 'N/A') || ' / ' || coalesce(ShipType_B, 'N/A') || chr(10)",
        "chr(10) || '" + rule + "' || chr(10)",
    ]
    q["event_report_text"] = _with("best", p) + "SELECT MMSI_A, MMSI_B, first_ts, " + " || ".join(lines) + " AS report FROM best"
    q["stage_counts"] = _with("best", p) + """SELECT * FROM (VALUES
  ('raw', 0, (SELECT count(*) FROM raw)), ('clean', 1, (SELECT count(*) FROM clean)),
  ('candidates', 2, (SELECT count(*) FROM cand)), ('close', 3, (SELECT count(*) FROM close)),
  ('validated', 4, (SELECT count(*) FROM valid)), ('final', 5, (SELECT count(*) FROM best))
) AS t(stage, stage_order, row_count)"""
    q["fixed_decimal_text"] = _with("raw", p) + (
        'SELECT "MMSI", '
        + ", ".join(
            f"CASE WHEN {_q(c)} IS NOT NULL THEN printf('%.{n}f', {_q(c)}) END AS {c.lower()}_{n}"
            for c in ("Latitude", "Longitude", "SOG", "COG")
            for n in (1, 2, 6)
        )
        + " FROM raw"
    )
    q["track_lines"] = _with("best", p, traj) + """SELECT MMSI_A, MMSI_B, event_ts, vessel, "MMSI", count(*) AS n_points,
  min("Timestamp") AS start_ts, max("Timestamp") AS end_ts,
  CASE WHEN count(*) = 1 THEN 'POINT (' ELSE 'LINESTRING (' END
  || string_agg(CAST("Longitude" AS VARCHAR) || ' ' || CAST("Latitude" AS VARCHAR), ', ' ORDER BY "Timestamp", "Latitude", "Longitude") || ')' AS wkt
FROM traj GROUP BY MMSI_A, MMSI_B, event_ts, vessel, "MMSI\""""
    half = f"INTERVAL {int(p.trajectory_half_window_min)} MINUTE"
    q["track_islands"] = _with("valid", p) + f"""SELECT "MMSI", min(lo) AS island_lo, max(hi) AS island_hi FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY "MMSI" ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY "MMSI" ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
    FROM (SELECT MMSI_A AS "MMSI", first_ts - {half} AS lo, first_ts + {half} AS hi FROM valid
          UNION SELECT MMSI_B, first_ts - {half}, first_ts + {half} FROM valid)))
GROUP BY "MMSI", island"""
    five = p.with_(bucket_minutes=5)
    q["five_minute_counts"] = _with("cand", five) + (
        'SELECT "TimeBucket", vessels, pings, coalesce(candidate_pairs, 0) AS candidate_pairs FROM'
        ' (SELECT "TimeBucket", count(DISTINCT "MMSI") AS vessels, count(*) AS pings FROM ib GROUP BY "TimeBucket")'
        ' LEFT JOIN (SELECT "TimeBucket", count(*) AS candidate_pairs FROM cand GROUP BY "TimeBucket") USING ("TimeBucket")'
    )
    q["five_minute_events"] = _with("best", five) + f"SELECT {_event_select()} FROM best"
    q["many_exclusion_zones"] = _with("parsed", p) + (
        f'SELECT "MMSI", "Timestamp", {_r(_q("Latitude"))} AS "Latitude", {_r(_q("Longitude"))} AS "Longitude" FROM parsed'
        " WHERE \"Latitude\" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM range(10000) z(k) WHERE"
        f' "Latitude" BETWEEN {_d(55.0)} + (k // 100) * {_d(0.009)} AND {_d(55.004)} + (k // 100) * {_d(0.009)}'
        f' AND "Longitude" BETWEEN {_d(14.0)} + (k % 100) * {_d(0.007)} AND {_d(14.003)} + (k % 100) * {_d(0.007)} + (k % 5) * {_d(0.001)})'
    )
    q["events_by_day"] = _with("valid", p) + (
        f"SELECT {_event_select()}, strftime(first_ts, '%Y-%m-%d') AS day, CAST(hour(first_ts) AS INTEGER) AS hour FROM valid"
    )
    q["required_columns"] = _with("raw", p) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS name, {'false' if c == 'Heading' else 'true'} AS present, "
        f"{0 if c == 'Heading' else f'(SELECT count({_q(c)}) FROM raw)'}::BIGINT AS n_values"
        for c in sorted(REQUIRED_COLUMNS)
    )
    place = ", ".join(f"c.{_q(c)} NULLS FIRST" for c in ["Lat_A", "Lon_A", "Lat_B", "Lon_B", "SOG_A", "SOG_B", "COG_A", "COG_B", "HDG_A", "HDG_B"])
    q["verified_by_distance"] = _with("valid", p, [*ver, ("rows_", f"SELECT d.* FROM checked c JOIN details d ON d.MMSI_A = c.MMSI_A AND d.MMSI_B = c.MMSI_B WHERE c.min_cog_stddev <= {_d(p.max_cog_stddev)}")]) + (
        f'SELECT MMSI_A, MMSI_B, {_r("vessel_distance_nm")} AS vessel_distance_nm, {_r(_q("DCPA"))} AS "DCPA",'
        f' row_number() OVER (ORDER BY c.vessel_distance_nm, c.MMSI_A, c.MMSI_B, c."DCPA", {place}) AS rank FROM rows_ c'
    )
    return q
