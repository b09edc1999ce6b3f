"""AIS-shaped pings derived from the driver's ``events`` table.

No driver table holds ship positions, so the test input is a pure projection
of ``events``: 16 vessels (``event_id % 16``) for each 1000 events, one ping
per second overall (some at the time of the vessel's ping before) from 2021-12-13 00:00:00, triangle-wave tracks and planted faults (other
mobile classes, bad MMSIs, out-of-range latitude, position jumps, an
out-of-region vessel, a vessel in a port zone, excluded ship types, anchored
and NULL statuses, slow speeds, NULL course and heading, vessels crossing a
grid-cell edge). Its size grows with ``events``.

``RAW_PINGS_SQL`` is the same table in DuckDB SQL for the oracle queries;
every literal there is cast to DOUBLE so both engines run the same IEEE
arithmetic.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vesselflow.params import DEFAULT, PRIORITY_PAIRS, Params
from vesselflow.plans.checkpoint import path_exists, stage_dir
from vesselflow.sources.schema import AIS_FIELDS

START = "2021-12-13 00:00:00"
N_VESSELS = 16
#: Every so many events 16 other vessels sail, so vessels and pairs grow with the table.
EPOCH = 1000
#: Events without a readable time.
BAD_TIME = 997


def _first_pair(v: str) -> str:
    """Two vessels of the first epoch carry the ids of the first priority pair."""
    a, b = PRIORITY_PAIRS[0]
    return f"WHEN event_id < {EPOCH} AND {v} = 1 THEN {a} WHEN event_id < {EPOCH} AND {v} = 3 THEN {b}"


EVENTS_READ_SCHEMA = "event_id BIGINT, value DOUBLE, props STRING"


def _spark_exprs(p: Params, as_text: bool) -> dict[str, str]:
    """Spark SQL expressions for the given columns (doubles as ``D`` literals)."""
    v = "(event_id % 16)"
    lat = (
        f"CASE WHEN {v} = 13 THEN 56.5D WHEN {v} = 12 THEN 55.55D ELSE 55.2D END"
        f" + 0.02D * abs(((event_id + 97.0D * {v}) / (600.0D + 37.0D * {v})) % 2.0D - 1.0D)"
    )
    lon = (
        f"CASE WHEN {v} = 12 THEN 13.06D WHEN {v} BETWEEN 7 AND 11 THEN 14.49D ELSE 14.24D END"
        f" + 0.02D * abs(((event_id + 31.0D * {v}) / (450.0D + 53.0D * {v})) % 2.0D - 1.0D)"
    )
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    ts = f"timestampadd(SECOND, event_id - CASE WHEN event_id % 37 = 0 THEN 16 ELSE 0 END, TIMESTAMP_NTZ'{START}')"
    bad = f"event_id % {BAD_TIME} = 0"
    fmt = p.ts_format.replace("'", "''")
    return {
        "Timestamp": f"CASE WHEN {bad} THEN 'no time' ELSE date_format({ts}, '{fmt}') END" if as_text else f"CASE WHEN NOT ({bad}) THEN {ts} END",
        "TypeOfMobile": "CASE WHEN event_id % 29 = 0 THEN 'Class B' WHEN event_id % 31 = 0 THEN 'Base Station' ELSE 'Class A' END",
        "MMSI": f"CASE WHEN event_id % 101 = 0 THEN 111000000 + {v} WHEN event_id % 103 = 0 THEN 222222222"
        f" WHEN event_id % 107 = 0 THEN 123456789 WHEN event_id % 109 = 0 THEN NULL"
        f" {_first_pair(v)} ELSE 219000000 + {v} + {N_VESSELS} * (event_id DIV {EPOCH}) END",
        "Latitude": f"CASE WHEN event_id % 113 = 0 THEN 91.0D ELSE ({lat}) + CASE WHEN event_id % 61 = 0 THEN 0.3D ELSE 0.0D END END",
        "Longitude": f"({lon})",
        "NavigationalStatus": "CASE WHEN event_id % 41 = 0 THEN 'At anchor' WHEN event_id % 43 = 0 THEN NULL ELSE 'Under way using engine' END",
        "SOG": "CASE WHEN event_id % 47 = 0 THEN 0.5D ELSE 2.0D + value * 0.05D END",
        "COG": f"CASE WHEN event_id % 53 = 0 THEN NULL WHEN {v} % 3 = 0 THEN 40.0D + {k} * 0.02D ELSE {k} * 3.6D END",
        "Heading": f"CASE WHEN event_id % 59 = 0 THEN NULL ELSE {k} * 3.6D END",
        "Name": f"concat('VESSEL ', CAST({v} AS STRING))",
        "ShipType": f"CASE WHEN {v} = 15 THEN 'Pilot' WHEN {v} = 14 THEN NULL ELSE 'Cargo' END",
    }


def raw_pings(spark: SparkSession, sf_dir: str, p: Params = DEFAULT, as_text: bool = False) -> DataFrame:
    """The 26-column raw ping table. ``Timestamp`` is TIMESTAMP_NTZ, as a
    typed (Parquet) AIS source delivers it; ``as_text=True`` gives the CSV
    text form instead. One projection over ``events`` (read with a fixed
    schema, so no footer inference)."""
    ev = spark.read.schema(EVENTS_READ_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    given = _spark_exprs(p, as_text)
    out = []
    for n, t in AIS_FIELDS:
        if n == "Timestamp":
            out.append(f"{given[n]} AS `{n}`")
        else:
            out.append(f"CAST({given.get(n, 'NULL')} AS {t.simpleString()}) AS `{n}`")
    return ev.selectExpr(*out)


_STORED: dict[tuple[str, str, str], str] = {}


def stored_pings(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """``raw_pings`` as an AIS table usually lies: stored as Parquet. Written once for a session and input folder, below the
    shared folder, so queries filter and prune a scan and don't carry the fixture's long expressions into their predicates.
    As many files as the session runs tasks at once, since ``events`` is a single row group at the small sizes."""
    at = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), stage_dir(spark))
    path = _STORED.get(at)
    if not path or not path_exists(spark, path):
        path = f"{stage_dir(spark)}/pings-{uuid.uuid4().hex}"
        raw_pings(spark, sf_dir, p).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
        _STORED[at] = path
    types = {"StringType()": "STRING", "LongType()": "BIGINT", "DoubleType()": "DOUBLE"}
    schema = ", ".join(f"`{n}` {'TIMESTAMP_NTZ' if n == 'Timestamp' else types[repr(t)]}" for n, t in AIS_FIELDS)
    return spark.read.schema(schema).parquet(path)


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _sql_track() -> str:
    v = "CAST(event_id % 16 AS DOUBLE)"
    e = "CAST(event_id AS DOUBLE)"
    lat = (
        f"CASE WHEN event_id % 16 = 13 THEN {_d(56.5)} WHEN event_id % 16 = 12 THEN {_d(55.55)} ELSE {_d(55.2)} END"
        f" + {_d(0.02)} * abs(fmod(({e} + {_d(97.0)} * {v}) / ({_d(600.0)} + {_d(37.0)} * {v}), {_d(2.0)}) - {_d(1.0)})"
    )
    lon = (
        f"CASE WHEN event_id % 16 = 12 THEN {_d(13.06)} WHEN event_id % 16 BETWEEN 7 AND 11 THEN {_d(14.49)} ELSE {_d(14.24)} END"
        f" + {_d(0.02)} * abs(fmod(({e} + {_d(31.0)} * {v}) / ({_d(450.0)} + {_d(53.0)} * {v}), {_d(2.0)}) - {_d(1.0)})"
    )
    return lat, lon


def raw_pings_sql() -> str:
    """DuckDB SELECT producing the same 26 columns from the ``events`` view."""
    lat, lon = _sql_track()
    k = "CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE)"
    given = {
        "Timestamp": f"CASE WHEN event_id % {BAD_TIME} <> 0 THEN TIMESTAMP '{START}' + to_seconds(event_id - CASE WHEN event_id % 37 = 0 THEN 16 ELSE 0 END) END",
        "TypeOfMobile": "CASE WHEN event_id % 29 = 0 THEN 'Class B' WHEN event_id % 31 = 0 THEN 'Base Station' ELSE 'Class A' END",
        "MMSI": "CAST(CASE WHEN event_id % 101 = 0 THEN 111000000 + event_id % 16 WHEN event_id % 103 = 0 THEN 222222222"
        " WHEN event_id % 107 = 0 THEN 123456789 WHEN event_id % 109 = 0 THEN NULL"
        f" {_first_pair('event_id % 16')} ELSE 219000000 + event_id % 16 + {N_VESSELS} * (event_id // {EPOCH}) END AS BIGINT)",
        "Latitude": f"CASE WHEN event_id % 113 = 0 THEN {_d(91.0)} ELSE ({lat}) + CASE WHEN event_id % 61 = 0 THEN {_d(0.3)} ELSE {_d(0.0)} END END",
        "Longitude": f"({lon})",
        "NavigationalStatus": "CASE WHEN event_id % 41 = 0 THEN 'At anchor' WHEN event_id % 43 = 0 THEN NULL ELSE 'Under way using engine' END",
        "SOG": f"CASE WHEN event_id % 47 = 0 THEN {_d(0.5)} ELSE {_d(2.0)} + value * {_d(0.05)} END",
        "COG": f"CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 16 % 3 = 0 THEN {_d(40.0)} + {k} * {_d(0.02)} ELSE {k} * {_d(3.6)} END",
        "Heading": f"CASE WHEN event_id % 59 = 0 THEN NULL ELSE {k} * {_d(3.6)} END",
        "Name": "'VESSEL ' || CAST(event_id % 16 AS VARCHAR)",
        "ShipType": "CASE WHEN event_id % 16 = 15 THEN 'Pilot' WHEN event_id % 16 = 14 THEN NULL ELSE 'Cargo' END",
    }
    sql_type = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "DoubleType()": "DOUBLE"}
    parts = []
    for n, t in AIS_FIELDS:
        expr = given.get(n, "NULL")
        typ = "TIMESTAMP" if n == "Timestamp" else sql_type[repr(t)]
        parts.append(f'CAST({expr} AS {typ}) AS "{n}"')
    return "SELECT " + ",\n  ".join(parts) + "\nFROM events"
