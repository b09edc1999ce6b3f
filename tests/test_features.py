"""Number text, zone lists, bucket widths, day sinks, column reports and observed counts."""

import collections
import datetime as dt
import math
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import T0, crossing, ping, pings_df
from vesselflow.functions.geo import bearing_text
from vesselflow.functions.numbertext import fixed_text
from vesselflow.operators import clean as C
from vesselflow.operators import pairs as P
from vesselflow.operators import report as R
from vesselflow.operators.index import minute_bucket
from vesselflow.params import DEFAULT
from vesselflow.plans import detect as D
from vesselflow.plans.queries import many_zones
from vesselflow.sources.fixture import raw_pings
from vesselflow.sources.schema import REQUIRED_COLUMNS, required_columns
from vesselflow.sources.sinks import write_days
from conftest import SF_MID, SF_SMALL

ODD_NUMBERS = [
    0.15, 0.25, 0.35, 2.675, 0.05, 0.95, 0.5, 1.5, 2.5, -0.04, -0.0, 0.0, 1e-320, 5e-324, 2.0**-53, 2.0**-54 * 3, 0.0000005, 0.0000015, 0.9999995,
    9.95, 99.95, 999999.9999995, 1 / 3, -2.675, 2.0**52 + 0.5, 2.0**53, 2.0**62, 123456789.123456789, 0.049999999999999996, 0.05000000000000001, 0.0000005000000000000001,
]


def texts(spark, values, digits):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x double")
    return [r[0] for r in rows.orderBy("k").select(fixed_text("x", digits)).collect()]


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_fixed_text_rounds_the_binary_value(spark, digits):
    assert texts(spark, ODD_NUMBERS, digits) == [f"{x:.{digits}f}" for x in ODD_NUMBERS]
    assert texts(spark, [None, math.nan, math.inf, -math.inf], digits) == [None, "nan", "inf", "-inf"]


doubles = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False, min_value=-9e18, max_value=9e18),
    st.floats(min_value=-400, max_value=400),
    st.integers(-(10**8), 10**8).map(lambda n: n / 2**7),
    st.integers(0, 10**7).map(lambda n: struct.unpack("<d", struct.pack("<q", struct.unpack("<q", struct.pack("<d", n / 10**6 + 5e-7))[0] + n % 3 - 1))[0]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(doubles, min_size=200, max_size=200))
def test_fixed_text_of_any_number(spark, values):
    for digits in (1, 6):
        assert texts(spark, values, digits) == [f"{x:.{digits}f}" for x in values]


def test_bearing_and_report_text_print_the_binary_value(spark):
    df = spark.createDataFrame([(0.25, 1.0), (0.35, 1.0), (0.15, None)], "r double, h double")
    assert [r[0] for r in df.select(bearing_text("r", "h")).collect()] == ["relative bearing 0.2°", "relative bearing 0.3°", "Unknown (missing heading)"]
    ev = spark.createDataFrame(
        [(1, 2, "A", None, T0, 55.0000005, 14.0, 0.25 / 1852.0, 0.35 / 1852.0, 0.15 / 60.0, 0.15, 2.675, "Cargo", None)],
        "MMSI_A long, MMSI_B long, Name_A string, Name_B string, first_ts timestamp_ntz, Lat_A double, Lon_A double, vessel_distance_nm double,"
        " DCPA double, TCPA double, SOG_A double, SOG_B double, ShipType_A string, ShipType_B string",
    )
    report = R.report_text(ev).first().report
    for line in (f"{55.0000005:.6f}°N", f"{0.25 / 1852.0 * 1852:.1f} meters", f"{0.35 / 1852.0 * 1852:.1f} meters", f"{0.15 / 60.0 * 60:.1f} minutes", "0.1 / 2.7 knots", "Cargo / N/A"):
        assert line in report


@pytest.mark.parametrize(
    "zones",
    [
        many_zones(),
        (("point", 55.2, 55.2, 14.2, 14.2), ("world", -90.0, 90.0, -180.0, -170.0), ("upside", 56.0, 55.0, 14.0, 15.0), ("edge", 55.0, 56.0, 14.99, 15.0)),
        DEFAULT.port_zones,
    ],
)
def test_zone_cells_equal_the_predicate(spark, zones):
    p = DEFAULT.with_(port_zones=zones)
    rows = [ping(1, 0, la, lo) for la in (-90.0, 54.999, 55.0, 55.2, 55.5, 55.7, 56.0) for lo in (-180.0, -170.0, -169.99, 12.9, 13.1, 14.0, 14.2, 14.99, 15.0)]
    rows += [ping(2, 0, z[1 + k % 2], z[3 + k // 2]) for z in zones[::97] for k in range(4)]
    df = pings_df(spark, rows).unionByName(raw_pings(spark, SF_SMALL))
    cols = ["MMSI", "Latitude", "Longitude"]
    box = np.array([z[1:] for z in zones])
    outside = lambda la, lo: not ((box[:, 0] <= la) & (la <= box[:, 1]) & (box[:, 2] <= lo) & (lo <= box[:, 3])).any()
    every = [tuple(r) for r in df.select(*cols).collect()]
    want = collections.Counter(r for r in every if outside(r[1], r[2]))
    got = collections.Counter(tuple(r) for r in C.filter_port_zones(df, p).select(*cols).collect())
    assert got == want and 0 < sum(want.values()) < len(every)
    if len(zones) < 100:
        assert collections.Counter(tuple(r) for r in df.where(C.outside_ports(p)).select(*cols).collect()) == want


@pytest.mark.parametrize("scale", [1.0, 0.05])
def test_a_cell_holds_few_of_many_small_zones(spark, scale):
    zones = tuple((name, *(scale * x for x in box)) for name, *box in many_zones())
    cells = C.zone_cells(spark, DEFAULT.with_(port_zones=zones))
    per_cell = [t.groupBy("zone_lat", "zone_lon").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first() for t in cells.values()]
    assert max(most for most, _ in per_cell) <= 100 and sum(n for _, n in per_cell) <= 4 * len(zones)


def test_zones_without_a_broadcast(spark, monkeypatch):
    df = raw_pings(spark, SF_SMALL)
    want = C.filter_port_zones(df).count()
    monkeypatch.setattr(C, "ZONE_BROADCAST", 1)
    assert C.filter_port_zones(df).count() == want < df.count()
    assert C.filter_port_zones(df, DEFAULT.with_(port_zones=())).count() == df.count()


def test_bucket_widths(spark):
    df = spark.createDataFrame([(T0.replace(minute=m, second=s, microsecond=7),) for m, s in ((0, 0), (4, 59), (5, 0), (59, 59))], "t timestamp_ntz")
    minutes = lambda n: [r[0].minute for r in df.select(minute_bucket("t", n)).collect()]
    assert minutes(1) == [0, 4, 5, 59] and minutes(5) == [0, 0, 5, 55] and minutes(60) == [0, 0, 0, 0]
    assert {(r[0].second, r[0].microsecond) for r in df.select(minute_bucket("t", 5)).collect()} == {(0, 0)}
    for bad in (7, 0, 120):
        with pytest.raises((ValueError, ZeroDivisionError)):
            minute_bucket("t", bad)


def test_bucket_width_reaches_counts_pairs_and_validation(spark):
    five = DEFAULT.with_(bucket_minutes=5)
    raw = pings_df(spark, crossing(every=50))
    one, wide = (D.shared_clean(raw, p) for p in (DEFAULT, five))
    assert one.agg(F.max("n_pings")).first()[0] == 2 and wide.agg(F.max("n_pings")).first()[0] == 6
    assert P.candidate_pair_counts(wide, five).agg(F.sum("candidate_pairs")).first()[0] == P.candidate_pairs(wide, five.with_(pair_join="plain")).count()


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "days")
    at = lambda day, n: [(day * 100 + k, dt.datetime(2021, 12, day, 5, k)) for k in range(n)]
    table = lambda rows: spark.createDataFrame(rows, "id int, first_ts timestamp_ntz")
    write_days(table(at(12, 5) + at(13, 4)), path, "first_ts")
    files = {f.name for f in (tmp_path / "days").glob("day=2021-12-12/*.parquet")}
    for _ in range(2):
        write_days(table(at(13, 2) + at(14, 1)), path, "first_ts")
        got = spark.read.parquet(path)
        assert sorted((r.id, str(r.day)) for r in got.collect()) == sorted((i, f"2021-12-{t.day}") for i, t in at(12, 5) + at(13, 2) + at(14, 1))
    assert {f.name for f in (tmp_path / "days").glob("day=2021-12-12/*.parquet")} == files
    write_days(table([]), path, "first_ts")
    assert spark.read.parquet(path).count() == 8
    write_days(table(at(12, 1)), str(tmp_path / "csv"), "first_ts", fmt="csv", unit="hour")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().hour == 5


def test_required_columns_report(spark):
    df = pings_df(spark, [ping(1, 0, 55.0, 14.0, Name=None), ping(2, 0, 55.0, 14.0)]).drop("COG")
    got = {r["name"]: (r.present, r.n_values) for r in required_columns(df).collect()}
    assert set(got) == REQUIRED_COLUMNS
    assert got["COG"] == (False, 0) and got["Name"] == (True, 1) and got["MMSI"] == (True, 2)


@pytest.mark.parametrize("p", [DEFAULT, DEFAULT.with_(flood_rows=20, flood_cell_rows=20)])
def test_observed_counts(spark, p):
    raw = raw_pings(spark, SF_MID)
    stages, counts = D.counted_stages(raw, p)
    assert list(counts) == ["raw", "clean", "candidates", "close", "validated", "final"]
    assert counts["raw"] == raw.count()
    for name, df in stages.items():
        assert counts[name] == df.count() > 0
    rows = R.stage_counts(spark, counts).collect()
    assert [(r.stage, r.stage_order, r.row_count) for r in rows] == [(n, i, counts[n]) for i, n in enumerate(counts)]
