import datetime as dt

import pytest
from pyspark.sql import functions as F

from vesselflow.operators import clean as C
from vesselflow.sources import csv as S
from vesselflow.sources.fixture import raw_pings
from vesselflow.sources.schema import AIS_COLUMNS, ais_schema, validate_schema
from conftest import SF_SMALL


def test_schema_is_26_positional_nullable():
    sch = ais_schema()
    assert len(sch.fields) == 26
    assert [f.name for f in sch.fields] == list(AIS_COLUMNS)
    assert all(f.nullable for f in sch.fields)


def test_validate_schema_names_missing(spark):
    df = spark.createDataFrame([(1, 2.0)], "MMSI long, SOG double")
    with pytest.raises(ValueError, match="Latitude"):
        validate_schema(df)
    full = spark.createDataFrame([], ais_schema())
    assert validate_schema(full) is full


def test_day_path():
    assert S.day_path("/d", 3).endswith("/d/aisdk-2021-12-03.csv")
    assert S.day_path("/d/", "all") == "/d/aisdk-2021-12-*.csv"
    with pytest.raises(ValueError):
        S.day_path("/d", 40)


def test_csv_roundtrip_and_parse(spark, tmp_path):
    raw = raw_pings(spark, SF_SMALL, as_text=True)
    S.write_pings_csv(raw, S.day_path(str(tmp_path), 13))
    back = S.load_pings(spark, str(tmp_path), "13")
    assert back.columns == list(AIS_COLUMNS)
    assert back.count() == 1000
    parsed = C.parse_timestamp(back)
    first = parsed.agg(F.min("Timestamp")).first()[0]
    assert first == dt.datetime(2021, 12, 13, 0, 0, 1)


def test_permissive_bad_values_become_null(spark, tmp_path):
    p = tmp_path / "aisdk-2021-12-01.csv"
    header = ",".join(["# Timestamp"] + list(AIS_COLUMNS[1:]))
    row = ["01/12/2021 00:00:01", "Class A", "abc", " 55.2 ", "14.2"] + [""] * 21
    bad_ts = ["31/02/2021 00:00:01", "Class A", "219000001", "55.2", "14.2"] + [""] * 21
    p.write_text(header + "\n" + ",".join(row) + "\n" + ",".join(bad_ts) + "\n")
    df = S.load_pings(spark, str(tmp_path), 1)
    rows = df.orderBy("Timestamp").collect()
    assert rows[0]["MMSI"] is None and rows[0]["Latitude"] == 55.2
    # the impossible date is dropped by C1 instead of failing under ANSI mode
    assert C.parse_timestamp(df).count() == 1


def test_all_days_glob_reads_every_day_file(spark, tmp_path):
    header = ",".join(["# Timestamp"] + list(AIS_COLUMNS[1:]))
    for day in (1, 2, 13):
        row = [f"{day:02d}/12/2021 00:00:01", "Class A", "219000001", "55.2", "14.2"] + [""] * 21
        (tmp_path / f"aisdk-2021-12-{day:02d}.csv").write_text(header + "\n" + ",".join(row) + "\n")
    (tmp_path / "other.csv").write_text(header + "\n")
    assert S.load_pings(spark, str(tmp_path), "all").count() == 3
    assert S.load_pings(spark, str(tmp_path), 2).count() == 1
