import datetime as dt

from pyspark.sql import functions as F

from vesselflow.sources.schema import AIS_FIELDS

T0 = dt.datetime(2021, 12, 13, 2, 20, 0)

BASE = {
    "TypeOfMobile": "Class A",
    "NavigationalStatus": "Under way using engine",
    "ShipType": "Cargo",
    "SOG": 10.0,
    "COG": 90.0,
    "Heading": 90.0,
}


def ping(mmsi, sec, lat, lon, **kw):
    r = dict(BASE)
    r.update({"MMSI": mmsi, "Timestamp": T0 + dt.timedelta(seconds=sec), "Latitude": lat, "Longitude": lon})
    r.update(kw)
    r.setdefault("Name", f"V{mmsi}")
    return r


def pings_df(spark, rows):
    """Raw ping table (26 AIS columns, Timestamp already TIMESTAMP_NTZ)."""
    names = [n for n, _ in AIS_FIELDS]
    types = {n: ("timestamp_ntz" if n == "Timestamp" else t.simpleString()) for n, t in AIS_FIELDS}
    schema = ", ".join(f"`{n}` {types[n]}" for n in names)
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def crossing(mmsi_a=219021240, mmsi_b=232018267, lat0=55.223427, lon0=14.244630, every=5, span=600):
    """Two vessels crossing at (lat0, lon0) at T0 + span/2: A eastbound, B northbound."""
    import math

    rows = []
    v = 12.0  # knots
    for s in range(0, span + 1, every):
        dt_h = (s - span / 2) / 3600.0
        east = v * dt_h / 60.0 / math.cos(math.radians(lat0))
        north = v * dt_h / 60.0
        rows.append(ping(mmsi_a, s, lat0, lon0 + east, SOG=v, COG=90.0, Heading=90.0, Name="KARIN HOEJ"))
        rows.append(ping(mmsi_b, s + 1, lat0 + north + 0.0002, lon0, SOG=v + 3, COG=0.0, Heading=0.0,
                         Name="MV SCOT CARRIER"))
    return rows
