"""Keys with very many rows: results equal the plain forms, and no key bounds a task."""

import datetime as dt
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, ping, pings_df
from vesselflow.operators import clean as C
from vesselflow.operators import pairs as P
from vesselflow.operators import skew
from vesselflow.operators import trajectory as T
from vesselflow.operators.index import SLICE, hour_bucket, minute_bucket
from vesselflow.operators.sequence import with_previous, with_rank
from vesselflow.params import DEFAULT
from vesselflow.plans import detect as D


@pytest.fixture()
def no_aqe(spark):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", was)


def task_rows(df):
    """Rows of each task that has some; all columns are read, so that nothing before is pruned away."""
    own = df.select(F.spark_partition_id().alias("task"), F.xxhash64(*df.columns).alias("h"))
    return [r.n for r in own.groupBy("task").agg(F.count("h").alias("n"), F.max("h")).collect()]


def flooded_rows(n=24_000, equal=False):
    """A third of the rows in one vessel-hour; with ``equal``, a sixth are the same row."""
    rng = np.random.default_rng(5)
    hot = n // 3
    secs = np.concatenate((rng.integers(3600, 7200, hot), rng.integers(0, 24 * 3600, n - hot)))
    if equal:
        secs[: n // 6] = 4000
    x = rng.integers(0, 50, n) / 4.0
    if equal:
        x[: n // 6] = 1.0
    keys = np.concatenate((np.full(hot, 1), rng.integers(1, 200, n - hot)))
    order = rng.permutation(n)
    return pd.DataFrame({"k": keys[order], "t": [T0.replace(hour=0, minute=0) + dt.timedelta(seconds=int(s)) for s in secs[order]], "x": x[order]})


@pytest.mark.parametrize("equal", [False, True])
def test_previous_row_of_a_flooded_chunk(spark, no_aqe, equal):
    df = spark.createDataFrame(flooded_rows(equal=equal), "k long, t timestamp_ntz, x double").withColumn("h", hour_bucket("t"))
    got = with_previous(df, ["k"], "h", ["t", "x"], ["x", "t"], prefix="p_", limit=500, keep_slice=True)
    assert SLICE in got.columns
    w = Window.partitionBy("k").orderBy("t", "x")
    cols = ["k", "t", "x", "p_x", "p_t"]
    want = df.select("k", "t", "x", F.lag("x").over(w).alias("p_x"), F.lag("t").over(w).alias("p_t"))
    assert got.select(*cols).exceptAll(want).isEmpty() and want.exceptAll(got.select(*cols)).isEmpty()
    sizes = task_rows(got)
    assert sum(sizes) == 24_000 and max(sizes) <= 2 * statistics.median(sizes)
    plain = with_previous(df, ["k"], "h", ["t", "x"], ["x", "t"], prefix="p_", keep_slice=True)
    assert SLICE not in plain.columns and max(task_rows(plain)) > 2 * statistics.median(task_rows(plain))
    assert plain.select(*cols).exceptAll(want).isEmpty()


def flooded_pings(spark, n=3000):
    rng = np.random.default_rng(9)
    rows = [ping(219000001, int(s), 55.2 + rng.normal(0, 0.001), 14.2 + rng.normal(0, 0.001)) for s in rng.integers(0, 1200, n // 3)]
    rows += [ping(219000002 + int(v), int(s), 55.2 + rng.normal(0, 0.02), 14.2 + rng.normal(0, 0.02)) for v, s in zip(rng.integers(0, 30, n - n // 3), rng.integers(0, 4 * 3600, n - n // 3))]
    rows += [rows[0]] * 300
    return pings_df(spark, rows)


def test_cleaning_and_counts_of_a_flooded_vessel_hour(spark):
    raw = flooded_pings(spark)
    flood = DEFAULT.with_(flood_rows=400)
    assert SLICE in C.clean_pings(raw, flood, keep_bucket=True).columns
    a, b = C.clean_pings(raw, flood), C.clean_pings(raw)
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() > 500
    x, y = (D.shared_clean(raw, p) for p in (flood, DEFAULT))
    assert x.columns == y.columns and x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
    e, f = (D.validated_events(t, p).select("MMSI_A", "MMSI_B", "first_ts", "Timestamp_B", "DCPA") for t, p in ((x, flood), (y, DEFAULT)))
    assert e.exceptAll(f).isEmpty() and f.exceptAll(e).isEmpty() and e.count() > 0
    assert C.with_implied_speed(C.clean_until_coordinates(raw), flood).columns[-1] == "implied_speed_kn"


def test_split_join_equals_the_join(spark, no_aqe):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("x"))
        right = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id") % 9).alias("k"), (F.col("id") % 3).alias("y"))
        want = left.join(right, "k")
        for limit in (30, 250, 10_000):
            got = skew.split_join(left, right, ["k"], limit)
            assert got.columns == want.columns
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        hot = skew.split_join(left, right, ["k"], 30).where("k = 1")
        assert len(task_rows(hot)) >= 6 and max(task_rows(hot)) < 0.4 * hot.count()
        assert len(task_rows(want.where("k = 1"))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attach_joins_hot_and_other_groups(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).alias("k"))
    groups = rows.where("k % 2 = 0 OR k = -1").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = skew.attach(rows, groups, ["k"], "n")
    want = rows.join(groups, "k", "left")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_flooded_sub_cell_is_split(spark, no_aqe):
    """Most pings of a minute in one sub-cell: the same pairs as the plain join, made by several tasks."""
    rng = np.random.default_rng(2)
    rows = [(219000000 + int(v), T0 + dt.timedelta(seconds=int(s)), 55.2 + float(d), 14.2 + float(e)) for v, s, d, e in zip(rng.integers(0, 60, 500), rng.integers(0, 60, 500), rng.normal(0, 1e-5, 500), rng.normal(0, 1e-5, 500))]
    rows += [rows[0]] * 50
    df = spark.createDataFrame(rows, "MMSI long, Timestamp timestamp_ntz, Latitude double, Longitude double")
    df = df.withColumn("TimeBucket", minute_bucket("Timestamp")).withColumns({"SOG": F.lit(5.0), "COG": F.lit(0.0), "Heading": F.lit(0.0), "Name": F.lit("x"), "ShipType": F.lit("Cargo")})
    cols = ["MMSI_A", "MMSI_B", "Timestamp_A", "Timestamp_B", "Latitude_A", "Latitude_B"]
    plain = P.candidate_pairs(df, DEFAULT.with_(pair_join="plain"))
    for join in ("subgrid", "plain"):
        flood = P.candidate_pairs(df, DEFAULT.with_(pair_join=join, flood_cell_rows=60))
        assert flood.columns == P.candidate_pairs(df, DEFAULT.with_(pair_join=join)).columns
        assert flood.select(*cols).exceptAll(plain.select(*cols)).isEmpty() and plain.select(*cols).exceptAll(flood.select(*cols)).isEmpty()
        sizes = task_rows(flood)
        assert len(sizes) >= 6 and max(sizes) < 0.4 * sum(sizes)
    fine = P.fine_pairs(df.withColumn("SOG", F.col("MMSI") % 7 * 3.0))
    split = P.fine_pairs(df.withColumn("SOG", F.col("MMSI") % 7 * 3.0), DEFAULT.with_(flood_cell_rows=60))
    assert fine.count() > 0 and split.exceptAll(fine).isEmpty() and fine.exceptAll(split).isEmpty()


def test_islands_read_each_ping_once(spark):
    clean = D.pings_of(D.shared_clean(flooded_pings(spark)))
    starts = [0, 300, 660, 2000, 2000, 6000, 12000]
    ev = spark.createDataFrame(
        [(219000001, 219000002 + k % 4, T0 + dt.timedelta(seconds=s)) for k, s in enumerate(starts)], "MMSI_A long, MMSI_B long, first_ts timestamp_ntz"
    )
    islands = T.track_islands(ev)
    own = sorted((r.island_lo, r.island_hi) for r in islands.where("MMSI = 219000001").collect())
    at = lambda lo, hi: (T0 + dt.timedelta(seconds=lo - 600), T0 + dt.timedelta(seconds=hi + 600))
    assert own == [at(0, 660), at(2000, 2000), at(6000, 6000), at(12000, 12000)]
    inside = T.island_pings(islands, clean)
    want = clean.join(islands, "MMSI").where("Timestamp BETWEEN island_lo AND island_hi").select(*T.TRAJ_COLUMNS)
    assert inside.drop("_slot").exceptAll(want).isEmpty() and want.exceptAll(inside.drop("_slot")).isEmpty() and inside.count() > 0
    half = F.expr("INTERVAL 10 MINUTES")
    sides = [
        ev.select("MMSI_A", "MMSI_B", F.col("first_ts").alias("event_ts"), F.lit(s).alias("vessel"), F.col(f"MMSI_{s}").alias("MMSI")).join(clean, "MMSI")
        .where(F.col("Timestamp").between(F.col("event_ts") - half, F.col("event_ts") + half)) for s in "AB"
    ]
    brute = sides[0].unionByName(sides[1])
    for p in (DEFAULT, DEFAULT.with_(flood_rows=50)):
        got = T.event_trajectories(ev, clean, p)
        brute_rows = brute.select(*got.columns)
        assert got.exceptAll(brute_rows).isEmpty() and brute_rows.exceptAll(got).isEmpty()
    lines = T.trajectory_lines(got).collect()
    assert sum(r.n_points for r in lines) == got.count() and len({(r.MMSI_A, r.MMSI_B, r.event_ts, r.vessel) for r in lines}) == len(lines)


def test_line_of_a_track(spark):
    rows = [(1, 2, T0, v, m, "x", T0 + dt.timedelta(seconds=s), la, lo, 1.0, 2.0) for v, m, s, la, lo in (("A", 1, 9, 55.5, 14.25), ("A", 1, 3, 55.0, 14.0), ("A", 1, 9, 55.25, 14.5), ("B", 2, 0, 55.5, 14.0))]
    schema = "MMSI_A long, MMSI_B long, event_ts timestamp_ntz, vessel string, MMSI long, Name string, Timestamp timestamp_ntz, Latitude double, Longitude double, SOG double, COG double"
    got = {r.vessel: (r.wkt, r.n_points, (r.end_ts - r.start_ts).seconds) for r in T.trajectory_lines(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"A": ("LINESTRING (14.0 55.0, 14.5 55.25, 14.25 55.5)", 3, 6), "B": ("POINT (14.0 55.5)", 1, 0)}
    assert T.trajectory_lines(spark.createDataFrame([], schema)).collect() == []


def test_rank_without_one_task(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("a"), (F.col("id") % 3).alias("b")).repartition(7)
    rows = with_rank(df, ["b", F.col("a").desc()]).collect()
    want = sorted(((r.a, r.b) for r in df.collect()), key=lambda x: (x[1], -x[0]))
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in rows) == list(range(1, 1001))
    assert with_rank(df.where("a < 0"), ["a"]).collect() == []
