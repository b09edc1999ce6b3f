"""Plan-shape checks: the scale properties the design relies on."""

from vesselflow.operators import clean as C
from vesselflow.operators.index import hour_bucket
from vesselflow.plans import detect as D
from vesselflow.plans.queries import _raw
from vesselflow.sources.fixture import raw_pings
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_splits_vessels_by_hour(spark):
    p = plan(D.clean_bucketed(_raw(spark, SF_SMALL)))
    assert "hashpartitioning(MMSI" in p and "_hour" in p
    # no shuffle keyed by the vessel id alone for the full ping rows: the only
    # MMSI-only exchange is the per-hour marker table feeding the chunk lag
    assert p.count("Window") >= 2


def test_detection_has_no_pair_expansion(spark):
    p = plan(D.close_events(D.shared_clean(_raw(spark, SF_SMALL))))
    assert p.count("Join") == 1
    assert "CartesianProduct" not in p
    assert "sub_lat" in p and "sub_lon" in p
    # the only nested-loop join allowed is none at all
    assert "BroadcastNestedLoopJoin" not in p


def test_parquet_scan_gets_pushed_filters_and_pruned_schema(spark, tmp_path):
    path = str(tmp_path / "ais")
    raw_pings(spark, SF_SMALL).write.parquet(path)
    df = C.clean_until_coordinates(spark.read.parquet(path)).select("MMSI", "Latitude")
    p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [" in p and "EqualTo(TypeOfMobile,Class A)" in p
    assert "GreaterThanOrEqual(MMSI,100000000)" in p
    read = p[p.index("ReadSchema"):].split("\n")[0]
    assert "Heading" not in read and "ShipType" not in read


def _exchanges(spark, df) -> int:
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return sum(1 for line in text.splitlines() if line.startswith("Arguments: ") and "partitioning(" in line.lower())


def test_minute_counts_reuse_the_jump_filter_partitioning(spark):
    from vesselflow.operators import pairs as P

    clean_b = D.clean_bucketed(_raw(spark, SF_SMALL))
    assert _exchanges(spark, P.with_minute_counts(clean_b)) == _exchanges(spark, clean_b)


def test_interval_joins_key_on_vessel_and_time_slot(spark):
    from vesselflow.operators import trajectory as T
    from vesselflow.operators import verify as V

    clean_b = D.clean_bucketed(_raw(spark, SF_SMALL))
    ev = D.detect(clean_b)
    pings = D.pings_of(clean_b)
    for df in (T.event_trajectories(ev, pings), V.course_steadiness(ev.select("MMSI_A", "MMSI_B", "first_ts"), pings)):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        keys = [l for l in text.splitlines() if l.startswith(("Left keys", "Right keys"))]
        assert any("MMSI" in k and "_slot" in k for k in keys)
        # no join on the vessel id alone (a vessel's whole history in one task)
        assert not any(k.split(": ", 1)[1].startswith("[MMSI") and "," not in k.split(": ", 1)[1] for k in keys)


def test_marker_rows_are_few(spark):
    """The rows carried across chunk edges stay below a twentieth of the pings."""
    base = C.clean_until_coordinates(_raw(spark, "/root/testdata/sf0.1")).withColumn("h", hour_bucket("Timestamp"))
    assert base.select("MMSI", "h").distinct().count() < 0.05 * base.count()


def test_plans_hold_no_pair_join_after_the_close_events_are_stored(spark):
    p = plan(D.validated_events(D.clean_bucketed(_raw(spark, SF_SMALL))))
    assert "sub_lat" not in p
