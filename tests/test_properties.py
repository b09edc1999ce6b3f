"""Property tests: the minute-split previous-row operator equals a plain lag."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vesselflow.operators.index import hour_bucket, minute_bucket
from vesselflow.operators.sequence import with_previous

T0 = dt.datetime(2021, 12, 13)

rows = st.lists(
    st.tuples(
        st.integers(1, 3),  # key: few keys, so one key often dominates
        st.integers(0, 6 * 3600),  # seconds: spans many minutes with gaps
        st.floats(-1000, 1000, allow_nan=False),
    ),
    min_size=1,
    max_size=60,
    unique_by=lambda r: (r[0], r[1]),  # order must be unique within a key for a defined lag
)


@settings(max_examples=15, deadline=None)
@given(rows)
def test_with_previous_equals_lag(spark, data):
    df = spark.createDataFrame(
        [(k, T0 + dt.timedelta(seconds=s), x) for k, s, x in data], "k long, t timestamp_ntz, x double"
    ).withColumn("m", minute_bucket("t"))
    got = with_previous(df, ["k"], "m", ["t"], ["x", "t"], prefix="p_").select("k", "t", "x", "p_x", "p_t")
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t", "x", F.lag("x").over(w).alias("p_x"), F.lag("t").over(w).alias("p_t"))
    assert sorted(got.collect()) == sorted(want.collect())


tied = st.lists(
    st.tuples(st.integers(1, 2), st.sampled_from([0, 59, 60, 3599, 3600, 3601, 7199, 7200]), st.integers(0, 3)), min_size=1, max_size=40
)


@settings(max_examples=15, deadline=None)
@given(tied, st.randoms())
def test_with_previous_equals_lag_with_equal_times(spark, data, random):
    """Rows that share a time, at chunk edges too, follow the whole order whatever the input order."""
    shuffled = data[:]
    random.shuffle(shuffled)
    schema = "k long, t timestamp_ntz, x long"
    make = lambda some: spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), x) for k, s, x in some], schema)
    df = make(shuffled).withColumn("h", hour_bucket("t"))
    got = with_previous(df, ["k"], "h", ["t", "x"], ["x", "t"], prefix="p_").select("k", "t", "x", "p_x", "p_t")
    w = Window.partitionBy("k").orderBy("t", "x")
    want = make(data).select("k", "t", "x", F.lag("x").over(w).alias("p_x"), F.lag("t").over(w).alias("p_t"))
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
