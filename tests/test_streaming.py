from pyspark.sql import functions as F

from vesselflow.sources.fixture import raw_pings
from vesselflow.streaming.ingest import land_pings, read_landed
from conftest import SF_SMALL


def test_landing_stream_is_exactly_once(spark, tmp_path):
    src, table, ckpt = tmp_path / "in", tmp_path / "table", tmp_path / "ckpt"
    raw = raw_pings(spark, SF_SMALL, as_text=True).toPandas()
    src.mkdir()
    # a day drop is one plain CSV file with the AIS header
    raw.rename(columns={"Timestamp": "# Timestamp"}).to_csv(src / "aisdk-2021-12-13.csv", index=False)
    land_pings(spark, str(src), str(table), str(ckpt)).awaitTermination()
    first = read_landed(spark, str(table)).count()
    assert first == 998  # two rows without a readable time
    # a second run over the same files adds nothing
    land_pings(spark, str(src), str(table), str(ckpt)).awaitTermination()
    assert read_landed(spark, str(table)).count() == 998
    got = read_landed(spark, str(table), days=["2021-12-13"]).agg(F.min("Timestamp")).first()[0]
    assert str(got) == "2021-12-13 00:00:01"
