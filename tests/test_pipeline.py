import pandas as pd

from helpers import crossing, pings_df
from vesselflow.plans.pipeline import run
from vesselflow.sources.fixture import raw_pings
from vesselflow.sources.schema import AIS_COLUMNS
from conftest import SF_SMALL


def test_end_to_end_job_on_csv(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    fixture = raw_pings(spark, SF_SMALL, as_text=True)
    cross = pings_df(spark, crossing()).selectExpr(
        *[f"date_format(Timestamp, 'dd/MM/yyyy HH:mm:ss') AS Timestamp" if c == "Timestamp" else f"`{c}`"
          for c in AIS_COLUMNS]
    )
    pdf = pd.concat([fixture.toPandas(), cross.toPandas()])
    pdf["MMSI"] = pdf["MMSI"].astype("Int64")  # integer text in the file, as in AIS exports
    pdf.rename(columns={"Timestamp": "# Timestamp"}).to_csv(src / "aisdk-2021-12-13.csv", index=False)

    counts = run(spark, str(src), str(out), day=13)
    assert counts["raw"] == len(pdf)
    assert counts["clean"] > 0 and counts["final"] > 0
    assert counts["clean"] >= counts["validated"] >= counts["final"]

    events = spark.read.parquet(str(out / "events"))
    assert events.count() == counts["final"]
    sel = spark.read.parquet(str(out / "selected")).collect()
    # the planted priority pair is found, so it (and only it) is selected
    assert [(r.MMSI_A, r.MMSI_B) for r in sel] == [(219021240, 232018267)]
    tracks = spark.read.parquet(str(out / "trajectories"))
    assert set(r.vessel for r in tracks.select("vessel").distinct().collect()) == {"A", "B"}
    assert spark.read.parquet(str(out / "endpoints")).count() == 2
    assert spark.read.parquet(str(out / "segments")).count() == tracks.count() - 2
    assert spark.read.option("header", True).csv(str(out / "report")).count() >= 1


def test_command_line(spark, tmp_path, capsys):
    import pytest

    from vesselflow.__main__ import main, parse_args

    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    cross = pings_df(spark, crossing()).selectExpr(
        *[f"date_format(Timestamp, 'dd/MM/yyyy HH:mm:ss') AS Timestamp" if c == "Timestamp" else f"`{c}`"
          for c in AIS_COLUMNS]
    ).toPandas()
    cross["MMSI"] = cross["MMSI"].astype("Int64")
    cross.rename(columns={"Timestamp": "# Timestamp"}).to_csv(src / "aisdk-2021-12-13.csv", index=False)
    assert main(["--data-dir", str(src), "--out", str(out), "-d", "13"], spark) == 0
    text = capsys.readouterr().out
    assert "KARIN HOEJ (MMSI 219021240) x MV SCOT CARRIER (MMSI 232018267)" in text
    assert main(["--data-dir", str(src), "--out", str(tmp_path / "out_csv"), "-d", "13", "--format", "csv"], spark) == 0
    assert "KARIN HOEJ (MMSI 219021240)" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        parse_args(["--data-dir", "x", "--out", "y", "-d", "40"])
