"""End-to-end batch job: AIS CSV in, encounter tables out.

``run`` loads the pings (one day or all), checks the schema, cleans them,
materialises the cleaned table and the validated events (each read by
several outputs), and writes:

  events/        one event per vessel pair (closest approach)
  verified/      pairs passing the duration and straight-course checks
  selected/      priority pairs, else the closest pairs (the map selection)
  trajectories/  +/- window pings of both vessels of each selected event
  segments/      the same tracks as WKT line segments
  endpoints/     first / last point of each track and the event point
  report/        one text report per event (CSV)

  lines/         each track as one WKT line

Row counts are observed by the jobs that make the stages
(``detect.counted_stages``); nothing is read again for its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vesselflow.operators import report as R
from vesselflow.operators import trajectory as T
from vesselflow.operators import verify as V
from vesselflow.params import DEFAULT, Params
from vesselflow.plans import detect as D
from vesselflow.plans.checkpoint import materialize
from vesselflow.sources.csv import load_pings
from vesselflow.sources.schema import validate_schema
from vesselflow.sources.sinks import write_table


def run_on(raw: DataFrame, out_dir: str, p: Params = DEFAULT, fmt: str = "parquet") -> dict[str, int]:
    """Run the whole job on a raw ping table; returns rows per stage."""
    out = out_dir.rstrip("/")
    stages, counts = D.counted_stages(validate_schema(raw), p)
    clean, valid, stored_events = stages["clean"], stages["validated"], stages["final"]
    pings = D.pings_of(clean)

    write_table(stored_events, f"{out}/events", fmt)
    write_table(V.verified_pairs(valid, pings, p), f"{out}/verified", fmt)
    selected = T.priority_events(stored_events, p)
    write_table(selected, f"{out}/selected", fmt)
    tracks = materialize(T.event_trajectories(selected, pings, p))
    write_table(T.ordered_tracks(tracks), f"{out}/trajectories", fmt)
    write_table(T.trajectory_segments(tracks), f"{out}/segments", fmt)
    write_table(T.trajectory_lines(tracks), f"{out}/lines", fmt)
    write_table(T.trajectory_endpoints(tracks, selected), f"{out}/endpoints", fmt)
    write_table(R.report_text(stored_events), f"{out}/report", "csv")
    return counts


def run(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    day="all",
    p: Params = DEFAULT,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Load ``{data_dir}/{prefix}-{yyyy-MM}-{dd}.csv`` (``day`` or ``"all"``)
    and run the job; returns rows per stage."""
    return run_on(load_pings(spark, data_dir, day, p), out_dir, p, fmt)
