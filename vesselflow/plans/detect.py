"""End-to-end chains built from the operators. Tables that a plan reads several
times are stored once (``materialize``), which runs a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.operators import clean as C
from vesselflow.operators import pairs as P
from vesselflow.operators.index import HOUR
from vesselflow.params import DEFAULT, Params
from vesselflow.plans.checkpoint import counted, materialize, materialize_counted


def clean_bucketed(raw: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """C10 with the minute column kept as ``TimeBucket``."""
    return C.clean_pings(raw, p, keep_bucket=True)


# Columns the detection, verification and trajectory steps read from the
# cleaned pings; the shared stage keeps only these.
SHARED_COLUMNS = (*P.SIDE_COLUMNS, "TimeBucket", "n_pings")


def shared_clean(raw: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Cleaned pings + ``TimeBucket`` + per-vessel-minute ``n_pings``,
    projected to ``SHARED_COLUMNS`` and stored once (``materialize``) for
    plans that read them several times. The count window runs on the
    partitioning the jump filter left behind, before the write."""
    counted = P.with_minute_counts(clean_bucketed(raw, p))
    return materialize(counted.select(*[c for c in SHARED_COLUMNS if c in counted.columns]))


def counted_stages(raw: DataFrame, p: Params = DEFAULT) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The stages of E1 stored one after the other, and A5's row counts: each count is observed by the job that makes the
    stage (``raw`` by the first that reads it), and the candidates are a sum that those jobs don't have, from partial
    counts of the stored pings. A failsafe or a jump filter that reads a stage twice doesn't count it twice."""
    watched, seen = counted(raw, "raw")
    counted_pings = P.with_minute_counts(clean_bucketed(watched, p))
    clean_b, n_clean = materialize_counted(counted_pings.select(*[c for c in SHARED_COLUMNS if c in counted_pings.columns]))
    close, n_close = materialize_counted(close_events(clean_b, p))
    valid, n_valid = materialize_counted(P.validate_proximity(close, p))
    final, n_final = materialize_counted(P.best_event_per_pair(valid))
    candidates = P.candidate_pair_counts(clean_b, p).agg(F.sum("candidate_pairs")).first()[0] or 0
    counts = {"raw": seen.get["rows"], "clean": n_clean, "candidates": candidates, "close": n_close, "validated": n_valid, "final": n_final}
    return {"clean": clean_b, "close": close, "validated": valid, "final": final}, counts


def pings_of(clean_b: DataFrame) -> DataFrame:
    """The ping columns of a cleaned table (helper columns dropped)."""
    return clean_b.drop("TimeBucket", "n_pings", HOUR)


def close_pairs(clean_b: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """J1 -> M1, M4-M7 with per-vessel-minute counts carried along."""
    idx = clean_b if "n_pings" in clean_b.columns else P.with_minute_counts(clean_b)
    return P.with_cpa(P.candidate_pairs(idx, p, carry=("n_pings",)), p)


def close_events(clean_b: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """F1/F2 events, still carrying ``n_pings_A``/``n_pings_B``."""
    return P.close_events(close_pairs(clean_b, p), p, keep=("n_pings_A", "n_pings_B"))


def validated_events(clean_b: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A2 on the close events (several events per pair remain). The close
    events, few next to the pings, are stored first: the failsafe reads them
    again, and the pair join runs once."""
    return P.validate_proximity(materialize(close_events(clean_b, p)), p)


def shared_validated(clean_b: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Validated events stored once, for plans that read them several times
    (duration + details, selection + top-k, tracks + end points)."""
    return materialize(validated_events(clean_b, p))


def detect(clean_b: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """I1, I2 -> J1 -> M -> F1/F2 -> A2 -> W2, one event per pair."""
    return P.best_event_per_pair(validated_events(clean_b, p))


def detect_from_raw(raw: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return detect(shared_clean(raw, p), p)
