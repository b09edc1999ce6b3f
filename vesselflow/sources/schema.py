"""AIS ping schema (26 positional columns) and the required-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

_S, _L, _D = StringType(), LongType(), DoubleType()

# Column order of the AIS CSV files; names are assigned by position.
AIS_FIELDS = (
    ("Timestamp", _S),
    ("TypeOfMobile", _S),
    ("MMSI", _L),
    ("Latitude", _D),
    ("Longitude", _D),
    ("NavigationalStatus", _S),
    ("ROT", _D),
    ("SOG", _D),
    ("COG", _D),
    ("Heading", _D),
    ("IMO", _S),
    ("Callsign", _S),
    ("Name", _S),
    ("ShipType", _S),
    ("CargoType", _S),
    ("Width", _D),
    ("Length", _D),
    ("TypeOfPositionFixingDevice", _S),
    ("Draught", _D),
    ("Destination", _S),
    ("ETA", _S),
    ("DataSourceType", _S),
    ("A", _D),
    ("B", _D),
    ("C", _D),
    ("D", _D),
)
AIS_COLUMNS = tuple(n for n, _ in AIS_FIELDS)

REQUIRED_COLUMNS = frozenset(
    {
        "Timestamp",
        "MMSI",
        "Latitude",
        "Longitude",
        "NavigationalStatus",
        "SOG",
        "COG",
        "Heading",
        "Name",
        "ShipType",
        "TypeOfMobile",
    }
)


def ais_schema() -> StructType:
    """All 26 fields, nullable; ``Timestamp`` is raw text until parsed."""
    return StructType([StructField(n, t, True) for n, t in AIS_FIELDS])


def required_columns(df: DataFrame) -> DataFrame:
    """S4 as a table: one row for each required column with whether ``df`` has it, and in how many rows it has a value
    (0 where it is missing). One partial aggregate over those columns."""
    names = sorted(REQUIRED_COLUMNS)
    counts = df.agg(*[(F.count(F.col(c)) if c in df.columns else F.lit(0).cast("long")).alias(c) for c in names])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.lit(c in df.columns).alias("present"), F.col(c).alias("n_values")) for c in names]))
    return counts.select(rows.alias("r")).select("r.*")


def validate_schema(df: DataFrame) -> DataFrame:
    """Raise ``ValueError`` naming missing required columns; return ``df``.

    Reads only the analysed schema, so it triggers no Spark job.
    """
    missing = sorted(REQUIRED_COLUMNS - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df
