"""Pipeline parameters.

One frozen dataclass holds every threshold, list and option the operators read.
Nothing here reads the environment or touches a Spark session; callers build a
``Params`` (or use ``DEFAULT``) and pass it down explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values the original pipeline uses, or the
# cleaning and detection results differ. Kept plainly, in their natural order.
# ---------------------------------------------------------------------------
MOBILE_TYPES = ("Class A", "Class B")
VESSEL_CLASS = "Class A"
STATIONARY_STATUSES = ("At anchor", "Moored", "Aground", "Not under command")
EXCLUDED_SHIP_TYPES = (
    "Undefined",
    "Pilot",
    "Pilot Vessel",
    "Undefined - Default Type",
    "Law enforcement",
    "SAR",
    "",
)
# (name, lat_min, lat_max, lon_min, lon_max), bounds inclusive
PORT_ZONES = (
    ("Copenhagen", 55.3, 55.8, 12.4, 12.9),
    ("Stockholm", 58.9, 59.5, 17.8, 18.5),
    ("Helsinki", 59.9, 60.5, 24.8, 25.5),
    ("Gdansk", 54.3, 54.9, 18.5, 19.1),
    ("Malmo", 55.5, 55.7, 12.9, 13.1),
)
MMSI_MIN = 100000000
MMSI_MAX = 999999999
TEST_MMSI = 123456789
REPEATED_DIGIT_MMSI = 111111111
# (lo, hi) inclusive: SAR aircraft, aids to navigation
EXCLUDED_MMSI_RANGES = ((111000000, 111999999), (970000000, 999999999))
# unordered MMSI pairs the map step looks for first
PRIORITY_PAIRS = ((219021240, 232018267), (219019287, 219021428))
CSV_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"
CSV_FIRST_HEADER = "# Timestamp"
METRES_PER_NM = 1852.0


@dataclass(frozen=True)
class Params:
    # Defaults below are fixed values too: the original pipeline's thresholds,
    # so results match it unless a caller overrides them. Fields after
    # "options" are this library's own choices.

    # region of interest
    center_lat: float = 55.225
    center_lon: float = 14.245
    radius_nm: float = 50.0
    box_lat_delta: float = 0.8
    box_lon_delta: float = 1.2
    earth_radius_nm: float = 3440.065
    nm_per_deg: float = 60.0

    # vessel state
    min_sog: float = 1.0
    max_sog: float = 50.0
    stationary_statuses: tuple = STATIONARY_STATUSES
    mobile_types: tuple = MOBILE_TYPES
    vessel_class: str = VESSEL_CLASS
    excluded_ship_types: tuple = EXCLUDED_SHIP_TYPES
    port_zones: tuple = PORT_ZONES

    # identity
    mmsi_min: int = MMSI_MIN
    mmsi_max: int = MMSI_MAX
    test_mmsi: int = TEST_MMSI
    repeated_digit_mmsi: int = REPEATED_DIGIT_MMSI
    excluded_mmsi_ranges: tuple = EXCLUDED_MMSI_RANGES

    # pairing and closest approach
    grid_deg: float = 0.5
    fine_cell_deg: float = 0.005  # our choice: square cell standing in for a hexagon index
    dcpa_limit_nm: float = 0.03
    max_distance_nm: float = 0.054
    tcpa_floor_h: float = -1.0
    rel_speed_sq_floor: float = 0.01
    validate: bool = True
    min_pings_per_minute: int = 2
    bucket_minutes: int = 1  # width of the time bucket that pairs and counts share; divides 60

    # convoy filters (off unless asked for)
    min_sog_diff: float = 2.0
    min_sog_max: float = 5.0
    max_pair_buckets: int = 2

    # verification
    max_duration_s: int = 30
    min_ping_count: int = 2
    max_cog_stddev: float = 2.0
    lookback_min: int = 10

    # trajectories and reports
    trajectory_half_window_min: int = 10
    top_k: int = 5
    priority_pairs: tuple = PRIORITY_PAIRS
    headon_deg: float = 22.5
    overtaking_min_deg: float = 112.5
    overtaking_max_deg: float = 247.5

    # fine-cell pair rules
    fallback_reject_factor: float = 2.0
    fallback_speed_sq_floor: float = 0.0001

    # options; defaults follow the original formulas except where noted
    lon_scale: str = "flat"  # "flat" (original) | "cos_mid" (east offset scaled by cos of mid latitude)
    clamp_acos: bool = True  # clamp the acos argument to [-1, 1]; False keeps NaN for repeated positions
    fallback_sign: str = "reference"  # "reference" | "corrected" relative-velocity sign in fine pairs
    pair_join: str = "subgrid"  # "subgrid" (exact, fewer candidates) | "plain" (minute x 0.5 deg cell)

    # flooded keys: above so many rows a vessel-hour (or a vessel's time slot), and above so many pings a cell and
    # minute, are split over several tasks
    flood_rows: int = 1_000_000
    flood_cell_rows: int = 20_000

    # CSV layout
    ts_format: str = CSV_TIMESTAMP_FORMAT
    file_prefix: str = "aisdk"
    year_month: str = "2021-12"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    # derived bounds, computed once in Python so Spark and SQL see the same doubles
    @property
    def box(self) -> tuple[float, float, float, float]:
        return (
            self.center_lat - self.box_lat_delta,
            self.center_lat + self.box_lat_delta,
            self.center_lon - self.box_lon_delta,
            self.center_lon + self.box_lon_delta,
        )


DEFAULT = Params()
