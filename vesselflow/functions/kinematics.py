"""Closest-point-of-approach kinematics as column expressions.

Units: positions in nautical miles, speeds in knots, TCPA in hours.
Arguments are column names or numbers; ``*_sql`` forms return SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column

from vesselflow.functions.sqltext import col, num, ref
from vesselflow.params import DEFAULT, Params


def relative_velocity_sql(sog_a, cog_a, sog_b, cog_b) -> tuple[str, str]:
    """(east, north) velocity of b relative to a."""
    a, b, ca, cb = ref(sog_a), ref(sog_b), ref(cog_a), ref(cog_b)
    east = f"({b} * sin(radians({cb})) - {a} * sin(radians({ca})))"
    north = f"({b} * cos(radians({cb})) - {a} * cos(radians({ca})))"
    return east, north


def relative_velocity(sog_a, cog_a, sog_b, cog_b) -> tuple[Column, Column]:
    e, n = relative_velocity_sql(sog_a, cog_a, sog_b, cog_b)
    return col(e), col(n)


def relative_position_sql(lat_a, lon_a, lat_b, lon_b, p: Params = DEFAULT) -> tuple[str, str]:
    """(east, north) offset of b from a.

    ``lon_scale="flat"`` uses one degree = 60 nm on both axes, as the original
    does; ``"cos_mid"`` scales the east offset by cos(mean latitude).
    """
    east = f"({ref(lon_b)} - {ref(lon_a)}) * {num(p.nm_per_deg)}"
    if p.lon_scale == "cos_mid":
        east = f"{east} * cos(radians(({ref(lat_a)} + {ref(lat_b)}) / {num(2)}))"
    north = f"({ref(lat_b)} - {ref(lat_a)}) * {num(p.nm_per_deg)}"
    return f"({east})", f"({north})"


def relative_position(lat_a, lon_a, lat_b, lon_b, p: Params = DEFAULT) -> tuple[Column, Column]:
    e, n = relative_position_sql(lat_a, lon_a, lat_b, lon_b, p)
    return col(e), col(n)


def _moving_sql(vel_e, vel_n, p: Params) -> str:
    ve, vn = ref(vel_e), ref(vel_n)
    return f"{ve} * {ve} + {vn} * {vn} > {num(p.rel_speed_sq_floor)}"


def tcpa_hours(pos_e, pos_n, vel_e, vel_n, p: Params = DEFAULT) -> Column:
    """Time of closest approach in hours; 0 when the squared relative speed
    is not above the floor (or unknown, e.g. a NULL course)."""
    pe, pn, ve, vn = ref(pos_e), ref(pos_n), ref(vel_e), ref(vel_n)
    return col(
        f"CASE WHEN {_moving_sql(vel_e, vel_n, p)} THEN -({pe} * {ve} + {pn} * {vn}) / ({ve} * {ve} + {vn} * {vn})"
        f" ELSE {num(0)} END"
    )


def dcpa_nm(pos_e, pos_n, vel_e, vel_n, tcpa, distance, p: Params = DEFAULT) -> Column:
    """Distance at closest approach; the current distance when not moving
    relative to each other (same test as ``tcpa_hours``)."""
    pe, pn, ve, vn, t = ref(pos_e), ref(pos_n), ref(vel_e), ref(vel_n), ref(tcpa)
    return col(
        f"CASE WHEN {_moving_sql(vel_e, vel_n, p)} THEN sqrt(pow({pe} + {ve} * {t}, 2) + pow({pn} + {vn} * {t}, 2))"
        f" ELSE {ref(distance)} END"
    )


def fine_pair_dcpa(lat1, lon1, lat2, lon2, sog1, cog1, sog2, cog2, p: Params = DEFAULT) -> Column:
    """DCPA of the fine-cell pair rules (cos-mid-latitude east offset).

    ``fallback_sign="reference"`` keeps the original sign: position is 2-1 but
    velocity is 1-2, so a closing pair gets a negative time and its current
    distance. ``"corrected"`` uses velocity 2-1. NULL course gives NULL.
    """
    dy = f"(({ref(lat2)} - {ref(lat1)}) * {num(p.nm_per_deg)})"
    dx = (
        f"(({ref(lon2)} - {ref(lon1)}) * {num(p.nm_per_deg)}"
        f" * cos(radians(({ref(lat1)} + {ref(lat2)}) / {num(2)})))"
    )
    vx1 = f"{ref(sog1)} * sin(radians({ref(cog1)}))"
    vy1 = f"{ref(sog1)} * cos(radians({ref(cog1)}))"
    vx2 = f"{ref(sog2)} * sin(radians({ref(cog2)}))"
    vy2 = f"{ref(sog2)} * cos(radians({ref(cog2)}))"
    if p.fallback_sign == "corrected":
        dvx, dvy = f"({vx2} - {vx1})", f"({vy2} - {vy1})"
    else:
        dvx, dvy = f"({vx1} - {vx2})", f"({vy1} - {vy2})"
    s = f"(pow({dvx}, 2) + pow({dvy}, 2))"
    now = f"sqrt(pow({dx}, 2) + pow({dy}, 2))"
    t = f"(-({dx} * {dvx} + {dy} * {dvy}) / {s})"
    return col(
        f"CASE WHEN {s} < {num(p.fallback_speed_sq_floor)} THEN {now}"
        f" WHEN {t} < {num(0)} THEN {now}"
        f" ELSE sqrt(pow({dx} + {dvx} * {t}, 2) + pow({dy} + {dvy} * {t}, 2)) END"
    )
