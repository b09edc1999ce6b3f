"""Great-circle geometry as Spark column expressions (no UDFs).

Arguments are column names or numbers. Each function has a ``*_sql`` form
returning Spark SQL text (for composing larger expressions) and a form
returning a ``Column``; both run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column

from vesselflow.functions.numbertext import fixed_text_sql
from vesselflow.functions.sqltext import col, num, ref
from vesselflow.params import DEFAULT, Params


def acos_distance_sql(lat1, lon1, lat2, lon2, p: Params = DEFAULT) -> str:
    f1, f2 = f"radians({ref(lat1)})", f"radians({ref(lat2)})"
    arg = f"sin({f1}) * sin({f2}) + cos({f1}) * cos({f2}) * cos(radians({ref(lon2)}) - radians({ref(lon1)}))"
    if p.clamp_acos:
        arg = f"least({num(1.0)}, greatest({num(-1.0)}, {arg}))"
    return f"(acos({arg}) * {num(p.earth_radius_nm)})"


def acos_distance_nm(lat1, lon1, lat2, lon2, p: Params = DEFAULT) -> Column:
    """Spherical law of cosines, the form the cleaning and pairing steps use.

    ``acos(sin f1 sin f2 + cos f1 cos f2 cos(l2 - l1)) * R``. With
    ``p.clamp_acos`` the argument is clamped to [-1, 1] so a repeated position
    gives 0 instead of NaN.
    """
    return col(acos_distance_sql(lat1, lon1, lat2, lon2, p))


def haversine_distance_sql(lat1, lon1, lat2, lon2, p: Params = DEFAULT) -> str:
    f1, f2 = f"radians({ref(lat1)})", f"radians({ref(lat2)})"
    dlon = f"radians({ref(lon2)} - {ref(lon1)})"
    a = f"pow(sin(({f2} - {f1}) / {num(2)}), 2) + cos({f1}) * cos({f2}) * pow(sin({dlon} / {num(2)}), 2)"
    return f"({num(p.earth_radius_nm)} * ({num(2)} * asin(sqrt({a}))))"


def haversine_distance_nm(lat1, lon1, lat2, lon2, p: Params = DEFAULT) -> Column:
    """Haversine form, used by the fine-cell pair rules."""
    return col(haversine_distance_sql(lat1, lon1, lat2, lon2, p))


def initial_bearing_sql(lat1, lon1, lat2, lon2) -> str:
    f1, f2 = f"radians({ref(lat1)})", f"radians({ref(lat2)})"
    dlon = f"radians({ref(lon2)} - {ref(lon1)})"
    x = f"sin({dlon}) * cos({f2})"
    y = f"cos({f1}) * sin({f2}) - sin({f1}) * cos({f2}) * cos({dlon})"
    return f"pmod(degrees(atan2({x}, {y})) + {num(360)}, {num(360)})"


def initial_bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from point 1 to point 2, degrees in [0, 360)."""
    return col(initial_bearing_sql(lat1, lon1, lat2, lon2))


def relative_bearing_deg(bearing, heading) -> Column:
    """Bearing of the other vessel relative to own heading, [0, 360)."""
    return col(f"pmod({ref(bearing)} - {ref(heading)}, {num(360)})")


def encounter_class(rel_bearing, p: Params = DEFAULT) -> Column:
    """head-on / overtaking / crossing from the relative bearing bands."""
    rb = ref(rel_bearing)
    return col(
        f"CASE WHEN {rb} IS NULL THEN CAST(NULL AS STRING)"
        f" WHEN {rb} < {num(p.headon_deg)} OR {rb} > {num(360.0 - p.headon_deg)} THEN 'head-on'"
        f" WHEN {rb} BETWEEN {num(p.overtaking_min_deg)} AND {num(p.overtaking_max_deg)} THEN 'overtaking'"
        " ELSE 'crossing' END"
    )


def bearing_text(rel_bearing, heading) -> Column:
    """Display text; every band prints the same wording."""
    return col(
        f"CASE WHEN {ref(heading)} IS NULL THEN 'Unknown (missing heading)'"
        f" ELSE concat('relative bearing ', {fixed_text_sql(ref(rel_bearing), 1)}, '°') END"
    )
