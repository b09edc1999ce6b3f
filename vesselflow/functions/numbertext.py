"""Fixed-decimal text of a DOUBLE, rounded from its exact binary value.

Java's formatter rounds the shortest decimal text half up (0.15 gives 0.2, 2.675 gives 2.68); ``printf``-style text
rounds the binary value itself, ties to even (0.1, 2.67). The value's fraction is taken exactly as an integer over 2^106
(two limbs of 53 bits, in wide decimals); no double has a fraction of more bits that could reach half a unit of
``MOST_DIGITS`` decimals. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column

from vesselflow.functions.sqltext import col, ref

MOST_DIGITS = 6
_LIMB = 2**53


def fixed_text(x: str, digits: int) -> Column:
    """The column ``x`` with ``digits`` decimals (1 to 6); NULL stays NULL, NaN is ``nan``, infinity ``inf``. From 2^63
    on, where doubles are whole numbers beyond a BIGINT, the digits are those of the shortest decimal text."""
    return col(fixed_text_sql(ref(x), digits))


def fixed_text_sql(x: str, digits: int) -> str:
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"{digits} decimals: expected 1 to {MOST_DIGITS}")
    unit = 10**digits

    def let(name: str, value: str, then: str) -> str:
        """``then``, in which ``name`` is the value."""
        return f"element_at(transform(array({value}), {name} -> {then}), 1)"

    # v: magnitude; f: fraction; m: f * 2^53; t: f * 2^106 * unit, q and r: its quotient and remainder by 2^106
    up = f"CASE WHEN qr.r > {_LIMB**2 // 2}BD OR (qr.r = {_LIMB**2 // 2}BD AND qr.q % 2 = 1) THEN qr.q + 1 ELSE qr.q END"
    sign = f"CASE WHEN {x} < 0 OR CAST({x} AS STRING) = '-0.0' THEN '-' ELSE '' END"
    text = f"concat({sign}, CAST(CAST(floor(v) AS BIGINT) + k DIV {unit} AS STRING), '.', lpad(CAST(k % {unit} AS STRING), {digits}, '0'))"
    limbs = f"CAST(CAST(floor(m) AS DECIMAL(16, 0)) * {_LIMB}BD + CAST(floor((m - floor(m)) * {_LIMB}D) AS DECIMAL(16, 0)) AS DECIMAL(32, 0))"
    parts = f"struct(t DIV {_LIMB**2}BD AS q, t % {_LIMB**2}BD AS r)"
    exact = let("v", f"abs({x})", let("m", f"(v - floor(v)) * {_LIMB}D", let("t", f"{limbs} * {unit}BD", let("qr", parts, let("k", up, text)))))
    return (
        f"CASE WHEN isnan({x}) THEN 'nan' WHEN abs({x}) = CAST('Infinity' AS DOUBLE) THEN concat(CASE WHEN {x} < 0 THEN '-' ELSE '' END, 'inf')"
        f" WHEN abs({x}) >= {2**63}D THEN format_string('%.{digits}f', {x}) WHEN {x} IS NOT NULL THEN {exact} END"
    )
