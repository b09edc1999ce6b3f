"""Small helpers to write column expressions as Spark SQL text.

An expression built with ``F.expr`` costs one call into the JVM, while the
same tree built from ``Column`` operators costs one call per node; for the
wide geometry and cleaning predicates that is the difference between a few
milliseconds and several hundred per query plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref(x) -> str:
    """A column name (back-quoted) or a number (as an exact DOUBLE literal)."""
    if isinstance(x, str):
        return "`" + x.replace("`", "``") + "`"
    if isinstance(x, bool):
        raise TypeError("booleans are not numeric arguments")
    if isinstance(x, (int, float)):
        return f"CAST({float(x)!r} AS DOUBLE)"
    raise TypeError(f"expected a column name or a number, got {type(x).__name__}")


def num(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def strings(values) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def one_of(name: str, values) -> str:
    """``name IN (values)``; an empty list holds nothing, not even NULL."""
    return f"({ref(name)} IN ({strings(values)}))" if values else "FALSE"


def col(sql: str) -> Column:
    return F.expr(sql)
