"""Case-insensitive name patterns in which only ``%`` is a wildcard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def like(value: Column, pattern: str | Column) -> Column:
    """True where ``value`` matches; ``_`` stands for itself, no ``%`` means equality."""
    if isinstance(pattern, str):
        literal = pattern.replace("\\", "\\\\").replace("_", "\\_")
        return value.ilike(literal)
    literal = F.replace(
        F.replace(pattern, F.lit("\\"), F.lit("\\\\")), F.lit("_"), F.lit("\\_")
    )
    return F.call_function("ilike", value, literal)
