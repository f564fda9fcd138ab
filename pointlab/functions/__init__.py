"""Column expressions; every one stays inside generated JVM code."""

from pointlab.functions.columns import (
    coordinate,
    exact_fraction,
    is_missing,
    key_bound,
    land_cover,
    ndvi,
    percent,
    point_key,
)

__all__ = [
    "coordinate",
    "exact_fraction",
    "is_missing",
    "key_bound",
    "land_cover",
    "ndvi",
    "percent",
    "point_key",
]
