"""Scalar column functions of the point table."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlab.schema import CLASS_MAPPING

# Keys have 60 bits, so that they are whole numbers of at most 15 hexadecimal digits.
KEY_BITS = 60


def coordinate(xyz: Column, axis: int) -> Column:
    """Element ``axis`` of the coordinate array; NULL where the array is too short."""
    return F.get(xyz, F.lit(axis))


def land_cover(code: Column, mapping: dict[int, int] | None = None) -> Column:
    """Land-cover class of a raw class code; NULL for a code outside the mapping."""
    codes_of: dict[int, list[int]] = {}
    for raw, cls in (mapping or CLASS_MAPPING).items():
        codes_of.setdefault(cls, []).append(raw)
    cases = [(code.isin(codes), F.lit(cls)) for cls, codes in codes_of.items()]
    chain = F.when(*cases[0])
    for condition, value in cases[1:]:
        chain = chain.when(condition, value)
    return chain


def ndvi(infrared: Column, red: Column) -> Column:
    """Vegetation index in [-1, 1]; NULL where both bands are dark or one is missing."""
    near, visible = infrared.cast("double"), red.cast("double")
    return F.try_divide(near - visible, near + visible)


def percent(part: Column, total: Column) -> Column:
    return part / total * 100


def is_missing(name: str, data_type: T.DataType) -> Column:
    """True where the value is NULL, or NaN in a floating column."""
    column = F.col(name)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def point_key(xyz: Column, others: Sequence[Column], hasher: str = "xxhash64") -> Column:
    """Repeatable key of a point: a whole number below 2**60.

    Points carry no identifier, so the key is taken from their own values, with coordinates in
    whole millimetres. It depends neither on partitioning nor on row order, and equal points
    share it. ``xxhash64`` is by far the cheaper; ``md5`` gives keys that other engines reproduce.
    """
    parts = [F.floor(coordinate(xyz, axis) * 1000 + 0.5) for axis in range(3)] + list(others)
    if hasher == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(*parts), 64 - KEY_BITS)
    if hasher == "md5":
        # One array cast instead of a cast per column keeps the generated method small enough to compile.
        numbers = F.array(*[c.cast("long") for c in parts])
        text = F.array_join(numbers.cast("array<string>"), "|", "")
        number = F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")
        # Never NULL, and said so: else each join on the key computes it once more to check.
        return F.coalesce(number, F.lit(0))
    raise ValueError(f"hasher must be xxhash64 or md5, got {hasher}")


def exact_fraction(fraction: float | str | Decimal) -> Decimal:
    """The decimal number as written, so 0.29 is 0.29 and not a little less."""
    value = Decimal(str(fraction))
    if not 0 < value <= 1:
        raise ValueError(f"fraction must be above 0 and at most 1, got {fraction}")
    return value


def key_bound(fraction: float | str | Decimal) -> int:
    """The key below which ``fraction`` of all keys lie; a smaller fraction has a smaller bound."""
    return int(exact_fraction(fraction) * 2**KEY_BITS)
