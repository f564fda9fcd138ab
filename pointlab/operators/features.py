"""Derived columns: class, coordinates, normalised height, vegetation index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.functions import coordinate, land_cover, ndvi
from pointlab.schema import FINAL_COLUMNS


def remap_classes(df: DataFrame, mapping: dict[int, int] | None = None) -> DataFrame:
    """Replace raw class codes by land-cover classes."""
    return df.withColumn("Classification", land_cover(F.col("Classification"), mapping))


def split_xyz(df: DataFrame) -> DataFrame:
    """Add ``x``, ``y``, ``z`` from the coordinate array."""
    xyz = F.col("xyz")
    return df.withColumns({name: coordinate(xyz, axis) for axis, name in enumerate("xyz")})


def add_ndvi(df: DataFrame) -> DataFrame:
    return df.withColumn("NDVI", ndvi(F.col("Infrared"), F.col("Red")))


def table_statistics(df: DataFrame, by_split: bool, **statistics: Column) -> Column:
    """Aggregates over the whole table, or over each row's own split, as one struct column.

    The result is a scalar subquery of exactly one row however large the table is: one partial and one
    final aggregate, no join, nothing collected by the caller. By split, that row is a map with one
    entry for each split value there is, a few whatever the number of points; rows without a split
    have an entry of their own.
    """
    values = F.struct(*[value.alias(name) for name, value in statistics.items()])
    if not by_split:
        return df.select(values).scalar()
    own = F.coalesce(F.concat(F.lit("="), F.col("split")), F.lit(""))
    entries = df.groupBy(own.alias("key")).agg(values.alias("value"))
    table = entries.select(F.map_from_entries(F.collect_list(F.struct("key", "value")))).scalar()
    return F.try_element_at(table, own)


def normalise_height(df: DataFrame, *, by_split: bool | None = None, floor: float | None = None) -> DataFrame:
    """Add ``z_norm``, the height above the lowest point.

    The lowest point is that of each row's own split if the table has a ``split`` column, else
    that of the table. ``floor`` gives a fixed one, such as the training table's.
    """
    if floor is not None:
        return df.withColumn("z_norm", F.col("z") - F.lit(float(floor)))
    if by_split is None:
        by_split = "split" in df.columns
    lowest = table_statistics(df, by_split, min_z=F.min("z"))
    return df.withColumn("z_norm", F.col("z") - lowest["min_z"])


def build_features(df: DataFrame, *, floor: float | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw points to the ten final columns, plus ``split`` where there is one, plus ``keep``.

    Two scans: one that reads only what the minimum height needs, one for the output.
    """
    table = add_ndvi(normalise_height(split_xyz(remap_classes(df)), floor=floor))
    extra = [c for c in ("split", *keep) if c in df.columns]
    return table.select(*FINAL_COLUMNS, *extra)
