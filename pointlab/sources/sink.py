"""Parquet sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_points(df: DataFrame, path: str, partition_by: Sequence[str] = ("split",),
                 max_records_per_file: int = 0) -> None:
    """Overwrite ``path``; a map-only job, one folder per split by default.

    Readers that filter on ``split`` then list only the folders they need.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
