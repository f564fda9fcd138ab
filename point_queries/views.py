"""A point table derived from the test data, which holds no point cloud of its own."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlab.schema import SPLITS
from pointlab.session import scratch_path
from pointlab.sources import write_points

# Raw class code by part key modulo 13; 7 is outside the class mapping.
CODES_BY_PART = [1, 2, 3, 4, 5, 6, 9, 17, 64, 65, 66, 7, None]
BUCKETS = 16


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def points_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per line item, with ``point_id`` and ``split`` beside the contract columns.

    Some points have no code, some no height, some no split, and some a split of another name.
    """
    part, quantity = F.col("l_partkey"), F.col("l_quantity")
    dark = part % 50 == 0
    order_digit = F.col("l_orderkey") % 10
    codes = F.array(*[F.lit(code).cast("int") for code in CODES_BY_PART])
    height = F.when(F.col("l_linenumber") != 7, quantity * 10.0 + F.col("l_discount") * 100.0)
    split = F.when(order_digit < 6, "train").when(order_digit == 6, "extra").when(order_digit == 8, "val")
    return lineitem(spark, sf_dir).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("point_id"),
        F.array("l_extendedprice", F.col("l_orderkey").cast("double"), height).alias("xyz"),
        (part * 37 % 3000).cast("int").alias("Intensity"),
        F.get(codes, (part % 13).cast("int")).alias("Classification"),
        F.when(dark, 0).otherwise((F.col("l_suppkey") + 1) * 500 % 65536).cast("int").alias("Red"),
        ((part % 13) * 4096 + quantity * 16).cast("int").alias("Green"),
        (F.col("l_linenumber") * 8000).cast("int").alias("Blue"),
        F.when(dark, 0.0).otherwise(quantity * 1024).cast("int").alias("Infrared"),
        split.when(order_digit == 9, "test").alias("split"),
    )


def known_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the three splits that paths can name."""
    return points_view(spark, sf_dir).where(F.col("split").isin(*SPLITS))


def staged_points(spark: SparkSession, sf_dir: str, files: int = 64) -> str:
    """The known points written with one folder per split, in at least ``files`` files."""
    path = scratch_path(spark, "points")
    per_file = max(1, math.ceil(lineitem(spark, sf_dir).count() / files))
    write_points(known_points(spark, sf_dir), path, max_records_per_file=per_file)
    return path


def staged_buckets(spark: SparkSession, sf_dir: str) -> str:
    """The known points written below ``<split>/bucket=<point_id modulo 16>``."""
    path = scratch_path(spark, "buckets")
    bucketed = known_points(spark, sf_dir).withColumn("bucket", F.col("point_id") % BUCKETS)
    for split in SPLITS:
        write_points(bucketed.where(F.col("split") == split).drop("split"), f"{path}/{split}", partition_by=["bucket"])
    return path


def crowded_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points with x, y, z, of which every third lies in one corner of less than a unit."""
    x, y, z = (F.get("xyz", i) for i in range(3))
    hot = F.col("point_id") % 3 == 0
    place = [F.when(hot, start + c / by).otherwise(c) for c, start, by in ((x, 500.25, 1e6), (y, 500.25, 1e7), (z, 1.0, 1e4))]
    return points_view(spark, sf_dir).withColumns({"x": place[0], "y": place[1], "z": place[2]}).drop("xyz")
