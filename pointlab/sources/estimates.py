"""Class shares from a sample of files drawn by their size, with standard errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pointlab.sources.files import name_hash


def files_by_size(spark: SparkSession, path: str, draws: int, seed: int = 42) -> DataFrame:
    """path, length, draws, share (of all bytes) of the Parquet files below ``path`` that are drawn.

    Systematic sampling: files stand in the order of a hash of their paths, each as long as its bytes, and
    ``draws`` marks at equal distances from a seeded offset fall on them. So a file is drawn as often as its size
    tells, a large one surely, and the sample is spread over the order. Only the listing is read.
    """
    if draws < 2:
        raise ValueError(f"standard errors need at least 2 draws, got {draws}")
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    # One row for each file of the listing, which the driver holds anyway.
    rows = listing.select("path", "length").where("length > 0")
    order = Window.partitionBy(F.lit(0)).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "path")), "path")
    summed = rows.withColumn("end", F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    total = F.sum("length").over(Window.partitionBy(F.lit(0)))
    offset = int(name_hash("offset", seed)[:8], 16) / 2**32
    marks = lambda at: F.floor(at / total * draws + offset)
    drawn = summed.withColumn("share", F.col("length") / total).withColumn("draws", marks(F.col("end")) - marks(F.col("end") - F.col("length")))
    return drawn.where("draws > 0").select("path", "length", "draws", "share")


def class_estimate(spark: SparkSession, path: str, draws: int, label: str = "Classification", seed: int = 42) -> DataFrame:
    """label, count, share, count_error, share_error, files: estimates for all files below ``path`` from those drawn by size.

    Each draw of a file stands for its points over its chance (Horvitz-Thompson; with several draws
    of one file, Hansen-Hurwitz). Errors are standard errors over draws; that of a share is of the ratio of two
    estimates. Only drawn files are opened: their names, at most ``draws``, are a filter on the file path.
    """
    chosen = files_by_size(spark, path, draws, seed).collect()
    if not chosen:
        raise ValueError(f"no Parquet files under {path}")
    # Paths as Spark gives them in both places; plain text, so that the filter reaches the listing.
    points = spark.read.option("recursiveFileLookup", "true").parquet(path)
    names = [row.path for row in chosen]
    file = F.col("_metadata.file_path")
    counted = points.where(file.isin(names)).groupBy(file.alias("of"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("y"))
    files = spark.createDataFrame([(r.path, int(r.draws), float(r.share)) for r in chosen], "path string, draws long, share double")
    drawn = counted.join(files, F.col("path") == F.col("of"))
    # What all draws have in common is one row; a class that a file does not hold adds nothing to the sums of its own.
    weight = F.col("draws") * F.col("n") / F.col("share")
    whole = drawn.groupBy("path", "draws", "share").agg(F.sum("y").alias("n")).agg(
        F.struct((F.sum(weight) / draws).alias("all"), F.sum(weight * F.col("n") / F.col("share")).alias("nn"))
    )
    y, n = F.col("y") / F.col("share"), F.sum("y").over(Window.partitionBy("path")) / F.col("share")
    values = drawn.select("label", "draws", y.alias("y"), n.alias("n"))
    common = whole.scalar()
    sums = values.groupBy("label").agg(
        (F.sum(F.col("draws") * F.col("y")) / draws).alias("count"), *[F.sum(F.col("draws") * F.col("y") * F.col(c)).alias(f"y{c}") for c in ("y", "n")]
    ).withColumns({"m": F.lit(draws), "all": common["all"], "nn": common["nn"]})
    share = F.col("count") / F.col("all")
    spread = F.greatest(F.lit(0.0), F.col("yy") - F.col("m") * F.col("count") * F.col("count"))
    residual = F.greatest(F.lit(0.0), F.col("yy") - 2 * share * F.col("yn") + share * share * F.col("nn"))
    scale = F.col("m") * (F.col("m") - 1)
    return sums.select(
        F.col("label").alias(label), "count", share.alias("share"), F.sqrt(spread / scale).alias("count_error"),
        (F.sqrt(residual / scale) / F.col("all")).alias("share_error"), F.lit(len(chosen)).alias("files"),
    )
