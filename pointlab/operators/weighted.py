"""Weighted samples of a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlab.functions.columns import KEY_BITS
from pointlab.operators.sampling import key_of_point, write_copies
from pointlab.session import stored

BINS = 4096
FEW = 10_000  # rows that one task may put in order


def exponential_key(weight: Column, hasher: str = "xxhash64") -> Column:
    """``-ln(u) / weight`` for a number u between 0 and 1 from the point's own values; NULL unless the weight is above 0."""
    u = (key_of_point(hasher).cast("double") + 0.5) / float(2**KEY_BITS)
    w = weight.cast("double")
    return F.when((w > 0) & ~F.isnan(w), -F.log(u) / w)


def weighted_sample(df: DataFrame, size: int, weight: str, hasher: str = "xxhash64", columns: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``size`` rows (all, if there are fewer with a weight), drawn without replacement by weight.

    Each row has an exponential key; the rows with the smallest ones are the sample, so a smaller sample lies
    inside a larger one, and the sample does not depend on the partitioning. The key up to which rows are
    taken is found by histograms: each pass counts the rows between two bounds in 4096 bins and goes on with the
    bin in which the ``size``-th row falls, until it holds few rows. Nothing is sorted, and one row comes
    back to the driver for each pass. Equal points have equal keys; they are counted, and as many of them as still
    fit are written out. ``columns`` are those that tell rows apart (all, if not given).
    """
    if size < 0:
        raise ValueError(f"size must not be negative, got {size}")
    keyed = df.withColumn("sample_key", F.explode(F.array(exponential_key(F.col(weight), hasher)))).where("sample_key is not null")
    row = keyed.agg(F.count(F.lit(1)).alias("n"), F.min("sample_key").alias("low"), F.max("sample_key").alias("high")).first()
    if row.n <= size:
        return keyed.drop("sample_key")
    if not size:
        return keyed.where(F.lit(False)).drop("sample_key")
    low, high, n, rest = row.low, row.high, row.n, size
    key = F.col("sample_key")
    while n > FEW and low < high:
        place = F.least(F.floor((key - low) / (high - low) * BINS), F.lit(BINS - 1))
        counted = keyed.where(key.between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bin")) - F.col("n")
        hit = counted.withColumn("before", before).where((F.col("before") < rest) & (F.col("before") + F.col("n") >= rest)).first()
        low, high, n, rest = hit.low, hit.high, hit.n, rest - hit.before
    whole = keyed.where(key < low).drop("sample_key")
    names = list(columns or df.columns)
    # Copies are one row with a count; what is put in order are at most FEW rows, or different ones with one key.
    distinct = stored(keyed.where(key.between(low, high)).groupBy("sample_key", *df.columns).agg(F.count(F.lit(1)).alias("times")), "edge")
    order = Window.partitionBy(F.lit(0)).orderBy("sample_key", *names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("times").over(order) - F.col("times")
    left = F.greatest(F.lit(0), F.least(F.col("times"), F.lit(rest) - before)).cast("long")
    edge = distinct.withColumn("wanted", left).select(*df.columns, F.col("wanted").alias("times"))
    return whole.unionByName(write_copies(edge, "times"))
