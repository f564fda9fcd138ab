"""Confidence intervals of the classification metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.operators.scoring import metrics_of_confusion

METRICS = ("accuracy", "f1", "weighted_precision", "weighted_recall")
HASH_BITS = 32


def poisson_bounds(bits: int = HASH_BITS, most: int = 12) -> list[int]:
    """Numbers of ``bits`` bits below which a Poisson count of mean 1 is at most 0, 1, 2 and so on."""
    share, total, out = math.exp(-1.0), 0.0, []
    for k in range(most):
        total += share
        out.append(math.floor(total * 2**bits))
        share /= k + 1
    return out


def poisson_weight(number: Column, bits: int = HASH_BITS) -> Column:
    """How many of the bounds a number lies at or above: a Poisson count of mean 1."""
    return sum(((number >= bound).cast("int") for bound in poisson_bounds(bits)[1:]), (number >= poisson_bounds(bits)[0]).cast("int"))


def replicate_number(key: Column, replicate: Column, hasher: str = "xxhash64") -> Column:
    """A number of 32 bits for a row and a replicate; ``md5`` gives those that other engines reproduce."""
    if hasher == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(key, replicate), 64 - HASH_BITS)
    if hasher == "md5":
        text = F.concat_ws("|", key.cast("string"), replicate.cast("string"))
        return F.coalesce(F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long"), F.lit(0))
    raise ValueError(f"hasher must be xxhash64 or md5, got {hasher}")


def weight_of_digest(digest: Column) -> Column:
    """``poisson_weight`` of the number that a digest in base 16 begins with, without making it a number.

    Digits of one length sort as their numbers do, and a longer text is not below one that it begins with.
    """
    out = F.lit(len(poisson_bounds()))
    for k, bound in reversed(list(enumerate(poisson_bounds()))):
        out = F.when(digest < f"{bound:0{HASH_BITS // 4}x}", k).otherwise(out)
    return out


def bootstrap_confusion(df: DataFrame, key: Column, replicates: int, label: str = "Classification", prediction: str = "prediction",
                        by: Sequence[str] = (), hasher: str = "xxhash64") -> DataFrame:
    """by, replicate, label, prediction, n: confusion counts of every replicate, replicate 0 being the rows as they are.

    In the others each row counts a Poisson number of times that comes from its own key and the replicate. One
    pass; a task sends one row for each replicate and pair of classes.
    """
    if hasher not in ("xxhash64", "md5"):
        raise ValueError(f"hasher must be xxhash64 or md5, got {hasher}")
    # The texts of ``replicate_number``, written once for each row and each replicate and not for each pair of them.
    begin = F.coalesce(F.concat(key.cast("string"), F.lit("|")), F.lit(""))
    ends = F.array(*[F.lit(str(r)) for r in range(replicates + 1)])
    rows = df.where(F.col(label).isNotNull()).select(
        *by, F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"), key.alias("row_key"),
        begin.alias("row_text"), F.posexplode(ends).alias("replicate", "replicate_text"),
    )
    if hasher == "md5":
        number, weigh = F.md5(F.concat("row_text", "replicate_text")), weight_of_digest
    else:
        number, weigh = replicate_number(F.col("row_key"), F.col("replicate"), hasher), poisson_weight
    # Through a generator, so that the bounds do not compute it once more each; the rows as they are draw nothing.
    drawn = F.when(F.col("replicate") > 0, number)
    weight = F.when(F.col("replicate") == 0, F.lit(1)).otherwise(weigh(F.col("number")))
    counted = rows.withColumn("number", F.explode(F.array(drawn))).groupBy(*by, "replicate", "label", "prediction").agg(F.sum(weight).alias("n"))
    return counted.where("n > 0")


def metric_intervals(df: DataFrame, key: Column, replicates: int = 200, confidence: float = 0.95, label: str = "Classification",
                     prediction: str = "prediction", by: Sequence[str] = (), hasher: str = "xxhash64") -> DataFrame:
    """by, metric, value, low, high: each metric, and the interval that holds ``confidence`` of its values in
    ``replicates`` bootstrap replicates (percentiles, by rank)."""
    if replicates < 1 or not 0 < confidence < 1:
        raise ValueError("at least one replicate and a confidence between 0 and 1 are needed")
    metrics = metrics_of_confusion(bootstrap_confusion(df, key, replicates, label, prediction, by, hasher), [*by, "replicate"])
    long = metrics.unpivot([*by, "replicate"], list(METRICS), "metric", "value")
    drawn = F.array_sort(F.collect_list(F.when(F.col("replicate") > 0, F.col("value"))))
    # At most ``replicates`` values in a group.
    grouped = long.groupBy(*by, "metric").agg(F.max(F.when(F.col("replicate") == 0, F.col("value"))).alias("value"), drawn.alias("drawn"))
    tail = (1 - confidence) / 2
    at = lambda share: F.get("drawn", F.greatest(F.lit(0), F.ceil(F.size("drawn") * F.lit(share)) - 1).cast("int"))
    return grouped.select(*by, "metric", "value", at(tail).alias("low"), at(1 - tail).alias("high"))
