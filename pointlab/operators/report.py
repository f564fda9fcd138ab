"""Class counts, distributions and summaries.

Every report reads the points once. What follows the first aggregate works on a few rows per
class, so windows over it stay small whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointlab.functions import percent
from pointlab.schema import SPLITS
from pointlab.sources import legend as default_legend


def class_counts(df: DataFrame, by: Sequence[str] = ("Classification",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, by: Sequence[str] = (), *, counts: bool = False) -> DataFrame:
    """Share of each class in percent, per group of ``by``; points without a class are a row too.

    The total is summed from the class counts, so the points are scanned once, not twice.
    ``counts`` keeps the rows per class beside their share.
    """
    table = class_counts(df, [*by, "Classification"])
    total = F.sum("n").over(Window.partitionBy(*by))
    kept = ["n"] if counts else []
    return table.select(*by, "Classification", *kept, percent(F.col("n"), total).alias("percentage"))


def describe_classes(df: DataFrame, legend: DataFrame | None = None) -> DataFrame:
    """Add ``Description`` by a left join.

    The built-in legend has eight rows and is broadcast; for any other one Spark decides by size.
    """
    small = F.broadcast(default_legend(df.sparkSession)) if legend is None else legend
    return df.join(small, "Classification", "left")


def distribution_report(df: DataFrame, legend: DataFrame | None = None, digits: int = 2) -> DataFrame:
    """Share of each land-cover class in train, test and val side by side, in class order.

    One conditional aggregate over all splits. A class absent from a split has share 0, and
    points without a class stay one row with no class.
    """
    counts = df.groupBy("Classification").agg(
        *[F.count_if(F.col("split") == split).alias(split) for split in SPLITS]
    )
    everything = Window.partitionBy()
    shares = counts.select(
        "Classification",
        *[
            F.coalesce(F.try_divide(F.col(split), F.sum(split).over(everything)) * 100, F.lit(0.0)).alias(split)
            for split in SPLITS
        ],
    )
    order = ("train", "test", "val")
    return (
        describe_classes(shares, legend)
        .select(
            "Classification",
            "Description",
            *[F.round(split, digits).alias(split.capitalize()) for split in order],
        )
        .orderBy("Classification")
    )


def outer_join_distributions(tables: dict[str, DataFrame], *, null_safe: bool = True) -> DataFrame:
    """Full outer join of single-split distributions, one percentage column per split.

    ``null_safe`` joins the rows without a class to each other. Without it they never match, and
    each split that has such points adds a row of its own. Absent shares become 0; the class
    itself is never filled.
    """
    names = list(tables)
    joined = tables[names[0]].withColumnRenamed("percentage", names[0])
    for name in names[1:]:
        other = tables[name].withColumnRenamed("percentage", name)
        if null_safe:
            other = other.withColumnRenamed("Classification", "other_class")
            joined = joined.join(other, F.col("Classification").eqNullSafe(F.col("other_class")), "full_outer")
            joined = joined.withColumn("Classification", F.coalesce("Classification", "other_class"))
            joined = joined.drop("other_class")
        else:
            joined = joined.join(other, "Classification", "full_outer")
    return joined.fillna(0, subset=names)


def feature_summary(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of each column, per class."""
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        aggregates += [
            F.struct(
                F.count(name).alias("n"),
                F.round(F.avg(name), digits).alias("mean"),
                F.round(F.stddev_samp(name), digits).alias("sd"),
                F.round(F.min(name).cast("double"), digits).alias("min"),
                F.round(F.max(name).cast("double"), digits).alias("max"),
            ).alias(name)
        ]
    wide = df.groupBy("Classification").agg(*aggregates)
    long = wide.unpivot(["Classification", "n_rows"], list(columns), "column_name", "s")
    return long.select("Classification", "n_rows", "column_name", "s.*")
