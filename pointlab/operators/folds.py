"""Folds for cross-validation made of whole blocks of space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlab.session import stored


def block_of(side: float, axes: tuple[str, str] = ("x", "y")) -> list[Column]:
    return [F.floor(F.col(a) / side).alias(f"block_{a}") for a in axes]


def block_folds(df: DataFrame, folds: int, side: float, label: str = "Classification") -> DataFrame:
    """block_x, block_y, fold (from 0) for each block of ``side`` that holds labelled points.

    Blocks are dealt greedily by what they hold most of, so that every class is spread evenly: those of each
    leading class go from the largest to the smallest to the folds in turn, there and back, and each class
    begins where the one before it left off, so that sizes stay even too. One pass over the points makes
    one row a block and class; all that follows is about blocks, of which ``side`` sets the number.
    """
    if folds < 2:
        raise ValueError("cross-validation needs at least 2 folds; one leaves no rows to train on")
    x, y = block_of(side)
    per_class = df.where(F.col(label).isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy(x, y, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # The class a block holds most of; ties go to the smallest.
    blocks = per_class.groupBy("block_x", "block_y").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("less"), "label"))["label"].alias("leading"))
    blocks = stored(blocks, "blocks")
    starts = blocks.groupBy("leading").agg(F.count(F.lit(1)).alias("blocks")).select(
        F.col("leading").alias("of"), (F.sum("blocks").over(Window.partitionBy(F.lit(0)).orderBy("leading")) - F.col("blocks")).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("leading").orderBy(F.desc("n"), "block_x", "block_y")) - 1
    placed = blocks.withColumn("place", place).join(starts, F.col("leading") == F.col("of"))
    turn = F.pmod(F.col("place") + F.col("start"), F.lit(2 * folds))
    fold = F.when(turn < folds, turn).otherwise(2 * folds - 1 - turn)
    return placed.select("block_x", "block_y", fold.cast("int").alias("fold"))


def with_fold(df: DataFrame, folds: int, side: float, label: str = "Classification", name: str = "fold") -> DataFrame:
    """``df`` with the fold of each labelled point's block; neighbours in a block are always in one fold.
    Points without a class or a place have no fold. Use it as ``foldCol`` of a cross-validation."""
    dealt = block_folds(df, folds, side, label).toDF("of_x", "of_y", name)
    joined = df.drop(name).join(dealt, (F.floor(F.col("x") / side) == F.col("of_x")) & (F.floor(F.col("y") / side) == F.col("of_y")), "left").drop("of_x", "of_y")
    return joined.withColumn(name, F.when(F.col(label).isNotNull(), F.col(name)))
