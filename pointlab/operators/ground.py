"""Height above the ground around a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.session import stored

# Fixed value: the raw code of ground points.
GROUND_CODE = 2


def _same(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out


def ground_cells(df: DataFrame, is_ground: Column, side: float, levels: int) -> DataFrame:
    """split, cx, cy, ground, level for each cell that holds points: the lowest ground in it, or in the smallest
    larger cell around it that has some; NULL where there is none up to the last level.

    One pass over the points makes the finest cells. The coarser ones are made of them in one grouping by
    level and cell, and only cells without ground look theirs up there.
    """
    x, y = (F.floor(F.col(c) / side) for c in ("x", "y"))
    split = F.col("split") if "split" in df.columns else F.lit(None).cast("string")
    lowest = F.min(F.when(is_ground & ~F.isnan("z"), F.col("z")))
    finest = stored(df.where("x is not null and y is not null").groupBy(split.alias("split"), x.alias("cx"), y.alias("cy")).agg(lowest.alias("ground")), "cells")
    up = F.explode(F.sequence(F.lit(1), F.lit(levels)))

    def larger(cells: DataFrame) -> DataFrame:
        return cells.withColumn("level", up).withColumns({f"{c}_up": F.call_function("shiftright", F.col(c), F.col("level")) for c in ("cx", "cy")})

    known = larger(finest.where("ground is not null")).groupBy("split", "level", "cx_up", "cy_up").agg(F.min("ground").alias("ground"))
    known = known.toDF("of_split", "of_level", "of_x", "of_y", "found")
    empty = larger(finest.where("ground is null").drop("ground"))
    met = empty.join(known, _same([F.col(c) for c in ("split", "level", "cx_up", "cy_up")], [F.col(c) for c in ("of_split", "of_level", "of_x", "of_y")]), "left")
    nearest = F.min(F.when(F.col("found").isNotNull(), F.struct("level", "found")))
    filled = met.groupBy("split", "cx", "cy").agg(nearest.alias("best")).select("split", "cx", "cy", F.col("best.found").alias("ground"), F.col("best.level").alias("level"))
    return finest.where("ground is not null").withColumn("level", F.lit(0)).unionByName(filled)


def height_above_ground(df: DataFrame, *, is_ground: Column | None = None, side: float = 1.0, levels: int = 16) -> DataFrame:
    """Add ``ground`` and ``height``, the height above the lowest ground point around, and ``ground_level``.

    Around is the cell of ``side`` that the point lies in; where that has no ground point, the cell of twice the
    side, and so on ``levels`` times. ``is_ground`` marks ground points, by default the raw ground code. Each
    split has its own ground, as it has its own lowest point. Two scans of the points: one that groups
    them by cell, one that looks the cells up; a cell may hold any share of them.
    """
    if not side > 0 or levels < 1:
        raise ValueError(f"side must be above 0 and levels at least 1, got {side} and {levels}")
    marked = F.coalesce(F.col("Classification") == GROUND_CODE if is_ground is None else is_ground, F.lit(False))
    cells = ground_cells(df, marked, side, levels).toDF("of_split", "of_x", "of_y", "ground", "ground_level")
    own = [F.col("split") if "split" in df.columns else F.lit(None).cast("string"), F.floor(F.col("x") / side), F.floor(F.col("y") / side)]
    joined = df.drop("ground", "height", "ground_level").join(cells, _same(own, [F.col(c) for c in ("of_split", "of_x", "of_y")]), "left")
    return joined.drop("of_split", "of_x", "of_y").withColumn("height", F.col("z") - F.col("ground"))
