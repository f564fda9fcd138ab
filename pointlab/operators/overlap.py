"""Points repeated within a distance, as where flight lines or files overlap."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.operators.neighbours import AXES, has_place
from pointlab.session import stored

# Cells have sides of the distance over the root of 3, so who is near lies at most 2 cells away.
REACH = 2
BLOCK = 2
_CELL = [f"c{a}" for a in AXES]


def connected(links: DataFrame) -> DataFrame:
    """node, component (one of its nodes) for every node of ``links`` (a, b), by contraction.

    In each round a node takes the name of the smallest node next to it, or keeps its own if that is smaller;
    links between nodes of one name go, and the names are the next round's nodes.
    """
    left = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    names = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        name = stored(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("name")), "names")
        names.append(name)
        ends = left.join(name.toDF("a", "x"), "a").join(name.toDF("b", "y"), "b").where("x <> y")
        left = stored(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not names:
        return left.toDF("node", "component")
    out = names[0].toDF("node", "component")
    for name in names[1:]:
        out = out.join(name.toDF("component", "next"), "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return out


def _boxes(nodes: DataFrame, side: float, level: int, name: str) -> DataFrame:
    """Cells of side ``side / 2**level`` in struct ``name`` and the bounds of their places."""
    bounds = [f(f"p{a}").alias(f"{end}{a}") for a in AXES for f, end in ((F.min, "low"), (F.max, "high"))]
    cell = [F.floor(F.col(f"p{a}") / side * 2**level).alias(f"c{a}") for a in AXES]
    found = nodes.groupBy(*cell).agg(*bounds)
    return found.select(F.struct(*_CELL).alias(name), F.struct(*[f"{end}{a}" for a in AXES for end in ("low", "high")]).alias(f"box_{name}"))


def _gap(a: Column, b: Column) -> Column:
    """Smallest distance that places in two boxes can have."""
    apart = [F.greatest(F.lit(0.0), a[f"low{x}"] - b[f"high{x}"], b[f"low{x}"] - a[f"high{x}"]) for x in AXES]
    return F.sqrt(sum((d * d for d in apart[1:]), apart[0] * apart[0]))


def _reach(a: Column, b: Column) -> Column:
    """Largest distance that places in two boxes can have."""
    apart = [F.greatest(a[f"high{x}"] - b[f"low{x}"], b[f"high{x}"] - a[f"low{x}"]) for x in AXES]
    return F.sqrt(sum((d * d for d in apart[1:]), apart[0] * apart[0]))


def _up(cell: Column, levels: int) -> Column:
    return F.struct(*[F.shiftright(cell[c], levels).alias(c) for c in _CELL])


def _met(cells: DataFrame) -> DataFrame:
    """Pairs a, box_a, b, box_b of different cells at most ``REACH`` apart along each axis, each pair once.

    A cell goes to its own block of ``2**BLOCK`` cells a side and to those before it that it can reach into. Only
    blocks with company are looked at, so that where cells lie apart little more than their names is shuffled.
    """
    axes = [F.sequence(F.shiftright(F.col("a")[c] - REACH, BLOCK), F.shiftright(F.col("a")[c], BLOCK)) for c in _CELL]

    def sent(*columns: str) -> DataFrame:
        out = cells.select(*columns, *[s.alias(f"{x}s") for s, x in zip(axes, AXES)])
        for i, x in enumerate(AXES):
            out = out.select(*columns, *AXES[:i], F.explode(f"{x}s").alias(x), *[f"{y}s" for y in AXES[i + 1:]])
        return out.select(*columns, F.xxhash64(*AXES).alias("block"))

    shared = stored(sent().groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "shared")
    held = sent("a", "box_a").join(shared, "block", "left_semi")
    other = held.toDF("block", "b", "box_b")
    # Two cells meet in the block where the lower of them lies, axis by axis.
    lower = F.xxhash64(*[F.shiftright(F.least(F.col("a")[c], F.col("b")[c]), BLOCK) for c in _CELL])
    near = F.lit(True)
    for c in _CELL:
        near = near & (F.abs(F.col("a")[c] - F.col("b")[c]) <= REACH)
    return held.join(other, "block").where((F.col("a") < F.col("b")) & near & (F.col("block") == lower)).drop("block")


def linked_cells(nodes: DataFrame, distance: float, side: float) -> DataFrame:
    """a, b: cells that hold two places at most ``distance`` apart, one in each.

    Two cells are judged by the bounds of what they hold: near enough as a whole, too far as a whole, or
    split in eight and judged again, until no pair of cells is undecided. A box of one place is a place, so the
    last word is an exact distance, and of two full cells few parts are ever looked at.
    """
    first = _met(stored(_boxes(nodes, side, 0, "a"), "cells"))
    a, b = F.col("box_a"), F.col("box_b")
    judged = stored(
        first.where(_gap(a, b) <= distance).select("a", "b", F.col("a").alias("part_a"), F.col("b").alias("part_b"), (_reach(a, b) <= distance).alias("linked")),
        "judged",
    )
    links, level = judged.where("linked").select("a", "b"), 0
    while True:
        settled = judged.where("linked").select("a", "b").distinct()
        open_ = judged.where("not linked").drop("linked").join(settled, ["a", "b"], "left_anti")
        if open_.isEmpty():
            return links.distinct()
        level += 1
        nodes = nodes.join(_members(open_), _CELL, "left_semi")
        if level == 1:
            nodes = stored(nodes, "places")
        parts = stored(_boxes(nodes, side, level, "sub"), "parts")
        of_a = parts.select(_up(F.col("sub"), 1).alias("part_a"), F.col("sub").alias("sub_a"), F.col("box_sub").alias("box_a"))
        of_b = parts.select(_up(F.col("sub"), 1).alias("part_b"), F.col("sub").alias("sub_b"), F.col("box_sub").alias("box_b"))
        finer = open_.join(of_a, "part_a").join(of_b, "part_b").where(_gap(a, b) <= distance)
        judged = stored(finer.select("a", "b", F.col("sub_a").alias("part_a"), F.col("sub_b").alias("part_b"), (_reach(a, b) <= distance).alias("linked")), "judged")
        links = links.unionByName(judged.where("linked").select("a", "b"))


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cell")).select("cell.*").distinct()


def merge_near_points(df: DataFrame, distance: float, order_by: Sequence[str], *, axes: Sequence[str] = AXES, merged: str = "merged") -> DataFrame:
    """One row for each cluster of points, the first by ``order_by`` and then by all columns, with the number of points.

    Points at most ``distance`` apart are in one cluster, and so are points that others link. Points without a
    place are clusters of their own. The cells have sides of ``distance / sqrt(3)``, so whatever shares a cell
    is one cluster without a look at pairs: a cell may hold any share of all points. Coordinates may be
    up to a billion cells from zero.
    """
    if not distance > 0:
        raise ValueError(f"distance must be above 0, got {distance}")
    side = distance / math.sqrt(3) * (1 - 1e-6)
    place = [F.col(x).cast("double").alias(f"p{a}") for x, a in zip(axes, AXES)]
    known = df.where(has_place(axes))
    cell = [F.floor(F.col(x).cast("double") / side).alias(c) for x, c in zip(axes, _CELL)]
    nodes = known.select(*place, *cell)
    named = stored(connected(linked_cells(nodes, distance, side)), "named")
    rest = [c for c in df.columns if c not in order_by]
    row = F.struct(*order_by, *rest)
    # Per cell first: rows are shuffled once, by the cell that also finds its cluster, and only linked cells are grouped again.
    cells = known.select(*cell, row.alias("first")).groupBy(*_CELL).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias(merged))
    firsts = stored(cells.join(named.select("node.*", "component"), _CELL, "left").select("component", "first", merged), "firsts")
    alone = firsts.where("component is null").select("first", merged)
    clusters = firsts.where("component is not null").groupBy("component").agg(F.min("first").alias("first"), F.sum(merged).alias(merged)).select("first", merged)
    columns = [F.col("first")[c].alias(c) for c in df.columns]
    return alone.unionByName(clusters).select(*columns, merged).unionByName(df.where(~has_place(axes)).withColumn(merged, F.lit(1).cast("long")))
