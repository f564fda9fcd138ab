"""Points and their nearest neighbours in space, and points that lie far from theirs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.operators.features import table_statistics
from pointlab.session import stored

AXES = ("x", "y", "z")
FINEST = 0.001  # side of the smallest cells, in the unit of the coordinates
BLOCK = 2  # a block has 2**BLOCK cells a side where many places ask


def has_place(axes: Sequence[str] = AXES) -> Column:
    """True where every coordinate is a finite number."""
    ok = F.lit(True)
    for axis in axes:
        c = F.col(axis).cast("double")
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return ok


def places(df: DataFrame, axes: Sequence[str], finest: float) -> DataFrame:
    """Distinct coordinates px, py, pz with the number n of points there, and their smallest cells cx, cy, cz."""
    coordinates = [F.col(a).cast("double").alias(f"p{name}") for a, name in zip(axes, AXES)]
    found = df.where(has_place(axes)).select(*coordinates).groupBy("px", "py", "pz").agg(F.count(F.lit(1)).alias("n"))
    return found.select("*", *smallest_cells(finest))


def smallest_cells(finest: float) -> list[Column]:
    return [F.floor(F.col(f"p{a}") / finest).alias(f"c{a}") for a in AXES]


@dataclass(frozen=True)
class Grid:
    """Cells of side ``finest * 2**level``; levels from 0 to ``top``, where any two places are in neighbouring cells.

    ``low`` and ``high`` are the outermost smallest cells with places, by axis.
    """

    finest: float
    start: int
    top: int
    low: tuple[int, ...]
    high: tuple[int, ...]

    def side(self, level: int) -> float:
        return self.finest * 2**level

    @staticmethod
    def cell(level: int) -> list[Column]:
        return [F.shiftright(f"c{a}", level).alias(a) for a in AXES]


def grid_of(nodes: DataFrame, finest: float, crowd: int) -> Grid | None:
    """The grid of some places, starting where a cell holds about ``crowd`` of them if they lie evenly over x and y."""
    ends = [F.min(f"c{a}").alias(f"low_{a}") for a in AXES] + [F.max(f"c{a}").alias(f"high_{a}") for a in AXES]
    row = nodes.agg(F.count(F.lit(1)).alias("n"), *ends).first()
    if not row.n:
        return None
    spans = [row[f"high_{a}"] - row[f"low_{a}"] + 1 for a in AXES]
    top = math.ceil(math.log2(max(spans)))
    even = math.sqrt(spans[0] * spans[1] * crowd / row.n)
    low, high = (tuple(row[f"{end}_{a}"] for a in AXES) for end in ("low", "high"))
    return Grid(finest, min(top, max(0, math.floor(math.log2(max(even, 1))))), top, low, high)


def start_levels(nodes: DataFrame, grid: Grid, crowd: int) -> dict[int, DataFrame]:
    """Places by the level at which their search begins: crowded cells are split until they are not, or are the smallest."""
    found, pending, level, step = {}, nodes, grid.start, 1
    while level > 0:
        full = stored(pending.groupBy(*grid.cell(level)).agg(F.count(F.lit(1)).alias("places")).where(F.col("places") > crowd), "crowded")
        most = full.agg(F.max("places")).first()[0]
        if most is None:
            break
        full = full.drop("places")
        placed = pending.select("*", *grid.cell(level))
        found[level] = stored(placed.join(full, list(AXES), "left_anti").drop(*AXES), "places")
        pending = stored(placed.join(full, list(AXES), "left_semi").drop(*AXES), "places")
        # As far down as the fullest cell needs at least, if its places lie evenly; farther where no cell was empty enough.
        step = 2 * step if found[level].isEmpty() else 1
        level = max(0, level - max(step, int(math.log(most / crowd, 8))))
    found[level] = pending
    return found


def _ranges(level: int, block: int, grid: Grid) -> list[Column]:
    """By axis, the blocks of ``2**block`` cells a side that hold a place's cell or one next to it, and that may hold places."""
    out = []
    for a, low, high in zip(AXES, grid.low, grid.high):
        cell, ends = F.shiftright(f"c{a}", level), (low >> level + block, high >> level + block)
        before, after = F.shiftright(cell - 1, block), F.shiftright(cell + 1, block)
        out.append(F.sequence(F.greatest(before, F.lit(ends[0])), F.least(after, F.lit(ends[1]))))
    return out


def _around(df: DataFrame, columns: Sequence[str], ranges: Sequence[Column]) -> DataFrame:
    """``columns`` of each row once for every block x, y, z of its ranges."""
    out = df.select(*columns, *[r.alias(f"{a}s") for a, r in zip(AXES, ranges)])
    for i, a in enumerate(AXES):
        out = out.select(*columns, *AXES[:i], F.explode(f"{a}s").alias(a), *[f"{b}s" for b in AXES[i + 1:]])
    return out


def _nearest(asks: DataFrame, nodes: DataFrame, grid: Grid, level: int, k: int, crowd: int) -> DataFrame:
    """px, py, pz, n, distances: the places asked, with up to ``k`` smallest distances to points around, all of those within a side of a cell.

    Places are gathered by blocks of cells, each with the cells around it, so a place is shuffled a few
    times at most where many ask; pairs are met within a row and never shuffled. Where few ask, a block is one cell and
    places far from all who ask stay out. A block whose places could be more than a crowd in each of its
    cells is dealt into parts, and who asks in it asks in every part.
    """
    few = asks.count() * 8 < nodes.count()
    block = 0 if few else BLOCK
    place, home = ["px", "py", "pz"], Grid.cell(level + block)
    if few:
        touched = _around(asks, [], _ranges(level, 0, grid)).distinct()
        near_asks = nodes.select(*place, "n", *Grid.cell(level)).join(touched, list(AXES), "left_semi").drop(*AXES)
        nodes = stored(near_asks, "touched").select("*", *smallest_cells(grid.finest))
    most = crowd * 4**3
    dense = nodes.groupBy(*Grid.cell(level + block)).agg(F.count(F.lit(1)).alias("places")).where(F.col("places") > most)
    wide = [F.sequence(F.col(a) - 1, F.col(a) + 1) for a in AXES]
    parts = stored(
        _around(dense.withColumn("parts", F.ceil(F.col("places") / most).cast("int")), ["parts"], wide).groupBy(*AXES).agg(F.max("parts").alias("parts")), "parts"
    )
    need = asks.select(*home).distinct()
    held = _around(nodes, [*place, "n"], _ranges(level, block, grid)).join(need, list(AXES), "left_semi")
    asked, keys = asks.select(*place, "n", *home), list(AXES)
    dealt = not parts.isEmpty()
    if dealt:
        count = F.coalesce("parts", F.lit(1))
        held = held.join(parts, list(AXES), "left").withColumn("part", F.pmod(F.xxhash64(*place), count)).drop("parts")
        asked = asked.join(parts, list(AXES), "left").withColumn("part", F.explode(F.sequence(F.lit(0), count - 1)).cast("long")).drop("parts")
        keys.append("part")
    # Of a place with many copies, as many as can matter; one of them is the asking point itself.
    others = F.collect_list(F.struct(*[F.col(f"p{a}").alias(f"q{a}") for a in AXES], F.least("n", F.lit(k + 1)).cast("int").alias("copies")))
    lists = held.groupBy(*keys).agg(others.alias("others"))
    lists = lists.withColumn("others", F.flatten(F.transform("others", lambda q: F.array_repeat(q, q["copies"]))))

    def square(q: Column) -> Column:
        apart = [F.col(f"p{a}") - q[f"q{a}"] for a in AXES]
        return apart[0] * apart[0] + apart[1] * apart[1] + apart[2] * apart[2]

    def within(q: Column) -> Column:
        return (F.abs(F.col("px") - q["qx"]) <= grid.side(level)) & (F.abs(F.col("py") - q["qy"]) <= grid.side(level))

    # What lies farther than a side settles nothing, but where there are no wider rings.
    met = F.col("others") if level == grid.top else F.filter("others", within)
    near = asked.join(lists, keys).select(*place, "n", F.slice(F.sort_array(F.transform(met, square)), 1, k + 1).alias("squares"))
    if dealt:
        near = near.groupBy(*place, "n").agg(F.slice(F.sort_array(F.flatten(F.collect_list("squares"))), 1, k + 1).alias("squares"))
    return near.select(*place, "n", F.transform(F.slice("squares", 2, k), F.sqrt).alias("distances"))


def crowd_for(k: int) -> int:
    """Places in a cell beyond which it is split: enough that the cells around mostly hold the ``k`` nearest."""
    return max(8, 2 * k)


def nearest_distances(nodes: DataFrame, k: int, *, finest: float = FINEST, crowd: int | None = None) -> DataFrame | None:
    """px, py, pz, distances (to the ``k`` nearest points, smallest first; fewer if there are no more) for all places.

    Exact for any grid. A place looks through the 27 cells around it, so whatever lies within the side of a
    cell is found; if the k-th distance is larger, it goes on with cells of twice the side. Searches begin
    in small cells where points are dense, so that the number of places met stays about the same.
    """
    crowd = crowd or crowd_for(k)
    grid = grid_of(nodes, finest, crowd)
    if grid is None:
        return None
    starts = start_levels(nodes, grid, crowd)
    done, waiting, level, step = [], None, min(starts), 1
    while True:
        asks = starts.pop(level, None)
        if waiting is not None:
            asks = waiting if asks is None else asks.unionByName(waiting)
        found = _nearest(asks, nodes, grid, level, k, crowd)
        inside = F.lit(level == grid.top) | F.coalesce((F.size("distances") >= k) & (F.get("distances", F.lit(k - 1)) <= grid.side(level)), F.lit(False))
        found = stored(found.withColumn("settled", inside), "nearest")
        done.append(found.where("settled").select("px", "py", "pz", "distances"))
        waiting = found.where("not settled").select("px", "py", "pz", "n", *smallest_cells(finest))
        if waiting.isEmpty():
            waiting = None
            if not starts:
                break
            level = min(starts)
            continue
        # Where nothing was near enough, the next ring is wider by more.
        step = 1 if not done[-1].isEmpty() else 2 * step
        level = min([level + step, grid.top, *(x for x in starts if x > level)])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def neighbour_distance(df: DataFrame, k: int = 8, *, axes: Sequence[str] = AXES, name: str = "neighbour_distance",
                       finest: float = FINEST, crowd: int | None = None) -> DataFrame:
    """Add the mean distance from each point to its ``k`` nearest other points.

    Points at the same place are neighbours at distance 0; they are counted, and searched for once. NULL
    where a point has no place or there is no other point. Beside the points themselves, places are
    shuffled once for each level of cells that is searched.
    """
    nodes = stored(places(df, axes, finest), "places")
    found = nearest_distances(nodes, k, finest=finest, crowd=crowd)
    if found is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    total = F.aggregate("distances", F.lit(0.0), lambda s, d: s + d)
    means = found.select("px", "py", "pz", F.when(F.size("distances") > 0, total / F.size("distances")).alias(name))
    same = [F.col(a).cast("double") == F.col(f"p{p}") for a, p in zip(axes, AXES)]
    return df.drop(name).join(means, same, "left").drop("px", "py", "pz")


def drop_neighbour_outliers(df: DataFrame, k: int = 8, deviations: float = 3.0, *, axes: Sequence[str] = AXES,
                            finest: float = FINEST, crowd: int | None = None) -> DataFrame:
    """Points whose mean distance to their ``k`` nearest neighbours is at most ``deviations`` standard deviations
    above the mean of all; points without such a distance are left to the missing-value operators."""
    measured = stored(neighbour_distance(df, k, axes=axes, finest=finest, crowd=crowd), "measured")
    own = F.col("neighbour_distance")
    stats = table_statistics(measured, False, mean=F.avg(own), sd=F.stddev_samp(own))
    near = own <= stats["mean"] + F.lit(float(deviations)) * stats["sd"]
    return measured.where(F.coalesce(near, F.lit(True)))
