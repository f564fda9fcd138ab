"""Points laid out along a space-filling curve, so that a box is a few stretches of it."""

from __future__ import annotations

import math
from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "curve_key"
# Shifts and masks that move the low 32 bits of a number to its even bits.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


@dataclass(frozen=True)
class Curve:
    """A Morton curve over ``2**bits`` by ``2**bits`` cells from (``x0``, ``y0``); what lies outside counts to the edge cells."""

    x0: float
    y0: float
    side: float
    bits: int = 24

    def __post_init__(self):
        if not 1 <= self.bits <= 31 or not self.side > 0:
            raise ValueError("a curve has 1 to 31 bits and a side above 0")

    def _cell(self, value: Column, start: float) -> Column:
        """The cell number, in double as in ``cell``; NULL without a number."""
        inside = F.greatest(F.lit(0.0), F.least(F.floor((value - start) / self.side).cast("double"), F.lit(float(2**self.bits - 1))))
        return F.when(value.isNotNull() & ~F.isnan(value), inside).cast("long")

    def key(self, x: Column | str = "x", y: Column | str = "y") -> Column:
        """The place of a point's cell on the curve: bits of x and y in turn; NULL without a place."""
        out = []
        for value, start in ((x, self.x0), (y, self.y0)):
            bits = self._cell(F.col(value) if isinstance(value, str) else value, start)
            for shift, mask in _SPREAD:
                bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
            out.append(bits)
        return out[0].bitwiseOR(F.shiftleft(out[1], 1))

    def cell(self, value: float, start: float) -> int:
        return math.floor(max(0.0, min((value - start) / self.side, 2.0**self.bits - 1)))

    def intervals(self, box: tuple[float, float, float, float], most: int = 64) -> list[tuple[int, int]]:
        """At most ``most`` stretches (first, last) of the curve that hold every cell a box (x, y, to x, to y) touches.

        Squares that lie across the edge of the box are cut in four, the largest first, while there is room for
        more stretches; neighbouring stretches are one.
        """
        low = [self.cell(box[0], self.x0), self.cell(box[1], self.y0)]
        high = [self.cell(box[2], self.x0), self.cell(box[3], self.y0)]
        if box[0] > box[2] or box[1] > box[3]:
            return []
        whole: list[tuple[int, int]] = []
        cut = [(0, 0, self.bits, 0)]  # cell x, cell y, bits of the side, first key
        while cut and len(whole) + len(cut) + 3 <= most:
            x, y, bits, first = cut.pop(0)
            for quarter in range(4 if bits else 0):
                side = 1 << (bits - 1)
                qx, qy, key = x + (quarter & 1) * side, y + (quarter >> 1) * side, first + quarter * side * side
                if qx > high[0] or qy > high[1] or qx + side <= low[0] or qy + side <= low[1]:
                    continue
                if low[0] <= qx and low[1] <= qy and qx + side - 1 <= high[0] and qy + side - 1 <= high[1] or bits == 1:
                    whole.append((key, key + side * side - 1))
                else:
                    cut.append((qx, qy, bits - 1, key))
        stretches = sorted(whole + [(first, first + (1 << 2 * bits) - 1) for _, _, bits, first in cut])
        out: list[tuple[int, int]] = []
        for first, last in stretches:
            if out and first <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(last, out[-1][1]))
            else:
                out.append((first, last))
        return out

    def condition(self, box: tuple[float, float, float, float], most: int = 64) -> Column:
        """Points in the box: first by stretches of the key, which reach the Parquet scan, then exactly."""
        near = F.lit(False)
        for first, last in self.intervals(box, most):
            near = near | F.col(KEY).between(first, last)
        return near & F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])


def curve_of(df: DataFrame, bits: int = 24) -> Curve:
    """The smallest curve over all points: one row is read back."""
    row = df.where("not isnan(x) and not isnan(y)").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if row[0] is None:
        return Curve(0.0, 0.0, 1.0, bits)
    return Curve(row[0], row[2], max(row[1] - row[0], row[3] - row[2], 1e-9) / 2**bits * (1 + 1e-9), bits)


def write_curve(df: DataFrame, path: str, curve: Curve, files: int, max_records_per_file: int = 0, row_group_bytes: int = 128 << 20) -> None:
    """Overwrite ``path`` with the points in order of the curve, in ``files`` ranges of it, and the curve beside them.

    Ranges have about equal numbers of points. A cell that holds many is dealt out by a hash of its points, so it
    may be spread over several files. This is one shuffle, once, for all boxes that are read later.
    """
    keyed = df.withColumn(KEY, curve.key())
    tie = F.xxhash64(*df.columns)
    laid = keyed.repartitionByRange(files, F.col(KEY), tie).sortWithinPartitions(KEY)
    writer = laid.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    names = [f.name for f in fields(Curve)]
    df.sparkSession.createDataFrame([astuple(curve)], "x0 double, y0 double, side double, bits int").select(*names).coalesce(1).write.mode("overwrite").parquet(f"{path}/_curve")


def read_box(spark: SparkSession, path: str, box: tuple[float, float, float, float], most: int = 64) -> DataFrame:
    """Points of a table by ``write_curve`` whose x and y lie in the box (x, y, to x, to y), edges included.

    Row groups and files that hold no stretch of the box are skipped by their statistics.
    """
    curve = Curve(*spark.read.parquet(f"{path}/_curve").first())
    return spark.read.parquet(path).where(curve.condition(box, most)).drop(KEY)
