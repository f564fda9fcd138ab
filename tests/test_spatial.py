from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from conftest import collect, plan_of
from pyspark.sql import functions as F

from pointlab.operators import ground, neighbours, overlap
from pointlab.operators.taskmetrics import measured, task_metrics
from pointlab.session import scratch_root
from pointlab.sources import curve

XYZ = "id long, x double, y double, z double"


@pytest.fixture(scope="module")
def cloud():
    """Dense and sparse stretches, copies of a place, and points without one."""
    rng = random.Random(4)
    rows = [(rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(0, 5)) for _ in range(120)]
    rows += [(50 + rng.gauss(0, 0.01), 50 + rng.gauss(0, 0.01), rng.gauss(0, 0.01)) for _ in range(120)]
    rows += [(7.0, 7.0, 1.0)] * 12 + [(-3000.0, 4000.0, 0.0), (1e5, -1e5, 10.0), (0.0, -0.0, 0.0), (-0.0, 0.0, 0.0)]
    rows += [(None, 1.0, 1.0), (1.0, float("nan"), 1.0), (1.0, 1.0, float("inf"))]
    return [(i, *r) for i, r in enumerate(rows)]


def placed(rows):
    return [r for r in rows if all(c is not None and math.isfinite(c) for c in r[1:])]


@pytest.mark.parametrize("k, finest, crowd", [(5, 0.002, 8), (30, 0.5, 1000), (300, 50.0, 64)])
def test_neighbour_distances_are_exact(spark, cloud, k, finest, crowd):
    own = placed(cloud)
    expected = {}
    for a in own:
        near = sorted(math.dist(a[1:], b[1:]) for b in own if b is not a)[:k]
        expected[a[0]] = sum(near) / len(near)
    rows = spark.createDataFrame(cloud, XYZ)
    got = {r.id: r.neighbour_distance for r in neighbours.neighbour_distance(rows, k, finest=finest, crowd=crowd).collect()}
    assert len(got) == len(cloud)
    for i, *_ in cloud:
        assert (got[i] is None) == (i not in expected)
        assert i not in expected or math.isclose(got[i], expected[i], rel_tol=1e-9, abs_tol=1e-9)


def test_no_cell_holds_more_than_a_crowd(spark, cloud):
    nodes = neighbours.places(spark.createDataFrame(cloud, XYZ), ("x", "y", "z"), 0.001)
    grid = neighbours.grid_of(nodes, 0.001, 16)
    starts = neighbours.start_levels(nodes, grid, 16)
    assert len(starts) >= 1 and sum(t.count() for t in starts.values()) == nodes.count()
    for level, table in starts.items():
        assert level == 0 or max((r["count"] for r in table.groupBy(*grid.cell(level)).count().collect()), default=0) <= 16


def test_outliers_by_neighbours(spark, cloud):
    rows = spark.createDataFrame(cloud, XYZ)
    kept = {r.id for r in neighbours.drop_neighbour_outliers(rows, 3, 3.0, finest=0.1).collect()}
    gone = {i for i, *_ in cloud} - kept
    assert gone == {i for i, x, *_ in cloud if x == 1e5}
    assert neighbours.neighbour_distance(rows.where("false")).count() == 0
    assert [r.neighbour_distance for r in neighbours.neighbour_distance(rows.where("id = 0")).collect()] == [None]


def test_pairs_of_neighbours_are_not_shuffled(spark, event_log):
    rng = random.Random(9)
    rows = [(i, rng.uniform(0, 1000), rng.uniform(0, 1000), rng.uniform(0, 5)) for i in range(4000)]
    df = spark.createDataFrame(rows, XYZ).repartition(4).cache()
    df.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with measured() as meter:
            assert neighbours.neighbour_distance(df, 4, finest=1.0).where("neighbour_distance is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = task_metrics(event_log(), meter.begin_ms, meter.end_ms).first().shuffleRecordsWritten
    assert shuffled < 25 * len(rows)


# Repeated within a distance


def clusters(rows, distance):
    parent = {r[0]: r[0] for r in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in rows:
        for b in rows:
            if a[0] < b[0] and math.dist(a[1:], b[1:]) <= distance:
                x, y = find(a[0]), find(b[0])
                parent[max(x, y)] = min(x, y)
    return Counter(find(r[0]) for r in rows)


@pytest.mark.parametrize("distance", [0.004, 8.0])
def test_near_points_against_all_pairs(spark, cloud, distance):
    got = overlap.merge_near_points(spark.createDataFrame(cloud, XYZ), distance, ["id"])
    assert got.columns == ["id", "x", "y", "z", "merged"]
    expected = clusters(placed(cloud), distance)
    out = {r.id: r.merged for r in got.collect()}
    assert out == expected | {r[0]: 1 for r in cloud if r not in placed(cloud)}


def test_two_full_cells_are_told_apart_exactly(spark):
    """Two sheets of points a little nearer and a little farther than the distance."""
    for gap, n in ((0.999, 1), (1.001, 2)):
        sheet = [(i * 0.02, j * 0.02) for i in range(8) for j in range(8)]
        rows = [(k, x, y, 0.0) for k, (x, y) in enumerate(sheet)] + [(1000 + k, x + 0.4 * 0.02, y, gap) for k, (x, y) in enumerate(sheet)]
        got = overlap.merge_near_points(spark.createDataFrame(rows, XYZ), math.hypot(1.0, 0.4 * 0.02), ["id"])
        assert sorted(r.merged for r in got.collect()) == ([128] if n == 1 else [64, 64])


def test_a_chain_is_one_cluster(spark):
    rows = [(i, i * 0.9, 0.0, 0.0) for i in range(100)] + [(900, 500.0, 0.0, 0.0)]
    got = overlap.merge_near_points(spark.createDataFrame(rows, XYZ).repartition(7), 1.0, ["id"])
    assert collect(got.select("id", "merged"), "id") == [(0, 100), (900, 1)]
    assert overlap.merge_near_points(spark.createDataFrame([], XYZ), 1.0, ["id"]).count() == 0
    with pytest.raises(ValueError):
        overlap.merge_near_points(got, 0.0, ["id"])


def test_lonely_points_are_shuffled_a_few_times_only(spark, event_log):
    rng = random.Random(10)
    rows = [(i, rng.uniform(0, 1e5), rng.uniform(0, 1e5), rng.uniform(0, 5)) for i in range(4000)]
    df = spark.createDataFrame(rows, XYZ).repartition(4).cache()
    df.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with measured() as meter:
            assert overlap.merge_near_points(df, 20.0, ["id"]).agg(F.sum("merged")).first()[0] == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert task_metrics(event_log(), meter.begin_ms, meter.end_ms).first().shuffleRecordsWritten < 15 * len(rows)


# Ground


def test_ground_is_taken_from_the_smallest_cell_that_has_some(spark):
    rows = [
        ("a", 0.5, 0.5, 3.0, 2), ("a", 0.6, 0.5, 1.0, 2), ("a", 0.7, 0.7, 9.0, 5),  # own cell
        ("a", 1.5, 0.5, 4.0, 5),  # twice the side
        ("a", -0.5, 0.5, 6.0, 5),  # never meets a positive cell
        ("a", 100.0, 0.5, 7.0, 5), ("b", 0.5, 0.5, 8.0, None), (None, 0.5, 0.5, 2.0, 2), (None, 3.5, 0.5, 5.0, 6), ("a", None, 0.5, 1.0, 2), ("a", 0.1, 0.1, None, 2),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, split string, x double, y double, z double, Classification int")
    out = ground.height_above_ground(df, side=1.0, levels=3)
    got = {r.id: (r.ground, r.ground_level, r.height) for r in out.collect()}
    nothing = (None, None, None)
    assert got == {0: (1.0, 0, 2.0), 1: (1.0, 0, 0.0), 2: (1.0, 0, 8.0), 3: (1.0, 1, 3.0), 4: nothing, 5: nothing, 6: nothing,
                   7: (2.0, 0, 0.0), 8: (2.0, 2, 3.0), 9: nothing, 10: (1.0, 0, None)}
    whole = ground.height_above_ground(df.drop("split"), side=1.0, levels=8)
    assert {r.id: r.ground_level for r in whole.collect()}[5] == 7
    assert ground.height_above_ground(df.where("false")).count() == 0


# Boxes


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curve") / "points")
    points = spark.range(40_000).select("id", ((F.col("id") * 7919) % 40_000 / 40.0).alias("x"), ((F.col("id") * 104_729) % 40_009 / 40.0).alias("y"))
    points = points.union(spark.sql("select -1L, cast(null as double), 1d union all select -2L, double('nan'), 1d"))
    curve.write_curve(points, path, curve.curve_of(points, bits=12), files=16, row_group_bytes=1 << 20)
    return points, path


@pytest.mark.parametrize("box", [(100, 100, 200, 200), (0, 0, 1e9, 1e9), (-5, 3, 1.5, 990), (500, 500, 500, 500), (10, 20, 5, 30), (float("-inf"), 0, float("inf"), 10)])
def test_box_scan_is_exact(spark, laid, box):
    points, path = laid
    expected = {r.id for r in points.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])).collect() if r.x == r.x}
    assert {r.id for r in curve.read_box(spark, path, box).collect() if r.x == r.x} == expected


def test_boxes_skip_what_they_do_not_touch(spark, laid, event_log):
    _, path = laid
    box = curve.read_box(spark, path, (100, 100, 160, 160))
    assert "PushedFilters: [IsNotNull(x), IsNotNull(y), Or(" in plan_of(box)
    with measured() as meter:
        rows = box.count()
    read = task_metrics(event_log(), meter.begin_ms, meter.end_ms).first().recordsRead
    assert 0 < rows <= read < 40_000 / 3


def test_intervals_hold_the_box_and_are_few(spark):
    own = curve.Curve(0.0, 0.0, 1.0, 5)
    keys = {(x, y): sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(5)) for x in range(32) for y in range(32)}
    got = spark.createDataFrame([(x + 0.5, y + 0.5) for x, y in keys], "x double, y double").select("x", "y", own.key().alias("k")).collect()
    assert {(int(r.x), int(r.y)): r.k for r in got} == keys
    rng = random.Random(2)
    for _ in range(50):
        (x, u), (y, v) = (sorted((rng.uniform(-3, 35), rng.uniform(-3, 35))) for _ in range(2))
        inside = {k for (cx, cy), k in keys.items() if own.cell(x, 0) <= cx <= own.cell(u, 0) and own.cell(y, 0) <= cy <= own.cell(v, 0)}
        for most in (4, 16, 1000):
            stretches = own.intervals((x, y, u, v), most)
            held = {k for a, b in stretches for k in range(a, b + 1)}
            assert len(stretches) <= most and inside <= held and (most < 1000 or held == inside)


def test_a_cluster_must_name_its_shared_folder(spark):
    class Context:
        def __init__(self, master):
            self.master = master

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {"spark.sql.warehouse.dir": "file:/w/"}

        def __init__(self, master):
            self.sparkContext = Context(master)

    assert scratch_root(Session("local[4]")) == "file:/w/_scratch"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_root(Session(master))
