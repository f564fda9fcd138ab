"""Queries on where points lie, beside those of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from pointlab.operators import clean, features, ground, neighbours, overlap
from pointlab.session import scratch_path
from pointlab.sources import curve
from point_queries.catalog import _POINTS, _register, _with
from point_queries.views import crowded_view, points_view

NEAREST, DEVIATIONS = 4, 2.0
DISTANCE = 20.0
GROUND_SIDE, GROUND_LEVELS = 400.0, 5
BOX = (20000.0, 1000.0, 45000.0, 9000.0)

_PLACED = "placed as (select * exclude (xyz), xyz[1] as x, xyz[2] as y, xyz[3] as z from points)"


# Neighbours

# Distances to whatever lies in nine cells of 2000; who has no four within 2000 looks through all.
_NEIGHBOURS = f"""nodes as (select row_number() over () as id, *, floor(x / 2000) as cx, floor(y / 2000) as cy
  from (select x, y, z, count(*) as n from placed where z is not null group by all)),
met as (select a.id, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) as d, b.n - (a.id = b.id)::int as copies
  from (select *, unnest([-1, 0, 1]) as i from nodes) a, (select unnest([-1, 0, 1]) as j) s, nodes b where b.cx = a.cx + i and b.cy = a.cy + j),
near as (select id, d, row_number() over (partition by id order by d) as r from (select id, d, unnest(range(least(copies, {NEAREST}))) from met)),
unsafe as (select id from nodes where id not in (select id from near where r = {NEAREST} and d <= 2000)),
far as (select a.id, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) as d, b.n - (a.id = b.id)::int as copies
  from nodes a join unsafe using (id), nodes b),
ranked as (select id, d, r from near where id not in (from unsafe) union all
  select id, d, row_number() over (partition by id order by d) from (select id, d, unnest(range(least(copies, {NEAREST}))) from far)),
means as (select x, y, z, avg(d) as mean from ranked join nodes using (id) where r <= {NEAREST} group by id, x, y, z),
measured as (select placed.*, mean from placed left join means using (x, y, z)),
stats as (select avg(mean) + {DEVIATIONS} * stddev_samp(mean) as most from measured)"""


@_register(_with(_POINTS, _PLACED, _NEIGHBOURS) + "select point_id, Intensity, split, x, y, z, round(mean, 6) as neighbour_distance from measured, stats where coalesce(mean <= most, true)")
def neighbour_outliers(spark, sf_dir):
    """Points dropped that lie far from their four nearest neighbours; points without a height stay."""
    points = features.split_xyz(points_view(spark, sf_dir)).drop("xyz")
    near = neighbours.drop_neighbour_outliers(points, NEAREST, DEVIATIONS, finest=1.0)
    return near.select("point_id", "Intensity", "split", "x", "y", "z", F.round("neighbour_distance", 6).alias("neighbour_distance"))


# Repeated points

_row = "point_id, Intensity, Classification, Red, Green, Blue, Infrared, split, x, y, z"
_CROWDED = """crowded as (select * exclude (xyz),
    case when point_id % 3 = 0 then 500.25 + xyz[1] / 1e6 else xyz[1] end as x,
    case when point_id % 3 = 0 then 500.25 + xyz[2] / 1e7 else xyz[2] end as y,
    case when point_id % 3 = 0 then 1.0 + xyz[3] / 1e4 else xyz[3] end as z from points)"""
# What shares a cube of side 1 is within the distance; cubes are linked by any two of their places.
_CLUSTERS = f"""places as (select distinct x, y, z, floor(x) as ux, floor(y) as uy, floor(z) as uz from crowded where z is not null),
cubes as (select row_number() over (order by ux, uy, uz) as u, ux, uy, uz from (select distinct ux, uy, uz from places)),
cells as (select *, floor(x / {DISTANCE}) as cx, floor(y / {DISTANCE}) as cy from places join cubes using (ux, uy, uz)),
links as (select distinct a.u as a, b.u as b from (select *, unnest([-1, 0, 1]) as i from cells) a, (select unnest([-1, 0, 1]) as j) s, cells b
  where b.cx = a.cx + i and b.cy = a.cy + j and a.u <> b.u and sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) <= {DISTANCE}),
reach as (select u, u as root from cubes union select links.b, reach.root from reach join links on links.a = reach.u where reach.root < links.b),
roots as (select u, min(root) as root from reach group by u),
marked as (select crowded.*, root from crowded left join cubes on floor(x) = ux and floor(y) = uy and floor(z) = uz left join roots using (u)),
firsts as (select *, row_number() over (partition by root order by {', '.join(f'{c} nulls first' for c in _row.split(', '))}) as r, count(*) over (partition by root) as merged from marked)"""


@_register("with recursive " + ",\n".join((_POINTS, _CROWDED, _CLUSTERS)) + f"""
select {_row}, merged from firsts where r = 1 and root is not null union all select {_row}, 1 as merged from marked where root is null""")
def near_points(spark, sf_dir):
    """One point for each cluster of points within a distance, where a third of all lies in one corner."""
    return overlap.merge_near_points(crowded_view(spark, sf_dir).select(*_row.split(", ")), DISTANCE, ["point_id"])


_whole = "xyz, Intensity, Classification, Red, Green, Blue, Infrared, split"


@_register(_with(_POINTS, "twice as (select * from points union all select * from points where point_id % 3 = 0)")
           + f"select * exclude (xyz), xyz[1] as x, xyz[2] as y, xyz[3] as z from (select distinct {_whole} from twice)")
def dedup_whole_points(spark, sf_dir):
    """Distinct points by all columns but the made-up id, the coordinate array among them; a third of them is there twice."""
    points = points_view(spark, sf_dir)
    twice = points.unionByName(points.where("point_id % 3 = 0")).drop("point_id")
    return features.split_xyz(clean.drop_duplicates(twice)).drop("xyz")


# Ground

_up = "({c} >> l)"
_GROUND = f"""cells as (select split, floor(x / {GROUND_SIDE})::bigint as cx, floor(y / {GROUND_SIDE})::bigint as cy, min(case when Classification = 2 then z end) as ground
  from placed group by all),
levels as (select unnest(range(0, {GROUND_LEVELS} + 1)) as l),
pyramid as (select split, l, cx >> l as ux, cy >> l as uy, min(ground) as found from cells, levels where ground is not null group by all),
filled as (select cells.split, cx, cy, min(l) as level, arg_min(found, l) as ground from cells, levels join pyramid using (l)
  where pyramid.split is not distinct from cells.split and pyramid.ux = cx >> l and pyramid.uy = cy >> l group by all)"""


@_register(_with(_POINTS, _PLACED, _GROUND) + f"""select point_id, Intensity, placed.split as split, x, y, z, filled.ground as ground, cast(level as int) as ground_level, z - filled.ground as height
  from placed left join filled on filled.split is not distinct from placed.split and cx = floor(x / {GROUND_SIDE}) and cy = floor(y / {GROUND_SIDE})""")
def ground_height(spark, sf_dir):
    """Height above the lowest ground point around, cells without one filled from larger ones."""
    points = features.split_xyz(points_view(spark, sf_dir)).drop("xyz")
    high = ground.height_above_ground(points, side=GROUND_SIDE, levels=GROUND_LEVELS)
    return high.select("point_id", "Intensity", "split", "x", "y", "z", "ground", "ground_level", "height")


# Boxes


@_register(_with(_POINTS, _PLACED) + f"select * from placed where x between {BOX[0]} and {BOX[2]} and y between {BOX[1]} and {BOX[3]}")
def box_scan(spark, sf_dir):
    """Points in a box, read from a table laid out along a space-filling curve."""
    points = features.split_xyz(points_view(spark, sf_dir)).drop("xyz")
    path = scratch_path(spark, "curve")
    curve.write_curve(points, path, curve.curve_of(points, bits=16), files=16, max_records_per_file=100_000)
    return curve.read_box(spark, path, BOX)
