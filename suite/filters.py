"""Projections, filters and predicates (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.operators import points as pts
from quadrille.operators.grid import grid_density, occupied, dense_grid
from quadrille.operators.label import excluded_points
from quadrille.operators.quadtree import overlapping
from suite import data
from suite.registry import query

_P = f"with {data.POINTS}"
_OUT = "id, cast(latitude as double) as latitude, cast(longitude as double) as longitude"
_SPLIT = "case when id <= cast(floor(t.top * 0.7) as bigint) then 'train' end"


def _top(spark, sf):
    return pts.max_id(data.points(spark, sf)).first()[0]


@query("b1_drop_columns", f"{_P} select cast(latitude as double) as latitude, cast(longitude as double) as longitude from points")
def b1(spark, sf):
    return data.wide(data.points(spark, sf).drop("id", "image"))


@query("b2_point_in_box", f"{_P} select {_OUT} from points where latitude >= -31 and latitude < 27 and longitude >= -87 and longitude < 128")
def b2(spark, sf):
    p = data.points(spark, sf)
    return data.wide(p.where(pts.in_box(-31, 27, -87, 128)))


@query(
    "b3_box_variants",
    f"""{_P} select 'open' as kind, id from points where latitude > -50 and latitude < 26 and longitude > -130 and longitude < 42
  union all select 'closed', id from points where latitude >= -50 and latitude <= 26 and longitude >= -130 and longitude <= 42""",
)
def b3(spark, sf):
    p = data.points(spark, sf)
    box = (-50, 26, -130, 42)
    return (
        p.where(pts.in_box(*box, bounds="()")).select(F.lit("open").alias("kind"), "id")
        .unionByName(p.where(pts.in_box(*box, bounds="[]")).select(F.lit("closed").alias("kind"), "id"))
    )


@query("b4_id_range", f"{_P}, t as (select max(id) as top from points) select {_OUT} from points, t where id >= top // 4 and id <= top // 2")
def b4(spark, sf):
    top = _top(spark, sf)
    return data.wide(data.points(spark, sf).where(pts.id_between(top // 4, top // 2)))


@query("b5_open_id_range", f"{_P}, t as (select max(id) as top from points) select {_OUT} from points, t where id > top // 4 and id < top // 2")
def b5(spark, sf):
    top = _top(spark, sf)
    return data.wide(data.points(spark, sf).where(pts.id_strictly_between(top // 4, top // 2)))


@query("b6_id_membership", f"{_P}, {data.REQUESTS_SQL} select {_OUT} from points where id in (select idx from requests)")
def b6(spark, sf):
    wanted = data.requests(spark, sf).select(F.col("idx").alias("id"))
    return data.wide(pts.with_ids(data.points(spark, sf), wanted))


@query("b7_id_exclusion", f"with {data.TREE_LABELS} select {_OUT} from points where id not in (select id from labelled where cell is null)")
def b7(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    return data.wide(pts.without_ids(data.points(spark, sf), excluded_points(rows)))


@query(
    "b8_excluded_in_range",
    f"with {data.TREE_LABELS}, t as (select max(id) as top from points) select id from labelled, t where cell is null and id between top // 4 and top // 2",
)
def b8(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    top = _top(spark, sf)
    return excluded_points(rows).where(pts.id_between(top // 4, top // 2))


@query(
    "b9_id_and_box",
    f"{_P}, t as (select max(id) as top from points) select {_OUT} from points, t where id = top // 3 and latitude >= -90 and latitude < 90 and longitude >= -180 and longitude < 180",
)
def b9(spark, sf):
    top = _top(spark, sf)
    return data.wide(data.points(spark, sf).where((F.col("id") == top // 3) & pts.in_box(-90, 90, -180, 180)))


@query(
    "b10_viewport_overlap",
    f"""with {data.TREE_BOXES} select b.cell, w.pad from boxes b join active a on a.cell = b.cell, (values (0), (10)) w(pad)
  where not (south > 41 + pad or north < 20 - pad or west > 60 + pad or east < -20 - pad)""",
)
def b10(spark, sf):
    active = data.cells(spark, sf).where("state = 2")
    return (
        overlapping(active, 20, 41, -20, 60).select("cell", F.lit(0).alias("pad"))
        .unionByName(overlapping(active, 20, 41, -20, 60, pad=10).select("cell", F.lit(10).alias("pad")))
    )


@query(
    "b11_coordinates_by_id",
    f"{_P}, t as (select max(id) as top from points) select cast(latitude as double) as latitude, cast(longitude as double) as longitude from points, t where id > top // 2 and id < top",
)
def b11(spark, sf):
    top = _top(spark, sf)
    chosen = data.points(spark, sf).where(pts.id_strictly_between(top // 2, top))
    return data.wide(chosen.select("latitude", "longitude"))


@query(
    "b12_occupied_squares",
    f"""{_P} select cast(44 - floor((latitude + 90) / 4) as integer) as row, cast(floor((longitude + 180) / 4) as integer) as col,
  count(*) as n from (select cast(latitude as double) as latitude, cast(longitude as double) as longitude from points)
  where latitude < 90 and longitude < 180 group by 1, 2""",
)
def b12(spark, sf):
    return occupied(dense_grid(grid_density(data.points(spark, sf), 45, 90), 45, 90))
