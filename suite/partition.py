"""Cells and the adaptive partition (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.functions.cells import box_area_km2, cell_outline, cell_path, with_bounds, with_center
from quadrille.operators import quadtree as qt
from quadrille.operators.label import excluded_points, with_cell
from suite import data
from suite.registry import query

_T = f"with {data.TREE}"
_B = f"with {data.TREE_BOXES}"


@query("c1_cell_bounds", f"{_B} select cell, south, north, west, east from boxes")
def c1(spark, sf):
    return with_bounds(data.cells(spark, sf).select("cell"))


@query("c2_cell_center", f"{_B} select cell, (south + north) / 2 as center_lat, (west + east) / 2 as center_lon from boxes")
def c2(spark, sf):
    return with_center(data.cells(spark, sf).select("cell"))


@query("c3_cell_path", f"with {data.POINTS}, {data.PLACED} select id, path from placed")
def c3(spark, sf):
    return data.points(spark, sf).select("id", cell_path("latitude", "longitude", data.MAX_DEPTH).alias("path"))


@query("c4_quadtree_build", f"{_T} select cell, n from active")
def c4(spark, sf):
    return data.cells(spark, sf).where("state = 2").select("cell", "n")


@query(
    "c4_quadtree_build_fraction",
    f"""with {data.POINTS}, {data.PLACED}, {data.tree_sql("id <= (select cast(floor(max(id) * 0.5) as bigint) from points)")}
  select cell, n from active""",
)
def c4_fraction(spark, sf):
    from quadrille.operators.points import id_fraction_bound

    p = data.points(spark, sf)
    tree = qt.build_quadtree(p, data.TAU_MIN, data.TAU_MAX, last_id=id_fraction_bound(p, 0.5))
    return tree.where("state = 2").select("cell", "n")


@query("c5_all_nodes", f"{_B} select c.cell, depth, parent, state, n, south, north, west, east from cells c join boxes b on b.cell = c.cell")
def c5(spark, sf):
    return data.cells(spark, sf).withColumn("state", F.col("state").cast("int"))


@query("c6_edges", f"{_T} select parent, cell as child from cells where depth > 0")
def c6(spark, sf):
    return qt.edges(data.cells(spark, sf))


@query("c7_class_index", f"{_T} select class_idx, cell, n from active")
def c7(spark, sf):
    return qt.active_cells(data.cells(spark, sf))


@query(
    "c8_nodes_by_state",
    f"{_T} select state, count(*) as nodes, coalesce((select bool_or(state = 1) from cells), false) as evaluating from cells group by state",
)
def c8(spark, sf):
    tree = data.cells(spark, sf)
    pending = qt.any_evaluating(tree).scalar()
    frames = [
        qt.cells_in_state(tree, s).groupBy(F.col("state").cast("int").alias("state")).agg(F.count(F.lit(1)).alias("nodes"))
        for s in (qt.STOPPED, qt.EVALUATING, qt.ACTIVE)
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).withColumn("evaluating", pending)


@query("c9_excluded_points", f"with {data.TREE_LABELS} select id from labelled where cell is null")
def c9(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    return excluded_points(rows)


@query(
    "c10_partition_summary",
    f"""with {data.TREE_LABELS} select (select max(depth) from cells) as max_depth, (select count(*) from active) as active_cells,
  count(*) as excluded_data_points from labelled where cell is null""",
)
def c10(spark, sf):
    rows, tree, _ = data.labelled(spark, sf)
    return qt.partition_summary(tree, excluded_points(rows))


_LEVELS = f"""{_T}, marked as (select *, depth = 0 or (n > 10 and n >= 200) as splits from cells),
levels as (select depth, count(*) filter (state = 2) as active, count(*) filter (splits) as evaluating,
    count(*) filter (not splits and state = 0) as sparse, coalesce(sum(n) filter (not splits and state = 0), 0) as left_out
  from marked group by depth),
running as (select depth, sum(active) over w as active, evaluating,
    sum(sparse) over w + coalesce(sum(evaluating) over (order by depth rows between unbounded preceding and 1 preceding), 0) as stopped,
    sum(left_out) over w as excluded
  from levels window w as (order by depth rows unbounded preceding))
"""


@query(
    "c11_level_report",
    f"""{_LEVELS} select depth, cast(active as bigint) as active, cast(evaluating as bigint) as evaluating, cast(stopped as bigint) as stopped,
  cast(excluded as bigint) as excluded, round(100.0 * cast(active as double) / (active + evaluating + stopped), 6) as pct_active,
  round(100.0 * cast(evaluating as double) / (active + evaluating + stopped), 6) as pct_evaluating,
  round(100.0 * cast(stopped as double) / (active + evaluating + stopped), 6) as pct_stopped,
  round(100.0 * cast(excluded as double) / (select n from cells where depth = 0), 6) as pct_excluded,
  case when evaluating > coalesce(lag(evaluating) over (order by depth), 0) then 'up'
    when evaluating < coalesce(lag(evaluating) over (order by depth), 0) then 'down' else 'same' end as trend
  from running""",
)
def c11(spark, sf):
    tree = data.cells(spark, sf)
    sparse = tree.where("state = 0").select("cell", F.lit(None).cast("int").alias("class_idx"))
    leaves = sparse.join(tree.select(F.col("parent").alias("cell")).distinct(), "cell", "left_anti")
    per_cell = with_cell(data.points(spark, sf), leaves).where("cell is not null").groupBy("cell").agg(
        F.count(F.lit(1)).alias("n")
    )
    report = qt.level_report(tree, per_cell, data.TAU_MIN, data.TAU_MAX)
    shares = [c for c in report.columns if c.startswith("pct_")]
    return report.select(*(F.round(c, 6).alias(c) if c in shares else F.col(c) for c in report.columns))


@query(
    "c12_path_lengths",
    f"{_T} select count(*) as cells, max(length(cell)) as longest, round(avg(length(cell)), 6) as mean_length from active",
)
def c12(spark, sf):
    stats = qt.path_length_stats(data.classes(data.cells(spark, sf)))
    return stats.select("cells", F.col("longest").cast("long").alias("longest"), F.round("mean_length", 6).alias("mean_length"))


@query(
    "c13_area_and_density",
    f"""{_B} select b.cell, round(radians(east - west) * (sin(radians(north)) - sin(radians(south))) * (6378137.0::double * 6378137.0::double / 1e6), 4) as area_km2,
  round(n / (radians(east - west) * (sin(radians(north)) - sin(radians(south))) * (6378137.0::double * 6378137.0::double / 1e6)), 6) as density
  from boxes b join cells c on c.cell = b.cell""",
)
def c13(spark, sf):
    tree = data.cells(spark, sf).withColumn("area", box_area_km2())
    return tree.select(
        "cell", F.round("area", 4).alias("area_km2"), F.round(F.col("n") / F.col("area"), 6).alias("density")
    )


@query(
    "c14_cell_outline",
    f"""{_B}, seqs as (select b.*, cast(k as integer) as seq, k // 10 as edge, (k % 10) / 9.0::double as t from boxes b join active a on a.cell = b.cell, range(40) r(k))
  select cell, seq, round(case edge when 0 then south + (north - south) * t when 1 then north when 2 then north + (south - north) * t else south end, 6) as latitude,
  round(case edge when 0 then west when 1 then west + (east - west) * t when 2 then east else east + (west - east) * t end, 6) as longitude from seqs""",
)
def c14(spark, sf):
    outline = cell_outline(data.cells(spark, sf).where("state = 2"), 10)
    return outline.select("cell", "seq", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"))


@query(
    "c15_children_of",
    f"{_T}, pick as (select min(cell) as cell from cells where depth = 2 and state = 0 and n >= 200) select c.cell, c.parent, c.state, c.n from cells c, pick where c.parent = pick.cell or c.cell = pick.cell",
)
def c15(spark, sf):
    tree = data.cells(spark, sf)
    pick = tree.where(f"depth = 2 and state = 0 and n >= {data.TAU_MAX}").agg(F.min("cell")).first()[0]
    chosen = qt.node(tree, pick or "-").unionByName(qt.children_of(tree, pick or "-"))
    return chosen.select("cell", "parent", F.col("state").cast("int").alias("state"), "n")


def entry(spark, sf):
    """Active cells with class number, bounds and number of points."""
    return with_bounds(qt.active_cells(data.cells(spark, sf)))
