"""Joins (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.functions.scores import rounded
from quadrille.operators import fetch
from quadrille.operators.evaluate import with_prediction
from quadrille.operators.label import (
    box_join,
    cell_to_class,
    class_to_cell,
    excluded_points,
    near_cells,
    with_cell,
    with_class,
)
from quadrille.operators.points import without_ids
from quadrille.operators.quadtree import leaf_lookup
from quadrille.plans.durable import fresh_folder
from quadrille.sources import shards
from quadrille.sources.zones import zone_map
from suite import data
from suite.registry import query

_L = f"with {data.TREE_LABELS}"
_R = f"with {data.POINTS}, {data.SHARD_ROWS_SQL}, {data.CATALOG_SQL}, {data.REQUESTS_SQL}"
_OUT = "cast(p.latitude as double) as latitude, cast(p.longitude as double) as longitude"
_PLACED = f"""{_R}, matched as (select r.pos, r.idx, c.name, c.min_index from requests r asof left join catalog c on r.idx >= c.min_index)"""


def _catalog(spark, sf):
    return shards.shard_catalog(shards.count_rows(data.shard_rows(spark, sf)))


@query("d1_enclosing_cell", f"{_L} select id, cell, class_idx from labelled")
def d1(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    return rows.select("id", "cell", "class_idx")


@query("d1_enclosing_cell_merge", f"{_L} select id, cell, class_idx from labelled")
def d1_merge(spark, sf):
    tree = data.cells(spark, sf)
    rows = with_cell(data.points(spark, sf), leaf_lookup(tree), strategy="merge")
    return rows.select("id", "cell", "class_idx")


@query(
    "d2_box_join",
    f"""with {data.TREE_BOXES} select p.id, b.cell from placed p join boxes b on p.lat >= b.south and p.lat < b.north and p.lon >= b.west and p.lon < b.east""",
)
def d2(spark, sf):
    boxes = data.cells(spark, sf).select("cell", "south", "north", "west", "east")
    return box_join(data.points(spark, sf), boxes).select("id", "cell")


@query("d3_asof_backward", f"{_PLACED} select pos, idx, name from matched")
def d3(spark, sf):
    return fetch.shard_of(data.requests(spark, sf), _catalog(spark, sf))


@query("d3_asof_backward_merge", f"{_PLACED} select pos, idx, name from matched")
def d3_merge(spark, sf):
    return fetch.shard_of(data.requests(spark, sf), _catalog(spark, sf), strategy="merge")


@query(
    "d4_requests_with_catalog",
    f"""{_PLACED} select m.name, m.idx // 100 as chunk, cast(sum(1) as bigint) as requested, cast(count(distinct m.idx) as bigint) as indices,
  c.count, c.min_index, c.max_index from matched m join catalog c on c.name = m.name group by all""",
)
def d4(spark, sf):
    catalog = _catalog(spark, sf)
    grouped = fetch.shard_requests(fetch.shard_of(data.requests(spark, sf), catalog), span=100)
    slim = grouped.select(
        "name",
        "chunk",
        F.expr("aggregate(indices, 0L, (a, e) -> a + e.n)").alias("requested"),
        F.size("indices").cast("long").alias("indices"),
    )
    return fetch.with_catalog(slim, catalog)


@query(
    "d5_batch_fetch",
    f"""{_R} select p.id, {_OUT}, r.pos from points p join (select idx, min(pos) as pos from requests group by idx) r on r.idx = p.id""",
)
def d5(spark, sf):
    return data.wide(fetch.fetch_batch(data.points(spark, sf), data.requests(spark, sf)))


@query(
    "d5_batch_fetch_zones",
    f"""{_R} select p.id, {_OUT}, r.pos from points p join (select idx, min(pos) as pos from requests group by idx) r on r.idx = p.id""",
)
def d5_zones(spark, sf):
    """The same fetch from a table in files, of which those without a wanted id are not opened."""
    folder = fresh_folder(spark, "points")
    data.points(spark, sf).repartitionByRange(16, "id").write.parquet(folder)
    zones = zone_map(spark, folder, span=1000)
    return data.wide(fetch.fetch_batch(spark.read.parquet(folder), data.requests(spark, sf), zones=zones))


@query("d6_anti_join_excluded", f"{_L} select id from points where id not in (select id from labelled where cell is null)")
def d6(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    return without_ids(data.points(spark, sf), excluded_points(rows)).select("id")


@query("d7_left_join_requests", f"{_R} select r.idx, r.pos, {_OUT} from requests r left join points p on p.id = r.idx")
def d7(spark, sf):
    return data.wide(fetch.fetch_left(data.requests(spark, sf), data.points(spark, sf)))


_KM = """6371.009 * atan2(sqrt(pow(cos(radians({b1})) * sin(radians({b2}) - radians({a2})), 2)
    + pow(cos(radians({a1})) * sin(radians({b1})) - sin(radians({a1})) * cos(radians({b1})) * cos(radians({b2}) - radians({a2})), 2)),
    sin(radians({a1})) * sin(radians({b1})) + cos(radians({a1})) * cos(radians({b1})) * cos(radians({b2}) - radians({a2})))"""
#: All pairs, and the distance decides: what the join must equal.
NEAR = f"""with {data.TREE_BOXES}, {data.LABELLED},
centers as (select a.class_idx, (south + north) / 2 as clat, (west + east) / 2 as clon from boxes b join active a on a.cell = b.cell),
pairs as (select l.id, l.class_idx, c.class_idx as near_class, {_KM.format(a1='l.lat', a2='l.lon', b1='c.clat', b2='c.clon')} as km
  from labelled l, centers c where l.class_idx is not null),
near as (select * from pairs where km <= 285 or class_idx = near_class)"""


@query("d8_near_cells", f"{NEAR} select id, near_class, round(km, 6) as km from near")
def d8(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    return near_cells(rows, numbered).select("id", "near_class", rounded("km", 6).alias("km"))


@query("d9_class_lookup", f"{_L} select id, class_idx, cell from labelled where class_idx is not null")
def d9(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    named = with_class(rows).select("id", F.col("cell").alias("_cell"))
    back = cell_to_class(named, numbered, "_cell")
    return class_to_cell(back, numbered).select("id", "class_idx", "cell")


@query(
    "d10_prediction_truth",
    f"""{_L}, {data.PREDICTIONS_SQL}, best as (select id, min(class_idx) as pred_idx from flat f
    where prob = (select max(prob) from flat g where g.id = f.id) group by id)
  select l.id, l.class_idx, b.pred_idx from labelled l join best b on b.id = l.id where l.class_idx is not null""",
)
def d10(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    predicted = with_prediction(data.predictions(spark, sf, numbered.count())).select("id", "pred_idx")
    return with_class(rows).select("id", "class_idx").join(predicted, "id")
