"""Sampling, splitting and batching (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.operators import fetch, points as pts, sampling
from quadrille.operators.label import excluded_points, with_cell
from quadrille.operators.quadtree import leaf_lookup
from quadrille.plans.durable import fresh_folder
from quadrille.sources import shards, tables
from quadrille.sources.zones import zone_map
from suite import data
from suite.joins import _catalog
from suite.registry import query

_P = f"with {data.POINTS}"
_L = f"with {data.TREE_LABELS}"
_TOP = "(select max(id) as top from points) t"
_TOP_CTE = "t as (select max(id) as top from points)"


@query("j1_prefix_fraction", f"{_P} select id from points, {_TOP} where id <= cast(floor(top * cast(0.37 as double)) as bigint)")
def j1(spark, sf):
    return pts.id_fraction(data.points(spark, sf), 0.37).select("id")


@query(
    "j2_split_by_id",
    f"""{_P}, b as (select top, cast(floor(top * cast(0.7 as double)) as bigint) as a, cast(floor(top * cast(0.2 as double)) as bigint) as c from {_TOP})
  select id, case when id <= a then 'train' when id <= a + 1 + c then 'test' else 'validation' end as split from points, b""",
)
def j2(spark, sf):
    return sampling.split_by_id(data.points(spark, sf)).select("id", "split")


#: The chain of replacements followed one step at a time.
_REMAP = f"""with recursive {data.TREE_LABELS}, excluded as (select id, cast(row_number() over (order by id) - 1 as bigint) as pos from labelled where cell is null),
b as (select min(id) as first, max(id) - min(id) + 1 - (select count(*) from excluded) as kept from points),
hops as (select range as idx, range + first as id from b, range((select max(id) from points)) r(range) where range < kept
  union all select h.idx, b.first + b.kept + e.pos from hops h join excluded e on e.id = h.id, b)"""


@query("j3_index_remap", f"{_REMAP} select h.idx, h.id from hops h anti join excluded e on e.id = h.id")
def j3(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    p = data.points(spark, sf)
    top = pts.max_id(p).first()[0]
    sampling.check_dense(p, 1, top)
    out = excluded_points(rows)
    kept = top - out.count()
    indices = p.select((F.col("id") - 1).alias("idx")).where(F.col("idx") < kept)
    return sampling.remap_indices(indices, out, 1, top)


@query("j4_seeded_shuffle", f"{_P} select id, cast(row_number() over (order by md5('11:' || id), id) - 1 as bigint) as position from points")
def j4(spark, sf):
    return sampling.shuffled(data.points(spark, sf).select("id"), seed=11)


@query("j4_sequential_order", f"{_P} select id, cast(row_number() over (order by id) - 1 as bigint) as position from points")
def j4_sequential(spark, sf):
    return sampling.row_index(data.points(spark, sf).select("id"), ["id"], "position")


def _permutation_sql(seed: int) -> str:
    """The permutation by one walk after another, with the halves of each round as columns of their own."""
    parts = ["v >> low as l0", "v & ((1 << low) - 1) as r0"]
    for k, (a, b) in enumerate(sampling.round_keys(seed)):
        change = f"((({{}}{k} + {b}) * {a}) >> 20) & ((1 << {{}}) - 1)"
        parts += [f"xor(l{k}, {change.format('r', '(bits - low)')}) as l{k + 1}", f"r{k} as r{k + 1}"] if k % 2 == 0 else [f"l{k} as l{k + 1}", f"xor(r{k}, {change.format('l', 'low')}) as r{k + 1}"]
    last = len(sampling.round_keys(seed))
    return f"select position, n, bits, low, (l{last} << low) | r{last} as v, step + 1 as step from (select *, {', '.join(parts)} from walk where step = 0 or v >= n)"


@query(
    "j5_range_permutation",
    f"""with recursive {data.POINTS}, size as (select n, greatest(2, length(bin(n - 1))) as bits, bits // 2 as low from (select count(*) as n from points)),
walk as (select range as position, n, bits, low, range as v, 0 as step from size, range((select n from size)) union all {_permutation_sql(3)})
select position, v * 3 + 5 as value from walk where step > 0 and v < n""",
)
def j5(spark, sf):
    n = data.points(spark, sf).count()
    return sampling.range_permutation(spark, 5, 5 + 3 * n, 3, seed=3)


@query(
    "j6_batch_assignment",
    f"""{_P}, n as (select id, row_number() over (order by id) - 1 as position, count(*) over () as total from points)
  select id, cast(position as bigint) as position, cast(position // 64 as bigint) as batch_id from n where position // 64 < total // 64""",
)
def j6(spark, sf):
    return sampling.batches(data.points(spark, sf).select("id"), ["id"], 64, drop_last=True)


@query(
    "j6_shuffled_batches",
    f"{_P}, n as (select row_number() over (order by id) - 1 as k from points) select cast(k // 64 as bigint) as batch_id, count(*) as rows from n group by 1",
)
def j6_shuffled(spark, sf):
    order = sampling.shuffled(data.points(spark, sf).select("id"), seed=5)
    return order.groupBy(F.expr("position div 64").alias("batch_id")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "j7_fetch_through_catalog",
    f"""with {data.POINTS}, {data.SHARD_ROWS_SQL}, {data.CATALOG_SQL}, {data.REQUESTS_SQL},
firsts as (select idx, min(pos) as pos from requests group by idx)
select f.pos, c.min_index + s.pos as id, s.shard from shard_rows s join catalog c on c.name = s.shard join firsts f on f.idx = c.min_index + s.pos""",
)
def j7(spark, sf):
    folder = fresh_folder(spark, "table")
    catalog = _catalog(spark, sf)
    numbered = shards.assign_ids(data.shard_rows(spark, sf), catalog).withColumnRenamed("pos", "place")
    tables.write_shards(numbered.withColumnRenamed("place", "pos"), folder)
    table = tables.read_shard_table(spark, folder).drop("pos")
    return fetch.fetch_through_catalog(table, catalog, data.requests(spark, sf), zones=zone_map(spark, folder)).select("pos", "id", "shard")


@query(
    "j8_labelled_rows",
    f"""{_L}, t as (select max(id) as top from points) select id, cell, class_idx, lat as latitude, lon as longitude, cast(1 as real) as weight
  from labelled, t where id >= top // 4 and cell is not null""",
)
def j8(spark, sf):
    p = data.points(spark, sf)
    top = pts.max_id(p).first()[0]
    rows, weights = sampling.labelled_rows(p, data.cells(spark, sf), first_id=top // 4)
    joined = rows.join(weights, ["id", "class_idx"])
    return data.wide(joined.select("id", "cell", "class_idx", "latitude", "longitude", "weight"))


@query(
    "j8_labelled_batches",
    f"""{_L}, {data.REQUESTS_SQL}, firsts as (select idx, min(pos) as pos from requests group by idx)
  select f.pos, l.id, l.cell, l.class_idx from firsts f join labelled l on l.id = f.idx""",
)
def j8_batches(spark, sf):
    """The fetch a trainer makes: requested ids with their cell and class, in request order."""
    tree = data.cells(spark, sf)
    rows = fetch.fetch_batch(data.points(spark, sf), data.requests(spark, sf), ordered=False)
    return with_cell(rows, leaf_lookup(tree)).select("pos", "id", "cell", "class_idx").orderBy("pos")


@query("j9_random_ids", f"{_P}, {_TOP_CTE} select id from points, t where id between top // 4 and top order by md5('2:' || id), id limit 20")
def j9(spark, sf):
    p = data.points(spark, sf)
    top = pts.max_id(p).first()[0]
    return sampling.random_rows(p.where(pts.id_between(top // 4, top)).select("id"), 20, seed=2)
