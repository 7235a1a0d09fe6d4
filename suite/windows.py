"""Windows, sorts, limits and set operations (F, G, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.functions.scores import rounded
from quadrille.operators import evaluate, profile, sampling
from quadrille.operators.quadtree import trend
from quadrille.plans.ranking import running_total
from quadrille.sources import shards
from suite import data
from suite.registry import query

_P = f"with {data.POINTS}"
_E = f"with {data.EPOCHS_SQL}"
_S = f"with {data.IMAGE_SIZES_SQL}, sizes as (select width, height, count(*) as n from image_sizes group by 1, 2)"


@query("f1_row_index", "select o_orderkey, cast(row_number() over (order by o_totalprice desc, o_orderkey) - 1 + 5 as bigint) as place from orders")
def f1(spark, sf):
    orders = data.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.row_index(orders, [F.desc("o_totalprice"), "o_orderkey"], "place", 5).drop("o_totalprice")


@query(
    "f2_cumulative_offsets",
    f"with {data.POINTS}, {data.SHARD_ROWS_SQL}, {data.CATALOG_SQL} select name, shard_no, count as n, min_index as before from (select *, cast(shard_no as bigint) as k from catalog)",
)
def f2(spark, sf):
    counts = shards.count_rows(data.shard_rows(spark, sf)).selectExpr(
        "shard as name", "cast(substring(shard, 7) as bigint) as shard_no", "n"
    )
    upto = running_total(counts, ["shard_no"], "n", "_upto")
    return upto.select("name", "shard_no", "n", (F.col("_upto") - F.col("n")).alias("before"))


#: Strict improvement in a loop over epochs, written as a self join.
_BEST = f"""{_E}, ranked as (select a.run, a.epoch, b.epoch as e, b.train_loss, b.test_loss, b.test_acc, b.mean_squared_error,
    row_number() over (partition by a.run, a.epoch order by b.test_loss, b.epoch) as k
  from epochs a join epochs b on b.run = a.run and b.epoch <= a.epoch and not isnan(b.test_loss)),
best as (select a.run, a.epoch, a.test_loss, a.epoch_start, a.epoch_end, coalesce(r.e, 1) as best_epoch,
    coalesce(r.train_loss, cast('inf' as double)) as best_epoch_train_loss, coalesce(r.test_loss, cast('inf' as double)) as best_epoch_test_loss,
    coalesce(r.test_acc, 0) as best_epoch_test_acc, coalesce(r.mean_squared_error, cast('inf' as double)) as best_epoch_mean_squared_error
  from epochs a left join ranked r on r.run = a.run and r.epoch = a.epoch and r.k = 1),
stops as (select run, min(epoch) as stop from best where (best_epoch <> epoch or isnan(test_loss)) and epoch - best_epoch >= 3 group by run),
cut as (select b.*, s.stop is not null as stopped_early from best b left join stops s on s.run = b.run where s.stop is null or b.epoch <= s.stop)"""
_CARRIED = "best_epoch, best_epoch_train_loss, best_epoch_test_loss, best_epoch_test_acc, best_epoch_mean_squared_error"


@query("f3_best_epoch", f"{_BEST} select run, epoch, {_CARRIED} from best")
def f3(spark, sf):
    return evaluate.best_so_far(data.epochs(spark, sf)).select("run", "epoch", *_CARRIED.split(", "))


@query("f4_early_stop", f"{_BEST} select run, epoch, best_epoch, stopped_early from cut")
def f4(spark, sf):
    return evaluate.early_stop(data.epochs(spark, sf), 3).select("run", "epoch", "best_epoch", "stopped_early")


@query(
    "f5_trend",
    f"""with {data.TREE}, levels as (select depth, count(*) as cells from cells group by depth)
  select depth, cells, case when cells > coalesce(lag(cells) over (order by depth), 0) then 'up'
    when cells < coalesce(lag(cells) over (order by depth), 0) then 'down' else 'same' end as trend from levels""",
)
def f5(spark, sf):
    levels = data.cells(spark, sf).groupBy("depth").agg(F.count(F.lit(1)).alias("cells"))
    return levels.select("depth", "cells", trend("cells", "depth").alias("trend"))


@query(
    "f6_run_summary",
    f"""{_BEST} select c.run, bool_or(c.stopped_early) as stopped_early, max(c.epoch) as last_epoch, {', '.join(f'arg_max({c}, c.epoch) as {c}' for c in _CARRIED.split(', '))},
  min(epoch_start) as run_start, max(epoch_end) as run_end, cast(epoch(max(epoch_end)) - epoch(min(epoch_start)) as double) as run_time from cut c group by c.run""",
)
def f6(spark, sf):
    return evaluate.run_summary(evaluate.early_stop(data.epochs(spark, sf), 3))


@query("g1_sort", f"{_P} select id, cast(row_number() over (order by latitude, id) - 1 as bigint) as place from points")
def g1(spark, sf):
    return sampling.row_index(data.points(spark, sf).select("latitude", "id"), ["latitude", "id"], "place").drop("latitude")


@query("g2_head", "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 5")
def g2(spark, sf):
    return profile.head(data.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 5, ["o_totalprice", "o_orderkey"])


@query("g3_tail", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey desc limit 5")
def g3(spark, sf):
    return profile.tail(data.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 5, ["o_totalprice", "o_orderkey"])


@query(
    "g4_row_batches",
    "select o_orderkey, cast(row_number() over (order by o_orderkey) - 1 as bigint) as position, cast((row_number() over (order by o_orderkey) - 1) // 1000 as bigint) as batch_id from orders",
)
def g4(spark, sf):
    return sampling.batches(data.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 1000)


@query("g4_row_slice", "select o_orderkey from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as k from orders) where k between 500 and 1499")
def g4_slice(spark, sf):
    return sampling.row_slice(data.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 500, 1000)


@query("g5_random_rows_large", f"with {data.POINTS} select id from points order by md5('8:' || id), id limit 9000")
def g5_large(spark, sf):
    return sampling.random_rows(data.points(spark, sf).select("id"), 9000, seed=8, direct=100)


@query("g5_random_rows", f"with {data.POINTS} select id, cast(latitude as double) as latitude, cast(longitude as double) as longitude from points order by md5('7:' || id), id limit 1000")
def g5(spark, sf):
    return data.wide(sampling.random_rows(data.points(spark, sf), 1000, seed=7))


@query("g6_most_common", f"{_S} select width, height, n from sizes order by n desc, width, height limit 20")
def g6(spark, sf):
    return profile.most_common(profile.size_histogram(data.image_sizes(spark, sf)), 20, ["width", "height"])


_F = f"with {data.TREE_BOXES}, {data.PREDICTIONS_SQL}"


@query("g7_arg_max", f"{_F}, tops as (select id, max(prob) as top from flat group by id) select f.id, min(f.class_idx) as pred_idx from flat f join tops t on t.id = f.id and t.top = f.prob group by f.id")
def g7(spark, sf):
    number = data.classes(data.cells(spark, sf)).count()
    return evaluate.with_prediction(data.predictions(spark, sf, number)).select("id", "pred_idx")


@query(
    "g8_top_cells",
    f"""{_F}, ranked as (select *, cast(row_number() over (partition by id order by prob desc, class_idx) as integer) as rank from flat)
  select r.id, r.rank, r.class_idx, a.cell, round(r.prob, 6) as prob, (south + north) / 2 as center_lat, (west + east) / 2 as center_lon
  from ranked r join active a on a.class_idx = r.class_idx join boxes b on b.cell = a.cell where rank <= 5""",
)
def g8(spark, sf):
    numbered = data.classes(data.cells(spark, sf))
    ranked = evaluate.ranked_cells(data.predictions(spark, sf, numbered.count()), numbered, 5)
    return ranked.withColumn("prob", rounded("prob", 6))


@query(
    "g8_all_cells",
    f"""{_F}, ranked as (select *, cast(row_number() over (partition by id order by prob desc, class_idx) as integer) as rank from flat)
  select r.id, r.rank, r.class_idx, a.cell, round(r.prob, 6) as prob from ranked r join active a on a.class_idx = r.class_idx""",
)
def g8_all(spark, sf):
    numbered = data.classes(data.cells(spark, sf))
    ranked = evaluate.ranked_cells(data.predictions(spark, sf, numbered.count()), numbered)
    return ranked.select("id", "rank", "class_idx", "cell", rounded("prob", 6).alias("prob"))


@query("h1_append", "select o_orderkey as id, o_totalprice as price from orders union all select l_orderkey, l_extendedprice from lineitem")
def h1(spark, sf):
    return evaluate.append(
        data.table(spark, sf, "orders").selectExpr("o_orderkey as id", "o_totalprice as price"),
        data.table(spark, sf, "lineitem").selectExpr("l_extendedprice as price", "l_orderkey as id"),
    )
