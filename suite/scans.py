"""Sources, sinks and tables (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.functions.text import file_stem, stem_number
from quadrille.functions.units import format_size
from quadrille.operators import profile
from quadrille.operators.grid import grid_density
from quadrille.operators.label import excluded_points
from quadrille.operators.points import IMAGE_TABLE, conform
from quadrille.operators.quadtree import partition_summary
from quadrille.operators.evaluate import early_stop, run_summary
from quadrille.plans.durable import fresh_folder
from quadrille.sources import files, shards, tables
from suite import data
from suite.registry import query

_SHARDS = f"with {data.POINTS}, {data.SHARD_ROWS_SQL}"
_CATALOG = f"{_SHARDS}, {data.CATALOG_SQL}"


def _files(spark, sf):
    folder = fresh_folder(spark, "shards")
    data.write_shard_files(data.shard_rows(spark, sf), folder)
    return shards.shard_files(spark, folder)


def _catalog(spark, sf):
    return shards.shard_catalog(shards.count_rows(data.shard_rows(spark, sf)))


@query(
    "a1_shard_source",
    f"""{_SHARDS} select shard, pos, shard || '/' || cast(pos as varchar) as source_id,
  cast(latitude as double) as latitude, cast(longitude as double) as longitude,
  shard || ':' || cast(pos as varchar) as content from shard_rows""",
)
def a1(spark, sf):
    # A small split size cuts every file, so that the border walk is exercised.
    splits = shards.shard_splits(_files(spark, sf), split_bytes=16_000)
    return shards.read_shards(splits).select(
        "shard", "pos", "source_id", "latitude", "longitude", F.col("image").cast("string").alias("content")
    )


@query(
    "a2_shard_natural_order",
    f"""{_SHARDS} select shard, cast(shard_no as integer) as shard_no,
  cast(row_number() over (order by shard_no) - 1 as bigint) as place
  from (select distinct shard, shard_no from shard_rows)""",
)
def a2(spark, sf):
    from quadrille.operators.sampling import row_index

    listed = _files(spark, sf).where(F.col("shard").startswith("shard_")).select("shard", "shard_no")
    return row_index(listed, [stem_number("shard"), "shard"], "place")


@query(
    "a3_dense_ids",
    f"{_CATALOG} select c.min_index + s.pos as id, s.shard, s.pos from shard_rows s join catalog c on c.name = s.shard",
)
def a3(spark, sf):
    rows = data.shard_rows(spark, sf).select("shard", "pos")
    return shards.assign_ids(rows, _catalog(spark, sf))


@query(
    "a4_parquet_shards",
    f"""{_CATALOG} select c.min_index + s.pos as id, s.shard, s.pos, cast(s.latitude as double) as latitude,
  cast(s.longitude as double) as longitude from shard_rows s join catalog c on c.name = s.shard""",
)
def a4(spark, sf):
    folder = fresh_folder(spark, "table")
    tables.write_shards(shards.assign_ids(data.shard_rows(spark, sf), _catalog(spark, sf)), folder)
    return data.wide(tables.read_shard_table(spark, folder).select("id", "shard", "pos", "latitude", "longitude"))


@query("a5_write_guard", f"with {data.POINTS} select true as refused, count(*) as n from points")
def a5(spark, sf):
    folder = fresh_folder(spark, "table")
    table = data.points(spark, sf)
    tables.guarded_write(table, folder)
    try:
        tables.guarded_write(table, folder)
        refused = False
    except Exception as error:
        refused = "PATH_ALREADY_EXISTS" in str(error)
    tables.guarded_write(table, folder, delete_existing=True)
    return spark.read.parquet(folder).agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n"))


@query(
    "a6_append_generated_ids",
    f"""{_SHARDS}, halves as (select shard, pos, case when shard_no % 2 = 0 then 0 else 1 end as half, shard_no from shard_rows)
  select cast(row_number() over (order by half, shard, pos) as bigint) as id, shard, pos from halves""",
)
def a6(spark, sf):
    folder = fresh_folder(spark, "table")
    rows = data.shard_rows(spark, sf).select("shard", "pos", (stem_number("shard") % 2).alias("half"))
    for half in (0, 1):
        tables.append_rows(rows.where(F.col("half") == half).drop("half"), folder, ["shard", "pos"])
    return spark.read.parquet(folder)


@query("a7_shard_catalog", f"{_CATALOG} select name, count, min_index, max_index from catalog")
def a7(spark, sf):
    return _catalog(spark, sf)


@query("a8_catalog_rebuild", f"{_CATALOG} select name, count, min_index, max_index from catalog")
def a8(spark, sf):
    folder = fresh_folder(spark, "table")
    tables.write_shards(shards.assign_ids(data.shard_rows(spark, sf), _catalog(spark, sf)), folder)
    return shards.shard_catalog(tables.shard_counts(tables.read_shard_table(spark, folder)))


@query("a9_catalog_json", f"{_CATALOG} select name, count, min_index, max_index from catalog")
def a9(spark, sf):
    folder = fresh_folder(spark, "catalog")
    shards.write_catalog(_catalog(spark, sf), folder)
    return shards.read_catalog(spark, folder)


@query("a10_ingest_accounting")
def a10(spark, sf):
    source = _files(spark, sf)
    folder = fresh_folder(spark, "table")
    tables.write_shards(shards.assign_ids(data.shard_rows(spark, sf), _catalog(spark, sf)), folder)
    sides = shards.accounting(source).withColumn("side", F.lit("source")).unionByName(
        shards.accounting(shards.folder_files(spark, folder)).withColumn("side", F.lit("target"))
    )
    return sides.withColumn("size", format_size("bytes", precision=3))


@query(
    "a11_scan_schema",
    """select * from (values (0, 'event_id', 'bigint', 6), (1, 'ts', 'timestamp_ntz', 6), (2, 'user_id', 'bigint', 6),
  (3, 'event_type', 'string', 6), (4, 'value', 'double', 6), (5, 'props', 'string', 6)) s("position", "column", "type", width),
  (select count(*) as "rows" from events)""",
)
def a11(spark, sf):
    return profile.frame_shape(files.read_parquet(spark, f"{sf}/events.parquet"))


@query(
    "a12_parametric_read",
    f"with {data.POINTS} select id, cast(latitude as double) as latitude, cast(longitude as double) as longitude from points where latitude >= 0 and latitude < 60",
)
def a12(spark, sf):
    data.points(spark, sf).createOrReplaceTempView("quadrille_points")
    text = "select * from quadrille_points where latitude >= :south and latitude < :north"
    return data.wide(tables.read_query(spark, text, {"south": 0.0, "north": 60.0}))


@query(
    "a13_table_copy",
    f"with {data.POINTS} select cast(row_number() over (order by id) as bigint) as id, cast(latitude as double) as latitude, cast(longitude as double) as longitude from points",
)
def a13(spark, sf):
    folder = fresh_folder(spark, "copy")
    tables.copy_table(data.points(spark, sf), folder)
    return data.wide(spark.read.parquet(folder))


@query(
    "a16_table_definition",
    f"with {data.POINTS} select id, cast(latitude as double) as latitude, cast(longitude as double) as longitude, 'id ' || cast(id as varchar) as image from points",
)
def a16(spark, sf):
    raw = data.points(spark, sf).withColumn("image", F.concat(F.lit("id "), F.col("id").cast("string")).cast("binary"))
    return data.wide(conform(raw, IMAGE_TABLE)).withColumn("image", F.col("image").cast("string"))


@query("a17_quadtree_store", f"with {data.TREE} select class_idx, cell, n from active")
def a17(spark, sf):
    folder = fresh_folder(spark, "cells")
    tables.save_cells(data.cells(spark, sf), folder)
    return tables.load_active_cells(spark, folder)


@query(
    "a18_quadtree_manifest",
    f"""with {data.TREE_LABELS} select 'qt_min10_max200_df100pct' as name, 10 as tau_min, 200 as tau_max,
  (select max(id) from points) as max_id, (select max(depth) from cells) as max_depth,
  (select count(*) from active) as active_cells, count(*) as excluded_data_points, cast(sum(id) as bigint) as excluded_sum
  from labelled where cell is null""",
)
def a18(spark, sf):
    folder = fresh_folder(spark, "manifest")
    rows, tree, _ = data.labelled(spark, sf)
    excluded = excluded_points(rows)
    name = tables.quadtree_name(data.TAU_MIN, data.TAU_MAX, 1.0)
    top = data.points(spark, sf).agg(F.max("id")).first()[0]
    summary = partition_summary(tree, excluded)
    for last_id in (top // 2, top):
        # Two entries of one name: the later one counts.
        tables.append_manifest(
            folder, name=name, tau_min=data.TAU_MIN, tau_max=data.TAU_MAX, max_id=last_id, summary=summary,
            excluded=excluded if last_id == top else excluded.where(F.col("id") <= last_id),
        )
    listed = tables.manifest_excluded(spark, folder, name).agg(F.sum("id")).scalar()
    return tables.manifest_entry(spark, folder, name).select(
        "name", "params.*", "stats.*", listed.alias("excluded_sum")
    )


@query(
    "a19_csv_round_trip",
    "select o_orderkey as id, o_totalprice as price, cast(o_orderdate as date) as day from orders",
)
def a19(spark, sf):
    folder = fresh_folder(spark, "csv")
    orders = data.table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "o_totalprice as price", "cast(o_orderdate as date) as day"
    )
    files.write_csv(orders, folder)
    guessed = files.read_csv(spark, folder, parse_dates=True)
    typed = files.read_csv(spark, folder, "id bigint, price double, day date")
    if dict(guessed.dtypes)["day"] != "date":
        raise AssertionError("dates were not recognised")
    return typed


@query("a20_json_round_trip", "select o_orderkey as id, o_totalprice as price, o_orderpriority as priority from orders")
def a20(spark, sf):
    folder = fresh_folder(spark, "json")
    orders = data.table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "o_totalprice as price", "o_orderpriority as priority"
    )
    files.write_json(orders, folder)
    return files.read_json(spark, folder, orders.schema)


@query(
    "a21_parquet_round_trip",
    "select event_id as id, ts, value from events",
)
def a21(spark, sf):
    folder = fresh_folder(spark, "parquet")
    files.write_parquet(data.table(spark, sf, "events").selectExpr("event_id as id", "ts", "value"), folder)
    return files.read_parquet(spark, folder)


@query(
    "a22_run_files",
    f"""with {data.EPOCHS_SQL} select run, epoch, train_loss, case when isnan(test_loss) then null else test_loss end as test_loss,
  test_acc, mean_squared_error from epochs""",
)
def a22(spark, sf):
    folder = fresh_folder(spark, "runs")
    epochs = data.epochs(spark, sf)
    files.append_epochs(epochs, f"{folder}/stats")
    summaries = run_summary(early_stop(epochs, 3))
    files.write_runs(summaries, f"{folder}/run")
    files.append_run_manifest(summaries, f"{folder}/manifest")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in epochs.schema if f.name != "run")
    return files.read_epochs(spark, f"{folder}/stats", columns).select(
        "run", "epoch", "train_loss", F.expr("if(isnan(test_loss), null, test_loss)").alias("test_loss"),
        "test_acc", "mean_squared_error",
    )


@query(
    "a23_grid_store",
    f"""with {data.POINTS} select cast(89 - floor((latitude + 90) / 2) as integer) as row, cast(floor((longitude + 180) / 2) as integer) as col,
  count(*) as n from (select cast(latitude as double) as latitude, cast(longitude as double) as longitude from points)
  where latitude < 90 and longitude < 180 group by 1, 2""",
)
def a23(spark, sf):
    folder = fresh_folder(spark, "grid")
    files.write_parquet(grid_density(data.points(spark, sf), 90, 180), folder)
    return files.read_parquet(spark, folder)


@query(
    "i19_file_stem",
    f"""{_SHARDS} select shard || '.msg' as name, shard as stem, cast(shard_no as integer) as number
  from (select distinct shard, shard_no from shard_rows)""",
)
def i19(spark, sf):
    return _files(spark, sf).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"),
        file_stem("path").alias("stem"),
        stem_number("shard").alias("number"),
    )
