"""Zone maps: a batch opens the files that hold its ids, and no other."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quadrille.operators import fetch
from quadrille.sources.zones import holding, in_files, zone_map, zones_of
from tests.conftest import plan_of


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def files_read(df):
    """Files of the scans that ran, from their metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numFiles").value())
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return sum(found)


def wanted_of(spark, ids):
    return spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "idx long, pos long")


def test_a_thousand_files_of_dense_ids(spark, tmp_path, plain_plans):
    folder = str(tmp_path / "t")
    spark.range(0, 20_000, 1, 1000).withColumn("image", F.expr("repeat(string(id), 20)")).write.parquet(folder)
    zones, table = zone_map(spark, folder, span=512), spark.read.parquet(folder)
    ids = random.Random(1).sample(range(20_000), 30) + [50_000]
    wanted = wanted_of(spark, ids + ids[:5])
    where = {r.file for r in table.where(F.col("id").isin(ids)).select(F.col("_metadata.file_path").alias("file")).collect()}
    chosen = in_files(table, zones, wanted.withColumnRenamed("idx", "id"))
    assert files_read(chosen) == len(where) <= 30
    assert [r.id for r in fetch.fetch_batch(table, wanted, zones=zones).collect()] == ids[:30]
    assert fetch.fetch_batch(table, wanted_of(spark, [99_999]), zones=zones).count() == 0


def test_sparse_ids_scattered_over_files(spark, tmp_path, plain_plans):
    folder = str(tmp_path / "t")
    spark.range(0, 4000).selectExpr("id * 7 as id", "'x' as image").repartition(40, "image", "id").write.parquet(folder)
    zones, table = zone_map(spark, folder), spark.read.parquet(folder)
    ids = [7, 8, 700, 27_993]
    wanted = wanted_of(spark, ids).withColumnRenamed("idx", "id")
    assert holding(zones, wanted).where("not sure").count() > 3
    where = table.where(F.col("id").isin(ids)).select("_metadata.file_path").distinct().count()
    assert files_read(in_files(table, zones, wanted)) == where <= 3
    assert {r.id for r in fetch.fetch_batch(table, wanted_of(spark, ids), zones=zones).collect()} == {7, 700, 27_993}


def test_the_map_follows_appended_files_and_odd_names(spark, tmp_path, plain_plans):
    folder = str(tmp_path / "a table=1 %41")
    spark.range(0, 100, 1, 5).write.parquet(folder)
    assert zone_map(spark, folder).count() == 5
    spark.range(100, 200, 1, 5).write.mode("append").parquet(folder)
    spark.createDataFrame([(None,), (7,), (7,)], "id long").coalesce(1).write.mode("append").parquet(folder)
    zones, table = zone_map(spark, folder), spark.read.parquet(folder)
    assert zones.count() == zone_map(spark, folder).count() == zones_of(table).count() == 11
    got = fetch.fetch_batch(table, wanted_of(spark, [7, 150, 500]), zones=zones).collect()
    assert sorted(r.id for r in got) == [7, 7, 7, 150]
    assert files_read(in_files(table, zones, spark.createDataFrame([(150,)], "id long"))) == 1


def test_negative_ids_have_buckets_of_their_own(spark, tmp_path, plain_plans):
    folder = str(tmp_path / "t")
    spark.range(-300, 300, 1, 6).write.parquet(folder)
    zones, table = zone_map(spark, folder, span=100), spark.read.parquet(folder)
    assert zones.count() == 6 and files_read(in_files(table, zones, spark.createDataFrame([(-1,), (-100,)], "id long"))) == 1


def test_ranges_cut_at_the_largest_gaps(spark, tmp_path):
    assert fetch.id_ranges([5, 1, 2, 90, 91, 40, 5], 3) == [(1, 5), (40, 40), (90, 91)]
    assert fetch.id_ranges([]) == [] and fetch.id_ranges([3]) == [(3, 3)]
    ids = random.Random(2).sample(range(10**6), 500)
    found = fetch.id_ranges(ids)
    assert len(found) == fetch.NAMED_RANGES and all(any(a <= i <= b for a, b in found) for i in ids)
    spark.range(10).write.parquet(str(tmp_path / "t"))
    plan = fetch.near_ids(spark.read.parquet(str(tmp_path / "t")), spark.createDataFrame([(i,) for i in range(0, 990, 9)], "id long"))
    assert "Or(" in plan_of(plan)
