from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quadrille.operators import fetch, profile, sampling
from quadrille.operators.points import IMAGE_TABLE, conform, id_fraction_bound, table_definition, without_ids
from suite import data
from tests.conftest import SF, plan_of


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def indices(spark, values):
    return spark.createDataFrame([(v,) for v in values], "idx long")


def remapped(spark, idx, excluded, first, last):
    rows = sampling.remap_indices(indices(spark, idx), ids(spark, excluded), first, last).collect()
    return {r.idx: r.id for r in rows}


def test_published_remap(spark):
    got = remapped(spark, range(12), [2, 11, 13], 0, 14)
    assert [got[i] for i in range(12)] == [0, 1, 12, 3, 4, 5, 6, 7, 8, 9, 10, 14]


@pytest.mark.parametrize("seed", range(4))
def test_remap_is_a_bijection_onto_kept_ids(spark, seed):
    rng = random.Random(seed)
    first, last = 5, 5 + rng.randint(20, 60)
    excluded = rng.sample(range(first, last + 1), rng.randint(1, 18)) + [last + 9]
    inside = [e for e in excluded if e <= last]
    kept = last - first + 1 - len(inside)
    got = remapped(spark, range(-kept, kept), excluded, first, last)
    # Ids that are kept stay where they are; the others come from the tail; negative indices count from the end.
    assert all(got[i] == first + i for i in range(kept) if first + i not in inside)
    assert all(got[i] >= first + kept for i in range(kept) if first + i in inside)
    assert all(got[i - kept] == got[i] for i in range(kept))
    assert sorted(got[i] for i in range(kept)) == sorted(set(range(first, last + 1)) - set(inside))


def test_remap_long_chain_and_no_exclusion(spark):
    # One excluded id at the head, all of the tail but its last: the longest chain.
    excluded = [0, *range(21, 40)]
    got = remapped(spark, range(21), excluded, 0, 40)
    assert got == {0: 40} | {i: i for i in range(1, 21)}
    assert remapped(spark, [0, 3], [], 7, 10) == {0: 7, 3: 10}


def test_remap_out_of_range(spark):
    with pytest.raises(Exception, match="index out of range"):
        remapped(spark, [12], [2, 11, 13], 0, 14)


def test_dense_ids_are_checked(spark):
    sampling.check_dense(ids(spark, range(1, 6)), 1, 5)
    for holes in ([1, 2, 4, 5], [1, 2, 3, 4]):
        with pytest.raises(ValueError):
            sampling.check_dense(ids(spark, holes), 1, 5)


def test_split_parts_cover_and_do_not_meet(spark):
    parts = sampling.split_by_id(ids(spark, range(1, 1001))).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in parts} == {"train": 700, "test": 201, "validation": 99}


def test_shuffle_is_a_permutation_fixed_by_its_seed(spark):
    df = ids(spark, range(500))
    a, b, c = (
        [r.id for r in sampling.shuffled(df.repartition(n), seed).orderBy("position").collect()]
        for n, seed in ((2, 1), (5, 1), (5, 2))
    )
    assert a == b and a != c and sorted(a) == list(range(500)) and a != sorted(a)


def test_batches(spark):
    df = ids(spark, range(10))
    whole = sampling.batches(df, ["id"], 4).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in whole] == [4, 4, 2]
    assert sampling.batches(df, ["id"], 4, drop_last=True).count() == 8
    assert sampling.batches(df, ["id"], 5, drop_last=True).count() == 10
    assert [r.id for r in sampling.row_slice(df, ["id"], 3, 2).orderBy("id").collect()] == [3, 4]


def test_random_rows_are_exact_and_repeatable(spark):
    df = ids(spark, range(300))
    first = {r.id for r in sampling.random_rows(df, 25, 9).collect()}
    assert len(first) == 25 and first == {r.id for r in sampling.random_rows(df.repartition(3), 25, 9).collect()}
    assert sampling.random_rows(df, 1000, 9).count() == 300


def test_many_random_rows_are_selected_where_they_lie(spark):
    df = spark.range(0, 60_000, 1, 6)
    few = sorted(r.id for r in df.orderBy(sampling.keyed_order(4, "id"), "id").limit(25_000).collect())
    many = sampling.random_rows(df, 25_000, 4, direct=50)
    assert "TakeOrdered" not in plan_of(many) and "Exchange" not in plan_of(many)
    assert sorted(r.id for r in many.collect()) == few
    assert sampling.random_rows(df, 70_000, 4, direct=50).count() == 60_000
    again = df.selectExpr("id % 3 as id", "id as own")
    got = sampling.random_rows(again, 30_000, 1, direct=50)
    assert got.count() == 30_000 and got.groupBy("id").count().where("count = 20000").count() == 1
    assert sampling.random_rows(df.limit(0), 30_000, 1, direct=50).count() == 0


def test_head_and_tail_of_many_rows(spark, monkeypatch):
    df = spark.range(1000).repartition(5)
    for most in (10, 10_000):
        monkeypatch.setattr(profile, "DIRECT_ROWS", most)
        assert sorted(r.id for r in profile.head(df, 30, ["id"]).collect()) == list(range(30))
        assert [r.id for r in profile.tail(df, 30, ["id"]).collect()] == list(range(970, 1000))
    assert "TakeOrdered" in plan_of(profile.head(df, 30, ["id"]))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permuted_places_are_all_taken_once(spark, n):
    rows = sampling.range_permutation(spark, -7, -7 + 5 * n + 2, 5, seed=n)
    assert "Exchange" not in plan_of(rows) and "Sort" not in plan_of(rows)
    got = sorted((r.position, r.value) for r in rows.collect())
    assert [p for p, _ in got] == list(range(n)) and sorted(v for _, v in got) == [5 * k - 7 for k in range(n)]
    if n > 60:
        other = {r.position: r.value for r in sampling.range_permutation(spark, -7, -7 + 5 * n, 5, seed=n + 1).collect()}
        moved = sum(v != 5 * p - 7 for p, v in got)
        assert moved > 0.9 * n and sum(other[p] != v for p, v in got) > 0.9 * n
        # Neighbours do not stay neighbours.
        values = [v for _, v in got]
        assert sum(abs(a - b) <= 5 for a, b in zip(values, values[1:])) < 0.1 * n


def test_permutation_of_nothing_and_of_large_ranges(spark):
    assert sampling.range_permutation(spark, 5, 5).count() == 0
    far = spark.range(2000).select(sampling.permuted(f"id + {10**18}", (1 << 61) + 12345, 9).alias("v"))
    assert far.distinct().count() == 2000 and far.where(f"v < 0 or v >= {(1 << 61) + 12345}").count() == 0


def test_empty_exclusion_keeps_everything(spark):
    df = ids(spark, range(5))
    assert without_ids(df, df.limit(0)).count() == 5 and without_ids(df, []).count() == 5


def test_fetch_order_duplicates_and_missing(spark):
    points = ids(spark, range(10)).withColumn("v", F.col("id") * 2)
    wanted = spark.createDataFrame([(0, 7), (1, 3), (2, 7), (3, 99), (4, 0)], "pos long, idx long")
    assert [r.id for r in fetch.fetch_batch(points, wanted).collect()] == [7, 3, 0]
    left = fetch.fetch_left(wanted, points).collect()
    assert [(r.idx, r.v) for r in left] == [(0, 0), (3, 6), (7, 14), (7, 14), (99, None)]


def test_catalog_fetch_opens_only_named_shards(spark, tmp_path):
    from quadrille.sources import shards, tables
    from tests.conftest import plan_of

    rows = data.shard_rows(spark, SF)
    catalog = shards.shard_catalog(shards.count_rows(rows))
    tables.write_shards(shards.assign_ids(rows, catalog), str(tmp_path / "t"))
    wanted = spark.createDataFrame([(0, 5), (1, 2)], "pos long, idx long")
    got = fetch.fetch_through_catalog(spark.read.parquet(str(tmp_path / "t")), catalog, wanted)
    assert [r.id for r in got.collect()] == [5, 2]
    assert "PartitionFilters: [isnotnull(shard" in plan_of(got) and "shard_0" in plan_of(got)


def test_labelled_rows_leave_out_excluded_points(spark):
    tree = data.cells(spark, SF)
    rows, weights = sampling.labelled_rows(data.points(spark, SF), tree, smoothing=True)
    assert rows.count() == 985 and weights.select("id").distinct().count() == 985


def test_table_definition(spark):
    names = [c[0] for c in table_definition()]
    assert names == ["id", "latitude", "longitude", "image"]
    raw = spark.createDataFrame([(1, 2.0, None, b"x")], "id int, latitude double, longitude double, image binary")
    with pytest.raises(Exception, match="NULL in longitude"):
        conform(raw).collect()
    with pytest.raises(ValueError):
        conform(raw.drop("image"))
    good = conform(raw.fillna(1.0))
    assert good.schema["id"].metadata == IMAGE_TABLE["id"].metadata


def test_fraction_bounds(spark):
    assert id_fraction_bound(ids(spark, range(1, 11)), 0.37) == 3
    for wrong in (0, 1.1):
        with pytest.raises(ValueError):
            id_fraction_bound(ids(spark, [1]), wrong)


def test_dense_check_sees_duplicates(spark):
    points = spark.createDataFrame([(1,), (1,), (3,)], "id long")
    with pytest.raises(ValueError):
        sampling.check_dense(points, 1, 3)
    sampling.check_dense(spark.createDataFrame([(2,), (1,), (3,)], "id long"), 1, 3)


def test_coincident_points_are_an_error_or_dropped_on_demand(spark):
    from quadrille.operators.quadtree import build_quadtree

    spots = [(10.0, 20.0), (-35.5, 60.25), (70.0, -120.0)]
    points = spark.createDataFrame([(i + 1, *spots[i % 3]) for i in range(3000)], "id long, latitude double, longitude double")
    deep = build_quadtree(points, 5, 500)
    with pytest.raises(Exception, match="cannot be split"):
        sampling.labelled_rows(points, deep)[0].collect()
    assert sampling.labelled_rows(points, deep, cut="drop")[0].count() == 0
    assert sampling.labelled_rows(points, build_quadtree(points, 5, 1500))[0].count() == 3000


def test_points_a_few_metres_apart_are_split(spark):
    from quadrille.operators.quadtree import build_quadtree

    points = spark.createDataFrame([(i + 1, 0.00001 + (i % 20) * 0.00001, 0.00001) for i in range(400)], "id long, latitude double, longitude double")
    rows, _ = sampling.labelled_rows(points, build_quadtree(points, 5, 50))
    assert rows.count() == 400
