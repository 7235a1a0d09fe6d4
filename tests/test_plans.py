from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from quadrille.plans import asof
from quadrille.plans.asof import asof_backward
from quadrille.plans.durable import durable_root, fresh_folder
from quadrille.plans.ranking import dense_index, keyed_index, rank_within, running_total
from quadrille.plans.salting import salted_join
from quadrille.plans.sizing import broadcast_if_small, fits_broadcast, measured_bytes
from tests.conftest import plan_of


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_index(spark, partitions):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 as k", "id").repartition(partitions)
    rows = dense_index(df, [F.desc("k")], "i", 10).orderBy("i").collect()
    assert [r.i for r in rows] == list(range(10, 5010))
    assert [r.k for r in rows] == list(range(4999, -1, -1))


@pytest.fixture
def many_partitions(spark):
    """Keeps every shuffle partition, so that offsets really cross partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers_cross_partitions(spark, many_partitions):
    from quadrille.plans.durable import pin

    df = spark.range(3000).selectExpr("(id * 7919) % 3000 as k", "1 as one")
    assert pin(df.orderBy("k")).rdd.getNumPartitions() == 4
    rows = running_total(dense_index(df, ["k"], "i"), ["k"], "one", "t").orderBy("k").collect()
    assert all(r.i == r.k and r.t == r.k + 1 for r in rows) and len(rows) == 3000


def test_merge_carries_over_partitions(spark, many_partitions):
    left = spark.range(0, 4000, 3).withColumnRenamed("id", "x")
    right = spark.createDataFrame([(5,), (2100,)], "k long").withColumn("v", F.col("k"))
    got = asof_backward(left, right, left_key="x", right_key="k", take=["v"], strategy="merge").collect()
    assert all(g.v == (None if g.x < 5 else 5 if g.x < 2100 else 2100) for g in got) and len(got) == left.count()


def test_merge_is_one_shuffle_a_side(spark, tmp_path):
    left = spark.range(30_000).selectExpr("if(id % 3 = 0, 777, if(id % 50 = 1, null, id * 3 - 500)) as x", "id as _n", "'w' as wide")
    right = spark.range(0, 5000).selectExpr("id * id % 70001 as k").distinct().withColumn("v", F.col("k"))
    for name, df in (("l", left), ("r", right)):
        df.write.parquet(str(tmp_path / name))
    left, right = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    got = asof_backward(left, right, left_key="x", right_key="k", take=["v"], strategy="merge")
    plan = plan_of(got)
    assert plan.count("Exchange hashpartitioning") == 2 and "ShuffledHashJoin" in plan and "Window" not in plan and "rangepartitioning" not in plan
    keys = sorted(r.k for r in right.collect())
    want = {r["_n"]: None if r.x is None or r.x < keys[0] else keys[bisect.bisect_right(keys, r.x) - 1] for r in left.collect()}
    rows = got.collect()
    assert {r["_n"]: r.v for r in rows} == want and len(rows) == 30_000 and got.columns == ["x", "_n", "wide", "v"]


@pytest.mark.parametrize("rows", [0, 1, 2, 40, 3000])
def test_merge_with_few_and_many_ranges(spark, rows, monkeypatch):
    monkeypatch.setattr(asof._merge, "__kwdefaults__", {"span": 7, "most": 150})
    left = spark.range(-5, 9100, 3).withColumnRenamed("id", "x")
    right = spark.range(rows).selectExpr("id * 3 + 1 as k", "string(id) as v")
    got = asof_backward(left, right, left_key="x", right_key="k", take=["v"], strategy="merge").collect()
    last = 3 * rows - 2
    assert all(g.v == (None if g.x < 1 or not rows else str((min(g.x, last) - 1) // 3)) for g in got) and len(got) == left.count()


def test_merge_plan_does_not_grow_with_its_ranges(spark):
    left = spark.range(0, 9000, 7).withColumnRenamed("id", "x")

    def length(rows):
        right = spark.range(rows).selectExpr("id * 3 as k", "id as v")
        got = asof_backward(left, right, left_key="x", right_key="k", take=["v"], strategy="merge")
        assert all(g.v == min(g.x // 3, rows - 1) for g in got.collect())
        return len(got._jdf.queryExecution().toString())

    assert length(3000) < 2 * length(40)


def test_rank_within_groups_larger_than_a_partition(spark, many_partitions):
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 40)) as g", "(id * 7919) % 6000 as k", "id")
    got = rank_within(rows.repartition(5), "g", ["k"], "r").collect()
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.g, []).append(r.k)
    want = {(g, k): (i, len(ks)) for g, ks in groups.items() for i, k in enumerate(sorted(ks))}
    assert {(r.g, r.k): (r.r, r.r_of) for r in got} == want and len(got) == 6000
    assert rank_within(rows.limit(0), "g", ["k"]).collect() == []


def test_dense_index_of_nothing(spark):
    assert dense_index(spark.range(0), ["id"], "i").collect() == []


def test_dense_index_uses_no_single_partition_window_over_rows(spark):
    numbered = dense_index(spark.range(1000), ["id"], "i")
    plan = plan_of(numbered)
    # The only window runs over one row per partition, below the broadcast.
    assert plan.count("Window") == 1 and plan.index("BroadcastExchange") < plan.index("Window")


def test_running_total(spark):
    df = spark.range(300).selectExpr("id", "id % 5 as v").repartition(6)
    total, expected = 0, []
    for i in range(300):
        total += i % 5
        expected.append(total)
    assert [r.t for r in running_total(df, ["id"], "v", "t").orderBy("id").collect()] == expected


def brute_asof(left, right):
    return [max((k for k in right if k <= x), default=None) if x is not None else None for x in left]


@pytest.mark.parametrize("strategy", ["auto", "bucket", "merge"])
@pytest.mark.parametrize("seed", range(4))
def test_asof(spark, strategy, seed):
    rng = random.Random(seed)
    spread = [50, 10_000, 10**15, 3][seed]
    right = sorted({rng.randint(-spread, spread) for _ in range(40)})
    left = [rng.randint(-2 * spread, 2 * spread) for _ in range(300)] + right + [None] + [right[0]] * 50
    l = spark.createDataFrame(list(enumerate(left)), "pos long, x long")
    r = spark.createDataFrame([(k, f"r{k}") for k in right], "k long, name string")
    got = asof_backward(l, r, left_key="x", right_key="k", take=["name"], strategy=strategy).orderBy("pos").collect()
    assert [g.name for g in got] == [None if k is None else f"r{k}" for k in brute_asof(left, right)]


def test_asof_with_crowded_intervals_and_empty_right(spark):
    l = spark.range(0, 3000, 7).withColumnRenamed("id", "x")
    right = list(range(500)) + [10**9]
    r = spark.createDataFrame([(k, k) for k in right], "k long, v long")
    got = asof_backward(l, r, left_key="x", right_key="k", take=["v"]).collect()
    assert all(g.v == min(g.x, 499) for g in got)
    none = asof_backward(l, r.limit(0), left_key="x", right_key="k", take=["v"]).collect()
    assert len(none) == l.count() and all(g.v is None for g in none)


def test_salted_join_splits_the_hot_key(spark):
    big = spark.range(1000).selectExpr("id", "if(id < 700, 1, cast(id % 9 as int)) as k")
    other = spark.createDataFrame([(k, v) for k in range(9) for v in range(2)], "k int, v int")
    met = salted_join(big, other, "k", "id", rows_per_salt=50)
    plain = big.join(other, "k")
    assert met.count() == 2000
    assert met.select(*plain.columns).exceptAll(plain).count() == 0


def test_sizes_are_measured(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) as s", "array(1, 2) as a")
    assert measured_bytes(df) > 100_000
    assert fits_broadcast(df, 1 << 20) and not fits_broadcast(df, 1000)
    assert "Broadcast" in plan_of(spark.range(10).join(broadcast_if_small(df), "id"))


def test_checkpoint_folder_of_the_session_is_used(spark):
    assert fresh_folder(spark, "x").startswith(durable_root(spark))
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_keyed_index_sorts_keys_alone(spark):
    rows = [(k, None if k == 3 else k % 5, f"image {k}") for k in range(200)]
    df = spark.createDataFrame(rows, "k long, g long, image string").repartition(5)
    numbered = keyed_index(df, ["g", "k"], "i", 7)
    place = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0])), 7)}
    assert {r.k: (r.i, r.image) for r in numbered.collect()} == {k: (place[k], image) for k, _, image in rows}
    # Equal keys: every row keeps a number of its own.
    assert sorted(r.i for r in keyed_index(df, ["g"], "i").collect()) == list(range(200))
    # Beyond the broadcast bound too, no sort moves the other columns.
    wide = keyed_index(df, ["g", "k"], "i", 7, max_bytes=1)
    assert "SortMergeJoin" not in plan_of(numbered) and "ShuffledHashJoin" in plan_of(wide)
    assert sorted(numbered.collect(), key=str) == sorted(wide.collect(), key=str)
