from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quadrille.functions.cells import in_world
from quadrille.operators import quadtree as qt
from quadrille.operators.label import excluded_points, with_cell
from suite import data
from tests.conftest import SF, plan_of


def make(spark, rows):
    return spark.createDataFrame(rows, "id long, latitude float, longitude float")


def by_levels(points, tau_min, tau_max, max_depth):
    """The partition level by level, cell by cell."""
    nodes, open_cells = {"": 0}, [("", -90.0, 90.0, -180.0, 180.0)]
    while open_cells:
        following = []
        for path, south, north, west, east in open_cells:
            mid_lat, mid_lon = (south + north) / 2, (west + east) / 2
            quarters = [
                (mid_lat, north, west, mid_lon), (mid_lat, north, mid_lon, east),
                (south, mid_lat, west, mid_lon), (south, mid_lat, mid_lon, east),
            ]
            for digit, (s, n, w, e) in enumerate(quarters):
                inside = sum(s <= lat < n and w <= lon < e for _, lat, lon in points)
                child = path + str(digit)
                if inside <= tau_min:
                    nodes[child] = (0, inside)
                elif inside < tau_max:
                    nodes[child] = (2, inside)
                elif len(child) == max_depth:
                    nodes[child] = (1, inside)
                else:
                    nodes[child] = (0, inside)
                    following.append((child, s, n, w, e))
        open_cells = following
    del nodes[""]
    return nodes


def found(tree):
    return {r.cell: (r.state, r.n) for r in tree.where("depth > 0").collect()}


@pytest.fixture(scope="module")
def sample(spark):
    return [(r.id, r.latitude, r.longitude) for r in data.points(spark, SF).collect()]


@pytest.mark.parametrize("tau", [(10, 200), (0, 20), (5, 5), (50, 60), (0, 2)])
def test_equals_levels(spark, sample, tau):
    tree = qt.build_quadtree(make(spark, sample), *tau, max_depth=12)
    assert found(tree) == by_levels(sample, *tau, 12)


@pytest.mark.parametrize("limits", [dict(first_span=2, next_span=1), dict(first_span=3, next_span=4, max_broadcast_bytes=0)])
def test_spans_do_not_matter(spark, sample, limits):
    points = make(spark, sample)
    assert found(qt.build_quadtree(points, 2, 9, **limits)) == found(qt.build_quadtree(points, 2, 9))


def test_tree_is_sound(spark):
    tree = data.cells(spark, SF).cache()
    leaves = tree.join(tree.select(F.col("parent").alias("cell")).distinct(), "cell", "left_anti")
    area = leaves.agg(F.sum((F.col("north") - F.col("south")) * (F.col("east") - F.col("west")))).first()[0]
    assert area == 180 * 360
    sums = tree.where("depth > 0").groupBy(F.col("parent").alias("cell")).agg(F.sum("n").alias("children"))
    wrong = tree.join(sums, "cell").where("n <> children")
    assert wrong.count() == 0
    assert [r.class_idx for r in qt.active_cells(tree).orderBy("class_idx").collect()] == list(range(13))


def test_identical_coordinates_stop_at_the_depth_bound(spark):
    points = make(spark, [(i, 10.0, 20.0) for i in range(50)] + [(99, 0.5, 0.5)])
    tree = qt.build_quadtree(points, 0, 10, max_depth=6)
    cut = tree.where("state = 1").collect()
    assert [(c.depth, c.n) for c in cut] == [(6, 50)]
    assert qt.any_evaluating(tree).first()[0] is True
    rows = with_cell(points, qt.leaf_lookup(tree))
    assert rows.where("cut").count() == 50 and rows.where("class_idx is not null").count() == 1
    assert excluded_points(rows).count() == 0


def test_empty_input(spark):
    tree = qt.build_quadtree(make(spark, []), 10, 200)
    assert sorted((r.cell, r.state, r.n) for r in tree.collect()) == [
        ("", 0, 0), ("0", 0, 0), ("1", 0, 0), ("2", 0, 0), ("3", 0, 0)
    ]
    points = make(spark, [(1, 0.0, 0.0)])
    assert with_cell(points, qt.leaf_lookup(tree)).first()["cell"] is None


def test_points_beyond_the_world_are_not_counted(spark):
    outside = [(1, 90.0, 0.0), (2, 0.0, 180.0), (3, float("nan"), 0.0), (4, -91.0, 0.0)]
    tree = qt.build_quadtree(make(spark, outside + [(5, 1.0, 1.0)]), 0, 3)
    assert tree.where("depth = 0").first()["n"] == 1


def test_bad_thresholds(spark):
    for tau in ((-1, 5), (6, 5)):
        with pytest.raises(ValueError):
            qt.build_quadtree(make(spark, []), *tau)


def test_excluded_plus_labelled_is_the_world(spark):
    rows, _, _ = data.labelled(spark, SF)
    out, labelled = excluded_points(rows).count(), rows.where("class_idx is not null").count()
    assert (out, labelled) == (15, 985)
    assert rows.where(in_world()).count() == out + labelled


def test_build_reads_only_coordinates(spark, tmp_path):
    images = data.points(spark, SF).withColumn("image", F.lit("x" * 100).cast("binary"))
    images.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    slots = table.where(in_world()).select("latitude", "longitude")
    plan = plan_of(slots)
    assert "image" not in plan and "GreaterThanOrEqual(latitude,-90.0)" in plan
