from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quadrille.functions import geo
from quadrille.functions.cells import (
    cell_bounds,
    cell_outline,
    cell_parent,
    cell_path,
    curve_place,
    curve_position,
    path_key,
    slot_key,
    with_slots,
)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "cell, box",
    [
        ("", (-90, 90, -180, 180)),
        ("10", (45, 90, 0, 90)),
        ("121", (22.5, 45, 45, 90)),
        ("1320231103", (13.7109375, 13.88671875, 100.1953125, 100.546875)),
        ("132023110331", (13.7548828125, 13.798828125, 100.458984375, 100.546875)),
    ],
)
def test_bounds(spark, cell, box):
    assert tuple(one(spark, cell_bounds(f"'{cell}'"))[0]) == box


def test_float_rule_decides_the_path(spark):
    row = one(spark, cell_path("13.75806D", "100.458984D", 12))
    assert row[0] == "132023110331"


def exact_path(lat, lon, depth):
    """Row and column of the cell as exact fractions of the world, their bits side by side."""
    from fractions import Fraction

    import numpy as np

    def slot(value, low, span, missing):
        value = float(np.float32(value))
        if value != value:
            return missing
        return min(max((Fraction(value) - low) * 2**depth // span, 0), 2**depth - 1)

    row = 2**depth - 1 - slot(lat, -90, 180, 2**depth - 1)
    column = slot(lon, -180, 360, 0)
    return "".join(str(2 * (row >> k & 1) + (column >> k & 1)) for k in reversed(range(depth)))


@pytest.mark.parametrize("depth", [1, 7, 18, 19, 25, 30])
def test_path_equals_exact_fractions(spark, depth):
    import random

    rng = random.Random(depth)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (45.0, -90.0), (95.0, -200.0)]
    points += [(-90 + 180 * k / 64, -180 + 360 * k / 64) for k in range(65)]
    points.append((float("nan"), float("nan")))
    df = spark.createDataFrame(points, "latitude double, longitude double")
    found = df.select("latitude", "longitude", cell_path("latitude", "longitude", depth).alias("p")).collect()
    assert [r["p"] for r in found] == [exact_path(r["latitude"], r["longitude"], depth) for r in found]


def test_null_coordinates_have_no_path(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "latitude double, longitude double")
    assert [r[0] for r in df.select(cell_path("latitude", "longitude", 5)).collect()] == [None, None]


def test_keys_of_slots_and_paths_agree(spark):
    df = spark.createDataFrame([(12.3, 45.6), (-80.0, 179.0)], "latitude double, longitude double")
    for depth in (1, 4, 19):
        slots = with_slots(df, 19).select(
            slot_key("_row", "_column", depth, 19 - depth).alias("a"),
            path_key(f"({_path_text(depth)})").alias("b"),
        )
        assert all(r["a"] == r["b"] for r in slots.collect())


def _path_text(depth):
    return (
        f"lpad(cast(cast(bin(shiftright(_row, {19 - depth})) as decimal(30,0)) * 2"
        f" + cast(bin(shiftright(_column, {19 - depth})) as decimal(30,0)) as string), {depth}, '0')"
    )


def test_parent(spark):
    assert one(spark, cell_parent("'132'"), cell_parent("'1'"), cell_parent("''")) == ("13", "", None)


def test_outline_walks_west_north_east_south(spark):
    df = spark.createDataFrame([("1",)], "cell string")
    points = [(r.latitude, r.longitude) for r in cell_outline(df, 3).orderBy("seq").collect()]
    assert points == [
        (0, 0), (45, 0), (90, 0), (90, 0), (90, 90), (90, 180),
        (90, 180), (45, 180), (0, 180), (0, 180), (0, 90), (0, 0),
    ]


def test_published_distances(spark):
    row = one(
        spark,
        geo.distance_to_box_km(40.7128, -76.006, 40.0, 41.0, -75.0, -73.0),
        geo.distance_to_edge_lines_km(40.7128, -76.006, 40.0, 41.0, -75.0, -73.0),
        geo.haversine_km(40.7128, -76.006, 40.5, -74.0),
        geo.great_circle_km(40.7128, -76.006, 40.5, -74.0),
        geo.distance_to_box_km(40.5, -74.0, 40.0, 41.0, -75.0, -73.0),
    )
    assert [round(v, 6) for v in row] == [84.789854, 31.935183, 170.985801, 170.986043, 0.0]


def test_normal_density(spark):
    row = one(spark, *(geo.normal_pdf(float(x)) for x in (0, 1, 2)))
    assert row == pytest.approx((0.3989422804014327, 0.24197072451914337, 0.05399096651318806), rel=1e-15)


def test_smoothing_weight_vanishes_in_single_precision(spark):
    row = one(spark, geo.normal_pdf(285.0, 0, 20).cast("float"), geo.normal_pdf(270.0, 0, 20).cast("float"))
    assert row[0] == 0 and row[1] > 0


def test_quadrants_add_up(spark):
    from quadrille.operators.points import count_in_box

    df = spark.range(2000).selectExpr(
        "id", "cast((id * 37) % 180 - 90 as float) as latitude", "cast((id * 101) % 360 - 180 as float) as longitude"
    )
    boxes = [(0, 90, -180, 0), (0, 90, 0, 180), (-90, 0, -180, 0), (-90, 0, 0, 180)]
    assert sum(count_in_box(df, *b).first()[0] for b in boxes) == count_in_box(df, -90, 90, -180, 180).first()[0]


def test_edges_of_the_world_are_not_counted(spark):
    from quadrille.operators.points import count_in_box

    df = spark.createDataFrame([(1, 90.0, 0.0), (2, 0.0, 180.0), (3, -90.0, -180.0)], "id long, latitude float, longitude float")
    assert count_in_box(df, -90, 90, -180, 180).first()[0] == 1


def test_no_python_in_cell_plans(spark):
    from tests.conftest import plan_of

    df = spark.range(10).selectExpr("cast(id as double) latitude", "cast(id as double) longitude")
    plan = plan_of(df.select(cell_path("latitude", "longitude", 19), F.lit(1)))
    assert "Python" not in plan and "*(1) Project" in plan


@pytest.mark.parametrize("depth", [1, 7, 19, 30])
def test_curve_place_is_the_path_in_base_four(spark, depth):
    points = spark.range(400).selectExpr("cast(id * 0.45D - 90 as float) as latitude", "cast((id * 7919) % 360 - 180D as float) as longitude")
    placed = with_slots(points.withColumn("path", cell_path("latitude", "longitude", depth)), depth)
    assert all(a == b for a, b in placed.select(curve_place("_row", "_column"), curve_position("path")).collect())
