from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from quadrille.operators import quadtree as qt
from quadrille.operators.label import (
    box_join,
    dense_labels,
    near_cells,
    one_hot_array,
    smoothed_labels,
    tiling,
    with_cell,
    with_class,
)
from quadrille.streaming.labelling import append_labelled
from suite import data
from tests.conftest import SF, plan_of
from tests.test_cells import exact_path


def make(spark, rows):
    return spark.createDataFrame(rows, "id long, latitude float, longitude float")


def leaf_table(spark, cells):
    return spark.createDataFrame(list(enumerate(cells)), "class_idx int, cell string").select("cell", "class_idx")


EDGES = [
    (1, 90.0, 180.0), (2, -90.0, -180.0), (3, 0.0, 0.0), (4, 45.0, 90.0), (5, float("nan"), float("nan")),
    (6, None, 1.0), (7, 1.0, None), (8, 89.9, 179.9), (9, 95.0, 190.0),
]


@pytest.mark.parametrize("strategy", ["broadcast", "merge"])
def test_equals_prefix_search(spark, strategy):
    cells = ["00", "10", "11", "1300", "1301", "2", "3111111"]
    rng = random.Random(4)
    rows = EDGES + [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(10, 400)]
    found = with_cell(make(spark, rows), leaf_table(spark, cells), strategy=strategy).collect()
    assert len(found) == len(rows)
    for r in found:
        expected = None
        if r.latitude is not None and r.longitude is not None:
            path = exact_path(r.latitude, r.longitude, 7)
            expected = next((c for c in cells if path.startswith(c)), None)
        assert r.cell == expected, r
        assert r.class_idx == (None if expected is None else cells.index(expected))


@pytest.mark.parametrize("cells", [["1", "10"], [""], ["2", "2"], ["", "1"]])
def test_overlapping_cells_are_refused(spark, cells):
    with pytest.raises(ValueError):
        with_cell(make(spark, [(1, 0.0, 0.0)]), leaf_table(spark, cells))


def test_tiles_cover_the_world(spark):
    tiles = tiling(leaf_table(spark, ["0", "120", "3333"]).withColumn("cut", F.lit(False)))
    assert tiles.agg(F.sum(F.pow(F.lit(0.25), F.length("tile")))).first()[0] == 1.0


def test_label_join_is_one_broadcast_without_shuffle(spark):
    tree = data.cells(spark, SF)
    plan = plan_of(with_cell(data.points(spark, SF), qt.leaf_lookup(tree), strategy="broadcast"))
    body = plan.split("BroadcastExchange")[0]
    assert plan.count("BroadcastHashJoin") == 1 and "Exchange" not in body and "Python" not in plan


def test_large_leaf_sets_are_not_broadcast(spark):
    tree = data.cells(spark, SF)
    few = with_cell(data.points(spark, SF), qt.leaf_lookup(tree))
    many = with_cell(data.points(spark, SF), qt.leaf_lookup(tree), max_bytes=10)
    assert "BroadcastHashJoin [_probe" in plan_of(few) and "_probe" not in plan_of(many)
    assert few.exceptAll(many).count() == 0 and many.exceptAll(few).count() == 0


def test_unlabelled_points(spark):
    rows = with_cell(make(spark, [(1, 10.0, 10.0), (2, -10.0, -10.0)]), leaf_table(spark, ["1"]))
    assert with_class(rows).count() == 1 and with_class(rows, unlabelled="keep").count() == 2
    with pytest.raises(Exception, match="without a class"):
        with_class(rows, unlabelled="raise").collect()


def test_streaming_labels_equal_batch_labels(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    points = data.points(spark, SF)
    points.repartition(3).write.parquet(source)
    leaves = qt.leaf_lookup(data.cells(spark, SF))
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(source)
    append_labelled(stream, leaves, target, progress=str(tmp_path / "progress")).awaitTermination(120)
    streamed, batch = spark.read.parquet(target), with_cell(points, leaves)
    assert streamed.count() == 1000 and streamed.exceptAll(batch).count() == 0


@pytest.mark.parametrize("bounds", ["[)", "()", "[]"])
@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_box_join(spark, bounds, max_bytes):
    rng = random.Random(1)
    rows = [(i, float(rng.randint(-90, 90)), float(rng.randint(-180, 180))) for i in range(300)]
    boxes = [(0, -10.0, 20.0, -30.0, 40.0), (1, 0.0, 5.0, 175.0, 180.0), (2, -90.0, 90.0, -180.0, 180.0), (3, 10.0, 15.0, 5.0, 10.0)]
    df = spark.createDataFrame(boxes, "box int, south double, north double, west double, east double")
    got = {(r.id, r.box) for r in box_join(make(spark, rows), df, bounds=bounds, max_bytes=max_bytes).collect()}
    low = (lambda a, b: a >= b) if bounds[0] == "[" else (lambda a, b: a > b)
    high = (lambda a, b: a <= b) if bounds[1] == "]" else (lambda a, b: a < b)
    assert got == {
        (i, b) for i, lat, lon in rows for b, s, n, w, e in boxes
        if low(lat, s) and high(lat, n) and low(lon, w) and high(lon, e)
    }


def great_circle(a, b):
    p1, p2, d = math.radians(a[0]), math.radians(b[0]), math.radians(b[1] - a[1])
    y = math.hypot(math.cos(p2) * math.sin(d), math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(d))
    return 6371.009 * math.atan2(y, math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(d))


def middle(cell):
    """Centre of a cell from its row and column."""
    n = 2 ** len(cell)
    row, column = (int("".join(str(int(c) >> s & 1) for c in cell) or "0", 2) for s in (1, 0))
    return 90 - 180 * (row + 0.5) / n, -180 + 360 * (column + 0.5) / n


@pytest.fixture(scope="module")
def crowded(spark):
    """Cells and points around the poles, the date line and a city, with one coarse cell."""
    rng = random.Random(8)
    spots = [(89.7, 10.0), (-89.5, -170.0), (3.0, 179.8), (-2.0, -179.9), (47.5, 19.0), (70.0, 179.0)]
    cells = {"20"}
    rows = []
    for k in range(240):
        lat, lon = spots[k % 6]
        lat = max(-90.0, min(89.99, lat + rng.uniform(-1.5, 1.5)))
        lon = (lon + rng.uniform(-4, 4) + 180) % 360 - 180
        rows.append((k, lat, lon))
        path = exact_path(lat, lon, 9)
        if not path.startswith("20"):
            cells.add(path)
    rows += [(1000, -10.0, -170.0), (1001, -40.0, -100.0)]
    cells = sorted(cells, key=lambda c: (len(c), c))
    classes = spark.createDataFrame(list(enumerate(cells)), "class_idx int, cell string")
    labelled = with_cell(make(spark, rows), classes.select("cell", "class_idx")).cache()
    return cells, classes, labelled


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_near_cells_equal_all_pairs(crowded, max_bytes):
    cells, classes, labelled = crowded
    got = {(r.id, r.near_class) for r in near_cells(labelled, classes, max_bytes=max_bytes).collect()}
    expected = set()
    for r in labelled.where("class_idx is not null").collect():
        for k, cell in enumerate(cells):
            if k == r.class_idx or great_circle((r.latitude, r.longitude), middle(cell)) <= 285:
                expected.add((r.id, k))
    assert got == expected and len(got) > len(labelled.collect())


def test_smoothed_rows_add_up_to_one(crowded):
    cells, classes, labelled = crowded
    weights = smoothed_labels(labelled, classes)
    sums = weights.groupBy("id").agg(F.sum(F.col("weight").cast("double")).alias("s")).collect()
    assert len(sums) == labelled.where("class_idx is not null").count()
    assert all(abs(r.s - 1) < 1e-5 for r in sums)
    dense = dense_labels(weights, len(cells)).first()
    assert len(dense.label) == len(cells)
    hot = one_hot_array(labelled, len(cells)).first()
    assert sum(hot.label) == 1.0


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_smoothing_sorts_and_shuffles_points_not_pairs(crowded, max_bytes):
    _, classes, labelled = crowded
    weights = smoothed_labels(labelled, classes, max_bytes=max_bytes)
    pairs = plan_of(weights).split("HashJoin [_square")[0]
    assert pairs.count("Window [sum") == 1 and "Sort" not in pairs and "Exchange" not in pairs
    plain = {(r.id, r.class_idx): r.weight for r in smoothed_labels(labelled, classes).collect()}
    got = {(r.id, r.class_idx): r.weight for r in weights.collect()}
    assert got.keys() == plain.keys() and all(abs(got[k] - plain[k]) < 1e-6 for k in got)


def test_boxes_of_mixed_sizes(spark):
    """Thin boxes, the whole world and an empty box together; no boxes at all."""
    rng = random.Random(12)
    rows = [(i, 40 + rng.random(), 10 + rng.random()) for i in range(400)]
    boxes = [(k, 40 + k / 200, 40 + (k + 1) / 200, 10.0, 10.01) for k in range(200)] + [(-1, -90.0, 90.0, -180.0, 180.0), (-2, 40.0, 40.0, 10.0, 10.0)]
    df = spark.createDataFrame(boxes, "box int, south double, north double, west double, east double")
    points = make(spark, rows)
    got = sorted((r.id, r.box) for r in box_join(points, df).collect())
    placed = {r.id: (r.latitude, r.longitude) for r in points.collect()}
    assert got == sorted(
        (i, b) for i, (lat, lon) in placed.items() for b, s, n, w, e in boxes if s <= lat < n and w <= lon < e
    )
    assert box_join(points, df.limit(0)).count() == 0


def test_a_distance_is_worked_out_once_per_pair(crowded):
    """Sines and cosines of latitudes come with points and cells; the join has a cheap condition alone, and weights follow it."""
    _, classes, labelled = crowded
    plan = plan_of(smoothed_labels(labelled, classes))
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "_square" in line]
    assert len(joins) == 1 and "ATAN2" not in joins[0].upper() and "EXP(" not in joins[0].upper()
    assert plan.upper().count("ATAN2") <= 2


def test_dense_labels_neither_move_nor_sort_the_pairs(crowded):
    """An aggregation that collects them would sort, and spill, from 128 points a task on."""
    cells, classes, labelled = crowded
    weights = smoothed_labels(labelled, classes)
    plan = plan_of(dense_labels(weights, len(cells))).split("HashJoin [_square")[0]
    assert "Sort" not in plan and "Exchange" not in plan and "Aggregate" not in plan
    expected = {}
    for r in weights.collect():
        expected.setdefault(r.id, [0.0] * len(cells))[r.class_idx] = r.weight
    got = {r.id: r.label for r in dense_labels(weights, len(cells)).collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k], abs=1e-6) for k in got)


def test_dense_labels_of_odd_entries(spark):
    entries = [(1, 2, 0.5), (1, 0, 0.25), (2, 1, None), (2, 3, 1.0), (None, 3, 1.0), (4, 1, 0.75), (4, 1, 0.5), (5, None, 1.0)]
    sparse = spark.createDataFrame(entries, "id long, class_idx int, weight float")
    got = {r.id: r.label for r in dense_labels(sparse, 4).collect()}
    assert got == {1: [0.25, 0, 0.5, 0], 2: [0, None, 0, 1.0], None: [0, 0, 0, 1.0], 4: [0, 0.5, 0.75, 0, 0], 5: None}
