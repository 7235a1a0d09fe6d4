"""Pairs of points and cells as matrices, packed and one-hot labels, sums and rounding in compiled code."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.functions.scores import rounded, sparse_sum
from quadrille.operators import squares
from quadrille.operators.label import (
    dense_labels,
    label_entries,
    label_sums,
    near_cells,
    one_hot_array,
    smoothed_labels,
    with_cell,
)
from tests.conftest import plan_of
from tests.test_cells import exact_path


@pytest.fixture(scope="module")
def spots(spark):
    """Points at a pole, the date line and a city; id 7 twice in one place and id 8 in two, one id is null."""
    rng = random.Random(5)
    rows = []
    for k in range(90):
        lat, lon = [(89.2, 10.0), (3.0, 179.8), (47.5, 19.0)][k % 3]
        rows.append((k + 10, lat + rng.uniform(-0.7, 0.7), (lon + rng.uniform(-3, 3) + 180) % 360 - 180))
    rows += [(7, 47.5, 19.0), (7, 47.5, 19.0), (8, 47.6, 19.1), (8, 3.0, 179.9), (None, 47.7, 19.3)]
    cells = sorted({exact_path(lat, lon, 9) for _, lat, lon in rows})
    classes = spark.createDataFrame(list(enumerate(cells)), "class_idx int, cell string")
    points = spark.createDataFrame(rows, "id long, latitude float, longitude float")
    return len(cells), classes, with_cell(points, classes.select("cell", "class_idx")).cache()


def test_near_cells_are_dealt_before_they_fan_out(spots):
    """A file may be one row group, and so one task, however many pairs its points have."""
    _, classes, labelled = spots
    met = near_cells(labelled, classes, tasks=5)
    assert met.rdd.getNumPartitions() == 5 and "_square" in plan_of(met).split("Exchange hashpartitioning")[1]
    by_join = near_cells(labelled, classes, max_bytes=0)
    one, other = (sorted((str(r.id), r.near_class, round(r.km, 6)) for r in f.collect()) for f in (met, by_join))
    assert one == other and len(one) > 90 * 3


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_packed_labels_are_the_pairs(spots, max_bytes):
    _, classes, labelled = spots
    labelled = labelled if max_bytes else labelled.where("id is null or id <> 8")  # the join adds up an id per square
    pairs = smoothed_labels(labelled, classes).collect()
    packed = smoothed_labels(labelled, classes, max_bytes=max_bytes, packed=True)
    got = label_entries(packed).collect()
    assert sorted((str(r.id), r.class_idx, round(r.weight, 6)) for r in got) == sorted((str(r.id), r.class_idx, round(r.weight, 6)) for r in pairs)
    sums = {r.id: (r.n, r.t) for r in label_sums(packed).groupBy("id").agg(F.sum("entries").alias("n"), F.sum("total").alias("t")).collect()}
    assert {k: n for k, (n, _) in sums.items()} == {r.id: sum(p.id == r.id for p in pairs) for r in pairs}
    assert all(abs(t - 1) < 1e-5 for _, t in sums.values())


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_packed_labels_become_the_same_dense_rows(spots, max_bytes):
    n, classes, labelled = spots
    labelled = labelled if max_bytes else labelled.where("id is null or id <> 8")
    whole = {r.id: r.label for r in dense_labels(smoothed_labels(labelled, classes), n).collect()}
    got = dense_labels(smoothed_labels(labelled, classes, max_bytes=max_bytes, packed=True), n).collect()
    assert len(got) == len(whole) and all(whole[r.id] == pytest.approx(r.label, abs=1e-6) for r in got)


def test_rounds_keep_equal_ids_together(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(squares, "ROUND_POINTS", 4)
    ids = [1, 1, 2, 2, 2, 2, 2, 2, 2, None, None, 5]
    batches = [pa.RecordBatch.from_pydict({"id": pa.array(ids[k : k + 3], pa.int64())}) for k in range(0, 12, 3)]
    rounds = [t.column("id").to_pylist() for t in squares._rounds(iter(batches), "id")]
    assert sum(rounds, []) == ids and all(a[-1] != b[0] for a, b in zip(rounds, rounds[1:])) and len(rounds) > 1


def test_distances_of_near_and_antipodal_points():
    def at(lat, lon):
        lat, lon = np.radians([lat]), np.radians([lon])
        return squares.unit_vectors(np.sin(lat), np.cos(lat), lon)

    assert squares.great_circle_km(at(12.0, 30.0), at(12.0, 30.0))[0, 0] == 0
    per_degree = 6371.009 * math.pi / 180
    for gap in (1e-6, 0.5, 89.0, 120.0, 179.999999):
        assert squares.great_circle_km(at(0.0, 0.0), at(0.0, gap))[0, 0] == pytest.approx(gap * per_degree, abs=1e-8)


def test_rounding_is_that_of_round(spark):
    rng = random.Random(3)
    odd = [0.0, -0.0, 0.5e-6, 1.5e-6, -0.5e-6, 2.5e-6, 1.0000005, 0.1234565, 1e-45, -1e-9, 1e15, 12345.6789125, None, math.nan, math.inf, -math.inf]
    numbers = odd + [rng.uniform(-300, 300) for _ in range(2000)] + [k / 2e6 for k in range(-500, 500)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    same = df.select(rounded("x", 6).alias("a"), F.round("x", 6).alias("b")).where("cast(a as string) <=> cast(b as string)")
    assert same.count() == len(numbers)
    assert "round" in df.select(rounded("x", 6))._jdf.queryExecution().toString()


def test_one_hot_rows_are_dealt_while_they_are_narrow(spots):
    n, _, labelled = spots
    hot = one_hot_array(labelled.coalesce(1), n, tasks=5)
    above, below = plan_of(hot).split("Exchange hashpartitioning")[:2]
    assert "array_repeat" in above and "array_repeat" not in below
    assert hot.rdd.getNumPartitions() == 5
    got = sorted((str(r.id), r.label) for r in hot.collect())
    assert got == sorted((str(r.id), r.label) for r in one_hot_array(labelled, n).collect())


def test_sum_of_sparse_floats(spark):
    rows = [([0.0, 0.25, 0.0, -0.0, 2.0],), ([],), (None,), ([0.0, None],), ([math.nan, 0.0],), ([0.0, 0.0],)]
    df = spark.createDataFrame(rows, "x array<float>")
    got = df.select(sparse_sum("x").alias("a"), F.expr("aggregate(x, 0D, (a, v) -> a + v)").alias("b"))
    assert got.where("a <=> b").count() == len(rows)
    assert "array_remove" in plan_of(got)
