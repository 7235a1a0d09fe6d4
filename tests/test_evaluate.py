from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from quadrille.functions import scores, text, units
from quadrille.operators import evaluate, grid, profile, scoring
from suite import data
from quadrille.operators.label import one_hot_array
from tests.conftest import SF, plan_of


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def epochs(spark, losses):
    rows = [(1, k, 0.5, loss, 0.1 * k, 2.0) for k, loss in enumerate(losses, 1)]
    kinds = "run int, epoch int, train_loss double, test_loss double, test_acc double, mean_squared_error double"
    return spark.createDataFrame(rows, kinds)


def test_best_epoch_and_early_stop(spark):
    nan = float("nan")
    table = epochs(spark, [0.9, 0.7, 0.7, nan, 0.8, 0.6])
    best = [r.best_epoch for r in evaluate.best_so_far(table).orderBy("epoch").collect()]
    assert best == [1, 2, 2, 2, 2, 6]
    kept = evaluate.early_stop(table, 3).orderBy("epoch").collect()
    assert [r.epoch for r in kept] == [1, 2, 3, 4, 5] and all(r.stopped_early for r in kept)
    assert [r.best_epoch for r in kept] == [1, 2, 2, 2, 2]


def test_nothing_ever_improves(spark):
    nan = float("nan")
    kept = evaluate.early_stop(epochs(spark, [nan, nan, nan]), 1).orderBy("epoch").collect()
    assert [r.epoch for r in kept] == [1, 2]
    assert kept[-1].best_epoch == 1 and kept[-1].best_epoch_test_loss == math.inf and kept[-1].best_epoch_test_acc == 0


def test_run_summary(spark):
    table = epochs(spark, [0.9, 0.5, 0.8]).withColumn(
        "epoch_start", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, epoch)")
    ).withColumn("epoch_end", F.expr("epoch_start + make_dt_interval(0, 0, 0, 30.5)"))
    row = evaluate.run_summary(evaluate.early_stop(table, 5)).first()
    assert (row.last_epoch, row.best_epoch, row.stopped_early) == (3, 2, False)
    assert row.run_time == 150.5 and row.best_epoch_test_acc == pytest.approx(0.2)


def test_scores(spark):
    df = spark.sql("select array(1D, 3D, 3D, 2D) as s, array(0.25D, 0.25D, 0.5D, 0D) as y")
    row = df.select(
        scores.arg_max("s"), scores.softmax("s"), scores.cross_entropy("s", "y"), scores.cross_entropy_one_hot("s", "2"),
        scores.top_classes("s", 2),
    ).first()
    total = sum(math.exp(x) for x in (1, 3, 3, 2))
    assert row[0] == 1
    assert row[1] == pytest.approx([math.exp(x) / total for x in (1, 3, 3, 2)])
    assert row[2] == pytest.approx(math.log(total) - (0.25 + 0.75 + 1.5))
    assert row[3] == pytest.approx(math.log(total) - 3)
    assert [(e.rank, e.class_idx, e.prob) for e in row[4]] == [(1, 1, 3.0), (2, 2, 3.0)]


def test_softmax_of_large_scores_and_floats(spark):
    row = spark.sql("select array(1000F, 1000F) as s").select(scores.softmax("s")).first()
    assert row[0] == [0.5, 0.5]


def test_baseline_denominators(spark):
    p = data.points(spark, SF)
    rows = evaluate.constant_baseline(p, 0.0, 0.0, top=1000).first()
    span = evaluate.constant_baseline(p, 0.0, 0.0, top=1000, denominator="range").first()
    assert rows.n == 200 and span.mean_km == pytest.approx(rows.mean_km * 200 / int(1000 * (0.9 - 0.7)))


def test_benchmark_summary_of_published_runs(spark):
    # Published fetch times of batch sizes 1, and their published mean and deviation.
    seconds = [0.7861878871917725, 0.7890615463256836, 0.5396754741668701, 0.7526328563690186, 0.7458944320678711]
    df = spark.createDataFrame([(1, s) for s in seconds] + [(2, 1.0), (2, 3.0)], "batch_size long, seconds double")
    one_row, two_rows = profile.benchmark_summary(df).orderBy("batch_size").collect()
    assert one_row.mean_seconds == pytest.approx(0.7226904392242431, rel=1e-12)
    assert one_row.std_seconds == pytest.approx(0.09313055440570546, rel=1e-12)
    assert (two_rows.mean_seconds, two_rows.std_seconds, two_rows.seconds_per_row) == (2.0, 1.0, 1.0)


def test_units(spark):
    row = one(
        spark,
        units.format_size("1024"),
        units.format_size("1024", "MB", "'GB'"),
        units.format_size("1024", base="'MB'"),
        units.format_size("0.5"),
        units.format_size("1.5"),
        units.format_size("3e24", precision=1),
        units.format_size_1024("1536"),
        units.convert_size("1", "B", "'YiB'"),
        units.auto_unit("999"),
    )
    assert tuple(row) == ("1 kB", "1024000 MB", "1024000 kB", "0 B", "2 B", "3.0 YB", "1.50 kb", float(1024**8), "B")
    with pytest.raises(ValueError):
        units.format_size("1", "foo")
    with pytest.raises(Exception, match="invalid unit"):
        spark.range(1).select(units.convert_size("1", "B", "'foo'")).collect()


def test_text_and_dates(spark):
    df = spark.sql("select date'2001-01-01' as a, date'2001-01-09' as b")
    days = text.date_steps(df, "a", "b", 2)
    assert [r.day.day for r in days.orderBy("day").collect()] == [1, 3, 5, 7, 9]
    assert [r[0] for r in days.orderBy("day").select(text.iso_weekday("day")).collect()] == [1, 3, 5, 7, 2]
    words = spark.createDataFrame([("polar",), ("a\npolar polar",), ("bear",)], "s string")
    assert [r[0] for r in words.select(text.replace_first("s", "polar", "pola")).collect()] == ["pola", "a\npola polar", "bear"]
    stems = spark.createDataFrame([("file:/a/b/shard_12.msg",), ("/x/plain",)], "p string")
    assert [r[0] for r in stems.select(text.file_stem("p")).collect()] == ["shard_12", "plain"]


def test_grid_edges_that_are_not_integers(spark):
    rows, columns = 180, 360
    points = []
    for k in range(rows):
        for edge in (-90 + 180 * (k / rows),):
            points.append((edge, 0.5))
    df = spark.createDataFrame(points, "latitude float, longitude float")
    got = {(r.row, r.n) for r in grid.grid_density(df, rows, columns).collect()}
    import numpy as np

    expected: dict[int, int] = {}
    for lat, _ in points:
        lat = float(np.float32(lat))
        for i in range(rows):
            if -90 + 180 * ((rows - i - 1) / rows) <= lat < -90 + 180 * ((rows - i) / rows):
                expected[i] = expected.get(i, 0) + 1
    assert got == set(expected.items())


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (10.0,), (None,)], "v double")
    row = profile.describe(df, ["v"]).first()
    assert (row["count"], row.null_count, row.mean, row.min, row.q25, row.q50, row.q75, row.max) == (4, 1, 3.75, 1, 1, 2, 2, 10)


def test_classifier_learns(spark):
    rows = spark.range(200).selectExpr("id", "cast(id % 2 as int) as class_idx", "array(cast(id % 2 as float), 1F) as features")
    model = scoring.train_classifier(rows, 3, max_iter=10)
    hits = scoring.classify(model, rows).join(rows, "id").where(scores.arg_max("probs") == F.col("class_idx"))
    assert hits.count() == 200


def test_append_needs_frames(spark):
    assert evaluate.append(spark.range(2), spark.range(3)).count() == 5
    with pytest.raises(ValueError):
        evaluate.append()


def test_training_blocks_follow_the_number_of_classes(spark, monkeypatch):
    rows = spark.range(40).selectExpr("array(cast(id % 4 = 0 as int) + id / 100, cast(id % 4 = 1 as int), id % 3) as features", "cast(id % 4 as int) as class_idx")
    assert scoring._block_mb(10, 64) == 1.0
    # A score per row of a block and class: 60,000 classes of blocks of the usual megabyte were about a gigabyte in each task.
    assert scoring._block_mb(60_000, 64) * (1 << 20) / (8 * 66) * 60_000 <= scoring.BLOCK_SCORES
    usual = scoring.train_classifier(rows, 6, max_iter=200, reg=0.1)
    monkeypatch.setattr(scoring, "BLOCK_SCORES", 12)
    small = scoring.train_classifier(rows, 6, max_iter=200, reg=0.1)
    assert small.getMaxBlockSizeInMB() < 1e-3 and usual.getMaxBlockSizeInMB() == 1.0
    assert abs(usual.coefficientMatrix.toArray() - small.coefficientMatrix.toArray()).max() < 1e-4


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    """Rows that come from one partition of many would be one task's work in every step."""
    seen = []
    monkeypatch.setattr(scoring, "pin", lambda df, put=scoring.pin: seen.append(put(df)) or seen[-1])
    rows = spark.range(800).selectExpr("cast(id % 2 as int) as class_idx", "array(cast(id % 2 as float), float(id)) as features").coalesce(1)
    assert scoring.train_classifier(rows, 2, max_iter=2).numClasses == 2
    shares = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) == spark.sparkContext.defaultParallelism and max(shares) < 2 * min(shares)


def test_softmax_of_repeated_scores(spark):
    df = spark.sql("select array(1F, 2F, 0.5F) as s union all select array(1F, null, 0.5F) union all select cast(null as array<float>)")
    for n in (1, 2, 3, 7, 9):
        rows = [r[0] for r in df.select(scores.softmax("s", n)).collect()]
        total = sum(math.exp([1, 2, 0.5][i % 3]) for i in range(n))
        assert rows[0] == pytest.approx([math.exp([1, 2, 0.5][i % 3]) / total for i in range(n)])
        assert rows[1] == ([1.0] if n == 1 else [None] * n) and rows[2] == [None] * n


def test_top_classes_of_long_arrays_are_those_of_a_whole_sort(spark):
    long = "transform(sequence(0, 999), i -> {})"
    values = ["cast((i * 7919) % 1000 as double)", "cast(i % 7 as double)", "if(i = 500, null, i / 7D)", "if(i = 500, double('NaN'), -i / 7D)", "0D"]
    for value in values:
        df = spark.range(1).select(F.expr(long.format(value)).alias("s"))
        for k in (1, 5, 200):
            few, every = df.select(scores.top_classes("s", k), scores.top_classes("s")).first()
            assert str(few) == str(every[:k])
    # Beyond a few scores only pieces are sorted.
    assert "sqrt" in str(df.select(scores.top_classes("s", 5))._jdf.queryExecution().analyzed().toString().lower())


def test_rows_of_scores_are_not_shuffled(spark):
    predictions = spark.range(4).select("id", F.expr("transform(sequence(0, 99), i -> cast(i % (id + 2) as double) / 10)").alias("probs"))
    truth = spark.range(1, 9).selectExpr("id", "1.5 as latitude", "2.5 as longitude", "if(id = 3, null, cast(id as int)) as class_idx")
    classes = spark.range(100).selectExpr("cast(id as int) as class_idx", "lpad(conv(cast(id as string), 10, 4), 5, '0') as cell", "1L as n")
    errors = evaluate.prediction_errors(predictions, truth, classes)
    plan = plan_of(errors)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    hard = {r.id: r.loss for r in errors.collect()}
    assert sorted(hard) == [1, 2]
    met = predictions.join(evaluate.truth_of(predictions, truth).select("id", "class_idx"), "id")
    soft = evaluate.prediction_errors(one_hot_array(met, 100, keep=("probs",)), truth, classes)
    assert {r.id: r.loss for r in soft.collect()} == pytest.approx(hard)


def test_all_cells_are_ranked_as_by_a_sort_of_pairs(spark):
    """Nulls first and NaN last, ties by class, without an object per score."""
    long = "transform(sequence(0, 299), i -> {})"
    values = ["cast((i * 7919) % 1000 as double)", "cast(i % 7 as double)", "if(i % 9 = 5, null, i % 11 / 7D)", "if(i % 5 = 0, double('NaN'), -(i % 3) / 7D)", "if(i = 3, -0D, 0D)"]
    rows = [spark.range(1).select(F.lit(k).alias("id"), F.expr(long.format(v)).alias("probs")) for k, v in enumerate(values)]
    rows.append(spark.sql("select 5 as id, cast(array() as array<double>) as probs union all select 6, null"))
    df = evaluate.append(*rows)
    classes = spark.range(300).selectExpr("cast(id as int) as class_idx", "lpad(conv(cast(id as string), 10, 4), 5, '0') as cell", "1L as n")
    found = evaluate.ranked_cells(df, classes).select("id", "rank", "class_idx", F.col("prob").cast("string").alias("prob"))
    wanted = df.select("id", F.inline(scores.top_classes("probs"))).withColumn("prob", F.col("prob").cast("string"))
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert "named_struct" not in plan_of(found) and "lambdafunction" not in plan_of(evaluate.ranked_cells(df.select("id", "probs").coalesce(1), classes)).split("ArrowEvalPython")[0]


def test_losses_of_long_arrays_are_those_of_short_ones(spark):
    """Sums in tasks, with the nulls of the expressions; no function per element."""
    rows = [([0.5, -1.0, 3.0], [0.25, 0.75, 0.0]), ([0.1, None], [0.5, 0.5]), ([0.1, 0.2], [0.5, None]), ([], []), (None, [1.0]), ([math.nan, 1.0], [1.0, 0.0]), ([800.0, 1.0], [0.0, 1.0])]
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(rows)], "id int, s array<double>, y array<float>").cache()
    pair = df.select(scores.long_cross_entropy("s", "y").alias("a"), scores.cross_entropy("s", "y").alias("b"))
    for r in pair.collect():
        assert (r.a is None and r.b is None) or str(r.a) == str(r.b) or r.a == pytest.approx(r.b)
    plan = plan_of(pair.select("a"))
    assert "ArrowEvalPython" in plan and "zip_with" not in plan and "aggregate(" not in plan
    with pytest.raises(Exception, match="scores of 1 classes against targets of 2"):
        spark.sql("select array(1D) as s, array(1F, 2F) as y, rand() as r").select(scores.long_cross_entropy("s", "y")).collect()
