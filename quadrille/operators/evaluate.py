"""Scores of predictions, baselines and the history of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.functions.cells import single_sql, with_bounds, with_center
from quadrille.functions.geo import distance_to_box_km, great_circle_km
from quadrille.functions.scores import arg_max, class_order, cross_entropy_one_hot, long_cross_entropy, top_classes
from quadrille.operators.label import class_to_cell
from quadrille.plans.durable import pin
from quadrille.plans.sizing import broadcast_if_small

#: Columns of the per-epoch table, in order (fixed form of the stored file).
EPOCH_COLUMNS = (
    "epoch int, epoch_start timestamp_ntz, epoch_end timestamp_ntz, train_loss double, test_loss double,"
    " test_acc double, mean_squared_error double, train_data_fetch_time double, train_model_time double,"
    " train_time double, model_save_time double, test_data_fetch_time double, test_model_time double,"
    " test_time double"
)


# --- predictions ----------------------------------------------------------------------------------------


def with_prediction(predictions: DataFrame, scores: str = "probs") -> DataFrame:
    """Adds ``pred_idx``."""
    return predictions.withColumn("pred_idx", arg_max(scores))


def prediction_errors(
    predictions: DataFrame, truth: DataFrame, classes: DataFrame, targets: DataFrame | None = None
) -> DataFrame:
    """One row per predicted point with a class: hit, distance to the predicted cell in km, loss.

    ``predictions`` is ``(id, probs)``, ``truth`` is ``(id, latitude, longitude, class_idx)`` and ``targets``
    optionally ``(id, label)`` with soft target arrays; without it the target is the ``label`` of the predictions, if they have one, or the
    own class. Rows of scores are not shuffled while the truth of the predicted points fits a broadcast; ids are read ahead.
    """
    joined = with_prediction(predictions).join(truth_of(predictions, truth), "id")
    if targets is None and "label" in predictions.columns:
        joined = joined.withColumn("loss", long_cross_entropy("probs", "label"))
    elif targets is None:
        joined = joined.withColumn("loss", cross_entropy_one_hot("probs", "class_idx"))
    else:
        joined = joined.join(targets.select("id", "label"), "id").withColumn("loss", long_cross_entropy("probs", "label"))
    slim = joined.select(
        "id",
        "class_idx",
        "pred_idx",
        "loss",
        F.expr(single_sql("latitude")).alias("latitude"),
        F.expr(single_sql("longitude")).alias("longitude"),
    )
    placed = with_bounds(class_to_cell(slim, classes, "pred_idx", "pred_cell"), "pred_cell")
    return placed.select(
        "id",
        "class_idx",
        "pred_idx",
        "pred_cell",
        (F.col("class_idx") == F.col("pred_idx")).alias("hit"),
        distance_to_box_km("latitude", "longitude").alias("km"),
        "loss",
    )


def truth_of(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """``(id, latitude, longitude, class_idx)`` of the predicted points with a class; marked for a broadcast where it fits."""
    known = truth.where("class_idx is not null").select("id", "latitude", "longitude", "class_idx")
    return broadcast_if_small(pin(known.join(predictions.select("id"), "id", "left_semi")))


def score_summary(errors: DataFrame) -> DataFrame:
    """Accuracy, mean squared distance in km2 and mean loss over all rows."""
    return errors.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("hit").cast("double")).alias("accuracy"),
        F.avg(F.col("km") * F.col("km")).alias("mean_squared_error"),
        F.avg("loss").alias("loss"),
    )


def ranked_cells(predictions: DataFrame, classes: DataFrame, k: int | None = None, scores: str = "probs") -> DataFrame:
    """``(id, rank, class_idx, cell, prob, center_lat, center_lon)``: the best ``k`` cells, or all of them.

    Ranking happens inside the row; nothing is shuffled by id.
    """
    if k is None:
        placed = predictions.withColumn("_order", class_order(scores)).select("id", scores, F.posexplode("_order").alias("_at", "class_idx"))
        ranked = placed.select("id", (F.col("_at") + 1).alias("rank"), "class_idx", F.get(scores, F.col("class_idx")).alias("prob"))
    else:
        ranked = predictions.select("id", F.inline(top_classes(scores, k)))
    named = class_to_cell(ranked, classes)
    return with_center(named).select("id", "rank", "class_idx", "cell", "prob", "center_lat", "center_lon")


# --- baseline -------------------------------------------------------------------------------------------


def mean_coordinate(points: DataFrame) -> DataFrame:
    return points.agg(
        F.avg(F.expr(single_sql("latitude"))).alias("latitude"), F.avg(F.expr(single_sql("longitude"))).alias("longitude")
    )


def constant_baseline(
    points: DataFrame,
    latitude: float,
    longitude: float,
    *,
    top: int,
    low: float = 0.7,
    high: float = 0.9,
    denominator: str = "rows",
) -> DataFrame:
    """Mean and mean squared distance of the id slice ``[int(top*low), int(top*high))`` to one coordinate.

    ``denominator='range'`` divides by ``int(top * (high - low))`` instead of the number of rows.
    """
    part = points.where((F.col("id") >= int(top * low)) & (F.col("id") < int(top * high)))
    away = part.select(
        great_circle_km(latitude, longitude, single_sql("latitude"), single_sql("longitude")).alias("km")
    )
    n = F.count(F.lit(1)) if denominator == "rows" else F.lit(int(top * (high - low)))
    return away.agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.sum(F.col("km") * F.col("km")), n).alias("mean_squared_km"),
        F.try_divide(F.sum("km"), n).alias("mean_km"),
    )


# --- training history -----------------------------------------------------------------------------------


def epoch_statistics(steps: DataFrame) -> DataFrame:
    """Per run, epoch and phase: rows, row-weighted means of loss, hits and squared error, summed durations.

    ``steps`` is ``(run, epoch, phase, rows, loss, hits, squared_error, fetch_seconds, model_seconds)`` with
    per-batch mean loss and per-batch sums of hits and squared errors.
    """
    return steps.groupBy("run", "epoch", "phase").agg(
        F.sum("rows").alias("rows"),
        F.try_divide(F.sum(F.col("loss") * F.col("rows")), F.sum("rows")).alias("loss"),
        F.try_divide(F.sum("hits").cast("double"), F.sum("rows")).alias("accuracy"),
        F.try_divide(F.sum("squared_error"), F.sum("rows")).alias("mean_squared_error"),
        F.sum("fetch_seconds").alias("fetch_seconds"),
        F.sum("model_seconds").alias("model_seconds"),
    )


def best_so_far(epochs: DataFrame) -> DataFrame:
    """Adds the best epoch up to each epoch of a run and the values it had.

    Best is the least test loss, the first of equals; NaN never improves. Before the first improvement the
    best epoch is 1 with infinite losses and accuracy 0.
    """
    carried = ["train_loss", "test_loss", "test_acc", "mean_squared_error"]
    rank = F.when(~F.isnan("test_loss"), F.struct("test_loss", "epoch"))
    upto = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    best = F.min_by(F.struct("epoch", *carried), rank).over(upto)
    nothing = {"test_acc": 0.0}
    return epochs.withColumn("_best", best).select(
        *epochs.columns,
        F.coalesce("_best.epoch", F.lit(1)).alias("best_epoch"),
        *(
            F.coalesce(f"_best.{c}", F.lit(nothing.get(c, float("inf")))).alias(f"best_epoch_{c}")
            for c in carried
        ),
    )


def early_stop(epochs: DataFrame, grace_period: int) -> DataFrame:
    """Cuts each run after the first epoch without improvement for ``grace_period`` epochs; that epoch stays.

    Adds the columns of :func:`best_so_far` and ``stopped_early``.
    """
    followed = best_so_far(epochs)
    stale = (F.col("best_epoch") != F.col("epoch")) | F.isnan("test_loss")
    fired = F.when(stale & (F.col("epoch") - F.col("best_epoch") >= grace_period), F.col("epoch"))
    stop = F.min(fired).over(Window.partitionBy("run"))
    return (
        followed.withColumn("_stop", stop)
        .where("_stop is null or epoch <= _stop")
        .withColumn("stopped_early", F.col("_stop").isNotNull())
        .drop("_stop")
    )


def run_summary(stopped: DataFrame) -> DataFrame:
    """One row per run from :func:`early_stop` rows with ``epoch_start`` and ``epoch_end``."""
    last = F.max_by(
        F.struct(
            "best_epoch", "best_epoch_train_loss", "best_epoch_test_loss", "best_epoch_test_acc",
            "best_epoch_mean_squared_error",
        ),
        "epoch",
    )
    return (
        stopped.groupBy("run")
        .agg(
            F.bool_or("stopped_early").alias("stopped_early"),
            F.max("epoch").alias("last_epoch"),
            last.alias("_last"),
            F.min("epoch_start").alias("run_start"),
            F.max("epoch_end").alias("run_end"),
        )
        .select(
            "run",
            "stopped_early",
            "last_epoch",
            "_last.*",
            "run_start",
            "run_end",
            F.expr("timestampdiff(MICROSECOND, run_start, run_end) / 1e6D").alias("run_time"),
        )
    )


def append(*frames: DataFrame) -> DataFrame:
    """Frames of equal columns, one after the other."""
    if not frames:
        raise ValueError("nothing to append")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
