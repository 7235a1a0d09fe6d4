"""Backward as-of join: for every left key the right row with the greatest key not above it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.plans.durable import pin
from quadrille.plans.sizing import BROADCAST_BYTES, fits_broadcast

#: Most intervals that may share one bucket before the sorted merge is the better plan.
BUCKET_FANOUT = 64
#: Right keys of a range of the merge, and the most ranges, whose cuts are one broadcast row; beyond, ranges hold more keys.
KEYS_PER_RANGE, MOST_RANGES = 256, 16_384


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    *,
    left_key: str,
    right_key: str,
    take: Sequence[str],
    strategy: str = "auto",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left rows with the columns ``take`` of the matching right row; NULL below every right key.

    ``right`` must be unique on an integral ``right_key``. A right side measured to be small is cut into
    equal-width buckets and broadcast as a hash join; otherwise, or when the intervals are too uneven for
    buckets, both sides are dealt to ranges of the key and merged there.
    """
    take = list(take)
    if strategy not in ("auto", "bucket", "merge"):
        raise ValueError(f"unknown strategy {strategy!r}")
    right = right.select(F.col(right_key).cast("long").alias("_start"), *take)
    # Buckets are up to three times the right rows, each with two more columns.
    small = strategy != "merge" and fits_broadcast(right, max_bytes // 4)
    if strategy == "bucket" and not small:
        raise ValueError(f"the right side is too large for buckets of {max_bytes} bytes")
    if not small:
        return _merge(left, right, left_key, take)
    low, high, rows = right.agg(F.min("_start"), F.max("_start"), F.count(F.lit(1))).first()
    if not rows:
        return left.select("*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in take))
    width = max(1, (high - low) // (2 * rows))
    last = (high - low) // width
    buckets = (
        right.withColumn("_stop", F.lead("_start").over(Window.orderBy("_start")))
        .withColumn(
            "_bucket",
            F.explode(
                F.sequence(
                    F.expr(f"(_start - {low}) div {width}"),
                    F.expr(f"coalesce((_stop - 1 - {low}) div {width}, {last})"),
                )
            ),
        )
    )
    if strategy == "auto":
        crowded = buckets.groupBy("_bucket").count().agg(F.max("count")).first()[0]
        if crowded > BUCKET_FANOUT:
            return _merge(left, right, left_key, take)
    key = F.col(left_key).cast("long")
    slot = F.when(key >= low, F.least(F.expr(f"(cast(`{left_key}` as long) - {low}) div {width}"), F.lit(last)))
    probe = left.withColumn("_slot", slot)
    hit = (
        (F.col("_slot") == F.col("_bucket"))
        & (key >= F.col("_start"))
        & (F.col("_stop").isNull() | (key < F.col("_stop")))
    )
    return probe.join(F.broadcast(buckets), hit, "left").select(*left.columns, *take)


def _merge(left: DataFrame, right: DataFrame, left_key: str, take: list[str], *, span: int = KEYS_PER_RANGE, most: int = MOST_RANGES) -> DataFrame:
    """Both sides dealt to ranges of the key, one shuffle each, and searched there. No side is sorted or kept.

    Ranges are cut at quantiles of the right keys, at keys that are there: so the match of a left row is in its own range. The right
    rows of a range are one row of sorted arrays, in which a left row finds its place by a binary search in column expressions. It is
    a plain join on the number of the range, so adaptive execution splits ranges with many left rows, also of a single key.
    """
    least = 16 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, number, cuts = _cuts(right, min(least, most))
    if rows // span > least:
        rows, number, cuts = _cuts(right, min(most, rows // span))

    def placed(side: DataFrame) -> DataFrame:
        return searched(side.crossJoin(F.broadcast(cuts)), "_range", F.col("_cuts"), number).drop("_cuts")

    marks = placed(right.withColumn("_key", F.col("_start")))
    lists = marks.groupBy("_range").agg(F.array_sort(F.collect_list(F.struct("_start", *take))).alias("_list"))
    # Quantiles are exact up to a twentieth of a range on each side, so no range holds twice the mean.
    longest = 2 * rows // (number + 1) + 16 if number + 1 >= min(least, most) else rows
    problem = F.raise_error(F.lit("a range of the as-of merge is longer than its quantiles allow")).cast("array<long>")
    starts = F.when(F.size("_list") <= longest, F.col("_list._start")).otherwise(problem)
    lists = lists.select(F.col("_range").alias("_own"), starts.alias("_starts"), "_list")
    keyed = left.withColumn("_key", F.col(left_key).cast("long"))
    met = placed(keyed).join(lists.hint("shuffle_hash"), F.col("_range") == F.col("_own"), "left")
    near = searched(met, "_at", F.col("_starts"), longest).withColumn("_near", F.get("_list", F.col("_at") - 1))
    return near.select(*left.columns, *(F.col(f"_near.{c}").alias(c) for c in take))


def _cuts(right: DataFrame, parts: int) -> tuple[int, int, DataFrame]:
    """Rows, and fewer than ``parts`` keys that cut them into like ranges: their number, and one row that holds them as ``_cuts``.

    They meet the rows by a broadcast. As literals they would stand in the plan once for each step of each search.
    """
    shares = F.split(F.lit(",".join(repr(k / parts) for k in range(1, parts)) or "0.0"), ",").cast("array<double>")
    found = F.array_sort(F.array_distinct(F.percentile_approx("_start", shares, 20 * parts)))
    table = pin(right.agg(F.count(F.lit(1)).alias("_rows"), F.coalesce(found, F.array().cast("array<long>")).alias("_cuts")))
    rows, number = table.select("_rows", F.size("_cuts")).first()
    return rows, number, table.select("_cuts")


def searched(df: DataFrame, name: str, table: Column, size: int) -> DataFrame:
    """Adds the number of elements of the sorted array ``table``, at most ``size``, that are not above ``_key``; 0 without a key."""
    out, step = df.withColumn(name, F.lit(0)), 1 << size.bit_length()
    while step > 1:
        step //= 2
        passed = F.get(table, F.col(name) + F.lit(step - 1)) <= F.col("_key")
        out = out.withColumn(name, F.when(passed, F.col(name) + F.lit(step)).otherwise(F.col(name)))
    return out
