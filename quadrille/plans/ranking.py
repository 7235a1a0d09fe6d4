"""Dense global numbering without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.plans.durable import pin
from quadrille.plans.sizing import BROADCAST_BYTES, fits_broadcast

_POSITION_BITS = 33


def partition_position(df: DataFrame) -> DataFrame:
    """Adds ``_part`` (partition number) and ``_pos`` (row position in it) to a pinned frame."""
    number = F.monotonically_increasing_id()
    return df.withColumn("_number", number).select(
        *df.columns,
        F.shiftright("_number", _POSITION_BITS).cast("int").alias("_part"),
        F.col("_number").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def dense_index(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "index", start: int = 0
) -> DataFrame:
    """Numbers rows ``start, start+1, ...`` in the given total order.

    The frame is range-sorted over all partitions and pinned once, so that both passes below see the same
    partitions even when executors are lost. The first pass counts rows per partition (at most one row per
    shuffle partition, which is what bounds the broadcast), the second adds the offset of the partition.
    Order keys must end in something unique: equal keys cannot be split over partitions.
    """
    tagged = partition_position(pin(df.orderBy(*order_by)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return tagged.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("long").alias(name)
    )


def keyed_index(
    df: DataFrame, order_by: Sequence[str], name: str = "index", start: int = 0, *, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``dense_index`` for rows with large columns: only the order columns are sorted and pinned.

    They identify a row, so the numbers come back by a hash join on them, and the other columns are moved once at most.
    Where two rows are equal in them, the whole rows are numbered instead. ``df`` is read twice and must give
    the same rows each time.
    """
    keys = dense_index(df.select(*order_by), order_by, name, start)
    if not keys.groupBy(*order_by).count().where("count > 1").isEmpty():
        return dense_index(df, order_by, name, start)
    side = keys.select(*(F.col(c).alias(f"_key{k}") for k, c in enumerate(order_by)), name)
    side = F.broadcast(side) if fits_broadcast(side, max_bytes) else side.hint("shuffle_hash")
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_key{k}")) for k, c in enumerate(order_by)))
    return df.join(side, same).select(*df.columns, name)


def running_total(df: DataFrame, order_by: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Inclusive running sum in a total order, without a single-partition window."""
    tagged = partition_position(pin(df.orderBy(*order_by)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_part")
        .agg(F.sum(value).alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.withColumn("_local", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_local") + F.col("_offset")).alias(name))
    )


def rank_within(df: DataFrame, group: str, order_by: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Numbers the rows of every ``group`` from 0, in the order given, and adds ``<name>_of``, the rows of the group.

    One range sort over all partitions, so a group may be of any size. What a partition holds of a group is one row; those
    rows are numbered per group (no more than there are partitions) and come back by partition and group, a key that
    no more than a partition's rows share. ``group`` must not be null; order keys should end in something unique.
    """
    tagged = partition_position(pin(df.orderBy(group, *order_by)))
    own = Window.partitionBy("_group")
    before = own.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        tagged.groupBy(F.col("_part").alias("_in"), F.col(group).alias("_group"))
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_in", "_group", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(own).alias("_all"),
        )
    )
    pieces = F.broadcast(pieces) if fits_broadcast(pieces) else pieces
    met = tagged.join(pieces, (F.col("_part") == F.col("_in")) & (F.col(group) == F.col("_group")))
    return met.select(*df.columns, (F.col("_pos") + F.col("_shift")).alias(name), F.col("_all").alias(f"{name}_of"))
