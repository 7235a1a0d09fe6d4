"""Batches of requested rows: by id, and through the shard catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.plans.asof import asof_backward
from quadrille.plans.sizing import BROADCAST_BYTES, broadcast_if_small, fits_broadcast
from quadrille.sources.zones import in_files

#: Indices per list: a shard with more requested indices gets several lists.
LIST_SPAN = 65_536
#: Shard names written into a scan filter; with more of them the join alone selects.
NAMED_SHARDS = 1_000
#: Ids that are looked at for a scan filter; with more of them their range alone is.
NAMED_IDS = 10_000
#: Ranges of a scan filter.
NAMED_RANGES = 64


def first_positions(requests: DataFrame) -> DataFrame:
    """``(idx, pos)``: each requested index once, at its first position."""
    return requests.groupBy("idx").agg(F.min("pos").alias("pos"))


def fetch_batch(points: DataFrame, requests: DataFrame, *, ordered: bool = True, zones: DataFrame | None = None) -> DataFrame:
    """Rows of the requested ids ``(pos, idx)`` in request order; duplicates collapse, missing ids vanish.

    With the ``zones`` of the table only files that hold a requested id are in the scan; ``points`` is then a plain scan of files.
    """
    wanted = first_positions(requests).withColumnRenamed("idx", "id")
    if zones is not None:
        points = in_files(points, zones, wanted)
    rows = near_ids(points, wanted).join(broadcast_if_small(wanted), "id")
    return rows.orderBy("pos") if ordered else rows


def near_ids(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without those that cannot be among the wanted ids, by a filter that reaches the scan.

    Statistics of row groups and pages then skip what is not asked for, images included; a join still has to follow.
    """
    ids = [r[0] for r in wanted.select("id").limit(NAMED_IDS + 1).collect()]
    if len(ids) > NAMED_IDS:
        low, high = wanted.agg(F.min("id"), F.max("id")).first()
        return rows.where(F.col("id").between(low, high))
    found = id_ranges([i for i in ids if i is not None])
    return rows.where(reduce(Column.__or__, (_in_range(*r) for r in found))) if found else rows.where(F.lit(False))


def id_ranges(ids: list[int], most: int = NAMED_RANGES) -> list[tuple[int, int]]:
    """No more than ``most`` ranges that hold all ids, cut where the gaps between ids are largest."""
    ids = sorted(set(ids))
    gaps = sorted(range(1, len(ids)), key=lambda k: ids[k - 1] - ids[k])[: most - 1]
    cuts = [0, *sorted(gaps), len(ids)]
    return [(ids[a], ids[b - 1]) for a, b in zip(cuts, cuts[1:])] if ids else []


def _in_range(low: int, high: int) -> Column:
    return F.col("id") == low if low == high else F.col("id").between(low, high)


def fetch_left(requests: DataFrame, rows: DataFrame) -> DataFrame:
    """Every request with its row, or NULLs; sorted by index, then position."""
    fetched = rows.withColumnRenamed("id", "idx")
    return requests.join(fetched, "idx", "left").orderBy("idx", "pos")


def shard_of(requests: DataFrame, catalog: DataFrame, *, strategy: str = "auto") -> DataFrame:
    """Adds the shard ``name`` with the greatest ``min_index`` not above the requested ``idx``."""
    return asof_backward(
        requests, catalog.select("min_index", "name"), left_key="idx", right_key="min_index", take=["name"],
        strategy=strategy,
    )


def shard_requests(placed: DataFrame, *, span: int = LIST_SPAN) -> DataFrame:
    """``(name, chunk, indices)``: requested indices per shard, as sorted lists of ``(idx, n)``.

    Equal indices are counted before they are collected and a list covers ``span`` neighbouring indices, so
    no list grows with the number of requests.
    """
    counted = placed.where("name is not null").groupBy("name", "idx").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.groupBy("name", F.expr(f"idx div {span}").alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("idx", "n"))).alias("indices"))
    )


def with_catalog(grouped: DataFrame, catalog: DataFrame) -> DataFrame:
    """Inner join of grouped requests to the catalog by shard name."""
    return grouped.join(broadcast_if_small(catalog), "name")


def fetch_through_catalog(
    shards: DataFrame, catalog: DataFrame, requests: DataFrame, *, zones: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of the requested indices from a table partitioned by ``shard``, in request order (``pos``).

    The as-of join names the shards in question; when they are few they go into the scan as a partition
    filter, so other shards are not opened. With the ``zones`` of the table, files of those shards without a wanted id are not
    opened either. The ranges of the wanted ids go along and skip parts of the files.
    """
    placed = shard_of(first_positions(requests), catalog).where("name is not null")
    wanted = placed.select(F.col("idx").alias("id"), "pos", F.col("name").alias("shard"))
    names = [r[0] for r in wanted.select("shard").distinct().limit(NAMED_SHARDS + 1).collect()]
    if len(names) <= NAMED_SHARDS:
        shards = shards.where(F.col("shard").isin(names)) if names else shards.where(F.lit(False))
    if zones is not None:
        shards = in_files(shards, zones, wanted)
    side = F.broadcast(wanted) if fits_broadcast(wanted, max_bytes) else wanted
    return near_ids(shards.drop("pos"), wanted).join(side, ["shard", "id"]).orderBy("pos")
