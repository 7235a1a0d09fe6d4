"""Labels on a stream. Labelling is stateless, so the batch operator is the streaming one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quadrille.operators.label import CellLookup, cell_lookup, with_cell
from quadrille.plans.durable import fresh_folder
from quadrille.plans.sizing import BROADCAST_BYTES


def label_stream(points: DataFrame, leaves: DataFrame | CellLookup, *, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A stream of points with the enclosing leaf of a fixed quadtree.

    The tiles are measured as they would be broadcast; beyond ``max_bytes`` the stream is shuffled to them instead.
    """
    lookup = leaves if isinstance(leaves, CellLookup) else cell_lookup(leaves)
    return with_cell(points, lookup, strategy="broadcast" if lookup.size <= max_bytes else "shuffle", max_bytes=max_bytes)


def append_labelled(
    points: DataFrame, leaves: DataFrame, folder: str, *, progress: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Writes labelled points to parquet as they arrive; ``progress`` is the folder of the stream's checkpoint."""
    progress = progress or fresh_folder(points.sparkSession, "stream")
    writer = label_stream(points, leaves).writeStream.format("parquet").option("checkpointLocation", progress)
    return (writer.trigger(availableNow=True) if available_now else writer).start(folder)
