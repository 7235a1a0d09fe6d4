"""Compression of vectors to short codes: a codebook per part of the vector, fitted by Lloyd's steps over cover trees.

A component x becomes the integer ``floor(scale * x)``, and a vector is cut into ``parts`` equal consecutive parts. The codebook of a
part starts with that part of the ``entries`` smallest kept ids. A round gives every part its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces each entry that is used by the floored mean of its parts.

Vectors are cut into blocks where they lie. A block has a cover tree for each part (``cover_tree``); the trees are
built once and written to the shared folder. A round sends the codebooks to the blocks: whole subtrees go to an entry by the triangle
inequality with the sums they have, ambiguous nodes descend, and only single points that stay ambiguous are compared
themselves. A task returns its counts and sums, a few numbers per entry; the driver sees those of all tasks summed.

Left out are vectors that are null, hold null or non-finite components, or whose length is not a positive multiple of ``parts``
or not that of the smallest id. Rows that share an id keep a code each; among the starting entries they are ordered by their
components. Rows without an id come after all others there. An empty table has no rows. Integers are exact: a component
so large that squared distances would not fit 64 bits is an error. Columns beside the three named are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm import cover_tree
from quadrille.llm.tables import stored
from quadrille.plans.sizing import broadcast_if_small

#: Vectors of a block.
BLOCK_ROWS = 4096
#: Squared distances of a whole vector stay below this.
_MOST_SQUARE = 1 << 62
_BLOCKS = "ids array<bigint>, labels array<string>, kind string, points binary, orders array<binary>, nodes array<binary>"


def kept_vectors(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16) -> DataFrame:
    """``id, vector, label`` of the vectors that take part, whatever their length."""
    infinite = F.lit(float("inf"))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label"))
    bad = F.exists("vector", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == infinite), F.lit(True)))
    return rows.where(F.col("vector").isNotNull() & ~bad & (F.size("vector") > 0) & (F.size("vector") % parts == 0))


def _integers(values: np.ndarray, scale: int, parts: int, dims: int) -> np.ndarray:
    """Rows of integers; raises where their squared distances could exceed 64 bits."""
    whole = np.floor(values * scale).reshape(-1, dims)
    if whole.size and 4.0 * float(np.abs(whole).max()) ** 2 * dims >= _MOST_SQUARE:
        raise OverflowError("components are too large for exact distances of 64 bits")
    return whole.astype(np.int64)


def _part(points: np.ndarray, k: int, parts: int) -> np.ndarray:
    width = points.shape[1] // parts
    return points[:, k * width : (k + 1) * width].astype(np.int64)


def _grow(scale: int, parts: int, dims: int, block: int):
    def one(rows: pa.Table) -> pa.RecordBatch:
        points = _integers(rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False), scale, parts, dims)
        kind = next(t for t in (np.int16, np.int32, np.int64) if not points.size or np.abs(points).max() <= np.iinfo(t).max)
        orders, nodes = [], []
        for k in range(parts):
            order, tree = cover_tree.grow(_part(points, k, parts))
            orders.append(order.tobytes())
            nodes.append(tree.tobytes())
        columns = [
            pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([rows.column("label").to_pylist()], pa.list_(pa.string())),
            pa.array([np.dtype(kind).name]), pa.array([points.astype(kind).tobytes()], pa.binary()), pa.array([orders], pa.list_(pa.binary())), pa.array([nodes], pa.list_(pa.binary())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, block - rows)
                held, rows, at = [*held, piece], rows + piece.num_rows, at + piece.num_rows
                if rows == block:
                    yield one(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield one(pa.Table.from_batches(held))

    return run


def _blocks(batches: Iterator[pa.RecordBatch], parts: int, dims: int) -> Iterator[tuple]:
    """Of every block: ids, labels, and for each part a pair of order and of points in that order with the nodes over them."""
    for batch in batches:
        for r in range(batch.num_rows):
            points = np.frombuffer(batch.column("points")[r].as_py(), batch.column("kind")[r].as_py()).reshape(-1, dims)

            orders, nodes = batch.column("orders")[r], batch.column("nodes")[r]

            def part(k: int, points: np.ndarray = points, orders: pa.Scalar = orders, nodes: pa.Scalar = nodes) -> tuple:
                order = np.frombuffer(orders[k].as_py(), np.int32)
                return order, _part(points, k, parts)[order], np.frombuffer(nodes[k].as_py(), cover_tree.NODE)

            yield batch.column("ids").slice(r, 1).flatten(), batch.column("labels").slice(r, 1).flatten(), part


def _summing(books: np.ndarray, dims: int):
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last component of an entry counts its points.
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, _, part in _blocks(batches, parts, dims):
            for k in range(parts):
                _, points, nodes = part(k)
                number, own = cover_tree.sums(points, nodes, books[k])
                total[k, :, :width] += own
                total[k, :, width] += number
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.ravel()[slot])], names=["slot", "total"])

    return run


def _coding(books: np.ndarray, dims: int):
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, part in _blocks(batches, parts, dims):
            codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
            for k in range(parts):
                order, points, nodes = part(k)
                own = cover_tree.codes(points, nodes, books[k])
                codes[order, k] = own
                error[order] += ((points - books[k][own]) ** 2).sum(axis=1)
            text = codes.tobytes().hex()
            code = [text[at : at + 2 * parts] for at in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    return run


def lloyd(blocks: DataFrame, books: np.ndarray, rounds: int, dims: int) -> np.ndarray:
    """The codebooks (part, entry, component) after ``rounds`` of assignment and floored means."""
    for _ in range(rounds):
        told = blocks.mapInArrow(_summing(books, dims), "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total")).collect()
        total = np.zeros((books.shape[0], books.shape[1], books.shape[2] + 1), np.int64)  # as large as the codebooks
        for slot, value in told:
            total.flat[slot] = value
        number = total[:, :, -1:]
        books = np.where(number > 0, total[:, :, :-1] // np.maximum(number, 1), books)
    return books


def compressed(
    df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
) -> DataFrame:
    """``<key>, code, error, label_error, codebooks_sha256`` of every vector that takes part.

    ``code`` has two hex digits for the entry of each part, ``error`` the squared distances to them, ``label_error`` the errors of
    all rows with that label (null is a label). The digest is that of all entries by part, entry and component.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("entries must be 1 to 256, parts at least 1")
    kept = kept_vectors(df, key=key, vector=vector, label=label, parts=parts)
    start = kept.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    if not start:
        none = "id long, code string, error long, label_error long, codebooks_sha256 string"
        return df.sparkSession.createDataFrame([], none).withColumnRenamed("id", key)
    dims = len(start[0].vector)
    if any(len(r.vector) != dims for r in start):
        start = kept.where(F.size("vector") == dims).orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    books = _integers(np.array([r.vector for r in start], np.float64), scale, parts, dims).reshape(len(start), parts, -1).transpose(1, 0, 2)
    blocks = stored(kept.where(F.size("vector") == dims).mapInArrow(_grow(scale, parts, dims, BLOCK_ROWS), _BLOCKS), "blocks")
    books = lloyd(blocks, np.ascontiguousarray(books), rounds, dims)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stored(blocks.mapInArrow(_coding(books, dims), "id long, label string, code string, error long"), "codes")
    coded = coded.withColumn("label", F.coalesce(F.concat(F.lit("="), "label"), F.lit("-")))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    met = coded.join(broadcast_if_small(totals), "label")
    return met.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
