"""Exact top-k by inner product over a bit-sliced index.

Vectors have whole-number components. The index cuts all rows into blocks; in a block every dimension, less its
minimum and without its lowest ``SHIFT`` bits, is kept as bit slices: one bitmap over the rows for each bit. A query adds
the slices of all dimensions, weighted by the bits of its own components, with bitmap adders, which gives the bit
slices of every row's approximate score. From the most significant slice downward it finds the k-th best value,
keeps every row that the rounding could lift to it, and scores those exactly from the components themselves.

Blocks of rows and blocks of queries are files in the shared folder; each pair of blocks is one piece of work.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.kneser_ney import map_arrays, write_arrays
from quadrille.llm.tables import stored
from quadrille.llm.token_store import file_system
from quadrille.plans.durable import fresh_folder

#: Rows of a block, and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 16, 128
#: Low bits of the components that the slices leave out.
SHIFT = 1
#: Most tasks of the search.
MOST_TASKS = 10_000
_FOUND = "query_id long, vec_id long, score long"


def slices_of(values: np.ndarray, shift: int = SHIFT) -> np.ndarray:
    """Bitmaps ``[dimension, bit, word]`` over the rows, of the components less the minimum of their dimension."""
    rows, dims = values.shape
    low = values.min(0) if rows else np.zeros(dims, np.int64)
    cut = ((values - low) >> shift).astype(np.uint64)
    bits = max(1, int(cut.max()).bit_length() if cut.size else 1)
    words = -(-rows // 64)
    out = np.zeros((dims, bits, words), np.uint64)
    padded = np.zeros((dims, words * 64), np.uint8)
    for b in range(bits):
        padded[:, :rows] = ((cut >> np.uint64(b)) & np.uint64(1)).T
        out[:, b] = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    return out


class _Sum:
    """Adds bitmaps by significance: three of one significance become one, and one a step higher."""

    def __init__(self):
        self.waiting: dict[int, list[np.ndarray]] = {}

    def add(self, bit: int, plane: np.ndarray) -> None:
        while True:
            own = self.waiting.setdefault(bit, [])
            if len(own) < 2:
                own.append(plane)
                return
            a, b = own
            odd = a ^ b
            carry = odd & plane
            odd ^= plane
            carry |= a & b
            own[:] = [odd]
            bit, plane = bit + 1, carry

    def slices(self) -> list[np.ndarray | None]:
        """One bitmap for each significance; None where it is empty."""
        out, bit = [], 0
        while self.waiting and bit <= max(self.waiting):
            own = self.waiting.get(bit, [])
            while len(own) > 1:
                a, b = own.pop(), own.pop()
                self.add(bit + 1, a & b)
                own.append(a ^ b)
            out.append(own[0] if own else None)
            bit += 1
        return out


def approximate(query: np.ndarray, slices: np.ndarray, complements: np.ndarray) -> np.ndarray:
    """Bit slices ``[bit, word]``, lowest first, of sum |q| u over the rows; u is complemented where q is negative."""
    total = _Sum()
    for d, q in enumerate(query.tolist()):
        planes = slices[d] if q >= 0 else complements[d]
        size, t = abs(q), 0
        while size >> t:
            if (size >> t) & 1:
                for b, plane in enumerate(planes):
                    total.add(b + t, plane)
            t += 1
    zero = np.zeros(slices.shape[2], np.uint64)
    return np.stack([s if s is not None else zero for s in total.slices()] or [zero])


def kth_value(slices: np.ndarray, rows: np.ndarray, k: int) -> int:
    """The k-th largest value among ``rows`` (a bitmap); 0 where there are fewer."""
    if int(np.bitwise_count(rows).sum(dtype=np.int64)) < k:
        return 0
    value = 0
    for bit in range(len(slices) - 1, -1, -1):
        ones = rows & slices[bit]
        count = int(np.bitwise_count(ones).sum(dtype=np.int64))
        if count >= k:
            rows, value = ones, value | 1 << bit
        else:
            rows, k = rows & ~slices[bit], k - count
    return value


def at_least(slices: np.ndarray, rows: np.ndarray, bound: int) -> np.ndarray:
    """Bitmap of the rows whose value is ``bound`` or more."""
    if bound >> len(slices):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for bit in range(len(slices) - 1, -1, -1):
        if (bound >> bit) & 1:
            equal = equal & slices[bit]
        else:
            above |= equal & slices[bit]
            equal = equal & ~slices[bit]
    return above | equal


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, slices: np.ndarray, k: int, shift: int = SHIFT):
    """For each query its k best rows but its own: its number, row numbers and scores, ties to the smaller id."""
    dims = max(queries.shape[1], values.shape[1])
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))[:, : values.shape[1]]
    live = np.zeros(slices.shape[2] * 64, np.uint8)
    live[: len(ids)] = 1
    live = np.packbits(live, bitorder="little").view(np.uint64)
    complements = ~slices
    for n, query in enumerate(queries):
        found = approximate(query, slices, complements)
        # As many more than k as rows have the query's id, since they may be among them.
        best = kth_value(found, live, k + int((ids == query_ids[n]).sum()))
        # The bits left out may be worth so much, in steps of the slices, rounded up.
        slack = -(-(((1 << shift) - 1) * int(np.abs(query).sum())) // (1 << shift))
        near = at_least(found, live, max(best - slack, 0))
        own = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
        own = own[ids[own] != query_ids[n]]
        score = values[own].astype(np.int64) @ query
        if len(own) > 4 * k:
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            own, score = own[keep], score[keep]
        order = np.lexsort((ids[own], -score))[:k]
        yield n, own[order], score[order]


def _write_block(folder: str, label: str, with_slices: bool):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        lists = table.column("v").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        values = np.zeros((len(ids), int(sizes.max()) if len(sizes) else 0), np.int64)
        values[np.repeat(np.arange(len(ids)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        order = np.argsort(ids)
        ids, values = ids[order], values[order]
        arrays = [np.array(values.shape, np.int64), ids, values.ravel().astype(np.min_scalar_type(-int(np.abs(values).max()) - 1) if values.size else np.int8)]
        if with_slices:
            slices = slices_of(values)
            arrays += [np.array(slices.shape, np.int64), slices.ravel()]
        block = table.column("block")[0].as_py()
        name = write_arrays(folder, f"{label}-{block}-{uuid.uuid4().hex[:8]}", *arrays)
        return pa.table({"block": pa.array([block], pa.int64()), "file": [name]})

    return run


def _blocks(vectors: DataFrame, folder: str, label: str, size: int, with_slices: bool) -> DataFrame:
    """Writes the vectors in blocks of about ``size`` rows, dealt by a hash of their number; a row per block."""
    rows = vectors.count()
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(max(1, -(-rows // size)))))
    return stored(dealt.groupBy("block").applyInArrow(_write_block(folder, label, with_slices), "block long, file string"), label)


def _searching(folder: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                shape, query_ids, flat = map_arrays(folder, pair["queries"])
                queries = np.asarray(flat).reshape(shape).astype(np.int64)
                shape, ids, flat, cut, slices = map_arrays(folder, pair["file"])
                found = list(search(np.asarray(query_ids), queries, np.asarray(ids), np.asarray(flat).reshape(shape), np.asarray(slices).reshape(cut), k))
                counts = [len(own) for _, own, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.asarray(query_ids)[[n for n, _, _ in found]], counts)),
                        pa.array(np.asarray(ids)[np.concatenate([own for _, own, _ in found])]),
                        pa.array(np.concatenate([score for _, _, score in found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def whole_numbers(vectors: DataFrame, *, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``number, vec_id, v``: floor(scale * x) of every component x as double; rows that are null or hold null or non-finite
    components, or have no id, are left out. ``number`` tells rows with one id apart; it is to be stored before it is used."""
    x = F.transform(vector, lambda e: e.cast("double"))
    whole = F.transform("x", lambda e: F.floor(e * scale).cast("long"))
    finite = F.forall("x", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & F.col("vec_id").isNotNull()).where(finite)
    return rows.select(F.monotonically_increasing_id().alias("number"), "vec_id", whole.alias("v"))


def top_k(vectors: DataFrame, *, k: int = 20, every: int = 20, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``every`` the k best rows of other ids.

    Rows with one id are candidates of their own, as in the SQL form; the candidates of all query rows of one id are ranked
    together.

    Score: inner product of the whole numbers floor(scale * x); vectors of unequal length are padded with zeros; scores
    must fit 64 bits. An empty table, or one without queries, gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    folder = fresh_folder(spark, "slices")
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    whole = stored(whole_numbers(vectors, scale=scale, key=key, vector=vector), "vectors")
    index = _blocks(whole, folder, "rows", BLOCK_ROWS, True)
    asked = _blocks(whole.where(F.col("vec_id") % every == 0), folder, "queries", BLOCK_QUERIES, False)
    # Every block of queries meets every block of rows, whose numbers it is dealt to.
    numbers = [r.block for r in index.select("block").collect()]  # a number per 65,536 rows
    pairs = asked.select(F.col("file").alias("queries"), F.explode(F.array(*map(F.lit, numbers)) if numbers else F.lit(None).cast("array<bigint>")).alias("block"))
    pairs = pairs.join(index, "block").repartition(max(1, min(MOST_TASKS, asked.count() * len(numbers))), "queries", "file")
    found = pairs.mapInArrow(_searching(folder, k), _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
