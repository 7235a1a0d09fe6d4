"""Token ids of a corpus as raw binary shards with keyed access.

A shard holds documents with neighbouring ids, in ascending order (rows without an id first):

    ids       all ids of the shard, one after the other, 2 or 4 bytes each as the vocabulary needs
    keys      the document ids (8 bytes; 0 where there is none), a flag byte each for "has an id"
    places    first id of every document, and the number of ids (8 bytes each)
    hash      minimal perfect hash over the distinct keys
    slots     by hash number: fingerprint of the key (4 bytes), its first document and how many have it (4 bytes each)
    tail      7 numbers of 8 bytes: bytes per id, documents, ids, slots, where keys, hash and slots begin

A lookup hashes the key, compares the fingerprint in its slot and reads the ids from the place it names: a fixed number
of steps whatever the size. A task writes its shard under a name of its own; the manifest, a Parquet table of the shards
that counted, comes from the tasks that succeeded, so lost or repeated tasks leave at most an unnamed file behind.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.encode import encoder
from quadrille.llm.perfect_hash import PerfectHash, fingerprints
from quadrille.llm.tables import stored, text_bytes
from quadrille.plans.durable import fresh_folder

#: Text bytes of one shard.
SHARD_BYTES = 32 << 20
#: Ids read or written at once.
BLOCK_IDS = 1 << 20
_MANIFEST = "shard int, file string, low long, high long, open_low boolean, n_docs long, n_ids long"
_ROWS = "shard int, row long, doc_id long, place long, n_tokens long, ids_crc32 long, ids array<int>"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``uri`` (file, hdfs, s3, gs, ...), and the path in it."""
    if uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :].lstrip("/").join(("/", ""))
    return fs.FileSystem.from_uri(uri)


def _writing(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        kind = "<u2" if max(encode.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        store, path = file_system(folder)
        name = f"{path}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        keys, known, counts, out = [], [], [], None
        for batch in batches:
            if not len(batch):
                continue
            out = out or store.open_output_stream(name)
            column = batch.column("doc_id")
            keys.append(pc.fill_null(column, 0).to_numpy(zero_copy_only=False))
            known.append(column.is_valid().to_numpy(zero_copy_only=False))
            held, size = [], 0
            for text in pc.fill_null(batch.column("text"), ""):
                ids = encode.encode(text.as_py()) + end
                counts.append(len(ids) // 4)
                held.append(ids)
                size += len(ids)
                if size >= 4 * BLOCK_IDS:
                    out.write(np.frombuffer(b"".join(held), "<u4").astype(kind).tobytes())
                    held, size = [], 0
            out.write(np.frombuffer(b"".join(held), "<u4").astype(kind).tobytes())
        if out is None:
            return
        keys, known, counts = np.concatenate(keys), np.concatenate(known), np.array(counts, np.int64)
        width, n_ids = np.dtype(kind).itemsize, int(counts.sum())
        for part in _tables(keys, known, counts, width):
            out.write(part)
        out.close()
        own = keys[known]
        row = (TaskContext.get().partitionId(), name.rsplit("/", 1)[1], int(own.min()) if len(own) else None, int(own.max()) if len(own) else None, bool((~known).any()), len(keys), n_ids)
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=[x.split()[0] for x in _MANIFEST.split(", ")])

    return run


def _tables(keys, known, counts, width) -> Iterator[bytes]:
    """Everything of a shard after its ids."""
    at = int(counts.sum()) * width
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    parts = [keys.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), np.stack((first, counts), 1).astype("<i8").tobytes()]
    yield from parts
    hash_at = at + sum(map(len, parts))
    rows = np.flatnonzero(known)
    distinct, lead, often = np.unique(keys[rows], return_index=True, return_counts=True)
    perfect = PerfectHash.build(distinct)
    data = perfect.to_bytes()
    yield data
    slots = np.zeros((len(distinct), 3), "<u4")
    slots[perfect.find(distinct)] = np.stack((fingerprints(distinct), rows[lead] if len(rows) else lead, often), 1)
    yield slots.tobytes()
    yield np.array([width, len(keys), int(counts.sum()), len(distinct), at, hash_at, hash_at + len(data)], "<i8").tobytes()


class Shard:
    """An open shard."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = np.frombuffer(self.file.read_at(56, size - 56), "<i8")
        self.width, self.n_docs, self.n_ids, n_slots, keys_at, hash_at, slots_at = map(int, tail)
        data = self.file.read_at(hash_at - keys_at, keys_at)
        self.keys = np.frombuffer(data, "<i8", self.n_docs)
        self.known = np.frombuffer(data, np.uint8, self.n_docs, 8 * self.n_docs).astype(bool)
        self.places = np.frombuffer(data, "<i8", 2 * self.n_docs, 9 * self.n_docs).reshape(-1, 2)
        self.hash = PerfectHash.from_bytes(self.file.read_at(slots_at - hash_at, hash_at))
        self.slots = np.frombuffer(self.file.read_at(12 * n_slots, slots_at), "<u4").reshape(-1, 3)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; 0 documents where the fingerprint or the stored key says no."""
        number = self.hash.find(keys)
        number[(number < 0) | (number >= len(self.slots))] = -1
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.slots[number]
        first = slot[:, 1].astype(np.int64)
        here = (number >= 0) & (slot[:, 0] == fingerprints(keys))
        # Keys that were never stored can share a fingerprint with the one in their slot.
        here &= self.keys[np.where(here, first, 0)] == keys
        return first, np.where(here, slot[:, 2].astype(np.int64), 0)

    def ids(self, first: int, count: int) -> np.ndarray:
        """Ids by place, as unsigned 32-bit integers."""
        data = self.file.read_at(self.width * count, self.width * first)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


def write_store(docs: DataFrame, tokenizer: str, *, end_id: int, folder: str | None = None, key: str = "doc_id") -> DataFrame:
    """Writes the shards of ``docs`` and returns the manifest (``folder``: where, else a new one in the shared folder).

    One range shuffle by id deals the documents out; each shard is encoded and written as it is read. Null texts are
    empty: the end id alone. Ids may be null or repeated: equal ids keep all their rows, in the order of a hash
    of their text. An empty table gives an empty manifest. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = max(1, -(-text_bytes(docs) // SHARD_BYTES))
    order = ["doc_id", F.xxhash64("text")]
    dealt = source.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    manifest = stored(dealt.mapInArrow(_writing(folder, tokenizer, end_id), _MANIFEST), "manifest")
    # As many rows as shards.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("folder", F.lit(folder))


def _reading(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                store, path = file_system(entry["folder"])
                shard = Shard(store, f"{path}/{entry['file']}")
                # Rows with an id are read by key, as any caller would; each key once, then its documents.
                distinct = np.unique(shard.keys[shard.known])
                lead, often = shard.find(distinct)
                rows = np.repeat(lead - np.concatenate(([0], np.cumsum(often)[:-1])), often) + np.arange(often.sum())
                rows = np.concatenate((np.flatnonzero(~shard.known), rows.astype(np.int64)))
                yield from _documents(shard, rows, entry["shard"], with_ids)

    return run


def _documents(shard: Shard, rows: np.ndarray, number: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """The documents in ``rows``, some million ids at a time."""
    places = shard.places[rows]
    total = np.cumsum(places[:, 1]) if len(rows) else np.zeros(0, np.int64)
    at = 0
    while at < len(rows):
        done = int(total[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + BLOCK_IDS, side="right")))
        first = int(places[at:upto, 0].min())
        span = int((places[at:upto, 0] + places[at:upto, 1]).max()) - first
        # Neighbours come in one read.
        near = shard.ids(first, span) if span <= 4 * BLOCK_IDS else None
        ids = [near[a - first : a - first + n] if near is not None else shard.ids(a, n) for a, n in places[at:upto].tolist()]
        own = rows[at:upto]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(own), number, np.int32)),
                pa.array(own),
                pa.array(shard.keys[own], mask=~shard.known[own]),
                pa.array(np.ascontiguousarray(places[at:upto, 0])),
                pa.array(np.ascontiguousarray(places[at:upto, 1])),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                pa.array([x.astype(np.int32) if with_ids else None for x in ids], pa.list_(pa.int32())),
            ],
            names=[x.split()[0] for x in _ROWS.split(", ")],
        )
        at = upto


def read_store(manifest: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32[, ids]`` of every document, read back from the shards by key.

    ``start`` counts the ids of all documents before it. A shard is a task of its own.
    """
    shards = manifest.count()
    rows = manifest.repartition(max(1, shards)).mapInArrow(_reading(with_ids), _ROWS)
    base = manifest.select("shard", "base")
    rows = rows.join(F.broadcast(base), "shard")  # two numbers a shard
    found = rows.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return found if with_ids else found.drop("ids")


def _fetching(table: pa.Table) -> pa.Table:
    entry = {name: table.column(name)[0].as_py() for name in ("folder", "file", "shard")}
    store, path = file_system(entry["folder"])
    shard = Shard(store, f"{path}/{entry['file']}")
    keys = np.unique(table.column("key").to_numpy())
    lead, often = shard.find(keys)
    rows = np.concatenate([np.arange(a, a + n) for a, n in zip(lead, often)] or [np.zeros(0, np.int64)]).astype(np.int64)
    found = list(_documents(shard, rows, entry["shard"], True))
    schema = pa.schema(list(zip([x.split()[0] for x in _ROWS.split(", ")], (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())))))
    return pa.Table.from_batches([b.cast(schema) for b in found], schema=schema)


def fetch(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids`` of the wanted keys: each goes to the shards whose range holds it and is looked up there."""
    ranges = F.broadcast(manifest.where("low is not null").select("shard", "file", "folder", "low", "high"))  # a row a shard
    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").distinct()
    asked = wanted.join(ranges, F.col("key").between(F.col("low"), F.col("high"))).select("shard", "file", "folder", "key")
    return asked.groupBy("shard").applyInArrow(_fetching, _ROWS).select("doc_id", "n_tokens", "ids")
