"""Shard files of geotagged images: distributed decoding, the shard catalog and id assignment.

A shard ``<name>_<number>.msg`` is a sequence of MessagePack maps with ``latitude``, ``longitude``, ``image``
and optionally ``id``. Files above a split size are first walked without reading the image bytes, by many tasks that start in the
middle of a file; the splits found there are what the decoding tasks share, so one very large shard is many tasks.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille.functions.text import file_stem, stem_number
from quadrille.plans.durable import pin
from quadrille.plans.ranking import running_total
from quadrille.plans.sizing import broadcast_if_small

#: Bytes of one shard that one task decodes.
SPLIT_BYTES = 128 * 1024 * 1024
#: Bytes of decoded rows per Arrow batch.
BATCH_BYTES = 16 * 1024 * 1024
#: Most decoding tasks of one read; each then works through several splits.
MOST_TASKS = 50_000
#: Files per part of the stored catalog document.
CATALOG_PART = 10_000

ROWS = "shard string, pos bigint, source_id string, latitude double, longitude double, image binary"
#: Bytes of a large shard in which one task looks for records, unless splits are larger.
WINDOW_BYTES = 32 * 1024 * 1024
# Bytes read at once in search of a record, and records that must follow a place that looks like one.
_SEARCH_BYTES, _PROOF_RECORDS = 1 << 20, 3
_LONGEST_NAME = 1 << 16
_DAMAGE = (ValueError, IndexError, struct.error)
_WINDOW = ["path", "shard", "shard_no", "bytes", "k", "low", "high"]
_WALKED = (
    "path string, shard string, shard_no int, bytes bigint, k bigint, low bigint, high bigint, start bigint, stop bigint,"
    " splits array<struct<start:bigint,stop:bigint,n:bigint>>"
)
_SPLITS = "path string, shard string, shard_no int, start bigint, stop bigint, first_pos bigint"

# Fixed values of the MessagePack format: type byte -> struct code of a number, or of a length.
_NUMBERS = {
    0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q",
    0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q",
}
_TEXT_LENGTHS = {0xD9: ">B", 0xDA: ">H", 0xDB: ">I"}
_BYTES_LENGTHS = {0xC4: ">B", 0xC5: ">H", 0xC6: ">I"}
_MAP_LENGTHS = {0xDE: ">H", 0xDF: ">I"}
_CONSTANTS = {0xC0: None, 0xC2: False, 0xC3: True}


# --- record walking (runs inside tasks) -----------------------------------------------------------------


def _open(path: str) -> io.BufferedReader:
    from pyarrow import fs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path
    if "://" in uri:
        system, name = fs.FileSystem.from_uri(uri)
    else:
        system, name = fs.LocalFileSystem(), uri
    return io.BufferedReader(system.open_input_file(name), 1 << 16)


def _number(stream, code: str):
    return struct.unpack(code, stream.read(struct.calcsize(code)))[0]


def _check_length(size: int, most: int | None) -> None:
    if most is not None and size > most:
        raise ValueError(f"a name of {size} bytes")


def _value(stream, wanted: bool, most: int | None = None):
    """Next scalar; text and bytes are skipped over when not wanted, and an error when longer than ``most``."""
    kind = stream.read(1)[0]
    if kind <= 0x7F:
        return kind
    if kind >= 0xE0:
        return kind - 0x100
    if kind in _CONSTANTS:
        return _CONSTANTS[kind]
    if kind in _NUMBERS:
        return _number(stream, _NUMBERS[kind])
    if 0xA0 <= kind <= 0xBF or kind in _TEXT_LENGTHS:
        size = kind & 0x1F if kind <= 0xBF else _number(stream, _TEXT_LENGTHS[kind])
        _check_length(size, most)
        if wanted:
            return stream.read(size).decode()
    elif kind in _BYTES_LENGTHS:
        size = _number(stream, _BYTES_LENGTHS[kind])
        _check_length(size, most)
        if wanted:
            return stream.read(size)
    else:
        raise ValueError(f"type byte {kind:#x} does not occur in shard records")
    stream.seek(size, io.SEEK_CUR)
    return None


def walk_records(stream, stop: int, fields: Iterable[str]) -> Iterator[tuple[int, dict]]:
    """``(offset, record)`` from the current position up to byte ``stop``; only ``fields`` are decoded."""
    fields = frozenset(fields)
    while (offset := stream.tell()) < stop:
        kind = stream.read(1)[0]
        if 0x80 <= kind <= 0x8F:
            entries = kind & 0x0F
        elif kind in _MAP_LENGTHS:
            entries = _number(stream, _MAP_LENGTHS[kind])
        else:
            raise ValueError(f"no record at byte {offset}")
        record = {}
        for _ in range(entries):
            name = _value(stream, True, _LONGEST_NAME)
            value = _value(stream, name in fields)
            if name in fields:
                record[name] = value
        yield offset, record
    if stream.tell() > stop:
        raise ValueError(f"record cut off at byte {stop}")


def _first_record(stream, low: int, high: int, size: int) -> int | None:
    """A place in ``low .. high`` that looks like the start of a record: it begins as the file does, and whole records follow."""
    stream.seek(0)
    head = stream.read(2)
    mark = head + stream.read(head[1] & 0x1F) if len(head) == 2 and 0xA0 <= head[1] <= 0xBF else head
    at, kept = low, b""
    while at < high:
        stream.seek(at)
        chunk = stream.read(min(_SEARCH_BYTES, high + len(mark) - 1 - at))
        text, base = kept + chunk, at - len(kept)
        place = text.find(mark)
        while place >= 0 and base + place < high:
            if _records_follow(stream, base + place, size):
                return base + place
            place = text.find(mark, place + 1)
        if not chunk:
            return None
        at, kept = at + len(chunk), text[len(text) - len(mark) + 1 :]
    return None


def _records_follow(stream, start: int, size: int) -> bool:
    stream.seek(start)
    try:
        for found, _ in enumerate(walk_records(stream, size, ()), 1):
            if found == _PROOF_RECORDS:
                break
    except _DAMAGE:
        return False
    return True


def _walk_windows(split_bytes: int):
    """Splits of the records that start in a window, from ``start`` where it is known, else from the first place that looks right."""

    def walked(w):
        with _open(w.path) as stream:
            start = w.start if w.known else _first_record(stream, w.low, w.high, w.bytes)
            if start is None:
                return w.high, w.high, []
            stream.seek(start)
            splits, first, upto, n = [], start, start, 0
            try:
                for offset, _ in walk_records(stream, w.bytes, ()):
                    if offset >= w.high:
                        break
                    if n and offset - first >= split_bytes:
                        splits.append({"start": first, "stop": offset, "n": n})
                        first, n = offset, 0
                    n, upto = n + 1, stream.tell()
            except _DAMAGE:
                return start, None, []
        return start, upto, [*splits, {"start": first, "stop": upto, "n": n}] if n else []

    def run(batches):
        import pandas as pd

        for windows in batches:
            rows = [(*w[: len(_WINDOW)], *walked(w)) for w in windows.itertuples(index=False)]
            out = pd.DataFrame(rows, columns=[*_WINDOW, "start", "stop", "splits"])
            yield out.astype({"stop": "Int64"})

    return run


def _count_records(batches):
    import pandas as pd

    for splits in batches:
        counted = []
        for s in splits.itertuples(index=False):
            with _open(s.path) as stream:
                stream.seek(s.start)
                counted.append((s.shard, s.shard_no, sum(1 for _ in walk_records(stream, s.stop, ()))))
        yield pd.DataFrame(counted, columns=["shard", "shard_no", "n"])


def _decode(batches):
    import pyarrow as pa

    kinds = pa.schema(
        [
            ("shard", pa.string()), ("pos", pa.int64()), ("source_id", pa.string()),
            ("latitude", pa.float64()), ("longitude", pa.float64()), ("image", pa.binary()),
        ]
    )
    for splits in batches:
        for s in splits.to_pylist():
            rows, held = [], 0
            with _open(s["path"]) as stream:
                stream.seek(s["start"])
                walked = walk_records(stream, s["stop"], ("id", "latitude", "longitude", "image"))
                for pos, (_, record) in enumerate(walked, s["first_pos"]):
                    source_id = record.get("id")
                    rows.append(
                        {
                            "shard": s["shard"],
                            "pos": pos,
                            "source_id": None if source_id is None else str(source_id),
                            "latitude": float(record["latitude"]),
                            "longitude": float(record["longitude"]),
                            "image": record["image"],
                        }
                    )
                    held += len(record["image"]) + 64
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kinds)


# --- source ---------------------------------------------------------------------------------------------


def shard_files(
    spark: SparkSession, folder: str, *, pattern: str = "*.msg", only: Column | None = None
) -> DataFrame:
    """``(path, shard, shard_no, bytes)`` of the shard files; ``only`` is a predicate on these columns.

    Listing reads no file content and leaves out files of zero bytes. Natural order is by ``shard_no``.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", file_stem("path").alias("shard"), F.col("length").alias("bytes"))
        .select("path", "shard", stem_number("shard").alias("shard_no"), "bytes")
    )
    return listed if only is None else listed.where(only)


def natural_order(df: DataFrame, stem: str = "shard") -> DataFrame:
    """Sorted by the number in the stem, so that shard_10 follows shard_9."""
    return df.orderBy(stem_number(stem), stem)


def shard_splits(files: DataFrame, *, split_bytes: int = SPLIT_BYTES, window_bytes: int | None = None) -> DataFrame:
    """``(path, shard, shard_no, start, stop, first_pos)``: byte ranges at record borders. Pinned.

    A large shard is cut into windows that are walked at the same time, each from the first place that looks like a record. A window
    is right when it starts where the one before it ends; the first one starts with the file. Windows that do not (bytes of an image may look
    like records) are walked again from there, until all fit: so the result is that of a walk from the first byte.
    """
    named = ("path", "shard", "shard_no")
    whole = files.where(F.col("bytes") <= split_bytes).select(
        *named, F.lit(0).cast("long").alias("start"), F.col("bytes").alias("stop"), F.lit(0).cast("long").alias("first_pos")
    )
    span = window_bytes or max(split_bytes, WINDOW_BYTES)
    windows = files.where(F.col("bytes") > split_bytes).select(*named, "bytes", F.explode(F.expr(f"sequence(0L, (bytes - 1) div {span})")).alias("k"))
    windows = windows.withColumn("low", F.expr(f"k * {span}")).withColumn("high", F.expr(f"least((k + 1) * {span}, bytes)"))
    walk = _walk_windows(split_bytes)

    def done(part: DataFrame) -> DataFrame:
        return part.repartition(_tasks(part, F.col("high") - F.col("low"))).mapInPandas(walk, _WALKED)

    walked = pin(done(windows.withColumn("start", F.lit(0).cast("long")).withColumn("known", F.col("k") == 0)))
    in_file = Window.partitionBy("path").orderBy("k")
    while True:
        placed = walked.withColumn("_before", F.lag("stop").over(in_file))
        # False where the window before is broken: its end is not known yet.
        wrong = F.coalesce(F.col("start") != F.col("_before"), F.lit(False))
        if placed.where(wrong).isEmpty():
            break
        again = placed.where(wrong).select(*_WINDOW, F.col("_before").alias("start"), F.lit(True).alias("known"))
        walked = pin(placed.where(~wrong).drop("_before").unionByName(done(again)))
    broken = walked.where("stop is null").select("path", "start").orderBy("path", "k").first()
    if broken:
        raise ValueError(f"damaged records in {broken.path} after byte {broken.start}")
    cut = walked.select(*named, F.inline("splits"))
    in_order = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    large = cut.select(*named, "start", "stop", F.coalesce(F.sum("n").over(in_order), F.lit(0)).cast("long").alias("first_pos"))
    return pin(whole.unionByName(large))


def _tasks(pieces: DataFrame, size: Column) -> int:
    """A task for each piece up to four for each shuffle partition; beyond, for each ``SPLIT_BYTES``, so that small pieces share a task."""
    rows, total = pieces.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    few = 4 * int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(rows, MOST_TASKS, max(few, -(-total // SPLIT_BYTES))))


def read_shards(splits: DataFrame) -> DataFrame:
    """``(shard, pos, source_id, latitude, longitude, image)`` of every record; ``pos`` counts inside a shard."""
    tasks = _tasks(splits, F.col("stop") - F.col("start"))
    return splits.repartition(tasks).mapInArrow(_decode, ROWS)


def count_shards(splits: DataFrame) -> DataFrame:
    """``(shard, n)`` without reading image bytes."""
    tasks = _tasks(splits, F.col("stop") - F.col("start"))
    counted = splits.repartition(tasks).mapInPandas(_count_records, "shard string, shard_no int, n bigint")
    return counted.groupBy("shard").agg(F.sum("n").alias("n"))


# --- catalog --------------------------------------------------------------------------------------------


def count_rows(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


def shard_catalog(counts: DataFrame) -> DataFrame:
    """``(name, count, min_index, max_index)`` from ``(shard, n)``: index ranges in natural order from 0."""
    numbered = counts.select("shard", stem_number("shard").alias("_no"), "n")
    upto = running_total(numbered, ["_no", "shard"], "n", "_upto")
    return upto.select(
        F.col("shard").alias("name"),
        F.col("n").alias("count"),
        (F.col("_upto") - F.col("n")).alias("min_index"),
        (F.col("_upto") - 1).alias("max_index"),
    )


def catalog_total(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.count(F.lit(1)).alias("files"))


def assign_ids(rows: DataFrame, catalog: DataFrame, *, first_id: int = 0) -> DataFrame:
    """Adds ``id`` = first index of the shard + position in it; ``first_id=1`` numbers like a database key."""
    starts = catalog.select(F.col("name").alias("shard"), F.col("min_index").alias("_start"))
    joined = rows.join(broadcast_if_small(starts), "shard")
    return joined.select(
        (F.col("_start") + F.col("pos") + F.lit(first_id)).cast("long").alias("id"), *rows.columns
    )


def catalog_document(catalog: DataFrame, *, part_size: int = CATALOG_PART) -> DataFrame:
    """``(part, count, files ARRAY<STRUCT>)``: the nested form, in parts of ``part_size`` files."""
    total = catalog.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    ranked = running_total(
        catalog.withColumn("_one", F.lit(1)), ["min_index", "max_index", "name"], "_one", "_rank"
    )
    entry = F.struct("_rank", F.struct("name", "count", "min_index", "max_index").alias("f"))
    return (
        ranked.groupBy(F.expr(f"cast((_rank - 1) div {part_size} as int)").alias("part"))
        .agg(F.sort_array(F.collect_list(entry)).getField("f").alias("files"))
        .select("part", total.alias("count"), "files")
    )


def write_catalog(catalog: DataFrame, folder: str) -> None:
    catalog_document(catalog).write.mode("overwrite").json(folder)


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    entry = "struct<name:string,count:bigint,min_index:bigint,max_index:bigint>"
    parts = spark.read.schema(f"part int, count bigint, files array<{entry}>").json(folder)
    return parts.select(F.inline("files"))


def accounting(files: DataFrame) -> DataFrame:
    """``(files, bytes)`` of a listing."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def folder_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """``(path, bytes)`` of the files below a folder, from metadata alone."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", F.col("length").alias("bytes"))
    )
