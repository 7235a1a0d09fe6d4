"""Benchmark passages in documents, by a prefix-filtered set join with exact verification.

A window is a run of ``width`` consecutive item words (the whole item where it has fewer). A window's set is its
runs of ``SHINGLE`` words; containment must be whole, so one shingle is all the prefix that is necessary, and the one
rarest in the corpus is taken. A document position with that shingle is a candidate; the position bound (the window must
start inside the text) and the length bound (and end there) come next, and then all words of the window are
compared. The items are read in blocks of bounded size, each broadcast on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.tables import fresh_name, numbered, stored
from quadrille.llm.words import FOLD, WORD_BYTES, Words, chunks, find_words, releasing, sequence_hashes, text_buffers

SHINGLE = 3
#: Bytes of item text whose windows are broadcast at once; more items make more blocks, each a pass over the documents.
BLOCK_BYTES = 8 << 20
_COUNTS = "gram long, n long"
_HITS = "number long, doc_id long, n_words long, item_id long, first int, stop int"


def item_words(text: str | None) -> list[bytes]:
    """Folded words of one text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    found = find_words(data, np.array([0, len(data)]), WORD_BYTES)
    folded = FOLD[data].tobytes()
    return [folded[a:b] for a, b in zip(found.start, found.end)]


def _hash_words(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    return find_words(data, np.array([0, len(data)]), WORD_BYTES).hash


def windows_of(items: list[tuple[int | None, str | None]], width: int) -> list[tuple[int | None, list[bytes]]]:
    """All windows of the items; items without words have none."""
    out = []
    for item, text in items:
        words = item_words(text)
        for at in range(max(1, len(words) - width + 1) if words else 0):
            out.append((item, words[at : at + width]))
    return out


class WindowIndex:
    """Windows by their rarest shingle."""

    def __init__(self, windows, rarity: dict[int, int] | None = None):
        self.windows = windows
        self.hashes = [_hash_words(w) for _, w in windows]
        self.grams = [sequence_hashes(h, min(SHINGLE, len(h))) for h in self.hashes]
        if rarity is not None:
            self.offset = [min(range(len(g)), key=lambda k: (rarity.get(int(g[k]), 0), k)) for g in self.grams]
            keys = np.array([g[k] for g, k in zip(self.grams, self.offset)], np.uint64)
            self.order = np.argsort(keys, kind="stable")
            self.keys = keys[self.order]

    def all_grams(self) -> np.ndarray:
        return np.unique(np.concatenate(self.grams)) if self.grams else np.zeros(0, np.uint64)

    def lengths(self) -> list[int]:
        return sorted({min(SHINGLE, len(h)) for h in self.hashes})


def _member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys: a bit table of their low bits first, then a binary search."""
    table = np.zeros(1 << 20, bool)
    table[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    at = np.flatnonzero(table[(values & np.uint64((1 << 20) - 1)).astype(np.int64)])
    if not len(at) or not len(keys):
        return at[:0]
    place = np.minimum(np.searchsorted(keys, values[at]), len(keys) - 1)
    return at[keys[place] == values[at]]


def _counting(grams, lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = grams.value
        total = np.zeros(len(keys), np.int64)
        for batch in chunks(batches):
            words = find_words(*text_buffers(batch.column("text")), WORD_BYTES)
            for length in lengths:
                found = sequence_hashes(words.hash, length)
                hit = found[_member(found, keys)]
                total += np.bincount(np.searchsorted(keys, hit), minlength=len(keys))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(total[some])], names=["gram", "n"])

    return run


def _matches(words: Words, data: bytes, index: WindowIndex) -> Iterator[tuple[int, int, int]]:
    """Window number, index of its first word, index after its last, for every occurrence."""
    bounds = words.bounds()
    for length in index.lengths():
        grams = sequence_hashes(words.hash, length)
        for at in _member(grams, index.keys).tolist():
            low, high = np.searchsorted(index.keys, grams[at], "left"), np.searchsorted(index.keys, grams[at], "right")
            doc = words.doc[at]
            for number in index.order[low:high].tolist():
                hashes = index.hashes[number]
                if min(SHINGLE, len(hashes)) != length:
                    continue
                first = at - index.offset[number]
                stop = first + len(hashes)
                if first < bounds[doc] or stop > bounds[doc + 1] or not np.array_equal(words.hash[first:stop], hashes):
                    continue
                text = [data[a:b] for a, b in zip(words.start[first:stop].tolist(), words.end[first:stop].tolist())]
                if text == index.windows[number][1]:
                    yield number, first, stop


def _matching(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in chunks(batches):
            data, offsets = text_buffers(batch.column("text"))
            words = find_words(data, offsets, WORD_BYTES)
            bounds = words.bounds()
            n_words = np.diff(bounds)
            rows: dict[str, list] = {"item": [], "first": [], "stop": [], "doc": []}
            for number, first, stop in _matches(words, FOLD[data].tobytes(), index) if len(words.hash) else ():
                doc = int(words.doc[first])
                for name, value in zip(rows, (index.windows[number][0], first - int(bounds[doc]), stop - int(bounds[doc]), doc)):
                    rows[name].append(value)
            # One row without an item keeps every document.
            docs = np.concatenate((np.arange(len(batch)), np.array(rows["doc"], np.int64)))
            none = [None] * len(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("number").take(pa.array(docs)),
                    batch.column("doc_id").take(pa.array(docs)),
                    pa.array(n_words[docs]),
                    pa.array(none + rows["item"], pa.int64()),
                    pa.array(none + rows["first"], pa.int32()),
                    pa.array(none + rows["stop"], pa.int32()),
                ],
                names=[x.split()[0] for x in _HITS.split(", ")],
            )

    return run


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about that many bytes; the driver holds one block at a time."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        yield sorted(map(tuple, part.collect()), key=repr)


def occurrences(docs: DataFrame, items: DataFrame, *, width: int = 13, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """``number, doc_id, n_words, item_id, first, stop``: word ranges of window occurrences (``number`` tells rows of
    ``docs`` apart), and a row with a null range per document and block of items.

    Each task joins its rows with one block of windows by prefix; ranges of one document may overlap.
    """
    spark = docs.sparkSession
    source = docs.select(F.monotonically_increasing_id().alias("number"), F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col(item_key).cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = []
    for block in _item_blocks(items, BLOCK_BYTES):
        index = WindowIndex(windows_of(block, width))
        grams = spark.sparkContext.broadcast(index.all_grams())
        counts = source.select("text").mapInArrow(releasing(_counting(grams, index.lengths())), _COUNTS).groupBy("gram").agg(F.sum("n").alias("n"))
        rarity = {g & ((1 << 64) - 1): n for g, n in counts.collect()}  # shingles of this block of items alone
        index = spark.sparkContext.broadcast(WindowIndex(index.windows, rarity))
        found.append(source.mapInArrow(releasing(_matching(index)), _HITS))
    return reduce(DataFrame.unionByName, found)


def contamination(docs: DataFrame, items: DataFrame, *, width: int = 13, percent: int = 5, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit when it lies in any occurrence of a window; a document is contaminated when it has hits and they are
    ``percent`` or more of its words. Null or empty texts have no words and are clean. Items without words or with
    a null text have no windows; a null item id counts as an item, written as an empty string. Rows with repeated ids are
    rows of their own; equal item ids are one item. Empty tables give no rows, or rows without hits.
    """
    hits = occurrences(docs, items, width=width, key=key, item_key=item_key)
    # Ranges of one document are added up as a union of intervals, sorted within the document.
    ranges = F.array_sort(F.collect_set(F.when(F.col("first").isNotNull(), F.struct("first", "stop"))))
    covered = F.aggregate(
        "ranges",
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, r: F.struct(
            F.greatest(a["upto"], r["stop"]).alias("upto"),
            (a["n"] + F.greatest(F.lit(0), r["stop"] - F.greatest(a["upto"], r["first"]))).cast("long").alias("n"),
        ),
        lambda a: a["n"],
    )
    ids = F.array_sort(F.collect_set(F.when(F.col("first").isNotNull(), F.coalesce(F.col("item_id").cast("string"), F.lit("")))))
    return (
        hits.groupBy("number", "doc_id", "n_words")
        .agg(ranges.alias("ranges"), ids.alias("ids"))
        .select(
            "doc_id",
            "n_words",
            covered.alias("n_hit"),
            F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", F.expr(f"n_hit > 0 and 100 * n_hit >= {percent} * n_words"))
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged by itself whatever its id. Null and empty texts stay, as do all columns."""
    number = fresh_name(docs, "_number")
    rows = numbered(docs, number)
    judged = contamination(rows, items, key=number)
    gone = stored(judged.where("contaminated").select(F.col("doc_id").alias(number)), "contaminated")
    return rows.join(gone, number, "left_anti").select(*(f"`{c}`" for c in docs.columns))
