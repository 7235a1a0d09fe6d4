"""Removal of lines, paragraphs or passages that stand earlier in the corpus, by hashes of normalised units.

A unit is a line (or a paragraph: text between blank lines). Normalised, it is folded to lower case (A-Z), its white
space is single blanks, and it has at least ``least_words`` words; shorter units are never removed. All units with one
digest are grouped over the whole corpus; the earliest in rank (doc_id, then place in the text) stays, the others go.

With ``unit="passage"`` the sentences of a line are units beside the line, since passages are often copied into the
middle of a line. A sentence is also hashed with the short ones that follow it. Repeated lines and sentences
go where a run of them, across line ends too, has at least ``least_run`` words; shorter ones are phrases that texts share.

Passages whose edges lie anywhere, also inside sentences or in text without sentence marks, are found word by word: each
run of ``least_passage`` words that stands earlier goes, so of a longer copy all words go. Words are parted by ASCII white
space here, and known by 64-bit hashes. A run is looked up only when its anchor, the least hash among its runs of
``ANCHOR`` words, occurs more than once; equal runs have equal anchors, so none is missed. The anchors
that do are broadcast as bits: a wrong bit makes one more run to look up, never another result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.ngram_join import FRAGMENT_BYTES
from quadrille.llm.tables import fresh_name, numbered, stored, text_bytes
from quadrille.llm.words import Words, blob, chunks, find_words, joined, mix, releasing, runs, sequence_hashes, text_buffers

#: Units of fewer words are kept wherever they stand: they are headings and list items more often than copies.
LEAST_WORDS = 5
#: Words of a run of repeated sentences inside lines that is removed; shorter runs are phrases more often than copies.
LEAST_RUN = 25
#: Words of a repeated passage that goes wherever its edges are: "over 50 words".
LEAST_PASSAGE = 51
#: Words of an anchor; bits of a table for each hash that occurs again, and the most bits of a table.
ANCHOR, BITS_PER_HASH, MOST_BITS = 16, 32, 1 << 29
#: Bytes of text whose runs of words are made at once.
RUN_BYTES = 1 << 18
#: Bytes of a digest.
_DIGEST = 12
_UNITS = {"line": re.compile(r"[^\n]+"), "paragraph": re.compile(r"[^\n]+(?:\n(?![^\S\n]*(?:\n|\Z))[^\n]+)*")}
_SENTENCE = re.compile(r"[^\n]+?(?:[.!?]+(?=\s|\Z)|(?=\n)|\Z)")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
_RUNS = "fragment int, ids binary, nulls binary, numbers binary, counts binary, places binary, digests binary"
_AGAIN = "number long, spans array<long>"
_FOUND = "doc_id long, number long, start int, stop int, digest binary"


def _digest(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode()).digest()[:_DIGEST]


def units_of(text: str, unit: str, least_words: int) -> Iterator[tuple[int, int, bytes]]:
    """Start, end (characters of the original text) and digest of every unit that is long enough."""
    for match in _UNITS["line" if unit == "passage" else unit].finditer(text):
        words = match[0].translate(_LOWER).split()
        if len(words) >= least_words:
            yield match.start(), match.end(), _digest(words)
            if unit == "passage":
                yield from _sentences(text, match.start(), match.end(), least_words)


def _sentences(text: str, start: int, stop: int, least_words: int) -> Iterator[tuple[int, int, bytes]]:
    """The long sentences of a line, and each with the short ones behind it; not the line itself."""
    long: list[str] = []
    begin = end = start

    def with_tail() -> Iterator[tuple[int, int, bytes]]:
        if tail and (begin, end) != (start, stop):
            yield begin, end, _digest(long + tail)

    tail: list[str] = []
    for match in _SENTENCE.finditer(text, start, stop):
        words = match[0].translate(_LOWER).split()
        if len(words) >= least_words:
            yield from with_tail()
            long, tail, begin, end = words, [], match.start(), match.end()
            if (begin, end) != (start, stop):
                yield begin, end, _digest(long)
        elif long:
            tail += words
            end = match.end()
    yield from with_tail()


def removable(text: str, spans: list[tuple[int, int]], unit: str, least_run: int) -> list[tuple[int, int]]:
    """The spans of repeated units that go: all, or for passages the runs of them that are long enough."""
    if unit != "passage":
        return spans
    runs: list[list[int]] = []
    for start, stop in sorted(spans):
        if runs and (start <= runs[-1][1] or not text[runs[-1][1] : start].strip()):
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    out = []
    for start, stop in runs:
        if len(text[start:stop].split()) >= least_run:
            while text[start - 1 : start] in (" ", "\t"):
                start -= 1
            out.append((start, stop))
    return out


def _units(unit: str, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows: list[tuple] = []
            for doc, number, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                rows.extend((doc, number, *found) for found in units_of(text or "", unit, least_words))
                if len(rows) > 50_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in _FOUND.split(", ")])


def _anchors(words: Words, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all runs of ``least`` words, the place of the anchor of each, and the hash of every run of ``width`` words."""
    hashes = sequence_hashes(words.hash, width)
    first = np.arange(max(0, len(words.hash) - least + 1))
    if not len(first):
        return first, first, hashes
    first = first[words.doc[: len(first)] == words.doc[least - 1 :]]
    place = np.lib.stride_tricks.sliding_window_view(hashes, least - width + 1).argmin(1)[first] + first
    return first, place, hashes


def _anchoring(width: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=RUN_BYTES):
            _, place, hashes = _anchors(find_words(*text_buffers(batch.column("text"))), width, least)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[np.unique(place)].view(np.int64))], names=["anchor"])

    return run


def _running(table, width: int, least: int, fragments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        for batch in chunks(batches, most=RUN_BYTES):
            data, offsets = text_buffers(batch.column("text"))
            words = find_words(data, offsets)
            first, place, hashes = _anchors(words, width, least)
            again = _marked(bits, hashes[place])
            first, anchor = first[again], hashes[place][again]
            digest = np.full(len(first), least, np.uint64)
            for k in (*range(0, least - width, width), least - width):
                digest = mix(digest ^ hashes[first + k])
            # Characters before each byte, as bytes that do not continue a character.
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            doc = words.doc[first]
            begin = chars[offsets[doc]]
            places = (chars[words.start[first]] - begin) << 32 | (chars[words.end[first + least - 1]] - begin)
            ids, nulls = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            numbers = batch.column("number").to_numpy()
            # By the anchor: equal runs have one, and neighbouring runs mostly share theirs, so a passage is in one or two fragments.
            part = ((mix(anchor) >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(fragments + 1, dtype=np.uint64))
            rows = []
            for k in np.flatnonzero(np.diff(ends)).tolist():
                own = order[ends[k] : ends[k + 1]]
                at, count = runs(doc[own])
                docs = doc[own][at]
                rows.append((k, blob(ids[docs]), blob(nulls[docs]), blob(numbers[docs]), blob(count), blob(places[own]), blob(digest[own])))
            kinds = (pa.int32(), *[pa.binary()] * 6)
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in _RUNS.split(", ")])

    return run


def _later(table: pa.Table) -> pa.Table:
    """Of one fragment: the places of runs of words that stand earlier and do not overlap the earliest one, by row; places that meet are
    one."""
    counts = joined(table.column("counts"), np.int64)
    ids, nulls, numbers = (np.repeat(joined(table.column(n), t), counts) for n, t in (("ids", np.int64), ("nulls", np.bool_), ("numbers", np.int64)))
    places, digests = joined(table.column("places"), np.int64), joined(table.column("digests"), np.uint64)
    order = np.lexsort((places, numbers, ids, nulls, digests))
    at, count = runs(digests[order])
    first = np.repeat(order[at], count)
    order = order[(numbers[order] != numbers[first]) | (places[order] >> 32 >= places[first] & 0xFFFFFFFF)]
    order = order[np.lexsort((places[order], numbers[order]))]
    numbers, places = numbers[order], places[order]
    start, stop = places >> 32, places & 0xFFFFFFFF
    # Runs have one number of words, so of two runs the later one also ends later.
    opens = np.ones(len(order), bool)
    opens[1:] = (numbers[1:] != numbers[:-1]) | (start[1:] > stop[:-1])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(order)) - 1 if len(first) else first
    at, count = runs(numbers[first])
    spans = pa.ListArray.from_arrays(pa.array(np.append(at, len(first)).astype(np.int32)), pa.array(start[first] << 32 | stop[last]))
    return pa.table({"number": numbers[first][at], "spans": spans})


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    slot = (hashes & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7)) & 1 == 1


def _bits(hashes: DataFrame, column: str) -> Broadcast:
    """A table with the bit of every hash, as a broadcast of ``MOST_BITS`` at most."""
    bits = min(MOST_BITS, 1 << max(16, (BITS_PER_HASH * hashes.count()).bit_length()))
    slots = hashes.select((F.col(column).bitwiseAND(F.lit(bits - 1)) + 1).alias("slot"))
    parts = slots.groupBy(F.bitmap_bucket_number("slot").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("part"))
    table = bytearray(bits // 8)
    for k, part in parts.collect():  # 4 KB each, ``MOST_BITS`` together
        table[(k - 1) * len(part) : k * len(part)] = part
    return hashes.sparkSession.sparkContext.broadcast(bytes(table))


#: The first seven bytes of a digest as a number.
_HASH = "cast(conv(hex(substring(digest, 1, 7)), 16, 10) as bigint)"


def _repeated(table: Broadcast):
    """The units whose digests may be among those that stand more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            column = batch.column("digest")
            data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
            digests = data[column.offset * _DIGEST : (column.offset + len(column)) * _DIGEST].reshape(-1, _DIGEST)
            hashes = np.zeros(len(digests), np.uint64)
            for k in range(7):
                hashes = hashes << np.uint64(8) | digests[:, k]
            yield batch.filter(pa.array(_marked(bits, hashes)))

    return run


def _repeated_runs(source: DataFrame, least: int) -> DataFrame:
    """``number, spans`` of all runs of ``least`` words that stand earlier, and not in part in the same place."""
    width = max(1, min(ANCHOR, least // 2))
    anchors = source.select("text").mapInArrow(releasing(_anchoring(width, least)), "anchor long").groupBy("anchor").count()
    anchors = stored(anchors.where("count > 1").select("anchor"), "anchors")
    shared = _bits(anchors, "anchor")
    fragments = max(8, text_bytes(source) // FRAGMENT_BYTES)
    return source.mapInArrow(releasing(_running(shared, width, least, fragments)), _RUNS).groupBy("fragment").applyInArrow(releasing(_later), _AGAIN)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; what is removed from the start of a line takes the line break behind it along."""
    parts, at = [], 0
    for start, stop in sorted(spans):
        parts.append(text[at:start])
        whole = not start or text[start - 1] == "\n"
        at = stop + 1 if whole and text[stop : stop + 1] == "\n" else stop
    parts.append(text[at:])
    kept = "".join(parts)
    return kept[:-1] if kept.endswith("\n") and not text.endswith("\n") else kept


def removed_units(
    rows: DataFrame, number: str, *, unit: str = "line", least_words: int = LEAST_WORDS, least_passage: int = LEAST_PASSAGE, key: str = "doc_id"
) -> DataFrame:
    """``number, spans``: the character ranges of repeated units, and of repeated runs of words for passages, a row
    per document that has any. A range is one number, start * 2**32 + stop.

    ``rows`` have a ``number`` of their own. Documents rank by id, those without one last, then by number: of equal rows one keeps its text.
    """
    source = rows.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(number).alias("number"), F.col("text").cast("string").alias("text"))
    found = stored(source.mapInArrow(releasing(_units(unit, least_words)), _FOUND), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "number", "start")
    # A digest that stands once is dropped here; counts are partial before they are shuffled.
    first = stored(
        found.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"), "digests"
    )
    maybe = found.mapInArrow(releasing(_repeated(_bits(first.selectExpr(f"{_HASH} as hash"), "hash"))), _FOUND)
    again = maybe.join(first, "digest").where(~rank.eqNullSafe(F.col("first")))
    again = again.selectExpr("number", "array(shiftleft(cast(start as bigint), 32) | stop) as spans")
    if unit == "passage":
        again = again.unionByName(_repeated_runs(source, least_passage))
    return again.groupBy("number").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _removal(schema, unit: str, least_run: int, text: str, spans: str):
    names, kind = schema.names, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            texts, marked = batch.column(text).to_pylist(), batch.column(spans).to_pylist()
            gone = [removable(t, [(s >> 32, s & 0xFFFFFFFF) for s in set(found)], unit, least_run) if found else [] for t, found in zip(texts, marked)]
            kept = [_cut(t, cuts) if cuts else t for t, cuts in zip(texts, gone)]
            removed = [[{"start": a, "stop": b} for a, b in sorted(cuts)] or None for cuts in gone]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns |= {text: pa.array(kept, batch.schema.field(text).type), spans: pa.array(removed, kind)}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return run


def without_repeats(
    docs: DataFrame, *, unit: str = "line", least_words: int = LEAST_WORDS, least_run: int = LEAST_RUN, least_passage: int = LEAST_PASSAGE, key: str = "doc_id",
    spans: str = "spans",
) -> DataFrame:
    """The rows of ``docs`` with repeated units cut from ``text``, and ``spans``: what went, in original characters.

    All columns and all rows stay, also those whose text is empty afterwards. Null texts stay null, with null spans, as
    have all texts that lose nothing. Of rows that are equal one keeps its text. A column of ``docs`` that is named as ``spans`` is replaced; any
    other column keeps its values, whatever its name.
    """
    docs = docs.drop(spans)
    number, own, found = (fresh_name(docs, c) for c in ("_number", "_own", "_spans"))
    rows = numbered(docs, number)
    gone = removed_units(rows, number, unit=unit, least_words=least_words, least_passage=least_passage, key=key)
    gone = gone.select(F.col("number").alias(own), F.col("spans").alias(found))
    full = rows.join(gone, F.col(number) == F.col(own), "left").select(*(f"`{c}`" for c in docs.columns), F.col(found).alias(spans))
    schema = docs.withColumn(spans, F.lit(None).cast("array<struct<start:int,stop:int>>")).schema
    return full.mapInArrow(releasing(_removal(schema, unit, least_run, "text", spans)), schema)
