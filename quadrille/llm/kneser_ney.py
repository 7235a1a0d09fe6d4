"""Interpolated modified Kneser-Ney word model, counted in Spark and scored from memory-mapped files.

Words and word pairs are known by 64-bit hashes. Counting sends blobs of distinct hashes with their counts to the
fragment of the hash, so every fragment has an even share whatever the words are. A fragment becomes a
file in the shared folder: its hashes, sorted, and the numbers that belong to them. Scoring tasks map all files and
look hashes up by binary search; nothing of the model is held in their own memory.

The model is of order two: p(w | v) = max(c - D(c), 0) / c(v) + gamma(v) p(w), where p(w) is the same estimate over the
number of distinct words before w, interpolated with the uniform distribution over the vocabulary and one unknown word.
D has three values (counts of 1, 2, and more), estimated from the counts of counts.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm.tables import stored, text_bytes
from quadrille.llm.token_store import file_system
from quadrille.llm.words import Words, blob, chunks, find_words, joined, mix, runs, text_buffers
from quadrille.plans.durable import fresh_folder

#: Training bytes whose pairs make up one fragment.
FRAGMENT_BYTES = 16 << 20
#: Chunks of text whose counts are joined before they are sent.
CHUNKS = 12
#: Hash of the token that ends a text; no word hashes to it but by the chance of any two words.
END = np.uint64(0x5851F42D4C957F2D)
_COUNTS = "fragment int, keys binary, counts binary"
_FILES = "fragment int, file string, n long, total long"
_PAIRS = "fragment int, file string, n long, often binary, kind string, part int, ids binary, a binary, b binary, c binary, d binary"
_STATS = "fragment int, file string, n long, often binary"


def fragment_of(hashes: np.ndarray, fragments: int) -> np.ndarray:
    """Fragments are equal ranges of hashes, in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, Words]:
    """Text number and hash of every token: the words of each text and its end."""
    words = find_words(*text_buffers(batch.column("text")))
    last = words.bounds()[1:]
    docs = np.insert(words.doc, last, np.arange(words.docs))
    return docs, np.insert(words.hash, last, END), words


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(keys)
    first, _ = runs(keys[order])
    return keys[order][first], np.add.reduceat(counts[order], first) if len(first) else counts


def _rows(columns: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    parts = list(zip(*columns)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(p, kinds[t]) for p, (_, t) in zip(parts, fields)], names=[n for n, _ in fields])


def _sent(keys: np.ndarray, counts: np.ndarray, part: np.ndarray, fragments: int) -> pa.RecordBatch:
    order = np.argsort(part.astype(np.uint16 if fragments <= 65536 else np.int64), kind="stable")
    bounds = np.searchsorted(part[order], np.arange(fragments + 1))
    rows = []
    for k in np.flatnonzero(np.diff(bounds)):
        own = order[bounds[k] : bounds[k + 1]]
        rows.append((int(k), blob(keys[own]), blob(counts[own].astype(np.uint32))))
    return _rows(rows, _COUNTS)


def _counting(fragments: int, keys_of):
    """Distinct keys of some chunks with their counts, by fragment of the key's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = keys_of()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in chunks(batches):
            held.append(np.unique(find(batch), return_counts=True))
            if len(held) == CHUNKS:
                yield _flush(held)
                held = []
        if held:
            yield _flush(held)

    def _flush(held):
        keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        return _sent(keys, counts, fragment_of(mix(keys), fragments), fragments)

    return run


def write_arrays(folder: str, label: str, *arrays: np.ndarray) -> str:
    """A file of arrays, one after the other; 64 bytes apart at most. Named anew for each attempt."""
    store, path = file_system(folder)
    name = f"{label}-{uuid.uuid4().hex}.bin"
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(np.array([len(arrays), *(x for a in arrays for x in (len(a), ord(a.dtype.char)))], "<i8").tobytes())
        for array in arrays:
            out.write(array.tobytes() + bytes(-array.nbytes % 8))
    return name


def map_arrays(folder: str, name: str) -> list[np.ndarray]:
    """The arrays of a file, memory-mapped. A store that cannot be mapped is copied to an unnamed local file first."""
    store, path = file_system(folder)
    if store.type_name == "local":
        data = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:
        handle, local = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as out, store.open_input_stream(f"{path}/{name}") as source:
            while part := source.read(8 << 20):
                out.write(part)
        data = np.memmap(local, np.uint8, "r")
        os.unlink(local)
    count = int(data[:8].view("<i8")[0])
    head = data[8 : 8 + 16 * count].view("<i8").reshape(-1, 2)
    at, out = 8 + 16 * count, []
    for size, kind in head.tolist():
        kind = np.dtype(chr(kind))
        out.append(data[at : at + size * kind.itemsize].view(kind))
        at += size * kind.itemsize
        at += -at % 8
    return out


class Vocabulary(NamedTuple):
    """Word files in the order of their hashes: names, and the number of words before each (plus the total)."""

    folder: str
    files: list[str]
    bases: np.ndarray
    tokens: int

    @property
    def words(self) -> int:
        return int(self.bases[-1])


class WordFiles:
    """Mapped word files of a worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.bases = vocabulary.bases
        self.arrays = [map_arrays(vocabulary.folder, f) for f in vocabulary.files]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Number of every word, -1 for unknown ones."""
        distinct, inverse = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        part = fragment_of(mix(distinct), len(self.arrays))
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(len(self.arrays) + 1))
        for k, (keys, *_) in enumerate(self.arrays):
            own = order[bounds[k] : bounds[k + 1]]
            if len(own) and len(keys):
                place = np.minimum(np.searchsorted(keys, distinct[own]), len(keys) - 1)
                hit = keys[place] == distinct[own]
                out[own[hit]] = self.bases[k] + place[hit]
        return out[inverse]


def gather(arrays: list[np.ndarray], bases: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Values by word number out of arrays that follow each other."""
    order = np.argsort(ids)
    ordered = ids[order]
    out = np.empty(len(ids), np.result_type(*{a.dtype for a in arrays}))
    bounds = np.searchsorted(ordered, bases)
    for k, array in enumerate(arrays):
        a, b = bounds[k], bounds[k + 1]
        if a < b:
            out[order[a:b]] = array[ordered[a:b] - bases[k]]
    return out


def _write_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        keys, counts = _summed(joined(table.column("keys"), np.uint64), joined(table.column("counts"), np.uint32).astype(np.int64))
        k = table.column("fragment")[0].as_py()
        return pa.Table.from_batches([_rows([(k, write_arrays(folder, f"words-{k}", keys, counts), len(keys), int(counts.sum()))], _FILES)])

    return run


def count_words(docs: DataFrame, folder: str, fragments: int) -> Vocabulary:
    """All distinct tokens of ``docs`` with their counts, as word files."""
    counted = docs.mapInArrow(_counting(fragments, lambda: lambda batch: tokens(batch)[1]), _COUNTS)
    files = stored(counted.groupBy("fragment").applyInArrow(_write_words(folder), _FILES), "words")
    rows = {r.fragment: r for r in files.collect()}  # a row per fragment
    empty = write_arrays(folder, "words-none", np.zeros(0, np.uint64), np.zeros(0, np.int64))
    names = [rows[k].file if k in rows else empty for k in range(fragments)]
    sizes = [rows[k].n if k in rows else 0 for k in range(fragments)]
    return Vocabulary(folder, names, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), sum(r.total for r in rows.values()))


def _pair_keys(words: WordFiles, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, number of the word before (the vocabulary's size at a start) and of the word, for every token."""
    docs, hashes, _ = tokens(batch)
    ids = words.ids(hashes)
    before = np.concatenate(([0], ids[:-1])) if len(ids) else ids
    start = np.concatenate(([True], docs[1:] != docs[:-1])) if len(docs) else np.zeros(0, bool)
    return docs, np.where(start, words.bases[-1], before), ids


def _pairs(vocabulary: Vocabulary):
    def keys_of():
        words = WordFiles(vocabulary)

        def find(batch: pa.RecordBatch) -> np.ndarray:
            _, before, ids = _pair_keys(words, batch)
            return (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)

        return find

    return keys_of


def _small(values: np.ndarray) -> np.ndarray:
    """In the fewest bytes that hold them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _often(counts: np.ndarray) -> bytes:
    """How many counts are 1, 2, 3, 4."""
    return blob(np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64))


def _write_pairs(folder: str, bases: np.ndarray):
    """File of the pairs of a fragment, and its share in the numbers of each word, by vocabulary fragment."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = _summed(joined(table.column("keys"), np.uint64), joined(table.column("counts"), np.uint32).astype(np.int64))
        k = table.column("fragment")[0].as_py()
        hashes = mix(keys)
        order = np.argsort(hashes)
        name = write_arrays(folder, f"pairs-{k}", hashes[order], _small(counts[order]))
        rows = [(k, name, len(keys), _often(counts), "pairs", None, None, None, None, None, None)]
        before, after = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first, _ = runs(before)  # keys are in order, so equal words before stand together
        stats = [np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts > 2)]
        for part, a, b in _parts(before[first], bases):
            rows.append((k, None, 0, None, "before", part, blob(before[first][a:b].astype(np.uint32)), *(blob(x[a:b].astype(np.uint32)) for x in stats)))
        ids, times = np.unique(after, return_counts=True)
        for part, a, b in _parts(ids, bases):
            rows.append((k, None, 0, None, "after", part, blob(ids[a:b].astype(np.uint32)), blob(times[a:b].astype(np.uint32)), None, None, None))
        return pa.Table.from_batches([_rows(rows, _PAIRS)])

    return run


def _parts(ids: np.ndarray, bases: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Ranges of ordered word numbers by vocabulary fragment; the start of a text belongs to the last."""
    bounds = np.searchsorted(ids, bases)
    bounds[-1] = len(ids)
    for k in range(len(bases) - 1):
        if bounds[k] < bounds[k + 1]:
            yield k, int(bounds[k]), int(bounds[k + 1])


def discounts(often: np.ndarray) -> np.ndarray:
    """D by count (0, 1, 2, 3 and more) from the numbers of things seen once to four times; between 0 and the count."""
    n1, n2, n3, n4 = (float(x) for x in often)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    ratio = lambda a, b: a / b if b else 0.0
    found = [0.0, 1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3)]
    return np.array([min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(found)])


def _write_stats(folder: str, bases: np.ndarray, discount: np.ndarray):
    """Per word of a vocabulary fragment: its count as a word before, the weight it leaves to the lower order, and how many
    distinct words stand before it."""

    def run(table: pa.Table) -> pa.Table:
        k = table.column("part")[0].as_py()
        size = int(bases[k + 1] - bases[k]) + (k == len(bases) - 2)
        total, left, prior = np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
        for kind in ("before", "after"):
            own = table.filter(pc.equal(table.column("kind"), kind))
            ids = joined(own.column("ids"), np.uint32).astype(np.int64) - bases[k]
            a, b, c, d = (joined(own.column(n), np.uint32).astype(np.float64) for n in "abcd")
            if kind == "after":
                np.add.at(prior, ids, a.astype(np.int64))
            else:
                total += np.bincount(ids, a, minlength=size)
                left += np.bincount(ids, discount[1] * b + discount[2] * c + discount[3] * d, minlength=size)
        gamma = np.divide(left, total, out=np.ones(size), where=total > 0)
        name = write_arrays(folder, f"stats-{k}", total.astype(np.int64), gamma, _small(prior))
        return pa.Table.from_batches([_rows([(k, name, int(prior.sum()), _often(prior))], _STATS)])

    return run


class KneserNey(NamedTuple):
    """A trained model: file names and a few numbers."""

    vocabulary: Vocabulary
    pair_files: list[str]
    stat_files: list[str]
    pair_discount: np.ndarray
    word_discount: np.ndarray
    pair_kinds: int
    word_weight: float


def train(docs: DataFrame, *, folder: str | None = None) -> KneserNey:
    """Counts ``docs`` (column ``text``; null: empty) and writes the model's files to the shared folder."""
    spark: SparkSession = docs.sparkSession
    folder = folder or fresh_folder(spark, "language-model")
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    docs = docs.select(F.col("text").cast("string").alias("text"))
    fragments = max(8, text_bytes(docs) // FRAGMENT_BYTES)
    vocabulary = count_words(docs, folder, fragments)
    counted = docs.mapInArrow(_counting(fragments, _pairs(vocabulary)), _COUNTS)
    shared = stored(counted.groupBy("fragment").applyInArrow(_write_pairs(folder, vocabulary.bases), _PAIRS), "pairs")
    pairs = {r.fragment: r for r in shared.where("kind = 'pairs'").select("fragment", "file", "n", "often").collect()}  # a row per fragment
    often = sum((np.frombuffer(r.often, np.int64) for r in pairs.values()), np.zeros(4, np.int64))
    pair_discount = discounts(often)
    stats = shared.where("kind != 'pairs'").groupBy("part").applyInArrow(_write_stats(folder, vocabulary.bases, pair_discount), _STATS)
    stats = {r.fragment: r for r in stored(stats, "stats").collect()}
    word_often = sum((np.frombuffer(r.often, np.int64) for r in stats.values()), np.zeros(4, np.int64))
    word_discount = discounts(word_often)
    kinds = sum(r.n for r in pairs.values())
    # What words with each number of predecessors leave to the uniform distribution.
    n1, n2 = word_often[:2]
    left = word_discount[1] * n1 + word_discount[2] * n2 + word_discount[3] * (vocabulary.words - n1 - n2)
    sizes = np.diff(vocabulary.bases) + (np.arange(fragments) == fragments - 1)
    none = write_arrays(folder, "pairs-none", np.zeros(0, np.uint64), np.zeros(0, np.uint8))
    blank = lambda n: write_arrays(folder, "stats-none", np.zeros(n, np.int64), np.ones(n), np.zeros(n, np.uint8))
    return KneserNey(
        vocabulary,
        [pairs[k].file if k in pairs else none for k in range(fragments)],
        [stats[k].file if k in stats else blank(int(sizes[k])) for k in range(fragments)],
        pair_discount,
        word_discount,
        kinds,
        left / kinds if kinds else 1.0,
    )


class Scorer:
    """The mapped model of a worker."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.words = WordFiles(model.vocabulary)
        folder = model.vocabulary.folder
        self.pairs = [map_arrays(folder, f) for f in model.pair_files]
        stats = [map_arrays(folder, f) for f in model.stat_files]
        self.total, self.gamma, self.prior = ([s[k] for s in stats] for k in range(3))
        self.counts = [a[1] for a in self.words.arrays]
        self.bases = model.vocabulary.bases
        self.stat_bases = np.append(self.bases[:-1], self.bases[-1] + 1)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        hashes = mix(keys)
        order = np.argsort(hashes)
        ordered = hashes[order]
        bounds = np.searchsorted(fragment_of(ordered, len(self.pairs)), np.arange(len(self.pairs) + 1))
        out = np.zeros(len(keys), np.int64)
        for k, (stored_keys, counts) in enumerate(self.pairs):
            a, b = bounds[k], bounds[k + 1]
            if a < b and len(stored_keys):
                place = np.minimum(np.searchsorted(stored_keys, ordered[a:b]), len(stored_keys) - 1)
                hit = stored_keys[place] == ordered[a:b]
                out[order[a:b][hit]] = counts[place[hit]]
        return out

    def score(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """Tokens, known tokens, base and model log10 probability of every text."""
        docs, before, ids = _pair_keys(self.words, batch)
        vocabulary, model = self.model.vocabulary, self.model
        n, size = vocabulary.tokens, vocabulary.words
        known = ids >= 0
        count, prior = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        count[known] = gather(self.counts, self.bases, ids[known])
        prior[known] = gather(self.prior, self.stat_bases, ids[known])
        base = np.log10((count + 0.5) / (n + 0.5 * (size + 1)))
        lower = model.word_weight / (size + 1)
        if model.pair_kinds:
            lower = lower + np.maximum(prior - model.word_discount[np.minimum(prior, 3)], 0) / model.pair_kinds
        lower = np.broadcast_to(lower, len(ids))
        total, gamma = np.zeros(len(ids), np.int64), np.ones(len(ids))
        led = before >= 0
        total[led], gamma[led] = gather(self.total, self.stat_bases, before[led]), gather(self.gamma, self.stat_bases, before[led])
        pair = np.zeros(len(ids), np.int64)
        both = known & (total > 0)
        pair[both] = self.pair_counts((before[both].astype(np.uint64) << np.uint64(32)) | ids[both].astype(np.uint64))
        seen = np.maximum(pair - model.pair_discount[np.minimum(pair, 3)], 0) / np.maximum(total, 1)
        value = np.log10(seen + np.where(total > 0, gamma, 1.0) * lower)
        rows = len(batch)
        return [np.bincount(docs, minlength=rows), np.bincount(docs, known, minlength=rows).astype(np.int64), np.bincount(docs, base, minlength=rows), np.bincount(docs, value, minlength=rows)]


def _scoring(model: KneserNey):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in chunks(batches):
            found = scorer.score(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *map(pa.array, found)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def language_scores(docs: DataFrame, *, parts: int = 5, held: int = 1, key: str = "doc_id") -> DataFrame:
    """Learns from the rows whose crc32(id as text) modulo ``parts`` is not ``held`` and scores all of them.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10). Null texts are empty: the end
    alone is their token. A null id counts as an empty text in the checksum. Repeated ids are rows of their own;
    an empty table gives no rows; without training rows every token is unknown. Other columns are ignored.
    """
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts == held
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held_out)
    model = train(docs.where("not held_out"))
    scored = docs.mapInArrow(_scoring(model), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score")
