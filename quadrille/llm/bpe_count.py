"""Token counts of whole texts by byte-pair merging with a heap and a linked list.

The vocabulary file is of the kind that folds case, drops white space and marks word ends. A word starts as one
symbol per byte, linked to its neighbours; the adjacent pair of the lowest rank is popped from a heap and merged until
none is left. Each merge takes one symbol away, so the count is symbols minus merges and no identifier is looked up.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words, and runs between white space, whose counts a worker remembers before it starts afresh.
MOST_WORDS = 500_000
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}


def merges_made(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges a word allows, lowest rank first, leftmost first among equals."""
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    heap = []
    for k in range(len(symbols) - 1):
        rank = ranks.get((symbols[k], symbols[k + 1]))
        if rank is not None:
            heap.append((rank, k, symbols[k], symbols[k + 1]))
    heapq.heapify(heap)
    symbols, made = list(symbols), 0
    while heap:
        _, k, left, right = heapq.heappop(heap)
        other = after[k]
        if symbols[k] != left or other < 0 or symbols[other] != right:
            continue  # one of the two has been merged since
        made += 1
        symbols[k], symbols[other] = left + right, ""
        after[k] = after[other]
        if after[k] >= 0:
            before[after[k]] = k
        for a, b in ((before[k], k), (k, after[k])):
            if a >= 0 and b >= 0:
                rank = ranks.get((symbols[a], symbols[b]))
                if rank is not None:
                    heapq.heappush(heap, (rank, a, symbols[a], symbols[b]))
    return made


class _Memory(dict):
    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, key: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[key] = self.count(key)
        return value


class Counter:
    """Counts tokens as the vocabulary file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        merges = (m.split(" ") if isinstance(m, str) else m for m in rules["model"]["merges"])
        self.ranks = {(a, b): n for n, (a, b) in enumerate(merges)}
        self.suffix = rules["model"]["end_of_word_suffix"] or ""
        split = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        specials = [t["content"] for t in rules["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.specials = set(specials)
        self.words, self.runs = _Memory(self._word), _Memory(self._run)

    def _word(self, word: str) -> int:
        symbols = list(word.encode().decode("latin-1").translate(_SYMBOLS))
        symbols[-1] += self.suffix
        return len(symbols) - merges_made(symbols, self.ranks)

    def _run(self, run: str) -> int:
        """Of characters without white space: special strings are one token each, the rest is folded and cut to words."""
        total = 0
        for part in self.special.split(run) if self.special and "<" in run else (run,):
            if part in self.specials:
                total += 1
            elif part:
                # Letter by letter, so that a final sigma is folded like any other.
                folded = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                total += sum(map(self.words.__getitem__, self.pattern.findall(folded)))
        return total

    def count(self, text: str) -> int:
        parts = text.split() if not _ODD_SPACE.search(text) else [p for p in _SPACE.split(text) if p]
        return sum(map(self.runs.__getitem__, parts))


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def _counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path).count
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            tokens = [count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, path: str, *, limit: int = 2048, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: a row per row of ``docs``, in one pass without a shuffle.

    Null texts count as empty (0 bytes, 0 tokens); null and repeated ids are kept as they are; an empty table gives
    no rows; other columns are ignored. ``path`` must be readable on the workers.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = source.mapInArrow(_counting(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
