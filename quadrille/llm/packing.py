"""Best-fit packing of documents into sequences of bounded length, by bin completion.

Lengths are whole numbers up to the capacity, so all that the search needs is how many pieces have each length: a
histogram of ``capacity`` numbers however large the corpus. The driver solves that; Spark counts it, ranks the
pieces of each length, and places each piece by its rank.

Bin completion (branch and bound): the largest length left opens a sequence; the undominated fillings of the rest
of it are the branches, each used as often as the counts allow, half as often, or once. A branch is pruned when
the waste so far is more than the incumbent could have had. The first incumbent is best-fit decreasing. The tree is
searched in rounds: round n allows paths that leave the first branches by n places in all, until a round leaves nothing out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.encode import encoder
from quadrille.llm.tables import stored
from quadrille.llm.words import releasing

#: Branches the search may open, over all rounds; the incumbent is returned when they are used up. Nothing else ends it. A
#: branch that is looked at and not opened counts as a sixteenth.
MOST_NODES = 20_000
#: Fillings that are tried first at each node, in all numbers of copies; all others follow.
BRANCHES = 3
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long, ids array<int>"


class Pattern(NamedTuple):
    """``copies`` sequences that hold these lengths."""

    lengths: tuple[int, ...]
    copies: int


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by the total, and by pieces over half a sequence with what cannot join them."""
    sizes = np.arange(len(counts))
    total = int((counts * sizes).sum())
    best = -(-total // capacity)
    number = np.concatenate(([0], np.cumsum(counts)))
    weight = np.concatenate(([0], np.cumsum(counts * sizes)))
    half = capacity // 2
    for small in range(0, half + 1):
        alone = number[-1] - number[capacity - small + 1]  # lengths over capacity - small
        large, large_w = number[capacity - small + 1] - number[half + 1], weight[capacity - small + 1] - weight[half + 1]
        rest = weight[half + 1] - weight[small]
        best = max(best, int(alone + large + max(0, -(-(rest - (large * capacity - large_w)) // capacity))))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing over the histogram: equal sequences are filled together."""
    open_by_rest: dict[int, Counter] = {}
    rests = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fitting = np.flatnonzero(rests[length:])
            if len(fitting):
                rest = length + int(fitting[0])
                lengths, copies = open_by_rest[rest].popitem()
                used = min(left, copies)
                if copies > used:
                    open_by_rest[rest][lengths] = copies - used
                rests[rest] = bool(open_by_rest[rest])
                each = 1
            else:
                lengths, rest = (), capacity
                each = min(left, capacity // length)
                used = left // each
            left -= used * each
            rest -= each * length
            open_by_rest.setdefault(rest, Counter())[lengths + (length,) * each] += used
            rests[rest] = rest > 0
    return [Pattern(lengths, copies) for group in open_by_rest.values() for lengths, copies in group.items()]


def _possible(lengths: tuple[int, ...], counts: np.ndarray) -> bool:
    return all(counts[x] >= n for x, n in Counter(lengths).items())


def fillings(counts: np.ndarray, rest: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``rest``, least waste first.

    The largest single length, the best pairs, the best triples with one of the largest lengths; each topped up until
    nothing fits. A filling no larger than the best single length is dominated by it and left out.
    """
    sizes = np.arange(rest + 1)
    present = np.where(counts[: rest + 1] > 0, sizes, 0)
    under = np.maximum.accumulate(present)
    if not under[rest]:
        return [()]
    single = int(under[rest])
    found = {(single,)}
    lengths = np.flatnonzero(present)
    partner = under[rest - lengths]
    sums = lengths + partner
    for k in np.argsort(-sums, kind="stable")[:8]:
        if partner[k] and sums[k] > single:
            found.add(tuple(sorted((int(lengths[k]), int(partner[k])), reverse=True)))
    for a in lengths[-16:].tolist():
        room = rest - a
        second = lengths[lengths <= room]
        third = under[room - second]
        if len(second):
            k = int(np.argmax(np.where(third > 0, second + third, 0)))
            if third[k] and a + second[k] + third[k] > single:
                found.add(tuple(sorted((a, int(second[k]), int(third[k])), reverse=True)))
    out = set()
    for filling in found:
        if _possible(filling, counts):
            left, full = counts.copy(), filling
            left[list(filling)] -= np.array([1] * len(filling)) if len(set(filling)) == len(filling) else 0
            if len(set(filling)) != len(filling):
                for x in filling:
                    left[x] -= 1
            room = rest - sum(filling)
            while room:
                more = np.flatnonzero(left[: room + 1])
                more = more[more > 0]
                if not len(more):
                    break
                x = int(more[-1])
                full, room = (*full, x), room - x
                left[x] -= 1
            out.add(tuple(sorted(full, reverse=True)))
    return sorted(out, key=lambda f: (-sum(f), len(f), f)) or [(single,)]


def _every_filling(counts: np.ndarray, rest: int) -> Iterator[tuple[int, ...] | None]:
    """One after the other, all ways to fill ``rest`` until nothing fits; None for each try that ends before that."""
    lengths = np.flatnonzero(counts[: rest + 1])[::-1].tolist()
    left = {x: int(counts[x]) for x in lengths}
    # Each entry: place in ``lengths`` of the next one to try, room, whether anything was put in.
    stack, filling = [[0, rest, False]], []
    while stack:
        at, room, some = stack[-1]
        while at < len(lengths) and (lengths[at] > room or not left[lengths[at]]):
            at += 1
        if at < len(lengths):
            stack[-1][:] = at + 1, room, True
            left[lengths[at]] -= 1
            filling.append(lengths[at])
            stack.append([at, room - lengths[at], False])
            continue
        if not some:
            yield None if any(left[x] and x <= room for x in lengths) else tuple(filling)
        stack.pop()
        if filling:
            left[filling.pop()] += 1


def _branches(counts: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Patterns with the largest length, and copies: all, half, one. First the best guesses, then all others; no copies for a vain try."""
    largest = int(np.flatnonzero(counts)[-1])
    one = counts.copy()
    one[largest] -= 1
    guessed = fillings(one, capacity - largest)

    def shares(filling: tuple[int, ...]) -> list[tuple[tuple[int, ...], int]]:
        pattern = (largest, *filling)
        most = min(int(counts[x]) // n for x, n in Counter(pattern).items())
        return [(pattern, n) for n in sorted({most, (most + 1) // 2, 1}, reverse=True)]

    first = [shares(f) for f in guessed[:BRANCHES]]
    for k in range(3):
        yield from (own[k] for own in first if k < len(own))
    for filling in guessed[BRANCHES:]:
        yield from shares(filling)
    known = set(guessed)
    for filling in _every_filling(one, capacity - largest):
        if filling is None or filling in known:
            yield (largest,), 0
        else:
            yield from shares(filling)


def bin_completion(counts: np.ndarray, capacity: int, most_nodes: int = MOST_NODES) -> list[Pattern]:
    """A packing of ``counts[length]`` pieces of each length, as patterns."""
    counts = counts.astype(np.int64).copy()
    sure = [Pattern((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    if not counts.any():
        return sure
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    incumbent = sum(p.copies for p in best)
    total = int((counts * np.arange(len(counts))).sum())
    nodes, limit, whole = 0, 0, False
    while not whole and incumbent > least and nodes < most_nodes:
        whole = True
        # Each entry: branches to come, counts left, places that may be skipped, places so far, sequences and waste so far,
        # patterns as a linked list.
        stack = [[_branches(counts, capacity), counts, limit, 0, 0, 0, None]]
        while stack and incumbent > least and nodes < most_nodes:
            branches, left, spare, place, used, waste, chosen = stack[-1]
            branch = next(branches, None)
            if branch is None:
                stack.pop()
                continue
            nodes += 1 / 16
            pattern, copies = branch
            lost = waste + copies * (capacity - sum(pattern))
            # The next incumbent must save a sequence, so it may waste no more than this.
            if not copies or lost > (incumbent - 1) * capacity - total:
                continue
            if place > spare:
                whole = False
                stack.pop()
                continue
            nodes += 15 / 16
            stack[-1][3] += 1
            after, path = left.copy(), (Pattern(pattern, copies), chosen)
            for x in pattern:
                after[x] -= copies
            if after.any():
                stack.append([_branches(after, capacity), after, spare - place, 0, used + copies, lost, path])
                continue
            incumbent, best = used + copies, []
            while path:
                best.append(path[0])
                path = path[1]
        limit += 1
    return sure + best


def _cutting(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), pc.fill_null(batch.column("text"), "")):
                ids = encode.encode(text.as_py()) + end
                n = len(ids) // 4
                start, stop = 0, n if n <= capacity else n % capacity or capacity
                piece = 0
                while start < n:
                    own = ids[4 * start : 4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(own), task, int(seen[stop - start]), np.frombuffer(own, "<i4") if with_ids else None))
                    seen[stop - start] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in _PIECES.split(", ")])

    return run


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, with_ids: bool = False, key: str = "doc_id") -> DataFrame:
    """Documents as pieces of up to ``capacity`` tokens, each document closed by ``end_id``; only longer ones are cut.

    ``task`` and ``nth`` number the pieces of one length within a task: the raw material of their ranks.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = source.mapInArrow(releasing(_cutting(tokenizer, capacity, end_id, with_ids), encoder), _PIECES)
    return stored(cut if with_ids else cut.drop("ids"), "pieces")


def _placing(table: list[tuple], capacity: int):
    """Places by length and rank. ``table``: length, first rank, sequences' base, pieces a sequence, offset inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, np.ndarray] = {}
        rows = np.array(sorted(table.value), np.int64).reshape(-1, 5)
        for length in np.unique(rows[:, 0]):
            by_length[int(length)] = rows[rows[:, 0] == length]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for own in np.unique(length):
                at = np.flatnonzero(length == own)
                plan = by_length[int(own)]
                step = plan[np.searchsorted(plan[:, 1], rank[at], side="right") - 1]
                inside = rank[at] - step[:, 1]
                sequence[at] = step[:, 2] + inside // step[:, 3]
                offset[at] = step[:, 4] + inside % step[:, 3] * own
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def placements(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """Rows length, first rank, first sequence, pieces of that length in a sequence, offset of the first one."""
    rank: Counter = Counter()
    out, base = [], 0
    for lengths, copies in patterns:
        offset = 0
        for length, n in sorted(Counter(lengths).items(), reverse=True):
            out.append((length, rank[length], base, n, offset))
            rank[length] += n * copies
            offset += n * length
        base += copies
    return out


def pack(cut: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences as the search finds, gapless from offset 0."""
    spark = cut.sparkSession
    counts = stored(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        histogram[length] = n
    plan = spark.sparkContext.broadcast(placements(bin_completion(histogram, capacity)))
    ranked = cut.join(stored(offsets, "offsets"), ["length", "task"]).withColumn("rank", F.col("_before") + F.col("nth"))
    kept = [c for c in cut.columns if c not in ("task", "nth")]
    ranked = ranked.select(*kept, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return ranked.mapInArrow(releasing(_placing(plan, capacity)), f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, with_ids: bool = False, key: str = "doc_id") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    Null texts are empty and pack as their end id alone; null and repeated ids are kept, a row of ``docs`` is a document
    of its own. An empty table gives no rows; other columns are ignored.
    """
    return pack(pieces(docs, tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids, key=key), capacity=capacity)
