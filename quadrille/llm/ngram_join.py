"""N-gram Jaccard join by vertical partitioning, and the groups of near-duplicates it links.

A document's set is its distinct word n-grams (64-bit hashes). Documents link when the Jaccard similarity of their sets
reaches the threshold. Steps:

1. Every n-gram occurrence goes to the fragment of its hash. A fragment counts the documents of each n-gram and hands
   back only those in two or more; an n-gram of a single document can never be shared.
2. A document whose shared n-grams are fewer than its least possible overlap has no partner and is done. Documents
   with equal sets form one class and are represented by one of them.
3. The n-grams that are left have a global order, rarest first. Pairs that share an n-gram of both prefixes, and pass
   the length and position bounds, are candidates. First every document meets one hub for each of its prefix n-grams, the document
   whose n-grams are the most common: it lies in the middle of its group. n-grams whose documents are all connected by
   then need no more pairs. In rounds, documents outside the largest component of an n-gram meet hubs of it, twice as many in
   each round, so that one with few partners in a large group finds one without meeting all of it. The documents still
   apart meet each other. So large groups of copies cost a few rows per copy and n-gram.
4. The global order is cut into fragments. Each fragment counts the overlap of a candidate in its own part of the
   order; the parts are summed per pair, which gives the exact similarity. The rarest fragment comes first, and pairs
   that cannot reach the threshold any more go no further.

Only connectivity is asked for, so pairs inside a connected group are left out; no link between different groups is.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.components import components
from quadrille.llm.tables import fresh_name, numbered, stored, text_bytes
from quadrille.llm.words import blob, chunks, find_words, joined, mix, releasing, runs, sequence_hashes, text_buffers
from quadrille.plans.sizing import broadcast_if_small

#: Text bytes whose n-grams make up one fragment of the counting step.
FRAGMENT_BYTES = 8 << 20
#: Parts of the global order whose overlaps are counted apart.
ORDER_FRAGMENTS = 4
#: Documents of an n-gram that the others meet in the second round, and how many pairs a prefix entry may cost on average before one more round is
#: the better plan. Each round has twice as many hubs. They choose the plan, never the result.
HUBS, PAIRS_PER_ENTRY = 8, 4
NUMBER, KEY = "_number", "_doc_id"
_SPREAD = "fragment int, numbers binary, keys binary, nulls binary, sizes binary, counts binary, hashes binary"
_SHARED = "bucket int, numbers binary, keys binary, nulls binary, sizes binary, counts binary, grams binary"


def least_overlap(size, percent: int):
    """Fewest shared elements a set of that size needs to link with any other."""
    return (size * percent + 99) // 100


def distinct_ngrams(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct n-grams of every text, sorted by both."""
    words = find_words(*text_buffers(batch.column("text")))
    hashes = sequence_hashes(words.hash, width)
    docs = words.doc[: len(hashes)]
    whole = docs == words.doc[width - 1 :] if len(hashes) else np.zeros(0, bool)
    docs, hashes = docs[whole], hashes[whole]
    bounds = words.bounds()
    sizes = np.diff(bounds)
    for length in range(1, width):
        short = np.flatnonzero(sizes == length)
        if len(short):
            at = sequence_hashes(words.hash, length)[bounds[short]]
            docs, hashes = np.concatenate((docs, short)), np.concatenate((hashes, at))
    order = np.argsort(hashes)
    order = order[np.argsort(docs[order].astype(np.uint16 if len(batch) <= 65536 else np.int64), kind="stable")]
    docs, hashes = docs[order], hashes[order]
    if len(docs):
        keep = np.concatenate(([True], (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])))
        docs, hashes = docs[keep], hashes[keep]
    return docs, hashes


def order_key(hashes: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Place of n-grams in the global order: by the octave of their document count, then by 57 bits of their hash."""
    octave = np.frexp(often.astype(np.float64))[1].astype(np.int64)
    return (octave << 57) | (hashes >> np.uint64(7)).astype(np.int64)


def _by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by part number, and the bounds of the parts in it."""
    order = np.argsort(part.astype(np.uint16 if parts <= 65536 else np.int64), kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _spread(width: int, fragments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(chunks(batches)):
            numbers = batch.column(NUMBER).to_numpy(zero_copy_only=False)
            keys = batch.column(KEY).fill_null(0).to_numpy(zero_copy_only=False)
            nulls = batch.column(KEY).is_null().to_numpy(zero_copy_only=False)
            docs, hashes = distinct_ngrams(batch, width)
            sizes = np.bincount(docs, minlength=len(numbers)).astype(np.int32)
            # The documents themselves travel with one fragment, chosen by the first number.
            home = int(mix(numbers[:1].astype(np.uint64))[0] % np.uint64(fragments))
            rows = [(home, blob(numbers), blob(keys), blob(nulls), blob(sizes), None, None)]
            part = ((hashes >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
            order, bounds = _by_part(part, fragments)
            docs, hashes = docs[order], hashes[order]
            for k in range(fragments):
                a, b = bounds[k : k + 2]
                if a < b:
                    first, count = runs(docs[a:b])
                    own = docs[a:b][first]
                    rows.append((k, blob(numbers[own]), None, None, blob(sizes[own]), blob(count.astype(np.int32)), blob(hashes[a:b])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _types(_SPREAD))], names=_names(_SPREAD))

    return run


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _types(schema: str) -> list[pa.DataType]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return [kinds[x.split()[1]] for x in schema.split(", ")]


def _share(buckets: int):
    """Of one fragment: the n-grams that two or more documents have, by bucket of documents."""

    def run(table: pa.Table) -> pa.Table:
        rows = []
        # Documents on their way to their bucket.
        about = table.filter(table.column("keys").is_valid())
        numbers, keys = joined(about.column("numbers"), np.int64), joined(about.column("keys"), np.int64)
        nulls, sizes = joined(about.column("nulls"), np.bool_), joined(about.column("sizes"), np.int32)
        order, bounds = _by_part(mix(numbers.astype(np.uint64)) % np.uint64(buckets), buckets)
        for k in np.flatnonzero(np.diff(bounds)):
            own = order[bounds[k] : bounds[k + 1]]
            rows.append((k, blob(numbers[own]), blob(keys[own]), blob(nulls[own]), blob(sizes[own]), None, None))
        grams = table.filter(table.column("hashes").is_valid())
        counts = joined(grams.column("counts"), np.int32)
        hashes = joined(grams.column("hashes"), np.uint64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        again = hashes[1:] == hashes[:-1]
        kept = np.zeros(len(hashes), bool)
        kept[1:] = again
        kept[:-1] |= again
        # Most n-grams are in one document: only those of the others get their documents.
        order, hashes = order[kept], hashes[kept]
        row = np.searchsorted(np.cumsum(counts), order, side="right")
        numbers = joined(grams.column("numbers"), np.int64)[row]
        sizes = joined(grams.column("sizes"), np.int32)[row]
        often = runs(hashes)[1]
        places = order_key(hashes, np.repeat(often, often))
        order = np.argsort(numbers, kind="stable")
        numbers, sizes, places = numbers[order], sizes[order], places[order]
        first, count = runs(numbers)
        part, bounds = _by_part(mix(numbers[first].astype(np.uint64)) % np.uint64(buckets), buckets)
        starts = np.append(first, len(numbers))
        for k in np.flatnonzero(np.diff(bounds)):
            own = part[bounds[k] : bounds[k + 1]]
            at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in own])
            rows.append((k, blob(numbers[first[own]]), None, None, blob(sizes[first[own]]), blob(count[own].astype(np.int32)), blob(places[at])))
        columns = list(zip(*rows)) or [()] * 7
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _types(_SHARED))], names=_names(_SHARED))

    return run


def _gather(percent: int):
    """Of one bucket: its documents; with their shared n-grams, rarest first, where they can have a partner."""
    schema = "number long, doc_id long, size int, digest binary, grams array<long>, middle float"

    def run(table: pa.Table) -> pa.Table:
        about = table.filter(table.column("keys").is_valid())
        numbers, keys = joined(about.column("numbers"), np.int64), joined(about.column("keys"), np.int64)
        nulls, sizes = joined(about.column("nulls"), np.bool_), joined(about.column("sizes"), np.int32)
        shared = table.filter(table.column("grams").is_valid())
        counts = joined(shared.column("counts"), np.int32)
        owners = joined(shared.column("numbers"), np.int64)
        size_of = np.repeat(joined(shared.column("sizes"), np.int32), counts)
        owner = np.repeat(owners, counts)
        places = joined(shared.column("grams"), np.int64)
        _, inverse, total = np.unique(owner, return_inverse=True, return_counts=True)
        can = total[inverse] >= least_overlap(size_of, percent) if len(owner) else np.zeros(0, bool)
        owner, places = owner[can], places[can]
        order = np.lexsort((places, owner))
        owner, places = owner[order], places[order]
        first, count = runs(owner)
        found = {int(n): (a, a + c) for n, a, c in zip(owner[first], first, count)}
        often = np.ldexp(1.0, (places >> 57).astype(np.int32))
        digests, grams, middle = [], [], []
        for number, size in zip(numbers.tolist(), sizes.tolist()):
            a, b = found.get(number, (0, 0))
            grams.append(places[a:b] if b > a else None)
            middle.append(often[a:b].sum() / size if b > a else None)
            digests.append(hashlib.md5(blob(places[a:b])).digest() if b > a and b - a == size else None)
        return pa.Table.from_arrays(
            [pa.array(numbers), pa.array(keys, mask=nulls), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(grams, pa.list_(pa.int64())), pa.array(middle, pa.float32())],
            names=["number", "doc_id", "size", "digest", "grams", "middle"],
        )

    return run, schema


def shared_ngrams(docs: DataFrame, *, width: int, percent: int, key: str = "doc_id") -> DataFrame:
    """A row per document: ``number`` (of the row), doc_id, size, digest, grams, middle.

    ``grams`` has the n-grams that other documents have too, rarest first, or null where they are too few for any
    partner. ``digest`` stands for the whole set where all of it is shared. ``middle`` is the mean document count of the n-grams, by octaves:
    of similar documents, the one that most others resemble has the greatest.
    """
    pieces = max(8, text_bytes(docs) // FRAGMENT_BYTES)
    spread = docs.select(F.monotonically_increasing_id().alias(NUMBER), F.col(key).cast("long").alias(KEY), F.col("text").cast("string").alias("text")).mapInArrow(
        releasing(_spread(width, pieces)), _SPREAD
    )
    shared = spread.groupBy("fragment").applyInArrow(releasing(_share(pieces)), _SHARED)
    run, schema = _gather(percent)
    return shared.groupBy("bucket").applyInArrow(releasing(run), schema)


def candidate_filter(percent: int):
    """Length and position bounds of two prefix entries ``x_*`` and ``y_*`` of the same n-gram."""
    need = f"ceil({percent} * (x_size + y_size) / {100 + percent})"
    return F.expr(
        f"100 * least(x_size, y_size) >= {percent} * greatest(x_size, y_size) and 1 + least(x_rest, y_rest) >= {need}"
    )


def segments_of(nodes: DataFrame, fragments: int = ORDER_FRAGMENTS) -> list[DataFrame]:
    """The documents' n-grams by fragment of the global order, rarest fragment first: number, size, shared, own."""
    pivots = nodes.select(F.explode("grams").alias("gram")).agg(
        F.percentile_approx("gram", [k / fragments for k in range(1, fragments)], 1000)
    ).first()[0] or [0] * (fragments - 1)
    ends = [-1, *pivots, (1 << 63) - 1]
    own = [f"filter(grams, g -> g > {low} and g <= {high})" for low, high in zip(ends, ends[1:])]
    cut = nodes.select("number", "size", F.expr("size(grams)").alias("shared"), *(F.expr(e).alias(f"own{k}") for k, e in enumerate(own)))
    cut = stored(cut, "segments")  # a column per fragment: each is read on its own
    return [cut.select("number", "size", "shared", F.col(f"own{k}").alias("own")) for k in range(fragments)]


def verified(pairs: DataFrame, segments: list[DataFrame], percent: int) -> DataFrame:
    """Pairs ``x, y`` whose similarity reaches the threshold.

    The overlap is counted apart in every fragment of the order and summed per pair. A pair goes on to the next fragment
    only while the n-grams that are left could still make up what is missing.
    """
    found = pairs.select("x", "y")
    for k, part in enumerate(segments):
        kept = ["x", "y"] if not k else ["x", "y", "overlap", "x_left", "y_left"]
        left = part.selectExpr("number as x", "size as x_size", "shared as x_shared", "own as x_own")
        right = part.selectExpr("number as y", "size as y_size", "shared as y_shared", "own as y_own")
        both = found.select(*kept).join(left, "x").join(right, "y")
        if not k:
            both = both.selectExpr("*", "0 as overlap", "x_shared as x_left", "y_shared as y_left")
        found = both.selectExpr(
            "x", "y", "x_size", "y_size", "overlap + size(array_intersect(x_own, y_own)) as overlap",
            "x_left - size(x_own) as x_left", "y_left - size(y_own) as y_left",
        ).where(f"(overlap + least(x_left, y_left)) * {100 + percent} >= {percent} * (x_size + y_size)")
    return found.select("x", "y")


def _hub_pairs(entries: DataFrame, percent: int, hubs: int, seed: int) -> DataFrame:
    """Distinct candidates of every entry with up to ``hubs`` documents of its n-gram's largest component, if it is not in it.

    Hubs are those in the middle of their share of the component, or in every other round any of it.
    """
    salt = f"pmod(xxhash64(number, {seed}), {hubs})"
    able, rank = entries, "struct(-middle, number)"
    if seed:
        # Only of the largest component: the others are few, and one of them would meet all of its documents.
        each = entries.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("n"))
        main = each.groupBy("gram").agg(F.max(F.struct("n", F.expr("-comp").alias("low"))).alias("main"))
        main = stored(main.selectExpr("gram", "-main.low as comp"), "main")
        able = entries.join(main, ["gram", "comp"], "left_semi")
        if seed % 2 == 0:
            rank = f"xxhash64(number, {seed} + 1000)"
    chosen = stored(
        able.groupBy("gram", F.expr(salt).alias("salt"))
        .agg(F.min_by(F.struct("number", "size", "rest", "comp"), F.expr(rank)).alias("hub"))
        .selectExpr("gram", "hub.number as h", "hub.size as x_size", "hub.rest as x_rest", "hub.comp as x_comp"),
        "chosen",
    )
    return (
        entries.selectExpr("gram", "number as n", "size as y_size", "rest as y_rest", "comp as y_comp").join(chosen, "gram")
        .where("x_comp != y_comp").where(candidate_filter(percent))
        .selectExpr("least(h, n) as x", "greatest(h, n) as y").distinct()
    )


def _still_apart(entries: DataFrame, comps: DataFrame) -> DataFrame:
    """Entries of the n-grams whose documents lie in several components, with the component of each."""
    placed = stored(
        entries.drop("comp").join(comps.withColumnRenamed("node", "number"), "number", "left")
        .withColumn("comp", F.coalesce("comp", "number")),
        "placed",
    )
    apart = placed.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return placed.join(stored(apart.select("gram"), "open"), "gram", "left_semi")


def _pairs_left(entries: DataFrame) -> tuple[int, int]:
    """Entries, and pairs of entries of one n-gram in different components."""
    each = entries.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("n"))
    per = each.groupBy("gram").agg(F.sum("n").alias("n"), F.sum(F.expr("n * n")).alias("inner"))
    rows, pairs = per.agg(F.sum("n"), F.sum(F.expr("(n * n - inner) div 2"))).first()
    return rows or 0, pairs or 0


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 75, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (columns ``key`` and ``text``; others are ignored).

    Null and wordless texts have an empty set and link with nothing; texts of fewer words than ``width`` have their
    whole word sequence as one n-gram. Repeated rows and repeated ids are rows of their own. ``component_id`` is the
    smallest id in reach; rows without an id link like others, but have no id to give (null where a group has none).
    An empty table gives an empty result.
    """
    docs = stored(shared_ngrams(docs, width=width, percent=percent, key=key), "shared")
    live = docs.where("grams is not null")
    # Classes of equal sets, represented by the least row.
    same = stored(
        live.where("digest is not null").groupBy("digest").agg(F.min("number").alias("node"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "same"
    )
    member = stored(
        live.select("number", "digest").join(same, "digest", "left").selectExpr("number", "coalesce(node, number) as node"), "member"
    )
    copies = broadcast_if_small(member.where("number != node").select("number"), 16 << 20)
    nodes = stored(live.join(copies, "number", "left_anti").select("number", "size", "grams", "middle"), "nodes")
    segments = segments_of(nodes)
    # Prefix entries; n-grams of this document alone come first in the order and are counted as positions.
    prefix = f"size(grams) - cast(({percent} * size + 99) div 100 as int) + 1"
    entries = stored(
        nodes.select("number", "size", "middle", F.expr("size(grams)").alias("shared"), F.posexplode(F.expr(f"slice(grams, 1, {prefix})")).alias("at", "gram"))
        .selectExpr("gram", "number", "size", "shared - at - 1 as rest", "middle"),
        "entries",
    )
    # Hubs first: one for each n-gram, then more and more for those whose documents are still apart.
    tested, links, rest, comps = [], [], entries.withColumn("comp", F.col("number")), None
    pairs_left = None
    for seed in itertools.count():
        hubs = HUBS << seed - 1 if seed else 1
        pairs = _hub_pairs(rest, percent, hubs, seed)
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["x", "y"], "left_anti")
        pairs = stored(pairs, "hubs")
        links.append(stored(verified(pairs, segments, percent), "links"))
        tested.append(pairs)
        comps = components(reduce(DataFrame.unionByName, links).selectExpr("x as a", "y as b"))
        rest = stored(_still_apart(rest, comps), "apart")
        before, (left, pairs_left) = pairs_left, _pairs_left(rest)
        # Another round costs up to its hubs an entry: worth it while that is little beside the pairs, or while rounds save as much.
        cheap = 2 * PAIRS_PER_ENTRY * (HUBS << seed) * left < pairs_left
        if pairs_left <= PAIRS_PER_ENTRY * left or not (cheap or before is None or before - pairs_left >= left):
            break
    if left:
        x = rest.selectExpr("gram", "number as x", "size as x_size", "rest as x_rest", "comp as x_comp")
        y = rest.selectExpr("gram", "number as y", "size as y_size", "rest as y_rest", "comp as y_comp")
        pairs = (
            x.join(y, "gram").where("x < y and x_comp != y_comp").where(candidate_filter(percent)).select("x", "y").distinct()
            .join(reduce(DataFrame.unionByName, tested), ["x", "y"], "left_anti")
        )
        found = stored(verified(stored(pairs, "last"), segments, percent), "links")
        comps = components(reduce(DataFrame.unionByName, [*links, found]).selectExpr("x as a", "y as b"))
    # Members of a class share its component, which is named by its least id.
    placed = stored(
        member.join(comps, "node", "left").selectExpr("number", "coalesce(comp, node) as comp")
        .join(docs.select("number", "doc_id"), "number"), "members"
    )
    names = stored(placed.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "names")
    named = placed.join(names, "comp").select("number", "component_id", F.lit(True).alias("grouped"))
    return docs.select("number", "doc_id", F.col("size").cast("long").alias("n_shingles")).join(named, "number", "left").select(
        "doc_id", "n_shingles", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each_group(docs: DataFrame, *, width: int = 5, percent: int = 75, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their group: of near duplicates the one with the smallest id, then the smallest row number.

    Rows without an id rank last. Null and empty texts and texts without words are linked with nothing and stay. Repeated rows are copies. All columns stay,
    whatever their names.
    """
    number = fresh_name(docs, "_number")
    rows = numbered(docs, number)
    groups = near_duplicates(rows, width=width, percent=percent, key=number).selectExpr("doc_id as number", "component_id as comp")
    shared = stored(groups.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("comp"), "groups")
    ids = rows.select(F.col(number).alias("number"), F.col(f"`{key}`").alias("id"))
    members = stored(groups.join(shared, "comp", "left_semi").join(ids, "number"), "members")
    first = stored(members.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "number")).alias("first")), "first")
    gone = stored(members.join(first, "comp").where("number != first.number").select(F.col("number").alias(number)), "gone")
    return rows.join(gone, number, "left_anti").select(*(f"`{c}`" for c in docs.columns))
