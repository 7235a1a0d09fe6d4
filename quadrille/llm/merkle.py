"""Merkle manifest of a data set: a tree of digests per source, one over the sources, and a proof for every document.

H is the lowercase hex sha256 of its inputs, one after the other. A leaf is H of ``doc_id, source, lang, n_chars, text``, each ``-``
where it is null, else its number of UTF-8 bytes, ``:`` and the value. The leaves of a source ascend by doc_id (nulls first;
rows with one id by their leaf); every ``fanout`` neighbours become their H, again and again, until one node is left, the
subroot. A lone leaf is its subroot. Subroots in order of their source (null first, then bytewise) become the root likewise.

Nodes are labelled by nested intervals: a node of level k covers the ranks ``[lo, hi)`` of its source's leaves, ``fanout ** k`` of
them or the rest. An ancestor is found by a containment join: both sides have the bucket ``lo div width`` of one level, and
the interval of the one lies in that of the other. The siblings of a node are what its parent's family holds outside the
node's own interval, left and right of it. Going down from the root, a node takes over the steps of its parent and puts its
own in front; a key of such a join is one parent and its ``fanout`` children, however large a source is.

Repeated rows are leaves of their own. Null and empty texts have leaves like others; an empty table has no rows. Columns beside
the five are left out, whatever their names. Sources and ids are ranked by one range sort; leaves are 32 bytes while they move.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.tables import stored
from quadrille.plans.ranking import rank_within

#: Children of a node.
FANOUT = 16
#: One of so many documents, by the crc32 of the decimal id, is tampered with by ``audited``.
TAMPERED = 5
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALL = "sources"


class Manifest(NamedTuple):
    """Levels of the trees of all sources, from the runs of leaves upwards, and of the tree over the sources."""

    sources: list[DataFrame]
    top: list[DataFrame]
    fanout: int


def leaf_digest(**changed: Column) -> Column:
    """The leaf of a row, as 32 bytes; columns can be replaced by name."""
    parts = []
    for name in _FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _tree(source: str = "source") -> Column:
    """A text that is never null and sorts as sources do."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))


def _h(family: str) -> str:
    return f"unhex(sha2(array_join(transform({family}, _x -> lower(hex(_x.digest))), ''), 256))"


def _climb(ranked: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels over ``tree, rank, rank_of, digest, payload``: ``tree, n, lo, hi, family, digest``, each stored.

    The family of a node are its children in order, of the first level with their payload. A tree with one leaf has one node, which
    has the leaf's digest.
    """
    runs = (
        ranked.groupBy("tree", F.col("rank_of").alias("n"), F.expr(f"rank div {fanout} * {fanout}").alias("lo"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "payload"))).alias("family"))
        .select("tree", "n", "lo", F.expr(f"least(lo + {fanout}, n)").alias("hi"), "family", F.expr(f"if(n = 1, family[0].digest, {_h('family')})").alias("digest"))
    )
    levels = [stored(runs, "runs")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    width = fanout
    while width < most:
        families = (
            levels[-1].where(F.col("n") > width)
            .groupBy("tree", "n", F.expr(f"lo div {width * fanout} * {width * fanout}").alias("start"))
            .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("family"))
        )
        width *= fanout
        levels.append(stored(families.select("tree", "n", F.col("start").alias("lo"), F.expr(f"least(start + {width}, n)").alias("hi"), "family", F.expr(_h("family")).alias("digest")), "nodes"))
    return levels


def _is_top(level: int, fanout: int) -> Column:
    """Whether a node of the level (from 0) is the only one of its tree there."""
    least = fanout**level if level else 0
    return (F.col("n") > least) & (F.col("n") <= fanout ** (level + 1))


def _tops(levels: list[DataFrame], fanout: int) -> DataFrame:
    parts = [df.where(_is_top(k, fanout)).select("tree", "digest") for k, df in enumerate(levels)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _step(family: str, lo: str, hi: str) -> str:
    """What a family holds outside ``[lo, hi)``: the digests left of it and right of it."""
    side = f"array_join(transform(filter({family}, _x -> {{}}), _x -> lower(hex(_x.digest))), '')"
    return f"struct({side.format(f'_x.hi <= {lo}')} as before, {side.format(f'_x.lo >= {hi}')} as after)"


def _descend(levels: list[DataFrame], seeds: DataFrame, fanout: int) -> DataFrame:
    """A row per leaf: ``tree, digest, payload``, ``steps`` from the leaf to where its tree's seed ends, and the seed's other columns.

    ``seeds`` has a row per tree, with the ``steps`` above its top node.
    """
    carried = [c for c in seeds.columns if c != "tree"]
    above = None
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k]
        reached = own.where(_is_top(k, fanout)).join(seeds, "tree").select(*own.columns, *carried)
        if above is not None:
            width = fanout ** (k + 2)
            parents = above.select(*(F.col(c).alias(f"p_{c}") for c in ("tree", "lo", "hi", "family")), *carried)
            bucket = F.expr(f"lo div {width} = p_lo div {width}")
            inside = (F.col("tree") == F.col("p_tree")) & bucket & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            met = own.where(F.col("n") > fanout ** (k + 1)).join(parents, inside)
            steps = F.expr(f"concat(array({_step('p_family', 'lo', 'hi')}), steps)").alias("steps")
            reached = reached.unionByName(met.select(*own.columns, *(steps if c == "steps" else c for c in carried)))
        above = reached
    rest = [c for c in carried if c != "steps"]
    leaves = above.select("tree", "n", "family", "steps", *rest, F.explode("family").alias("leaf"))
    steps = F.expr(f"if(n = 1, steps, concat(array({_step('family', 'leaf.lo', 'leaf.hi')}), steps))").alias("steps")
    return leaves.select("tree", "leaf.digest", "leaf.payload", steps, *rest)


def manifest(docs: DataFrame, *, fanout: int = FANOUT, tampered: Column | None = None) -> Manifest:
    """Both layers of the tree over ``docs``. Where the condition ``tampered`` holds, the leaf of the lower-cased text goes along."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    lower = leaf_digest(text=F.translate(F.col("text").cast("string"), _UPPER, _LOWER))
    leaves = docs.select(
        _tree().alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"),
        F.when(F.lit(False) if tampered is None else tampered, lower).alias("changed"), F.monotonically_increasing_id().alias("row"),
    )
    ranked = rank_within(stored(leaves, "leaves"), "tree", ["doc_id", "digest", "row"])
    sources = _climb(ranked.select("tree", "rank", "rank_of", "digest", F.struct("doc_id", "changed").alias("payload")), fanout)
    tops = _tops(sources, fanout).select(F.lit(_ALL).alias("all"), "tree", "digest")
    over = rank_within(stored(tops, "subroots"), "all", ["tree"])
    top = _climb(over.select(F.col("all").alias("tree"), "rank", "rank_of", "digest", F.struct("tree").alias("payload")), fanout)
    return Manifest(sources, top, fanout)


def nodes(made: Manifest) -> DataFrame:
    """``source, level, lo, hi, digest``: the nodes above the leaves with their intervals; the levels of the tree over all sources
    go on above those of the highest source, with ``source`` null and ``over_sources`` true."""
    out = None
    for over, levels in ((False, made.sources), (True, made.top)):
        for k, df in enumerate(levels):
            source = F.lit(None).cast("string") if over else F.when(F.col("tree") != "-", F.substr("tree", F.lit(2)))
            level = F.lit(k + 1 + (len(made.sources) if over else 0))
            part = df.where("n > 1").select(source.alias("source"), F.lit(over).alias("over_sources"), level.alias("level"), "lo", "hi", F.lower(F.hex("digest")).alias("digest"))
            out = part if out is None else out.unionByName(part)
    return out


def proofs(made: Manifest) -> DataFrame:
    """A row per document: ``doc_id, leaf, changed, subroot, root`` as 32 bytes each, and ``steps``, the siblings before and after each
    node of its way to the root, as hex texts."""
    nothing = F.expr("cast(array() as array<struct<before:string,after:string>>)")
    root = _tops(made.top, made.fanout).select("tree", nothing.alias("steps"), F.col("digest").alias("root"))
    seeds = _descend(made.top, root, made.fanout).select(F.col("payload.tree").alias("tree"), "steps", F.col("digest").alias("subroot"), "root")
    # A row per source, read by every level below.
    seeds = stored(seeds, "seeds")
    rows = _descend(made.sources, seeds, made.fanout)
    return rows.select("payload.doc_id", F.col("digest").alias("leaf"), "payload.changed", "subroot", "root", "steps")


def folded(leaf: Column, steps: str = "steps") -> Column:
    """The root that a leaf (hex text) and the siblings on its way give."""
    return F.aggregate(steps, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def audited(docs: DataFrame, *, fanout: int = FANOUT) -> DataFrame:
    """The proof of every document, checked with the leaf of a tampered text where the crc32 of the decimal id is divisible by 5."""
    changed = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % TAMPERED == 0
    rows = proofs(manifest(docs, fanout=fanout, tampered=changed))
    text = lambda c: F.lower(F.hex(c))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), "")
    told = rows.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
        folded(text(F.coalesce("changed", "leaf"))).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
