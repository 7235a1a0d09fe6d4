"""The Merkle manifest against a plain tree in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quadrille.llm import merkle

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(level, fanout):
    """The last node over ``level``, and for each entry the siblings before and after, level by level."""
    steps, members = [[] for _ in level], [[k] for k in range(len(level))]
    while len(level) > 1:
        up, below = [], []
        for at in range(0, len(level), fanout):
            run = level[at : at + fanout]
            for j, own in enumerate(members[at : at + fanout]):
                for k in own:
                    steps[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h(*run))
            below.append([k for own in members[at : at + fanout] for k in own])
        level, members = up, below
    return level[0], steps


def expected(rows, fanout):
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [grown([leaf(r) for r in sources[n]], fanout) for n in names]
    root, over = grown([sub for sub, _ in trees], fanout)
    out = []
    for name, (sub, steps), top in zip(names, trees, over):
        for r, own in zip(sources[name], steps):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf((*r[:4], None if r[4] is None else r[4].translate(LOWER))) if changed else leaf(r)
            for before, after in own + top:
                node = h(before, node, after)
            out.append((r[0], leaf(r), sub, root, h(*(b + a for b, a in own + top)), node, node == root))
    return sorted(out, key=repr)


ROWS = [
    (1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "abd"), (None, "a", None, None, None), (None, "a", None, None, None), (2, "a", "", 0, ""),
    (3, None, "de", 9, "Grüße 日本 🙂"), (5, "é", "fr", 1, "É"), (6, "z", "fr", 1, "LONG " * 40_000), (7, "=", "x", 1, "-"), (8, "-", "x", 1, "-"), (9, "", "x", 1, "Q"),
    *((100 + k, "hot", "en", k, f"Text {k}") for k in range(300)), *((1000 + k, "run", "en", k, f"T {k}") for k in range(17)),
    *((2000 + k, f"s{k}", "en", k, f"One {k}") for k in range(20)), *((3000, "same", "en", 1, "Same") for _ in range(20)),
]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    more = "tree string, rank int, n int, lo int, family string, leaf string, steps int, row int"
    return spark.createDataFrame([(*r, "t", 1, 2, 3, "f", "l", 4, 5) for r in ROWS], f"{SCHEMA}, {more}").repartition(5)


@pytest.mark.parametrize("fanout", [2, 16])
def test_proofs(docs, fanout):
    got = sorted((tuple(r) for r in merkle.audited(docs, fanout=fanout).collect()), key=repr)
    assert got == expected(ROWS, fanout)
    assert {r[-1] for r in got} == {True, False}


def test_small_tables(spark):
    for rows in ([], ROWS[:1], ROWS[:2], ROWS[6:8]):
        got = merkle.audited(spark.createDataFrame(rows, SCHEMA))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == (expected(rows, 16) if rows else [])


def test_nodes_are_nested_intervals(docs):
    made = merkle.manifest(docs)
    got = merkle.nodes(made).collect()
    hot = sorted((r.level, r.lo, r.hi) for r in got if r.source == "hot")
    assert hot == [(1, k, min(k + 16, 300)) for k in range(0, 300, 16)] + [(2, 0, 256), (2, 256, 300), (3, 0, 300)]
    assert not [r for r in got if r.source == "é"] and [r.hi for r in got if r.source == "run" and r.level == 2] == [17]
    sources = len({r[1] for r in ROWS})
    assert max(r.hi for r in got if r.over_sources) == sources
    root = {r.root for r in merkle.proofs(made).select(F.lower(F.hex("root")).alias("root")).collect()}
    assert root == {r.digest for r in got if r.over_sources and (r.lo, r.hi) == (0, sources)}


def test_a_changed_column_breaks_the_proof(docs):
    made = merkle.manifest(docs, tampered=F.col("source") == "z")
    told = merkle.proofs(made).select("doc_id", (merkle.folded(F.lower(F.hex(F.coalesce("changed", "leaf")))) == F.lower(F.hex("root"))).alias("good"))
    assert {r.doc_id for r in told.where("not good").collect()} == {6}
    with pytest.raises(ValueError):
        merkle.manifest(docs, fanout=1)
