"""Vector codes against Lloyd's steps by brute force, and the cover trees' own promises."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quadrille.llm import cover_tree, vector_codes

points_of = st.lists(st.tuples(*[st.integers(-9, 9)] * 3), min_size=1, max_size=120)


@settings(max_examples=60, deadline=None)
@given(points_of, st.lists(st.tuples(*[st.integers(-12, 12)] * 3), min_size=1, max_size=9), st.sampled_from([1, 1000, 1 << 26]))
def test_trees_cover_and_assign_as_brute_force(points, entries, factor):
    points, entries = np.array(points, np.int64) * factor, np.array(entries, np.int64) * factor
    cover_tree.LEAF_POINTS, before = 2, cover_tree.LEAF_POINTS
    try:
        order, nodes = cover_tree.grow(points)
    finally:
        cover_tree.LEAF_POINTS = before
    assert sorted(order) == list(range(len(points)))
    tree = points[order]
    for node in nodes:
        own = tree[node["start"] : node["end"]]
        assert ((own - own[0]) ** 2).sum(1).max() == node["square"]
        if node["child"] >= 0:
            family = nodes[node["child"] : node["child"] + node["children"]]
            assert len(family) > 1 and family["start"][0] == node["start"] and family["end"][-1] == node["end"]
            assert (family["start"][1:] == family["end"][:-1]).all() and (family["square"] < node["square"]).all()
            centers = tree[family["start"]]
            apart = ((centers[:, None] - centers) ** 2).sum(-1)[np.triu_indices(len(family), 1)]
            assert (apart > family["square"].max()).all()
        else:
            assert node["end"] - node["start"] <= 2 or node["square"] == 0
    want = ((tree[:, None] - entries) ** 2).sum(-1).argmin(1)
    assert (cover_tree.codes(tree, nodes, entries) == want).all()
    number, total = cover_tree.sums(tree, nodes, entries)
    for k in range(len(entries)):
        assert number[k] == (want == k).sum() and (total[k] == tree[want == k].sum(0)).all()


def test_whole_subtrees_are_assigned_at_once():
    draw = np.random.default_rng(5)
    centers = draw.integers(-3000, 3000, (20, 4))
    points = np.concatenate([c + draw.integers(-9, 9, (200, 4)) for c in centers])
    order, nodes = cover_tree.grow(points)
    spans, _, single, _ = cover_tree.assigned(points[order], nodes, centers)
    assert len(single) == 0 and len(spans) < 400


def expected(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, [math.floor(scale * float(x)) for x in v], label) for i, v, label in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            used = defaultdict(list)
            for _, v, _ in kept:
                used[near(v, p)].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*used[e])] if e in used else old for e, old in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for i, v, label in kept:
        own = [near(v, p) for p in range(parts)]
        error = sum(far(cut(v, p), books[p][e]) for p, e in enumerate(own))
        by_label[label] += error
        out.append((i, "".join(f"{e:02x}" for e in own), error, label))
    return sorted(((i, c, e, by_label[x], digest) for i, c, e, x in out), key=repr)


def table(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, id long, code string, error int, slot int, points string"
    return spark.createDataFrame([(*r, 1, "c", 2, 3, "p") for r in rows], schema).repartition(5)


def vectors(n, dims=32, seed=1):
    draw = np.random.default_rng(seed)
    return [(k, [float(np.float32(x)) for x in draw.normal(0, 0.2, dims)], [None, 0, 1, 2][k % 4]) for k in range(n)]


def test_codes(spark, monkeypatch):
    hot = [float(np.float32(0.1))] * 32
    odd = [(900, None, 1), (901, [], 1), (902, [None] * 32, 1), (903, [math.nan] * 32, 1), (904, [math.inf] + [0.0] * 31, 1), (905, [0.5] * 16, 1), (906, [0.5] * 31, 1)]
    rows = vectors(300) + odd + [(1000 + k, hot, 5) for k in range(200)] + [(7, hot, 1), (7, hot, 1), (None, hot, None), (None, [-0.001] * 32, None)]
    assert sorted((tuple(r) for r in vector_codes.compressed(table(spark, rows)).collect()), key=repr) == expected(rows)


def test_blocks_smaller_than_a_task(spark):
    rows = vectors(150, 16)
    kept = vector_codes.kept_vectors(table(spark, rows)).coalesce(1)
    got = kept.mapInArrow(vector_codes._grow(256, 16, 16, 40), vector_codes._BLOCKS).selectExpr("size(ids) as n").collect()
    assert sorted(r.n for r in got) == [30, 40, 40, 40]


def test_few_and_no_vectors(spark):
    few = vectors(3, 16)
    assert sorted((tuple(r) for r in vector_codes.compressed(table(spark, few)).collect()), key=repr) == expected(few)
    alone = [(1, [0.25] * 16, None)]
    assert [tuple(r) for r in vector_codes.compressed(table(spark, alone), parts=4, entries=2, rounds=1).collect()] == expected(alone, 4, 2, 1)
    for rows in ([], [(1, None, 1), (2, [0.5] * 3, 1)]):
        got = vector_codes.compressed(table(spark, rows))
        assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_components_beyond_exact_distances_are_an_error(spark):
    with pytest.raises(Exception, match="too large for exact distances"):
        vector_codes.compressed(table(spark, [(1, [1e30] * 16, 1)])).collect()
