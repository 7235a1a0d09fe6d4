"""Cover trees over the integer points of one block, and Lloyd's steps that use them.

A tree is a list of nodes, level after level. A node is a range of the points in tree order; the first point of the range is its
center, and all of them are within its radius. Its children have centers from its range that cover it at a power
of two below its radius, its own center first; centers of one family are further apart than that. Radii are the true ones.
Sums over a range are differences of running sums.
"""

from __future__ import annotations

import numpy as np

#: Nodes of no more points are not split.
LEAF_POINTS = 16
#: Points whose distances to all entries are held at once.
_AT_ONCE = 4096

NODE = np.dtype([("start", np.int32), ("end", np.int32), ("square", np.int64), ("child", np.int32), ("children", np.int32)])


def grow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the points in the tree, and its nodes; ``points`` are rows of int64."""
    n = len(points)
    order = np.arange(n, dtype=np.int32)
    first = np.zeros(1, NODE)
    first["end"], first["child"] = n, -1
    first["square"] = _squares(points, points[:1]).max(initial=0)
    levels, made = [first], 1
    while True:
        nodes = levels[-1]
        split = np.flatnonzero((nodes["end"] - nodes["start"] > LEAF_POINTS) & (nodes["square"] > 0))
        if not len(split):
            return order, np.concatenate(levels)
        children = _cover(points, order, nodes[split])
        owner = np.searchsorted(nodes["start"][split], children["start"], side="right") - 1
        nodes["children"][split] = np.bincount(owner, minlength=len(split))
        nodes["child"][split] = made + np.searchsorted(owner, np.arange(len(split)))
        made += len(children)
        levels.append(children)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def _cover(points: np.ndarray, order: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The children of all ``nodes``; sorts their ranges of ``order`` so that children are ranges. One round adds a child to every
    node that still has points beyond its children."""
    sizes = nodes["end"] - nodes["start"]
    place = np.repeat(nodes["start"] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum(), dtype=np.int32)
    # The square of the largest power of two below the radius; 0 for a radius of 1, so that equal points alone are covered.
    level = np.frexp(np.sqrt(nodes["square"].astype(np.float64)) * (1 - 1e-12))[1] - 1
    scale = np.left_shift(np.int64(1), 2 * level.clip(0).astype(np.int64))
    scale = np.where(scale < nodes["square"], scale, nodes["square"] // 4)
    node = np.repeat(np.arange(len(nodes)), sizes)
    child, square = np.zeros(len(place), np.int32), np.zeros(len(place), np.int64)
    left, turn = np.arange(len(place)), 0
    while len(left):
        heads = np.flatnonzero(np.concatenate(([True], node[left][1:] != node[left][:-1])))
        center = np.repeat(order[place[left[heads]]], np.diff(np.append(heads, len(left))))
        far = _squares(points[order[place[left]]], points[center])
        near = far <= scale[node[left]]
        child[left[near]], square[left[near]] = turn, far[near]
        left, turn = left[~near], turn + 1
    sort = np.lexsort((child, node))
    order[place] = order[place[sort]]
    node, child, square = node[sort], child[sort], square[sort]
    at = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (child[1:] != child[:-1]))))
    made = np.zeros(len(at), NODE)
    made["start"] = place[at]
    made["end"] = made["start"] + np.diff(np.append(at, len(node)))
    made["square"], made["child"] = np.maximum.reduceat(square, at), -1
    return made


def _nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (the lower index of equal ones), its squared distance, and that of the next one."""
    best, square, other = (np.empty(len(points), np.int64) for _ in range(3))
    for at in range(0, len(points), _AT_ONCE):
        far = _squares(points[at : at + _AT_ONCE, None, :], entries)
        rows, own = np.arange(len(far)), far.argmin(axis=1)
        best[at : at + _AT_ONCE], square[at : at + _AT_ONCE] = own, far[rows, own]
        far[rows, own] = np.iinfo(np.int64).max
        other[at : at + _AT_ONCE] = far.min(axis=1)
    return best, square, other


def assigned(points: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranges whose points all have one nearest entry, and that entry; single points, and theirs. ``points`` are in tree order.

    If the center's next entry is further than its nearest by more than twice the radius, no point of the node can have
    another one. Equal points have equal entries. Ambiguous nodes give way to their children; points of ambiguous nodes without
    children are compared themselves. The margin allows for the rounding of square roots.
    """
    at, ranges, owners, loose = np.zeros(min(1, len(points)), np.int64), [], [], []
    while len(at):
        own = nodes[at]
        best, square, other = _nearest(points[own["start"]], entries)
        gap = np.sqrt(other.astype(np.float64)) - np.sqrt(square.astype(np.float64))
        clear = (own["square"] == 0) | (gap > 2 * np.sqrt(own["square"].astype(np.float64)) + 1e-9 * np.sqrt(other.astype(np.float64)) + 1e-9)
        if len(entries) == 1:
            clear[:] = True
        ranges.append(np.stack([own["start"][clear], own["end"][clear]], axis=1))
        owners.append(best[clear])
        open_ = own[~clear]
        leaf = open_["child"] < 0
        loose.append(_spread(open_["start"][leaf], open_["end"][leaf] - open_["start"][leaf]))
        at = _spread(open_["child"][~leaf], open_["children"][~leaf])
    single = np.concatenate([np.zeros(0, np.int64), *loose])
    spans = np.concatenate([np.zeros((0, 2), np.int64), *ranges])
    return spans, np.concatenate([np.zeros(0, np.int64), *owners]), single, _nearest(points[single], entries)[0]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers ``first .. first + count - 1``."""
    total = np.cumsum(count, dtype=np.int64)
    return np.repeat(first - total + count, count) + np.arange(total[-1] if len(total) else 0)


def sums(points: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many points each entry has, and the sums of their components; whole ranges by running sums."""
    spans, owners, single, own = assigned(points, nodes, entries)
    running = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points, axis=0, out=running[1:])
    number, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    np.add.at(number, owners, spans[:, 1] - spans[:, 0])
    np.add.at(total, owners, running[spans[:, 1]] - running[spans[:, 0]])
    np.add.at(number, own, 1)
    np.add.at(total, own, points[single])
    return number, total


def codes(points: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of every point in tree order."""
    spans, owners, single, own = assigned(points, nodes, entries)
    out = np.zeros(len(points), np.int64)
    out[_spread(spans[:, 0], spans[:, 1] - spans[:, 0])] = np.repeat(owners, spans[:, 1] - spans[:, 0])
    out[single] = own
    return out
