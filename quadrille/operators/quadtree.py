"""Adaptive partition of the globe.

A cell is split while it holds ``tau_max`` points or more (and more than ``tau_min``). Because the number of
points never grows on the way down, one aggregation over path prefixes gives the same cells as a loop over
levels: a cell is reached when its parent was split. Levels are processed in spans, so that each shuffle
carries counts of prefixes, never points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.functions.cells import (
    DEEPEST,
    cell_parent,
    in_world,
    slots_to_path,
    with_bounds,
    with_slots,
)
from quadrille.plans.durable import pin
from quadrille.plans.ranking import dense_index
from quadrille.plans.sizing import BROADCAST_BYTES, ROW_OVERHEAD

#: Cell states (fixed values of the stored form).
STOPPED, EVALUATING, ACTIVE = 0, 1, 2

#: Levels of the first span: at most 4**10 prefixes, which a map task can aggregate in memory.
FIRST_SPAN = 10
#: Levels of each further span, below cells that are still open.
NEXT_SPAN = 5


def build_quadtree(
    points: DataFrame,
    tau_min: int,
    tau_max: int,
    *,
    last_id: int | None = None,
    max_depth: int = DEEPEST,
    first_span: int = FIRST_SPAN,
    next_span: int = NEXT_SPAN,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All cells ``(cell, depth, parent, state, n, south, north, west, east)``, the world included.

    Only points inside the half-open world with ``id <= last_id`` are counted. Cells still too full at
    ``max_depth`` are returned as EVALUATING; the default is as deep as cells go, where only points on one spot are left
    together. The result is pinned.
    """
    if not 0 <= tau_min <= tau_max:
        raise ValueError("0 <= tau_min <= tau_max is required")
    if not 1 <= max_depth <= DEEPEST:
        raise ValueError(f"max_depth must lie in 1..{DEEPEST}")
    counted = points.where(in_world())
    if last_id is not None:
        counted = counted.where(F.col("id") <= last_id)
    slots = with_slots(counted.select("latitude", "longitude"), max_depth).select("_row", "_column")

    spans: list[DataFrame] = []
    base, opened = 0, None
    while base < max_depth:
        top = min(base + (next_span if spans else first_span), max_depth)
        prefixes = _count_prefixes(slots, max_depth, base, top, opened, max_broadcast_bytes)
        span = pin(_children(prefixes, base, top, tau_min, tau_max))
        spans.append(span)
        base = top
        if top < max_depth:
            rest = span.where((F.col("depth") == top) & _splits(F.col("n"), tau_min, tau_max)).select("_row", "_column")
            remaining = rest.count()
            if remaining == 0:
                break
            opened = (rest, remaining)

    nodes = reduce(DataFrame.unionByName, spans)
    world = spans[0].where("depth = 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    world = world.select(F.lit(0).alias("depth"), F.lit(0).alias("_row"), F.lit(0).alias("_column"), "n")
    state = (
        F.when(F.col("depth") == 0, STOPPED)
        .when((F.col("n") > tau_min) & (F.col("n") < tau_max), ACTIVE)
        .when(_splits(F.col("n"), tau_min, tau_max) & (F.col("depth") == max_depth), EVALUATING)
        .otherwise(STOPPED)
    )
    return describe_cells(
        nodes.unionByName(world).select(
            slots_to_path("_row", "_column", "depth").alias("cell"), state.cast("byte").alias("state"), "n"
        )
    )


def describe_cells(nodes: DataFrame) -> DataFrame:
    """Adds everything that follows from the path to ``(cell, state, n)``."""
    return with_bounds(
        nodes.select("cell", F.length("cell").alias("depth"), cell_parent("cell").alias("parent"), "state", "n")
    )


def _splits(n: Column, tau_min: int, tau_max: int) -> Column:
    return (n > tau_min) & (n >= tau_max)


def _count_prefixes(slots, max_depth, base, top, opened, max_broadcast_bytes) -> DataFrame:
    """Points per cell at depth ``top``, below the open cells of depth ``base`` only."""

    def above(df: DataFrame, levels: int) -> list[Column]:
        return [F.shiftright(df["_row"], levels), F.shiftright(df["_column"], levels)]

    def count(df: DataFrame) -> DataFrame:
        row, column = above(df, max_depth - top)
        return df.groupBy(row.alias("_row"), column.alias("_column")).agg(F.count(F.lit(1)).alias("n"))

    if opened is None:
        return count(slots)
    cells, number = opened
    gate = cells.select(F.col("_row").alias("_r"), F.col("_column").alias("_c"))
    if number * (ROW_OVERHEAD + 16) <= max_broadcast_bytes:
        row, column = above(slots, max_depth - base)
        return count(slots.join(F.broadcast(gate), (row == gate["_r"]) & (column == gate["_c"]), "left_semi"))
    # Too many open cells to send around: aggregate first, so that a hot cell is a few thousand counts
    # before it meets the join.
    counts = count(slots)
    row, column = above(counts, top - base)
    return counts.join(gate, (row == gate["_r"]) & (column == gate["_c"]), "left_semi")


def _children(prefixes: DataFrame, base: int, top: int, tau_min: int, tau_max: int) -> DataFrame:
    """Cells of depth ``base+1 .. top`` whose parent splits, empty ones included: ``(depth, _row, _column, n)``.

    Counts are summed per parent with one column per child, so empty children need no join.
    """
    levels = prefixes.withColumn("_level", F.explode(F.sequence(F.lit(base), F.lit(top - 1))))
    parents = levels.select(
        "_level",
        F.expr(f"shiftright(_row, {top} - _level)").alias("_row"),
        F.expr(f"shiftright(_column, {top} - _level)").alias("_column"),
        F.expr(
            f"(shiftright(_row, {top - 1} - _level) & 1) * 2 + (shiftright(_column, {top - 1} - _level) & 1)"
        ).alias("_digit"),
        "n",
    )
    if base == 0:
        # The world is split before anything is counted, also when it is empty.
        nothing = prefixes.sparkSession.sql(
            "select 0 as _level, 0 as _row, 0 as _column, 0 as _digit, 0L as n"
        )
        parents = parents.unionByName(nothing)
    sums = [F.sum(F.when(F.col("_digit") == d, F.col("n")).otherwise(0)).alias(f"n{d}") for d in range(4)]
    total = F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3")
    split = parents.groupBy("_level", "_row", "_column").agg(*sums)
    split = split.where((F.col("_level") == 0) | _splits(total, tau_min, tau_max))
    four = F.array(*(F.struct(F.lit(d).alias("_digit"), F.col(f"n{d}").alias("n")) for d in range(4)))
    return split.select((F.col("_level") + 1).alias("depth"), "_row", "_column", F.inline(four)).selectExpr(
        "depth", "_row * 2 + shiftright(_digit, 1) as _row", "_column * 2 + (_digit & 1) as _column", "n"
    )


# --- reading the tree -----------------------------------------------------------------------------------


def cells_in_state(cells: DataFrame, state: int) -> DataFrame:
    return cells.where(F.col("state") == state)


def any_evaluating(cells: DataFrame) -> DataFrame:
    """One row: whether a cell is still too full."""
    return cells.agg(F.coalesce(F.bool_or(F.col("state") == EVALUATING), F.lit(False)).alias("evaluating"))


def edges(cells: DataFrame) -> DataFrame:
    return cells.where("depth > 0").select("parent", F.col("cell").alias("child"))


def children_of(cells: DataFrame, cell: str) -> DataFrame:
    return cells.where(F.col("parent") == cell)


def node(cells: DataFrame, cell: str) -> DataFrame:
    return cells.where(F.col("cell") == cell)


def active_cells(cells: DataFrame) -> DataFrame:
    """``(class_idx, cell, n)``: active cells numbered breadth first."""
    numbered = dense_index(cells_in_state(cells, ACTIVE).select("depth", "cell", "n"), ["depth", "cell"], "class_idx")
    return numbered.select(F.col("class_idx").cast("int"), "cell", "n")


def leaf_lookup(cells: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Leaves that hold points of a class, plus cells cut by the depth bound: ``(cell, class_idx, cut)``."""
    classes = active_cells(cells) if classes is None else classes
    cut = cells_in_state(cells, EVALUATING).select(
        "cell", F.lit(None).cast("int").alias("class_idx"), F.lit(True).alias("cut")
    )
    return classes.select("cell", "class_idx", F.lit(False).alias("cut")).unionByName(cut)


# --- reports --------------------------------------------------------------------------------------------


def partition_summary(cells: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row: deepest path, number of active cells, number of excluded points."""
    shape = cells.agg(
        F.max("depth").alias("max_depth"),
        F.count(F.when(F.col("state") == ACTIVE, 1)).alias("active_cells"),
    )
    return shape.withColumn("excluded_data_points", excluded.agg(F.count(F.lit(1))).scalar())


def level_report(cells: DataFrame, excluded_per_cell: DataFrame, tau_min: int, tau_max: int) -> DataFrame:
    """State of the tree before each expansion and at the end.

    ``excluded_per_cell`` is ``(cell, n)``: excluded points of all ids per sparse leaf. One row per depth;
    percentages are of the nodes so far, and of the counted points for the excluded ones.
    """
    splits = _splits(F.col("n"), tau_min, tau_max) | (F.col("depth") == 0)
    level = cells.groupBy("depth").agg(
        F.count(F.when(F.col("state") == ACTIVE, 1)).alias("active"),
        F.count(F.when(splits, 1)).alias("evaluating"),
        F.count(F.when((F.col("state") == STOPPED) & ~splits, 1)).alias("sparse"),
        F.count(F.when(splits & (F.col("state") != EVALUATING), 1)).alias("expanded"),
    )
    left_out = excluded_per_cell.groupBy(F.length("cell").alias("depth")).agg(F.sum("n").alias("left_out"))
    counted = cells.where("depth = 0").agg(F.max("n")).scalar()
    # One row per depth, thirty at most.
    upto = Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    report = (
        level.join(left_out, "depth", "left")
        .select(
            "depth",
            F.sum("active").over(upto).alias("active"),
            "evaluating",
            (F.sum("sparse").over(upto) + F.coalesce(F.sum("expanded").over(before), F.lit(0))).alias("stopped"),
            F.sum(F.coalesce("left_out", F.lit(0))).over(upto).alias("excluded"),
        )
    )
    nodes = F.col("active") + F.col("evaluating") + F.col("stopped")
    return report.select(
        "depth",
        "active",
        "evaluating",
        "stopped",
        "excluded",
        (F.lit(100.0) * F.col("active") / nodes).alias("pct_active"),
        (F.lit(100.0) * F.col("evaluating") / nodes).alias("pct_evaluating"),
        (F.lit(100.0) * F.col("stopped") / nodes).alias("pct_stopped"),
        F.try_divide(F.lit(100.0) * F.col("excluded"), counted).alias("pct_excluded"),
        trend("evaluating", "depth").alias("trend"),
    )


def trend(column: str, order: str) -> Column:
    """``up``, ``down`` or ``same`` against the previous row; the first row is compared with 0."""
    change = F.col(column) - F.coalesce(F.lag(column).over(Window.orderBy(order)), F.lit(0))
    return F.when(change > 0, "up").when(change < 0, "down").otherwise("same")


def path_length_stats(active: DataFrame) -> DataFrame:
    length = F.length("cell")
    return active.agg(
        F.count(F.lit(1)).alias("cells"), F.max(length).alias("longest"), F.avg(length).alias("mean_length")
    )


def overlapping(
    cells: DataFrame, south: float, north: float, west: float, east: float, *, pad: float = 0.0
) -> DataFrame:
    """Cells that are not entirely beyond one side of the padded window."""
    return cells.where(
        ~(
            (F.col("south") > north + pad)
            | (F.col("north") < south - pad)
            | (F.col("west") > east + pad)
            | (F.col("east") < west - pad)
        )
    )


