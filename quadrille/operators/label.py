"""Labels: the enclosing cell of every point, one-hot and distance-smoothed class weights."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.functions.cells import (
    curve_place,
    in_world,
    path_key,
    single_sql,
    slot_key,
    with_bounds,
    with_slots,
)
from quadrille.functions.geo import (
    GREAT_CIRCLE_RADIUS_KM,
    angle_cosine_of_parts_sql,
    great_circle_of_parts_sql,
    great_circle_parts_sql,
    normal_pdf,
)
from quadrille.operators.points import in_box
from quadrille.operators.squares import codes, packed_rows, pairs_within, smoothed_within, square_index, unpacked
from quadrille.plans.asof import asof_backward
from quadrille.plans.durable import pin
from quadrille.plans.salting import neighbours, salted_join
from quadrille.plans.sizing import BROADCAST_BYTES, ROW_OVERHEAD, fits_broadcast

#: Standard deviation of the smoothing weight, km.
SMOOTHING_STD_KM = 20.0
#: Beyond this distance the FLOAT weight for the standard deviation above is exactly zero.
SMOOTHING_RADIUS_KM = 285.0

#: Size in degrees of the squares that bring points and cell centers together.
_SQUARE = 2.5
_LAT_SQUARES, _LON_SQUARES = 72, 144
#: Columns of a point and of a cell center for the distance between them.
_PARTS = ("_sin1", "_cos1", "_lon1", "_sin2", "_cos2", "_lon2")
#: Values of dense labels that a task makes at once.
_DENSE_VALUES = 2_000_000
#: Entries of a batch of labels.
_ENTRIES = 1 << 18
_PACKED = "class_idx binary, weight binary"
#: Finest grid level of the box join; a level halves the squares of the one before.
_BOX_LEVELS = 16


@dataclass(frozen=True)
class CellLookup:
    """A checked set of leaves, ready to label any number of frames."""

    leaves: DataFrame
    tiles: DataFrame
    depths: tuple[int, ...]
    size: int


def cell_lookup(leaves: DataFrame) -> CellLookup:
    """Prepares ``(cell, class_idx[, cut])``; a set in which one cell encloses another is refused."""
    cut = F.col("cut") if "cut" in leaves.columns else F.lit(False)
    leaves = leaves.select("cell", "class_idx", cut.alias("cut"))
    tiles = pin(tiling(leaves))
    depths, size = _survey(tiles)
    table = tiles.select(path_key("tile").alias("_key"), "_hit")
    return CellLookup(leaves, table, tuple(sorted(depths)), size)


def with_cell(
    points: DataFrame,
    leaves: DataFrame | CellLookup,
    *,
    strategy: str = "auto",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``cell``, ``class_idx`` and ``cut`` of the enclosing leaf; NULL where no leaf encloses the point.

    Tiles measured to fit are looked up in one broadcast hash table: no shuffle, no row is written twice, and
    it works on a stream. Otherwise leaves become intervals of the space-filling curve, and both are dealt to
    ranges of it. ``shuffle`` makes the same join as ``broadcast`` without sending the tiles to every task;
    ``broadcast`` refuses tiles beyond ``max_bytes``.
    """
    if strategy not in ("auto", "broadcast", "shuffle", "merge"):
        raise ValueError(f"unknown strategy {strategy!r}")
    lookup = leaves if isinstance(leaves, CellLookup) else cell_lookup(leaves)
    kept = [c for c in points.columns if c not in ("cell", "class_idx", "cut")]
    points = points.select(*kept)
    if not lookup.depths:
        hit = F.lit(None).cast("struct<cell:string,class_idx:int,cut:boolean>")
        return points.select(*kept, hit.alias("_hit")).select(*kept, "_hit.*")
    deepest = lookup.depths[-1]
    if strategy == "merge" or (strategy == "auto" and lookup.size > max_bytes):
        return _merge_cell(points, lookup.leaves, deepest)
    if strategy == "broadcast" and lookup.size > max_bytes:
        raise ValueError(f"tiles of {lookup.size} bytes are too large for a broadcast of {max_bytes}")
    # Tiles cover the world without overlap, so exactly one of the keys of a point is in the table: the inner
    # join keeps every point once. Points without a coordinate go along under the first tile and are blanked.
    keys = F.array(*(slot_key("coalesce(_row, 0)", "coalesce(_column, 0)", d, deepest - d) for d in lookup.depths))
    met = (
        with_slots(points, deepest)
        .select(*kept, F.explode(keys).alias("_probe"))
        .join(lookup.tiles if strategy == "shuffle" else F.broadcast(lookup.tiles), F.col("_probe") == F.col("_key"))
    )
    known = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.col("_hit"))
    return met.select(*kept, known.alias("_hit")).select(*kept, "_hit.*")


def tiling(leaves: DataFrame) -> DataFrame:
    """``(tile, _hit, _listed, _above)``: the leaves, and the largest cells that fill the rest of the world.

    Tiles are the children of all cells above a leaf, except those that are above a leaf themselves. One
    aggregation by path; a leaf above another leaf is kept, so that it can be refused.
    """
    hit = F.struct("cell", "class_idx", "cut")
    above = (
        leaves.where("length(cell) > 0")
        .select("cell", F.explode(F.expr("sequence(0, length(cell) - 1)")).alias("_length"))
        .select(F.expr("substring(cell, 1, _length)").alias("tile"))
        .distinct()
    )
    family = F.array(
        F.struct(F.col("tile").alias("tile"), F.lit(True).alias("_above")),
        *(F.struct(F.concat("tile", F.lit(d)).alias("tile"), F.lit(False).alias("_above")) for d in "0123"),
    )
    pieces = (
        above.select(F.inline(family))
        .withColumn("_hit", F.lit(None).cast(leaves.select(hit).schema[0].dataType))
        .unionByName(leaves.select(F.col("cell").alias("tile"), F.lit(False).alias("_above"), hit.alias("_hit")))
    )
    gathered = pieces.groupBy("tile").agg(
        F.any_value("_hit", ignoreNulls=F.lit(True)).alias("_hit"),
        F.count("_hit").alias("_listed"),
        F.bool_or("_above").alias("_above"),
    )
    return gathered.where("not _above or _listed > 0")


def _survey(tiles: DataFrame) -> tuple[list[int], int]:
    """Depths in use and bytes of the lookup table, from one pass that also checks the set of leaves."""
    rows = (
        tiles.groupBy(F.length("tile").alias("depth"))
        .agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.octet_length("_hit.cell")), F.lit(0)),
            F.max((F.col("_above") & (F.col("_listed") > 0)) | (F.col("_listed") > 1)),
        )
        .collect()
    )
    if any(depth == 0 or wrong for depth, _, _, wrong in rows):
        raise ValueError("a cell of the set encloses another one, or is the world, or is listed twice")
    return [row[0] for row in rows], sum(n * (ROW_OVERHEAD + 24) + text for _, n, text, _ in rows)


def _merge_cell(points: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    span = f"cast(pow(4D, {depth} - length(cell)) as bigint)"
    intervals = leaves.select(
        F.expr(f"cast(conv(cell, 4, 10) as bigint) * {span}").alias("_from"),
        F.struct("cell", "class_idx", "cut", F.expr(span).alias("_span")).alias("_leaf"),
    )
    placed = with_slots(points, depth).select(*points.columns, curve_place("_row", "_column").alias("_place"))
    found = asof_backward(
        placed, intervals.withColumn("_first", F.col("_from")), left_key="_place", right_key="_from",
        take=["_leaf", "_first"], strategy="merge",
    )
    inside = F.col("_place") < F.col("_first") + F.col("_leaf._span")
    return found.withColumn("_leaf", F.when(inside, F.col("_leaf"))).select(
        *points.columns, "_leaf.cell", "_leaf.class_idx", "_leaf.cut"
    )


def excluded_points(labelled: DataFrame) -> DataFrame:
    """``(id)`` of in-world points in sparse leaves: no active cell, and not cut by the depth bound."""
    return labelled.where(in_world() & F.col("cell").isNull()).select("id")


def with_class(labelled: DataFrame, *, unlabelled: str = "drop") -> DataFrame:
    """Rows with a class. ``unlabelled`` is ``drop``, ``keep`` (NULL) or ``raise``."""
    if unlabelled == "keep":
        return labelled
    if unlabelled == "drop":
        return labelled.where("class_idx is not null")
    if unlabelled != "raise":
        raise ValueError("unlabelled must be 'drop', 'keep' or 'raise'")
    number = F.coalesce("class_idx", F.raise_error(F.lit("point without a class")).cast("int"))
    return labelled.withColumn("class_idx", number)


def class_to_cell(df: DataFrame, classes: DataFrame, column: str = "class_idx", name: str = "cell") -> DataFrame:
    """Adds the cell of a class number."""
    names = classes.select(F.col("class_idx").alias("_class"), F.col("cell").alias(name))
    side = F.broadcast(names) if fits_broadcast(names) else names
    return df.join(side, F.col(column) == F.col("_class"), "left").drop("_class")


def cell_to_class(df: DataFrame, classes: DataFrame, column: str = "cell", name: str = "class_idx") -> DataFrame:
    """Adds the class number of a cell."""
    numbers = classes.select(F.col("cell").alias("_name"), F.col("class_idx").alias(name))
    side = F.broadcast(numbers) if fits_broadcast(numbers) else numbers
    return df.join(side, F.col(column) == F.col("_name"), "left").drop("_name")


# --- boxes ----------------------------------------------------------------------------------------------


def box_join(
    points: DataFrame, boxes: DataFrame, *, bounds: str = "[)", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every point with every rectangle ``(south, north, west, east, ...)`` that holds it.

    A rectangle is written to the squares it touches on the grid level that fits its size, some four of them; a point has
    one square on each level in use. They meet by an equi-join on the square, so the candidates of a point are the
    rectangles close to it in their own measure, however dense the points are.
    """

    def slot(value: str, low: float, span: float, level: str) -> str:
        n = f"shiftleft(1, {level})"
        return f"cast(greatest(least(floor(({value} - {low}D) * {n} / {span}D), {n} - 1), 0) as int)"

    def square(level: str, y: str, x: str) -> str:
        return f"shiftleft(cast({level} as bigint), 40) + shiftleft(cast({y} as bigint), 20) + {x}"

    def fit(span: float, low: str, high: str) -> str:
        return f"log2({span}D / greatest(abs({high} - {low}), 1e-9D))"

    level = f"coalesce(floor(least({fit(180.0, 'south', 'north')}, {fit(360.0, 'west', 'east')})), 0)"
    tiled = (
        boxes.select("*", F.expr(f"cast(greatest(least({level}, {_BOX_LEVELS}), 0) as int)").alias("_level"))
        .select("*", F.explode(F.expr(f"sequence({slot('south', -90.0, 180.0, '_level')}, {slot('north', -90.0, 180.0, '_level')})")).alias("_y"))
        .select("*", F.explode(F.expr(f"sequence({slot('west', -180.0, 360.0, '_level')}, {slot('east', -180.0, 360.0, '_level')})")).alias("_x"))
        .select(*boxes.columns, "_level", F.expr(square("_level", "_y", "_x")).alias("_square"))
    )
    tiled = pin(tiled)
    levels = sorted(r[0] for r in tiled.select("_level").distinct().collect())  # at most _BOX_LEVELS + 1 rows
    tiled = tiled.drop("_level")
    lat, lon = single_sql("latitude"), single_sql("longitude")
    probes = [square(str(k), slot(lat, -90.0, 180.0, str(k)), slot(lon, -180.0, 360.0, str(k))) for k in levels or [0]]
    placed = points.where(F.expr(f"not isnan({lat}) and not isnan({lon})")).withColumn(
        "_square", F.explode(F.array(*map(F.expr, probes)))
    )
    if fits_broadcast(tiled, max_bytes):
        met = placed.join(F.broadcast(tiled), "_square")
    else:
        met = salted_join(placed, tiled, "_square", "id")
    return met.where(in_box("south", "north", "west", "east", bounds=bounds)).drop("_square")


# --- weights --------------------------------------------------------------------------------------------


def one_hot(labelled: DataFrame) -> DataFrame:
    """Sparse label matrix ``(id, class_idx, weight)``."""
    return labelled.where("class_idx is not null").select("id", "class_idx", F.lit(1.0).cast("float").alias("weight"))


def one_hot_array(labelled: DataFrame, classes: int, keep: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """Dense one-hot rows ``(id, label)``, and the columns ``keep``. A class number beyond ``classes`` has zeros alone.

    With ``tasks`` the rows are dealt to so many tasks while they are narrow: their bytes say little about the work.
    """
    if tasks:
        labelled = labelled.where("class_idx is not null").select("id", "class_idx", *keep).repartition(tasks, "id", "class_idx")
    zeros = f"array_repeat(0F, {classes})"
    ones = f"concat(array_repeat(0F, class_idx), array(1F), array_repeat(0F, {classes - 1} - class_idx))"
    label = F.expr(f"if(class_idx between 0 and {classes - 1}, {ones}, {zeros})")
    return labelled.where("class_idx is not null").select("id", *keep, label.alias("label"))


def label_entries(rows: DataFrame) -> DataFrame:
    """``(id, class_idx, weight)`` of packed rows, see :func:`smoothed_labels`: a row per entry."""

    def run(batches):
        import numpy as np

        for batch in batches:
            ids, ends, names, weights = unpacked(batch)
            at = np.repeat(np.arange(len(ids)), np.diff(ends))
            for k in range(0, len(at), _ENTRIES):
                cut = slice(k, k + _ENTRIES)
                columns = [ids.take(pa.array(at[cut])), pa.array(names[cut]), pa.array(weights[cut])]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "class_idx", "weight"])

    return rows.mapInArrow(run, _pair_type(rows, "class_idx int, weight float", ("id",)))


def label_sums(rows: DataFrame) -> DataFrame:
    """``(id, entries, total)`` of packed rows: number and sum of the weights of each row."""

    def run(batches):
        import numpy as np

        for batch in batches:
            ids, ends, _, weights = unpacked(batch)
            total = np.zeros(len(ids))
            some = np.diff(ends) > 0
            if some.any():
                total[some] = np.add.reduceat(weights, ends[:-1][some], dtype="float64")
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(ends)), pa.array(total)], names=["id", "entries", "total"])

    return rows.mapInArrow(run, _pair_type(rows, "entries long, total double", ("id",)))


def dense_labels(sparse: DataFrame, classes: int) -> DataFrame:
    """Dense rows ``(id, label)`` of a sparse label matrix; a row has one entry per class at most.

    Where the entries of a row are neighbours already, as smoothing leaves them, they are neither moved, nor sorted, nor spilled. ``sparse`` may hold
    packed rows instead; those of an id are next to one another.
    """
    if isinstance(sparse.schema["class_idx"].dataType, T.BinaryType):
        return sparse.mapInArrow(_dense_of_packed(classes), _pair_type(sparse, "label array<float>", ("id",)))
    kind = "double" if sparse.schema["weight"].dataType.typeName() in ("double", "decimal") else "float"
    entries = sparse.select("id", "class_idx", F.col("weight").cast(kind).alias("weight"))
    schema = T.StructType([sparse.schema["id"], T.StructField("label", entries.select(F.array("weight")).schema[0].dataType)])

    def run(table: pa.Table) -> pa.Table:
        label = _dense_row(table.column("class_idx").combine_chunks(), table.column("weight").combine_chunks(), classes)
        return pa.Table.from_arrays([table.column("id").slice(0, 1), label], names=["id", "label"])

    return entries.groupBy("id").applyInArrow(run, schema)


def _dense_row(number: pa.Array, weight: pa.Array, classes: int) -> pa.Array:
    """One list: zeros up to each entry, the entry, and zeros after the last one."""
    import numpy as np

    if number.null_count:
        return pa.nulls(1, pa.list_(weight.type))
    number, empty = number.to_numpy(), weight.is_null().to_numpy(zero_copy_only=False)
    values = weight.fill_null(0).to_numpy()
    order = np.lexsort((values, ~empty, number))
    number = number[order].astype("int64")
    place = np.cumsum(np.maximum(np.diff(number, prepend=-1) - 1, 0) + 1) - 1
    row = np.zeros(max(place[-1] + 1 + max(0, classes - 1 - number[-1]), 0) if len(number) else classes, values.dtype)
    row[place] = values[order]
    gone = None
    if empty.any():
        gone = np.zeros(len(row), bool)
        gone[place] = empty[order]
    return pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), pa.array(row, mask=gone))


def _dense_of_packed(classes: int):
    def runs(batches):
        """Batches in which no id goes on from the one before."""
        import numpy as np

        held = None
        for batch in batches:
            batch = pa.concat_batches([held, batch]) if held is not None else batch
            same = np.flatnonzero((code := codes(batch.column("id"))) != code[-1]) if batch.num_rows else ()
            end = int(same[-1]) + 1 if len(same) else 0
            if end:
                yield batch.slice(0, end)
            held = batch.slice(end)
        if held is not None and held.num_rows:
            yield held

    def run(batches):
        import numpy as np

        for batch in runs(batches):
            ids, ends, names, weights = unpacked(batch)
            firsts = np.flatnonzero(np.diff(codes(ids), prepend=-1))
            rising = np.diff(names, prepend=-1) > 0
            rising[ends[:-1][ends[:-1] < len(names)]] = True
            if len(firsts) == len(ids) and rising.all() and (not len(names) or names.max() < classes):
                step = max(1, _DENSE_VALUES // max(classes, 1))
                for k in range(0, len(ids), step):
                    at = ends[k : k + step + 1]
                    rows = np.zeros((len(at) - 1, classes), "float32")
                    rows[np.repeat(np.arange(len(rows)), np.diff(at)), names[at[0] : at[-1]]] = weights[at[0] : at[-1]]
                    starts = pa.array(np.arange(len(rows) + 1, dtype="int32") * classes)
                    yield pa.RecordBatch.from_arrays([ids.slice(k, len(rows)), pa.ListArray.from_arrays(starts, pa.array(rows.ravel()))], names=["id", "label"])
                continue
            for first, last in zip(firsts, [*firsts[1:], len(ids)]):
                own = slice(ends[first], ends[last])
                label = _dense_row(pa.array(names[own]), pa.array(weights[own]), classes)
                yield pa.RecordBatch.from_arrays([ids.slice(first, 1), label], names=["id", "label"])

    return run


def _ranges(classes: DataFrame, radius_km: float) -> DataFrame:
    """``(near_class, center_lat, center_lon, _y0, _y1, _x0, _x1)``: the squares that the disc of a cell or its own box can touch."""
    reach = math.degrees(radius_km / GREAT_CIRCLE_RADIUS_KM)
    sine = math.sin(radius_km / GREAT_CIRCLE_RADIUS_KM)
    return (
        with_bounds(classes.select(F.col("class_idx").alias("near_class"), "cell"))
        .selectExpr(
            "near_class", "south", "north", "west", "east",
            "(south + north) / 2 as center_lat", "(west + east) / 2 as center_lon",
        )
        .selectExpr(
            "*",
            f"case when abs(center_lat) + {reach!r}D >= 90D then 180D"
            f" else degrees(asin(least({sine!r}D / cos(radians(center_lat)), 1D))) end as _half",
        )
        .selectExpr(
            "near_class", "center_lat", "center_lon",
            f"cast(floor((least(south, center_lat - {reach!r}D) + 90D) / {_SQUARE}D) as int) as _y0",
            f"cast(floor((greatest(north, center_lat + {reach!r}D) + 90D) / {_SQUARE}D) as int) as _y1",
            f"cast(floor((least(west, center_lon - _half) + 180D) / {_SQUARE}D) as int) as _x0",
            f"cast(floor((greatest(east, center_lon + _half) + 180D) / {_SQUARE}D) as int) as _x1",
        )
    )


def _placed(labelled: DataFrame) -> DataFrame:
    """Points with a class, what their distances need of them, and their square."""
    lat, lon = single_sql("latitude"), single_sql("longitude")
    row = f"greatest(least(floor(({lat} + 90D) / {_SQUARE}D), {_LAT_SQUARES - 1}), 0)"
    column = f"pmod(floor(({lon} + 180D) / {_SQUARE}D), {_LON_SQUARES})"
    return labelled.where("class_idx is not null").select(
        "id",
        "class_idx",
        *(F.expr(e).alias(f"_{n}1") for n, e in great_circle_parts_sql(lat, lon).items()),
        F.expr(f"cast({row} * {_LON_SQUARES} + {column} as int)").alias("_square"),
    )


def _index(classes: DataFrame, radius_km: float, max_bytes: int) -> Broadcast | None:
    """The cells by square, sent to all tasks, when they are measured to fit."""
    parts = (F.expr(e).alias(f"_{n}2") for n, e in great_circle_parts_sql("center_lat", "center_lon").items())
    cells = pin(_ranges(classes, radius_km).select("near_class", *parts, "_y0", "_y1", "_x0", "_x1"))
    rows, columns = f"least(_y1, {_LAT_SQUARES - 1}) - greatest(_y0, 0) + 1", f"least(_x1 - _x0, {_LON_SQUARES - 1}) + 1"
    n, listed = cells.agg(F.count(F.lit(1)), F.expr(f"coalesce(sum(cast(({rows}) * ({columns}) as bigint)), 0)")).first()
    if n * (ROW_OVERHEAD + 64) + listed * 8 > max_bytes:
        return None
    return classes.sparkSession.sparkContext.broadcast(square_index(cells.toArrow(), _LAT_SQUARES, _LON_SQUARES))


def near_cells(
    labelled: DataFrame,
    classes: DataFrame,
    *,
    radius_km: float = SMOOTHING_RADIUS_KM,
    max_bytes: int = BROADCAST_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """``(id, class_idx, near_class, km)``: cells whose center is within the radius, and the own cell always.

    The small side is spread: each cell is written to every square of a 2.5 degree grid that its disc or its
    own box can touch (with wrap at 180 degrees and whole circles near the poles), while a point has exactly
    one square. The exact distance decides. While the squares fit a broadcast, points are dealt to ``tasks`` tasks before they fan out,
    the shuffle partitions by default, where distances of a square are one matrix; otherwise points and cells meet in an equi-join on the square.
    """
    index = _index(classes, radius_km, max_bytes)
    if index:
        placed = _placed(labelled)
        dealt = placed.repartition(tasks or _shuffle_tasks(labelled), "id", "_lon1")
        return dealt.mapInArrow(pairs_within(index, radius_km), _pair_type(placed, "near_class int, km double"))
    met = _near(labelled, classes, radius_km, max_bytes, None)[0].withColumn("km", F.expr(great_circle_of_parts_sql(*_PARTS)))
    return met.where((F.col("km") <= radius_km) | (F.col("class_idx") == F.col("near_class"))).select("id", "class_idx", "near_class", "km")


def _shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _pair_type(placed: DataFrame, others: str, own: tuple[str, ...] = ("id", "class_idx")) -> T.StructType:
    return T.StructType([*(placed.schema[c] for c in own), *T.StructType.fromDDL(others)])


def _near(
    labelled: DataFrame, classes: DataFrame, radius_km: float, max_bytes: int, tasks: int | None
) -> tuple[DataFrame, list[str]]:
    """The pairs of a point and a cell, and the columns by which all pairs of a point are neighbours in one task. No pair within the radius is
    missing; a few are a hair beyond it. Sines and cosines are worked out per point and per cell, not per pair.

    With ``tasks`` the points are dealt and sorted by those columns before they fan out, and the hash joins keep that: what is summed per
    point later needs neither a shuffle nor a sort of the pairs.
    """
    spread = (
        _ranges(classes, radius_km)
        .selectExpr(
            "near_class", "center_lat", "center_lon", "_x0", "_x1",
            f"explode(sequence(greatest(_y0, 0), least(_y1, {_LAT_SQUARES - 1}))) as _y",
        )
        .selectExpr(
            "near_class", "center_lat", "center_lon", "_y",
            f"explode(sequence(_x0, least(_x1, _x0 + {_LON_SQUARES - 1}))) as _x",
        )
        .selectExpr(
            "near_class", *(f"{e} as _{n}2" for n, e in great_circle_parts_sql("center_lat", "center_lon").items()),
            f"_y * {_LON_SQUARES} + pmod(_x, {_LON_SQUARES}) as _square",
        )
    )
    placed = _placed(labelled)
    if fits_broadcast(spread, max_bytes):
        keys = ["id"]
        placed = neighbours(placed.repartition(tasks, "id"), keys) if tasks else placed
        met = placed.join(F.broadcast(spread), "_square")
    else:
        keys = ["_square", "_salt", "id"]
        met = salted_join(placed, spread, "_square", "id", neighbour_tasks=tasks)
    # The cosine of the angle falls with the distance; NaN is greater than all numbers here. The planner moves conditions into the join, where what
    # occurs twice is worked out twice, so only this cheap one is made.
    least = math.cos(min(radius_km / GREAT_CIRCLE_RADIUS_KM, math.pi)) - 1e-9
    return met.where(f"{angle_cosine_of_parts_sql(*_PARTS)} between {least!r}D and 1.5D or class_idx = near_class"), keys


def smoothed_labels(
    labelled: DataFrame,
    classes: DataFrame,
    *,
    std_km: float = SMOOTHING_STD_KM,
    max_bytes: int = BROADCAST_BYTES,
    tasks: int | None = None,
    packed: bool = False,
) -> DataFrame:
    """Sparse smoothed label matrix ``(id, class_idx, weight)``; the weights of a row add up to 1.

    Weight before division: 1 for the own cell plus the normal density of the distance to each cell center. Ids are unique. The points are
    dealt to ``tasks`` tasks, the shuffle partitions by default: rows are narrow before they fan out, so their bytes say
    little about the work.

    ``packed`` gives a row per point, ``class_idx`` being its classes as 32 bit integers in binary, and ``weight`` their 32 bit floats. While the cells by square fit a broadcast, they are
    made of matrices of distances, and no pair is a row. An id with several points has them next to one another, or in one row; their weights add up
    to 1 together.
    """
    radius = SMOOTHING_RADIUS_KM * std_km / SMOOTHING_STD_KM + (5.0 if std_km != SMOOTHING_STD_KM else 0.0)
    tasks = tasks or _shuffle_tasks(labelled)
    if packed:
        index = _index(classes, radius, max_bytes)
        if index:
            placed = _placed(labelled)
            dealt = placed.repartition(tasks, "id").sortWithinPartitions("id")
            return dealt.mapInArrow(smoothed_within(index, std_km), _pair_type(placed, _PACKED, ("id",)))
        pairs = smoothed_labels(labelled, classes, std_km=std_km, max_bytes=max_bytes, tasks=tasks)
        each = pairs.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("class_idx", "weight"))).alias("_each"))
        return each.select("id", "_each.class_idx", "_each.weight").mapInArrow(_pack, _pair_type(each, _PACKED, ("id",)))
    near, keys = _near(labelled, classes, radius, max_bytes, tasks)
    own = F.when(F.col("class_idx") == F.col("near_class"), 1.0).otherwise(0.0).cast("float")
    km = great_circle_of_parts_sql(*_PARTS)
    raw = near.select(*keys, "near_class", (own + normal_pdf(km, 0.0, std_km).cast("float")).cast("float").alias("_raw"))
    total = F.sum(F.col("_raw").cast("double")).over(Window.partitionBy(*keys))
    # Weights beyond the radius are zeros, which the sums do not see. They go behind the sums, so that each weight is worked out once.
    shares = raw.select("id", "near_class", "_raw", (F.col("_raw") / total).cast("float").alias("weight"))
    return shares.where("_raw > 0").select("id", F.col("near_class").alias("class_idx"), "weight")


def _pack(batches):
    for batch in batches:
        names, weights = batch.column("class_idx"), batch.column("weight")
        yield packed_rows(batch.column("id"), names.value_lengths().to_numpy(), names.flatten().to_numpy(), weights.flatten().to_numpy())
