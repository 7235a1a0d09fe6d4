"""Quadtree cells as Column expressions.

A cell is a path of digits 0..3 from the world (the empty path) downwards: 0 north-west, 1 north-east,
2 south-west, 3 south-east. Joins and aggregations use the row and column of a cell among the cells of its depth.
Coordinates follow the FLOAT rule: they are rounded to single precision before any comparison.

Arguments are column names or SQL expressions; every function returns one Column built from SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Deepest level whose row, column and depth marker fit one LONG.
DEEPEST = 30
#: Deepest level at which every cell edge is exact in single precision.
FLOAT_EXACT = 19

#: Equatorial radius in metres for areas of cells.
AREA_RADIUS_M = 6378137.0

# The bit each path digit contributes to the row (0 = north) and to the column (0 = west).
_DIGITS = "0123"
_ROW_BITS = "0011"
_COLUMN_BITS = "0101"


def single_sql(value: str) -> str:
    """A coordinate as DOUBLE after rounding to FLOAT."""
    return f"cast(cast({value} as float) as double)"


def in_world(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Half-open world box; false for NaN."""
    lat, lon = single_sql(latitude), single_sql(longitude)
    return F.expr(f"{lat} >= -90D and {lat} < 90D and {lon} >= -180D and {lon} < 180D")


def slot_sql(value: str, low: float, span: float, slots: int, missing: int) -> str:
    """Index of the half-open interval that holds ``value``; values outside stick to the ends.

    The quotient only guesses; the guess is corrected against the edges ``low + span * k / slots``.
    """
    top = slots - 1
    guess = f"greatest(least(floor(({value} - {low}D) / {span}D * {slots}D), {top}), 0)"
    fixed = (
        f"{guess} + case when {value} < {low}D + {span}D * {guess} / {slots}D then -1"
        f" when {value} >= {low}D + {span}D * ({guess} + 1) / {slots}D then 1 else 0 end"
    )
    placed = f"when isnan({value}) then {missing} else greatest(least({fixed}, {top}), 0)"
    return f"cast(case when {value} is null then null {placed} end as int)"


def row_sql(latitude: str, depth: int) -> str:
    n = 2**depth
    return f"({n - 1} - {slot_sql(single_sql(latitude), -90.0, 180.0, n, n - 1)})"


def column_sql(longitude: str, depth: int) -> str:
    return slot_sql(single_sql(longitude), -180.0, 360.0, 2**depth, 0)


def row_slot(latitude: str, depth: int) -> Column:
    """Row of the point among ``2**depth`` rows, 0 in the north."""
    return F.expr(row_sql(latitude, depth))


def column_slot(longitude: str, depth: int) -> Column:
    """Column of the point among ``2**depth`` columns, 0 in the west."""
    return F.expr(column_sql(longitude, depth))


def with_slots(
    df: DataFrame, depth: int = FLOAT_EXACT, *, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Adds INT ``_row`` and ``_column`` of the point at ``depth``; an ancestor's slots are right shifts of them."""
    _check_depth(depth)
    return df.select(
        *(c for c in df.columns if c not in ("_row", "_column")),
        row_slot(latitude, depth).alias("_row"),
        column_slot(longitude, depth).alias("_column"),
    )


def slots_to_path(row: str, column: str, depth: int | str) -> Column:
    """Path of a cell. Binary digits are read as decimal ones, so that one addition yields all path digits."""
    if isinstance(depth, int) and depth <= 18:
        digits = f"cast(bin({row}) as bigint) * 2 + cast(bin({column}) as bigint)"
    else:
        digits = f"cast(bin({row}) as decimal(30,0)) * 2 + cast(bin({column}) as decimal(30,0))"
    padded = f"lpad(cast({digits} as string), {depth}, '0')"
    return F.expr(padded if isinstance(depth, int) else f"if({depth} = 0, '', {padded})")


def cell_path(latitude: str, longitude: str, depth: int) -> Column:
    """Path of the cell at ``depth`` that holds the point (edges of the world stick to the outer cells)."""
    _check_depth(depth)
    return slots_to_path(row_sql(latitude, depth), column_sql(longitude, depth), depth)


def path_row_sql(cell: str) -> str:
    return _axis_sql(cell, _ROW_BITS)


def path_column_sql(cell: str) -> str:
    return _axis_sql(cell, _COLUMN_BITS)


def _axis_sql(cell: str, bits: str) -> str:
    """Row or column number of a cell among the cells of its depth."""
    return (
        f"case when length({cell}) = 0 then 0L"
        f" else cast(conv(translate({cell}, '{_DIGITS}', '{bits}'), 2, 10) as bigint) end"
    )


def slot_key(row: str, column: str, depth: int, shift: int = 0) -> Column:
    """One LONG for the ancestor ``shift`` levels above a slot pair, at ``depth``: marker bit, row bits, column bits."""
    return F.expr(
        f"shiftleft(cast(shiftright({row}, {shift}) as bigint) + {1 << depth}L, {depth})"
        f" + shiftright({column}, {shift})"
    )


def path_key(cell: str) -> Column:
    """:func:`slot_key` of a path."""
    side = f"cast(pow(2D, length({cell})) as bigint)"
    return F.expr(f"({path_row_sql(cell)} + {side}) * {side} + {path_column_sql(cell)}")


def curve_position(path: str) -> Column:
    """Position of a full-depth path on the space-filling curve: its digits read in base 4."""
    return F.expr(f"cast(conv({path}, 4, 10) as bigint)")


#: The bits of a byte with a zero in front of each.
_APART = [sum((byte >> k & 1) << 2 * k for k in range(8)) for byte in range(256)]


def curve_place(row: str, column: str) -> Column:
    """:func:`curve_position` of a slot pair: the bits of row and column in turn, without a path in between."""
    table = F.lit(_APART).cast("array<long>")

    def apart(slot: str) -> Column:
        own = [F.shiftleft(F.get(table, F.shiftright(F.col(slot), 8 * k).bitwiseAND(F.lit(255))), 16 * k) for k in range(4)]
        return own[0].bitwiseOR(own[1]).bitwiseOR(own[2]).bitwiseOR(own[3])

    return F.shiftleft(apart(row), 1).bitwiseOR(apart(column))


def cell_depth(cell: str) -> Column:
    return F.length(F.expr(cell))


def cell_parent(cell: str) -> Column:
    """Path of the enclosing cell one level up; NULL for the world."""
    return F.expr(f"if(length({cell}) > 0, substring({cell}, 1, length({cell}) - 1), null)")


def cell_bounds(cell: str) -> Column:
    """STRUCT<south, north, west, east> of a path; exact in double precision."""
    n, row, column = f"pow(2D, length({cell}))", path_row_sql(cell), path_column_sql(cell)
    return F.expr(
        f"named_struct('south', 90D - ({row} + 1) * 180D / {n}, 'north', 90D - {row} * 180D / {n},"
        f" 'west', {column} * 360D / {n} - 180D, 'east', ({column} + 1) * 360D / {n} - 180D)"
    )


def with_bounds(df: DataFrame, cell: str = "cell") -> DataFrame:
    """Adds ``south, north, west, east``."""
    kept = [c for c in df.columns if c not in ("south", "north", "west", "east")]
    return df.select(*kept, cell_bounds(cell).alias("_box")).select(*kept, "_box.*")


def with_center(df: DataFrame, cell: str = "cell") -> DataFrame:
    """Adds ``center_lat, center_lon``."""
    return df.select("*", cell_bounds(cell).alias("_box")).select(
        *df.columns,
        F.expr("(_box.south + _box.north) / 2 as center_lat"),
        F.expr("(_box.west + _box.east) / 2 as center_lon"),
    )


def box_area_km2(south: str = "south", north: str = "north", west: str = "west", east: str = "east") -> Column:
    """Area of a box on the sphere."""
    square = AREA_RADIUS_M * AREA_RADIUS_M / 1e6
    return F.expr(
        f"radians({east} - {west}) * (sin(radians({north})) - sin(radians({south}))) * {square!r}D"
    )


def cell_outline(df: DataFrame, resolution: int, cell: str = "cell") -> DataFrame:
    """Boundary points ``(cell, seq, latitude, longitude)``: west edge south to north, then north, east, south.

    Every edge has ``resolution`` evenly spaced points and corners are repeated.
    """
    if resolution < 2:
        raise ValueError("resolution must be at least 2")
    points = df.select(
        cell, cell_bounds(cell).alias("_b"), F.explode(F.sequence(F.lit(0), F.lit(4 * resolution - 1))).alias("seq")
    ).selectExpr(
        cell,
        "seq",
        f"seq div {resolution} as _edge",
        f"(seq % {resolution}) / {resolution - 1}D as _step",
        "_b.south as _s",
        "_b.north as _n",
        "_b.west as _w",
        "_b.east as _e",
    )
    return points.selectExpr(
        cell,
        "seq",
        "case _edge when 0 then _s + (_n - _s) * _step when 1 then _n"
        " when 2 then _n + (_s - _n) * _step else _s end as latitude",
        "case _edge when 0 then _w when 1 then _w + (_e - _w) * _step"
        " when 2 then _e else _e + (_w - _e) * _step end as longitude",
    )


def _check_depth(depth: int) -> None:
    if not 1 <= depth <= DEEPEST:
        raise ValueError(f"depth must lie in 1..{DEEPEST}")
