"""Density of points on a regular grid of rows and columns, row 0 in the north."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.functions.cells import in_world, single_sql


def grid_density(points: DataFrame, rows: int = 180, columns: int = 360) -> DataFrame:
    """``(row, col, n)`` of the non-empty squares.

    Edges are ``-90 + 180 * (k / rows)`` and ``-180 + 360 * (k / columns)``, half-open, computed in double
    precision; the square found by division is corrected against exactly these edges.
    """
    lat, lon = single_sql("latitude"), single_sql("longitude")
    placed = points.where(in_world()).select(
        F.expr(f"{rows - 1} - {_edge_slot(lat, -90.0, 180.0, rows)}").alias("row"),
        F.expr(_edge_slot(lon, -180.0, 360.0, columns)).alias("col"),
    )
    return placed.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))


def _edge_slot(value: str, low: float, span: float, slots: int) -> str:
    guess = f"greatest(least(floor(({value} - {low}D) / {span}D * {slots}D), {slots - 1}), 0)"
    return (
        f"cast({guess} + case when {value} < {low}D + {span}D * ({guess} / {slots}D) then -1"
        f" when {value} >= {low}D + {span}D * (({guess} + 1) / {slots}D) then 1 else 0 end as int)"
    )


def dense_grid(density: DataFrame, rows: int = 180, columns: int = 360, *, flip: bool = False) -> DataFrame:
    """Every square, empty ones with 0; ``flip`` puts row 0 in the south. The grid is fixed, not data."""
    spark = density.sparkSession
    squares = spark.range(rows * columns).select(
        F.expr(f"cast(id div {columns} as int)").alias("row"), F.expr(f"cast(id % {columns} as int)").alias("col")
    )
    filled = squares.join(density, ["row", "col"], "left").select(
        "row", "col", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )
    return filled.withColumn("row", F.lit(rows - 1) - F.col("row")) if flip else filled


def occupied(grid: DataFrame) -> DataFrame:
    return grid.where("n > 0")


def log_density(grid: DataFrame, *, floor: float = 0.1) -> DataFrame:
    """Adds ``shade`` = log n / log of the greatest n (NULL for empty squares), and ``scaled`` with zero lifted."""
    n = F.col("n").cast("double")
    top = grid.agg(F.max("n").cast("double")).scalar()
    return grid.select(
        *grid.columns,
        F.when(n > 0, F.try_divide(F.log(n), F.log(top))).alias("shade"),
        F.when(n == 0, F.lit(floor)).otherwise(n).alias("scaled"),
    )
