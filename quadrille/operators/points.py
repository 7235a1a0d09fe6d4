"""The points table: schema, filters and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.functions.cells import in_world, single_sql

#: Canonical table of geotagged images. The comments travel as column metadata.
IMAGE_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType(), False, {"comment": "Row number of the record, dense"}),
        T.StructField("latitude", T.FloatType(), False, {"comment": "Latitude where the picture was taken"}),
        T.StructField("longitude", T.FloatType(), False, {"comment": "Longitude where the picture was taken"}),
        T.StructField("image", T.BinaryType(), False, {"comment": "Encoded image"}),
    ]
)


def as_points(df: DataFrame) -> DataFrame:
    """``id`` as LONG and coordinates as FLOAT; other columns stay."""
    kinds = {"id": "long", "latitude": "float", "longitude": "float"}
    return df.select(*(F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns))


def conform(df: DataFrame, schema: T.StructType = IMAGE_TABLE) -> DataFrame:
    """Casts to ``schema``, attaches its comments and drops no row: a NULL in a required column fails the job."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in {field.name}")).cast(field.dataType))
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def table_definition(schema: T.StructType = IMAGE_TABLE) -> list[tuple[str, str, bool, str]]:
    """``(name, type, nullable, comment)`` per column."""
    return [(f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment", "")) for f in schema]


# --- predicates -----------------------------------------------------------------------------------------


def in_box(
    south, north, west, east, *, bounds: str = "[)", latitude: str = "latitude", longitude: str = "longitude"
) -> Column:
    """Point-in-box predicate; edges are numbers or SQL expressions. ``bounds`` is ``[)`` (counting rule), ``()`` or ``[]``."""
    if bounds not in ("[)", "()", "[]"):
        raise ValueError("bounds must be '[)', '()' or '[]'")
    lower = ">=" if bounds[0] == "[" else ">"
    upper = "<=" if bounds[1] == "]" else "<"
    south, north, west, east = (e if isinstance(e, str) else f"{float(e)!r}D" for e in (south, north, west, east))
    lat, lon = single_sql(latitude), single_sql(longitude)
    return F.expr(f"{lat} {lower} {south} and {lat} {upper} {north} and {lon} {lower} {west} and {lon} {upper} {east}")


def id_between(first: int, last: int) -> Column:
    return F.col("id").between(first, last)


def id_strictly_between(low: int, high: int) -> Column:
    return (F.col("id") > low) & (F.col("id") < high)


def with_ids(points: DataFrame, wanted: DataFrame | list[int]) -> DataFrame:
    """Rows whose id is wanted: a literal list for a handful, a semi join for a table."""
    if isinstance(wanted, DataFrame):
        return points.join(wanted.select("id"), "id", "left_semi")
    return points.where(F.col("id").isin(list(wanted)))


def without_ids(points: DataFrame, excluded: DataFrame | list[int]) -> DataFrame:
    """Rows whose id is not excluded; an empty exclusion keeps everything."""
    if isinstance(excluded, DataFrame):
        return points.join(excluded.select("id"), "id", "left_anti")
    return points.where(~F.col("id").isin(list(excluded))) if excluded else points


# --- counts ---------------------------------------------------------------------------------------------


def max_id(points: DataFrame) -> DataFrame:
    return points.agg(F.max("id").alias("max_id"))


def count_rows(points: DataFrame, name: str = "n") -> DataFrame:
    return points.agg(F.count(F.lit(1)).alias(name))


def count_in_box(points: DataFrame, south, north, west, east, *, last_id: int | None = None) -> DataFrame:
    kept = points if last_id is None else points.where(F.col("id") <= last_id)
    return count_rows(kept.where(in_box(south, north, west, east)))


def ids_in_box(points: DataFrame, south, north, west, east) -> DataFrame:
    return points.where(in_box(south, north, west, east)).select("id")


def id_fraction_bound(points: DataFrame, fraction: float) -> int:
    """``int(max(id) * fraction)``."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    top = max_id(points).first()[0]
    return int((top or 0) * fraction)


def id_fraction(points: DataFrame, fraction: float) -> DataFrame:
    """The leading ``fraction`` of the id range."""
    return points.where(F.col("id") <= id_fraction_bound(points, fraction))


def column_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))


def in_world_points(points: DataFrame) -> DataFrame:
    return points.where(in_world())
