"""Size checks in front of every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper bound, in bytes, of a side that is sent whole to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024
#: Rows that one task may gather and sort for a result in order.
DIRECT_ROWS = 10_000
#: Cost per row of a hashed relation on top of its values.
ROW_OVERHEAD = 40


def measured_bytes(df: DataFrame) -> int:
    """Exact size of ``df`` as flat values: one aggregation, variable-length columns are added up."""
    fixed = ROW_OVERHEAD
    variable = []
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            variable.append(F.octet_length(field.name))
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            variable.append(F.octet_length(F.to_json(F.struct(field.name))))
        elif isinstance(kind, T.StructType):
            variable.append(F.octet_length(F.to_json(F.col(field.name))))
        else:
            fixed += 8
    rows, extra = df.agg(
        F.count(F.lit(1)),
        F.sum(sum((F.coalesce(size, F.lit(0)).cast("long") for size in variable), F.lit(0).cast("long"))),
    ).first()
    return rows * fixed + (extra or 0)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row as flat values: texts and bytes by length, arrays of numbers by 8 bytes each, all else 8."""
    sizes = []
    for field in df.schema.fields:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(name) + 4)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
            sizes.append(F.size(name) * 8)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.octet_length(F.to_json(F.struct(name))))
    whole = 8 * max(1, len(df.columns) - len(sizes))
    return sum((F.greatest(F.coalesce(s, F.lit(4)), F.lit(0)).cast("long") for s in sizes), F.lit(whole).cast("long"))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it is measured to fit; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
