"""Small text and date expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_first(value: str, old: str, new: str) -> Column:
    """Replaces the first occurrence of a literal, through the whole text."""
    pattern = "(?s)^(.*?)" + re.escape(old)
    return F.regexp_replace(F.col(value), pattern, "$1" + new.replace("\\", "\\\\").replace("$", "\\$"))


def iso_weekday(day: str) -> Column:
    """Day of the week, Monday = 1."""
    return F.weekday(day) + 1


def date_steps(df: DataFrame, start: str, stop: str, days: int, name: str = "day") -> DataFrame:
    """One row per step from ``start`` to ``stop``, both ends included when they fall on a step."""
    steps = F.expr(f"sequence(cast({start} as date), cast({stop} as date), make_interval(0, 0, 0, {int(days)}))")
    return df.withColumn(name, F.explode(steps))


def parse_size(text: str) -> Column:
    """``"(w, h)"`` as STRUCT<width, height>."""
    return F.struct(
        F.regexp_extract(text, r"\((\d+), (\d+)\)", 1).cast("int").alias("width"),
        F.regexp_extract(text, r"\((\d+), (\d+)\)", 2).cast("int").alias("height"),
    )


def size_text(width: str, height: str) -> Column:
    return F.format_string("(%d, %d)", F.col(width), F.col(height))


def file_stem(path: str) -> Column:
    """File name without folders and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def stem_number(stem: str) -> Column:
    """Integer after the first underscore of a stem; NULL without one."""
    return F.expr(f"try_cast(regexp_extract({stem}, '^[^_]*_([0-9]+)', 1) as int)")
