"""Byte sizes: conversion between units and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factor of every unit name in bytes, decimal units first.
DECIMAL_UNITS = {
    "B": 1,
    "kB": 1000,
    "MB": 1000**2,
    "GB": 1000**3,
    "TB": 1000**4,
    "PB": 1000**5,
    "EB": 1000**6,
    "ZB": 1000**7,
    "YB": 1000**8,
}
BINARY_UNITS = {
    "kiB": 1024,
    "MiB": 1024**2,
    "GiB": 1024**3,
    "TiB": 1024**4,
    "PiB": 1024**5,
    "EiB": 1024**6,
    "ZiB": 1024**7,
    "YiB": 1024**8,
}
UNITS = DECIMAL_UNITS | BINARY_UNITS


def _factor_sql(unit: str) -> str:
    """Factor of the unit named by a SQL expression; an unknown name fails the job."""
    arms = " ".join(f"when '{name}' then {float(factor)!r}D" for name, factor in UNITS.items())
    return f"case {unit} {arms} else cast(raise_error(concat('invalid unit: ', {unit})) as double) end"


def auto_unit_sql(size: str) -> str:
    """Greatest decimal unit not above ``size``, taken as bytes whatever its base is."""
    arms = " ".join(
        f"when {size} >= {float(factor)!r}D then '{name}'" for name, factor in reversed(DECIMAL_UNITS.items())
    )
    return f"case {arms} else 'B' end"


def auto_unit(size: str) -> Column:
    return F.expr(auto_unit_sql(f"cast({size} as double)"))


def _target_sql(size: str, to: str) -> str:
    return auto_unit_sql(size) if to == "auto" else f"'{_known(to)}'"


def _known(unit: str) -> str:
    if unit not in UNITS:
        raise ValueError(f"invalid unit: {unit}")
    return unit


def convert_size_sql(size: str, to: str = "auto", base: str = "'B'") -> str:
    size = f"cast({size} as double)"
    return f"({size} * ({_factor_sql(base)}) / ({_factor_sql(_target_sql(size, to))}))"


def convert_size(size: str, to: str = "auto", base: str = "'B'") -> Column:
    """``size`` in the target unit. ``base`` is a SQL expression for the unit name of ``size``."""
    return F.expr(convert_size_sql(size, to, base))


def format_size(size: str, to: str = "auto", base: str = "'B'", *, precision: int = 0) -> Column:
    """``"<number> <unit>"`` with half-even rounding."""
    target = _target_sql(f"cast({size} as double)", to)
    value = f"bround({convert_size_sql(size, to, base)}, {precision})"
    return F.expr(f"concat(format_string('%.{precision}f', {value}), ' ', {target})")


def format_size_1024(size: str, unit: str = "kb") -> Column:
    """Earlier form: b, kb or Mb by powers of 1024, two decimals."""
    steps = {"b": "", "kb": " / 1024D", "Mb": " / 1024D / 1024D"}
    if unit not in steps:
        raise ValueError("unit must be b, kb or Mb")
    return F.expr(f"concat(format_string('%.2f', bround(cast({size} as double){steps[unit]}, 2)), ' {unit}')")
