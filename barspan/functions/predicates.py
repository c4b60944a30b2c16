"""Reusable predicates."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Concept codes left out of concept statistics (index samples, financing, listing status, regions).
EXCLUDED_CONCEPTS = [
    "883300.TI", "883301.TI", "883302.TI", "883303.TI", "883304.TI", "885338.TI", "885472.TI", "885487.TI",
    "885514.TI", "885520.TI", "885521.TI", "885587.TI", "885591.TI", "885598.TI", "885617.TI", "885694.TI",
    "885699.TI", "885701.TI", "885729.TI", "885734.TI", "885739.TI", "885742.TI", "885796.TI", "885849.TI",
    "885855.TI", "885867.TI", "885873.TI", "885905.TI", "885906.TI", "885907.TI",
]

# Which end of a range each side includes (start, end).
SIDES = {"both": (True, True), "left": (True, False), "right": (False, True), None: (False, False)}


def as_literal(value: Any) -> Column:
    """A bound as a Column; text that looks like a time compares as a naive timestamp."""
    return value if isinstance(value, Column) else F.lit(value)


def time_literal(value: Any) -> Column:
    return as_literal(value).cast("timestamp_ntz")


def in_range(column: Column, start: Any = None, end: Any = None, side: str | None = "both") -> Column:
    """``column`` between two bounds; ``None`` means no bound on that end."""
    if side not in SIDES:
        raise ValueError(f"side must be one of {list(SIDES)}, not {side!r}")
    from_closed, to_closed = SIDES[side]
    cond = F.lit(True)
    if start is not None:
        cond = cond & (column >= as_literal(start) if from_closed else column > as_literal(start))
    if end is not None:
        cond = cond & (column <= as_literal(end) if to_closed else column < as_literal(end))
    return cond


def regular_name(name: Column) -> Column:
    """Neither special-treatment nor delisting; an unknown name does not qualify."""
    return ~(name.contains("ST") | name.contains("退"))


def price_return(close: Column, preclose: Column) -> Column:
    """(close - preclose) / preclose, NULL where preclose is 0."""
    return F.try_divide(close - preclose, preclose)


def legacy_table_name(symbol: Column) -> Column:
    """Per-symbol table names write the dot of a symbol as an underscore."""
    return F.replace(symbol, F.lit("."), F.lit("_"))
