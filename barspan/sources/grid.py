"""Label access on the (symbol, dt) grid, kept as a long table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspan.functions.predicates import as_literal, in_range

_SHARES = 32


def _one(column: Column, selector: Any) -> Column:
    if isinstance(selector, slice):
        return in_range(column, selector.start, selector.stop)
    if isinstance(selector, tuple):
        return in_range(column, *selector)
    return column == as_literal(selector)


def label_slice(df: DataFrame, axes: Mapping[str, Any], attrs: Sequence[str] | None = None) -> DataFrame:
    """Select by labels: a point, a closed ``(start, end)`` range or slice, or a list mixing both, per axis."""
    for axis, selector in axes.items():
        parts = selector if isinstance(selector, list) else [selector]
        df = df.where(reduce(lambda a, b: a | b, [_one(F.col(axis), p) for p in parts], F.lit(False)))
    return df.select("symbol", "dt", *attrs) if attrs else df


def last_dts(df: DataFrame, k: int = 1, attrs: Sequence[str] | None = None) -> DataFrame:
    """All symbols at the last ``k`` times of the axis."""
    newest = df.select("dt").distinct().orderBy(F.col("dt").desc()).limit(k)
    out = df.join(newest, "dt", "left_semi")
    return out.select("symbol", "dt", *attrs) if attrs else out


def axis_labels(df: DataFrame, axis: str) -> DataFrame:
    return df.select(axis).distinct().orderBy(axis)


def grid_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("symbol").alias("n_symbols"), F.count_distinct("dt").alias("n_dts"))


def dense_grid(df: DataFrame) -> DataFrame:
    """Every (symbol, dt) of the two axes; cells without a row are NULL.

    Each symbol is expanded over the months of the time axis and then joined to the times of each
    month, so neither a cross join nor the whole time axis in one value is needed. Symbols are dealt into
    shares and the times, few next to the grid, repeated for each, so a busy month is spread over tasks.
    """
    times = df.select("dt").distinct().withColumn("_month", F.trunc("dt", "month"))
    span = times.agg(F.min("_month").alias("lo"), F.max("_month").alias("hi")).select(F.struct("*")).scalar()
    months = F.sequence(span["lo"], span["hi"], F.expr("interval 1 month"))
    cells = (
        df.select("symbol").distinct()
        .withColumns({"_month": F.explode(months), "_share": F.pmod(F.xxhash64("symbol"), F.lit(_SHARES)).cast("int")})
        .join(times.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1)))), ["_month", "_share"])
        .drop("_month", "_share")
    )
    return cells.join(df, ["symbol", "dt"], "left")


def field_presence(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, present) for every asked field."""
    present = set(df.columns)
    rows = [(f, f in present) for f in fields]
    return df.sparkSession.createDataFrame(rows, "field string, present boolean")
