"""Price adjustment: forward adjustment from preclose, and as-of adjustment tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barspan.operators.chunks import (
    CARRIED, CHUNK, TIE, WHOLE, asof_merge, at, chunk_window, fitting_width, time_chunk, with_next_time, with_tie,
)

OHLC = ["open", "high", "low", "close"]
# The columns an adjustment table applies to.
ADJUSTABLE = ["last_price", "bid_price1", "ask_price1", *OHLC]

# A factor table this small is shipped to every executor; beyond either limit the merge is used.
BROADCAST_ROWS = 500_000
BROADCAST_ROWS_PER_KEY = 512


def forward_adjust(
    df: DataFrame, keys: Sequence[str] = ("symbol",), time: str = "dt", chunk_seconds: int | None = None, sequence: str | None = None
) -> DataFrame:
    """Add ``adjust_factor`` and ``adj_*`` prices, anchored to the last row of each symbol in ``df``.

    Rows of equal time are ordered by ``sequence``, then by a hash of the row.

    The factor of a row is the product of preclose / previous close over all later rows; the last row
    has 1. A row whose next ratio is unknown has no factor; unknown ratios are skipped inside products.

    Rows are shuffled once, by (symbol, chunk). The product over the later chunks comes from a
    summary with one line per (symbol, chunk) and enters each chunk as its newest row.
    """
    keys = list(keys)
    if chunk_seconds is None:
        chunk_seconds = fitting_width(df, keys, time)
    tied = with_tie(df, sequence)
    newest_first = chunk_window(keys, F.col(CARRIED).desc(), F.col(time).desc(), F.col(TIE).desc())
    # lead() over a descending window is the previous row, so ratios and products share one sort.
    ratio = F.try_divide(F.col("preclose"), F.lead("close").over(newest_first))

    def chunked(frame: DataFrame) -> DataFrame:
        return frame.withColumns({CHUNK: time_chunk(F.col(time), chunk_seconds), CARRIED: F.lit(False)})

    def later_chunks() -> DataFrame:
        """Per chunk: the product of all later ratios, and whether the next row's ratio is known."""
        ends = (
            chunked(tied.select(*keys, time, TIE, "close", "preclose"))
            .withColumn("_ratio", ratio)
            .groupBy(*keys, CHUNK)
            .agg(
                F.min_by(F.struct("preclose"), at(time, TIE))["preclose"].alias("_first_preclose"),
                F.max_by(F.struct("close"), at(time, TIE))["close"].alias("_last_close"),
                F.product("_ratio").alias("_inner"),
            )
        )
        oldest = Window.partitionBy(*keys).orderBy(CHUNK)
        newest = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())
        first_ratio = F.try_divide(F.col("_first_preclose"), F.lag("_last_close").over(oldest))
        return (
            ends.withColumn("_first_ratio", first_ratio)
            .withColumn("_total", F.coalesce("_first_ratio", F.lit(1.0)) * F.coalesce("_inner", F.lit(1.0)))
            .select(
                *keys,
                CHUNK,
                F.product("_total").over(newest.rowsBetween(Window.unboundedPreceding, -1)).alias("_later"),
                F.lag(F.col("_first_ratio").isNotNull()).over(newest).alias("_later_known"),
            )
            # The last chunk of a key has nothing after it.
            .where(F.col("_later_known").isNotNull())
            .withColumn(CARRIED, F.lit(True))
        )

    rows = chunked(tied)
    if chunk_seconds == WHOLE:
        rows = rows.withColumn("_ratio", ratio).withColumn("_known", F.col("_ratio").isNotNull())
    else:
        rows = (
            rows.unionByName(later_chunks(), allowMissingColumns=True)
            .withColumn("_ratio", F.when(F.col(CARRIED), F.col("_later")).otherwise(ratio))
            .withColumn("_known", F.when(F.col(CARRIED), F.col("_later_known")).otherwise(F.col("_ratio").isNotNull()))
        )
    product = F.product("_ratio").over(newest_first.rowsBetween(Window.unboundedPreceding, -1))
    next_known = F.lag("_known").over(newest_first)
    factor = F.when(next_known.isNull(), F.lit(1.0)).when(next_known, F.coalesce(product, F.lit(1.0)))
    adjusted = rows.withColumn("adjust_factor", factor).where(~F.col(CARRIED))
    prices = {f"adj_{c}": F.col(c) * F.col("adjust_factor") for c in OHLC if c in df.columns}
    return adjusted.withColumns(prices).select(*df.columns, "adjust_factor", *prices)


def latest_factors(factors: DataFrame, keys: Sequence[str], time: str, value: str, sequence: str | None) -> DataFrame:
    """One known value per (key, time); of several the one with the highest ``sequence`` counts, and without a sequence
    different ones are an error. Values without a key or time hold for no bar and are left out.
    """
    known = factors.where(reduce(and_, [F.col(c).isNotNull() for c in (value, time, *keys)]))
    if sequence:
        pick = F.max_by(value, at(sequence))
    else:
        several = F.raise_error(F.lit(f"several values of {value} at one time: give a sequence")).cast("double")
        pick = F.when(F.min(value) == F.max(value), F.max(value)).otherwise(several)
    return known.groupBy(*keys, time).agg(pick.alias(value))


def fits_broadcast(factors: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the table is small, and no key has many rows (each bar is checked against its key's rows)."""
    size = factors.groupBy(*keys).count().agg(F.sum("count").alias("n"), F.max("count").alias("hot")).first()
    return (size.n or 0) <= BROADCAST_ROWS and (size.hot or 0) <= BROADCAST_ROWS_PER_KEY


def validity_spans(
    points: DataFrame, keys: Sequence[str], time: str, chunk_seconds: int | None = None
) -> DataFrame:
    """Change points to half-open periods ``[valid_from, valid_to)``; the last one is open (NULL)."""
    return with_next_time(points, keys, time, "valid_to", chunk_seconds).withColumnRenamed(time, "valid_from")


def asof_value(
    bars: DataFrame, factors: DataFrame, keys: Sequence[str] = ("symbol",), time: str = "dt",
    factor_time: str = "tradedate", value: str = "adjust_factor", sequence: str | None = None,
    broadcast: bool | None = None, chunk_seconds: int | None = None,
) -> DataFrame:
    """Attach the latest ``value`` whose time is <= the bar's time, NULL before the first one.

    A small factor table is turned into validity intervals and broadcast, so the bars are not shuffled
    at all. Its size is always counted first; a larger table (or any, with ``broadcast=False``) is merged with the
    bars in time order per (key, chunk), which stays linear however many factors a key has. Bars without a key or time get NULL.
    """
    keys = list(keys)
    points = latest_factors(factors, keys, factor_time, value, sequence)
    if broadcast is False or not fits_broadcast(points, keys):
        return asof_merge(bars, points, keys, time, factor_time, value, chunk_seconds)
    spans = validity_spans(points, keys, factor_time, WHOLE).withColumnsRenamed(
        {**{k: f"_k_{k}" for k in keys}, "valid_from": "_from", "valid_to": "_to"}
    )
    cond = (F.col(time) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(time) < F.col("_to")))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_k_{k}"))
    return bars.join(F.broadcast(spans), cond, "left").drop(*[f"_k_{k}" for k in keys], "_from", "_to")


def asof_adjust(
    bars: DataFrame, factors: DataFrame, method: str = "multiply", sequence: str | None = None,
    broadcast: bool | None = None, chunk_seconds: int | None = None,
) -> DataFrame:
    """Multiply price columns by, or reduce them by, the factor in force at each bar's time."""
    if method not in ("multiply", "minus"):
        raise ValueError(f"method must be 'multiply' or 'minus', not {method!r}")
    factors = factors.select("symbol", "tradedate", "adjust_factor", *([sequence] if sequence else []))
    factors = factors.withColumnRenamed("adjust_factor", "_factor")
    out = asof_value(bars, factors, value="_factor", sequence=sequence, broadcast=broadcast, chunk_seconds=chunk_seconds)
    columns = [c for c in bars.columns if c in ADJUSTABLE]
    if method == "multiply":
        new = {c: F.col(c) * F.coalesce("_factor", F.lit(1.0)) for c in columns}
    else:
        new = {c: F.col(c) - F.coalesce("_factor", F.lit(0.0)) for c in columns}
    return out.withColumns(new).select(*bars.columns)
