"""Bars at coarser intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspan.operators.adjust import forward_adjust

# Calendar periods: weeks start on Monday.
_PERIODS = {"1d": "day", "1w": "week", "1mo": "month"}
_UNITS = {"min": "minutes", "h": "hours"}


def _window_text(freq: str) -> str:
    for unit, word in _UNITS.items():
        if freq.endswith(unit) and freq[: -len(unit)].isdigit():
            return f"{freq[: -len(unit)]} {word}"
    raise ValueError(f"unknown frequency {freq!r}")


def _known(price: Column) -> Column:
    """NaN sorts above every number and would be the highest price of its period: it counts as unknown."""
    return F.nanvl(price.cast("double"), F.lit(None).cast("double"))


def _bars(
    df: DataFrame, freq: str, time: str, prices: list[Column], suffix: str, extra: dict, sequence: str | None
) -> DataFrame:
    o, h, lo, c = map(_known, prices)
    df = df.withColumn("_at", F.col(time))
    # Of rows with equal times the sequence tells which is first.
    order = F.struct("_at", *([sequence] if sequence else []))
    if freq in _PERIODS:
        day = F.col("_at").cast("date")
        period = (day if freq == "1d" else F.trunc(day, _PERIODS[freq])).cast("timestamp_ntz")
    else:
        df = df.withColumn("_w", F.window("_at", _window_text(freq)))
        period = F.col("_w.start")
    # min_by / max_by combine on the map side and do not depend on arrival order.
    return df.groupBy(F.col("symbol"), period.alias("dt")).agg(
        F.min_by(o, order).alias(f"open{suffix}"),
        F.max(h).alias(f"high{suffix}"),
        F.min(lo).alias(f"low{suffix}"),
        F.max_by(c, order).alias(f"close{suffix}"),
        *[expr.alias(f"{name}{suffix}") for name, expr in extra.items()],
    )


def resample(
    bars: DataFrame, freq: str, time: str = "dt", suffix: str = "", price_prefix: str = "", sequence: str | None = None
) -> DataFrame:
    """OHLCV bars of (symbol, period) from finer bars; ``sequence`` orders rows of equal times."""
    p = [F.col(price_prefix + c) for c in ("open", "high", "low", "close")]
    return _bars(bars, freq, time, p, suffix, {"volume": F.sum("volume"), "amount": F.sum("amount")}, sequence)


def bars_from_ticks(
    ticks: DataFrame, freq: str, price: str = "last_price", time: str = "dt", sequence: str | None = None
) -> DataFrame:
    """OHLCV bars of (symbol, period) from ticks that carry their own volume and amount; ``sequence`` orders ticks of equal times."""
    p = [F.col(price)] * 4
    return _bars(ticks, freq, time, p, "", {"volume": F.sum("volume"), "amount": F.sum("amount")}, sequence)


def resample_adjusted(daily: DataFrame, freq: str) -> DataFrame:
    """Weekly or monthly bars of forward-adjusted daily bars, columns suffixed with the frequency."""
    return resample(forward_adjust(daily), freq, suffix=f"_{freq}", price_prefix="adj_")
