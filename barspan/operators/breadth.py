"""Market statistics per trading day."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspan.functions.predicates import EXCLUDED_CONCEPTS, price_return, regular_name, time_literal
from barspan.operators.chunks import rolling_max, run_lengths
from barspan.operators.membership import members_at_rows, membership_spans
from barspan.sources.reads import best_rows, last_rows


def listed_only(bars: DataFrame, basic_info: DataFrame | None) -> DataFrame:
    """Bars of symbols that basic info lists."""
    if basic_info is None:
        return bars
    return bars.join(basic_info.select("symbol").distinct(), "symbol", "left_semi")


def market_breadth(bars: DataFrame, pct: float, basic_info: DataFrame | None = None) -> DataFrame:
    """Per day: share of regular stocks whose return exceeds ``pct``; an unknown return (NULL or NaN) counts as not exceeding."""
    change = price_return(F.col("close"), F.col("preclose"))
    exceeds = F.nanvl(change, F.lit(None).cast("double")) > pct
    return (
        listed_only(bars, basic_info)
        .where(regular_name(F.col("name")))
        .groupBy("dt")
        .agg(F.avg(F.when(exceeds, 1.0).otherwise(0.0)).alias("ratio_of_perctg_gt"))
    )


def recent_limit_up(bars: DataFrame, n: int = 10, chunk_seconds: int | None = None) -> DataFrame:
    """(symbol, dt) rows whose last ``n`` bars are complete and contain a limit-up."""
    flagged = rolling_max(bars.select("symbol", "dt", "maxupordown"), ["symbol"], "dt", "maxupordown", n, "_max", chunk_seconds)
    return flagged.where(F.col("_max") > 0).select("symbol", "dt")


# Limit states of the daily-bar schema.
LIMIT_UP, ONE_PRICE_UP = 1, 2
LIMIT_DOWN, ONE_PRICE_DOWN = -1, -2


def limit_streaks(bars: DataFrame, chunk_seconds: int | None = None, sequence: str | None = None) -> DataFrame:
    """The bars with ``lb_up_count`` and ``lb_down_count`` from ``maxupordown``: on which limit-up (limit-down) in a row a stock is, 0 without one.

    A bar with an unknown state ends a streak; days without a bar do not. One-price limits count.
    """
    state = F.col("maxupordown")
    runs = {"lb_up_count": state.isin(LIMIT_UP, ONE_PRICE_UP), "lb_down_count": state.isin(LIMIT_DOWN, ONE_PRICE_DOWN)}
    out = run_lengths(bars.drop(*runs), ["symbol"], "dt", runs, chunk_seconds, sequence)
    return out.withColumns({n: F.col(n).cast("int") for n in runs})


def limit_up_concepts(
    bars: DataFrame, log: DataFrame, m: int, n: int = 10, days: Sequence[Any] | None = None,
    basic_info: DataFrame | None = None, excluded: Sequence[str] = EXCLUDED_CONCEPTS,
) -> DataFrame:
    """Per day the ``m`` concepts shared by most stocks with a limit-up in their last ``n`` bars.

    Membership is taken at each day itself. ``days`` restricts the reported days, not the look-back.
    """
    if days is None:
        horizon = bars.agg(F.max("dt").alias("dt"))
    else:
        # Nothing after the last asked day counts. There is no lower bound: the look-back is by rows.
        wanted = [time_literal(d) for d in days]
        last = F.greatest(*wanted) if len(wanted) > 1 else (wanted or [time_literal(None)])[0]
        bars, log = bars.where(F.col("dt") <= last), log.where(F.col("tradedate") <= last)
        horizon = bars.sparkSession.range(1).select(last.alias("dt"))
    hits = recent_limit_up(listed_only(bars, basic_info), n)
    if days is not None:
        hits = hits.where(F.col("dt").isin(wanted) if wanted else F.lit(False))
    spans = membership_spans(log.where(~F.col("index_code").isin(list(excluded))))
    held = members_at_rows(hits, spans, horizon, stock="symbol")
    counts = held.groupBy("dt", "index_code").agg(F.count(F.lit(1)).alias("n_stocks"))
    order = [F.col("n_stocks").desc(), F.col("index_code")]
    best = best_rows(counts, m, "dt", *order)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("dt").orderBy(*order)))


def top_n_with_ties(df: DataFrame, n: int, by: str, value: str) -> DataFrame:
    """Rows whose value is among the ``n`` largest of their ``by`` group, all ties included.

    The n-th largest value per group is found with a limit that works on the map side; the rows are then
    compared with it in a join, which run-time skew handling can split. So a group with any number of
    rows or ties never has to pass through one task.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    threshold = (
        best_rows(known.select(by, value), n, by, F.col(value).desc())
        .groupBy(F.col(by).alias("_by"))
        .agg(F.min(value).alias("_least"))
    )
    cond = (F.col(by) == F.col("_by")) & (F.col(value) >= F.col("_least"))
    return known.join(threshold, cond, "left_semi")


def top_rank_concepts(
    index_bars: DataFrame, top_n: int, m: int, until: Any = None, excluded: Sequence[str] = EXCLUDED_CONCEPTS
) -> DataFrame:
    """Concepts that were among the ``top_n`` gainers on any of their last ``m`` days up to a time."""
    bars = index_bars.where(~F.col("symbol").isin(list(excluded))).select("symbol", "dt", "pct_change")
    if until is not None:
        bars = bars.where(F.col("dt") <= time_literal(until))
    recent = last_rows(bars, m)
    return top_n_with_ties(recent, top_n, "dt", "pct_change").select("symbol").distinct()


def hot_list(ranked: DataFrame, top_n: int, date: Any = None) -> DataFrame:
    """The ``top_n`` entries with the smallest ``order`` of one date, or of every date (ties by symbol)."""
    if date is not None:
        return ranked.where(F.col("date") == time_literal(date)).orderBy("order", "symbol").limit(top_n)
    return best_rows(ranked, top_n, "date", F.col("order"), F.col("symbol"))


def market_stats(bars: DataFrame) -> DataFrame:
    """Per day, without special-treatment names: limit-up/down counts and ratios, and the ``lb`` ladder.

    ``lb[i]`` is the number of stocks on their (i+1)-th limit-up in a row. One-price limits are counted
    as limits too.
    """
    state = F.col("maxupordown")
    flags: dict[str, Column] = {
        "uplimit": state.isin(LIMIT_UP, ONE_PRICE_UP),
        "downlimit": state.isin(LIMIT_DOWN, ONE_PRICE_DOWN),
        "yiziup": state == ONE_PRICE_UP,
        "yizidown": state == ONE_PRICE_DOWN,
    }
    # First per (dt, step), which is combined on the map side; a day then has at most one row per step.
    steps = (
        bars.where(regular_name(F.col("name")))
        .groupBy("dt", F.coalesce(F.col("lb_up_count").cast("int"), F.lit(0)).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in flags.items()])
    )
    ladder = F.map_from_entries(F.collect_list(F.when(F.col("step") > 0, F.struct("step", "n"))))
    days = steps.groupBy("dt").agg(
        F.sum("n").alias("_n"),
        *[F.sum(k).alias(f"count_of_{k}") for k in flags],
        ladder.alias("_ladder"),
        F.max("step").alias("_top"),
    )
    height = F.when(F.col("_top") > 0, F.sequence(F.lit(1), F.col("_top"))).otherwise(F.array().cast("array<int>"))
    lb = F.transform(height, lambda i: F.coalesce(F.try_element_at("_ladder", i), F.lit(0)).cast("smallint"))
    return days.select(
        "dt",
        *[F.col(f"count_of_{k}").cast("int").alias(f"count_of_{k}") for k in flags],
        *[(F.col(f"count_of_{k}") / F.col("_n")).alias(f"ratio_of_{k}") for k in flags],
        lb.alias("lb"),
    )
