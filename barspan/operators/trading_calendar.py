"""Trading-calendar queries and the calendar dimension."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspan.functions.predicates import in_range, time_literal

OPEN = 1


def open_days(calendar: DataFrame, start: Any = None, end: Any = None) -> DataFrame:
    """Trading days in order, optionally from / to a time, both included."""
    lo = None if start is None else time_literal(start)
    hi = None if end is None else time_literal(end)
    return calendar.where((F.col("status") == OPEN) & in_range(F.col("day"), lo, hi)).select("day", "status").orderBy("day")


def last_and_next_open(calendar: DataFrame, at: Any) -> DataFrame:
    """One row: the last trading day <= ``at`` and the next one > ``at``; NULL if there is none."""
    day, t = F.col("day"), time_literal(at)
    return calendar.where(F.col("status") == OPEN).agg(
        F.max(F.when(day <= t, day)).alias("last_day"), F.min(F.when(day > t, day)).alias("next_day")
    )


def align_to_calendar(df: DataFrame, calendar: DataFrame, time: str = "dt") -> DataFrame:
    """Attach ``prev_day`` (<= time) and ``next_day`` (> time) to every row.

    Each open day holds until the next one. These spans are laid out by date once (a window over the open days alone, one row
    each), so the rows need only an equi-join on their date. Rows before the first or after the last open day get the edges.
    """
    opens = calendar.where(F.col("status") == OPEN).select(F.to_date("day").alias("_prev")).distinct()
    spans = opens.withColumn("_next", F.lead("_prev").over(Window.orderBy("_prev")))
    until = F.coalesce(F.date_sub("_next", 1), "_prev")
    by_date = spans.withColumn("_date", F.explode(F.sequence("_prev", until)))
    edge = opens.agg(F.min("_prev").alias("first"), F.max("_prev").alias("last")).select(F.struct("*")).scalar()
    joined = df.withColumn("_date", F.to_date(time)).join(by_date, "_date", "left")
    prev_day = F.when(F.col("_date") > edge["last"], edge["last"]).otherwise(F.col("_prev"))
    next_day = F.when(F.col("_date") < edge["first"], edge["first"]).otherwise(F.col("_next"))
    return joined.withColumns(
        {"prev_day": prev_day.cast("timestamp_ntz"), "next_day": next_day.cast("timestamp_ntz")}
    ).drop("_date", "_prev", "_next")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def calendar_dimension(days: DataFrame, day: str = "day") -> DataFrame:
    """Calendar attributes of each date in ``days``."""
    d = F.col(day).cast("date")
    jan1 = F.trunc(d, "year")
    first = F.lit("0001-01-01").cast("date")
    return days.select(
        d.alias("day"),
        iso_year(d).alias("iso_year"),
        F.extract(F.lit("WEEK"), d).alias("iso_week"),
        F.extract(F.lit("DAYOFWEEK_ISO"), d).alias("iso_weekday"),
        (F.datediff(d, first) + 1).alias("ordinal"),
        (F.dayofyear(F.last_day(F.add_months(jan1, 11))) == 366).alias("leap_year"),
        F.day(F.last_day(d)).alias("days_in_month"),
        (F.dayofyear(F.trunc(d, "month")) - 1).alias("days_before_month"),
        F.datediff(jan1, first).alias("days_before_year"),
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
    )


def date_range(start: Column, end: Column, one_row: DataFrame) -> DataFrame:
    """All dates from ``start`` to ``end``, both columns of the single row ``one_row``."""
    return one_row.select(F.explode(F.sequence(start, end)).alias("day"))
