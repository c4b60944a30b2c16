"""Point-in-time index and concept membership from an add/remove log.

The log has (index_code, stock_code, tradedate, op, seq); op 1 adds, anything else removes.
Replaying it comes down to the last operation of each (index, stock) pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspan.functions.predicates import EXCLUDED_CONCEPTS, time_literal
from barspan.operators.chunks import CHUNK, DAY, time_chunk
from barspan.sources.files import list_names

_PAIR = ["index_code", "stock_code"]
QUARTER = 92 * DAY


def members(
    log: DataFrame, at: Any, index_codes: Sequence[str] | None = None, stock_codes: Sequence[str] | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """(index_code, stock_code) pairs that are members at a time; restricting codes reach the scan."""
    log = log.where(F.col("tradedate") <= time_literal(at))
    if index_codes is not None:
        log = log.where(F.col("index_code").isin(list(index_codes)))
    if stock_codes is not None:
        log = log.where(F.col("stock_code").isin(list(stock_codes)))
    if excluded:
        log = log.where(~F.col("index_code").isin(list(excluded)))
    # max_by is combined on the map side: one line per pair and task is shuffled, however often a pair changes.
    last = log.groupBy(*_PAIR).agg(F.max_by("op", F.struct("tradedate", "seq")).alias("op"))
    return last.where(F.col("op") == 1).select(*_PAIR)


def indexes_of_stocks(log: DataFrame, at: Any, stock_codes: Sequence[str] | None = None,
                      excluded: Sequence[str] = EXCLUDED_CONCEPTS) -> DataFrame:
    """Indexes each stock belongs to at a time, without the excluded concepts."""
    return members(log, at, stock_codes=stock_codes, excluded=excluded)


def in_concepts(stocks: DataFrame, log: DataFrame, at: Any, concept_codes: Sequence[str],
                excluded: Sequence[str] = EXCLUDED_CONCEPTS) -> DataFrame:
    """Stocks that belong to any of the concepts at a time; an empty concept list leaves them unchanged."""
    if not concept_codes:
        return stocks
    # Only the listed concepts can match, so only their log entries are replayed.
    eligible = members(log, at, index_codes=concept_codes, excluded=excluded).select("stock_code").distinct()
    return stocks.join(eligible, "stock_code", "left_semi")


def top_concepts(stocks: DataFrame, log: DataFrame, at: Any, limit: int | None = None,
                 excluded: Sequence[str] = EXCLUDED_CONCEPTS) -> DataFrame:
    """How many of the stocks each concept holds at a time, most frequent first (ties by code)."""
    held = stocks.join(indexes_of_stocks(log, at, excluded=excluded), "stock_code")
    counts = held.groupBy("index_code").agg(F.count(F.lit(1)).alias("n_stocks"))
    ordered = counts.orderBy(F.col("n_stocks").desc(), "index_code")
    return ordered.limit(limit) if limit else ordered


def concepts_per_stock(stocks: DataFrame, log: DataFrame, at: Any,
                       excluded: Sequence[str] = EXCLUDED_CONCEPTS) -> DataFrame:
    """Each stock with its sorted concept codes, ``[]`` if it has none.

    The array holds at most one entry per existing concept, since pairs are unique after the replay.
    """
    lists = indexes_of_stocks(log, at, excluded=excluded).groupBy("stock_code").agg(
        F.array_sort(F.collect_list("index_code")).alias("concepts")
    )
    return stocks.join(lists, "stock_code", "left").withColumn(
        "concepts", F.coalesce("concepts", F.array().cast("array<string>"))
    )


def membership_spans(log: DataFrame) -> DataFrame:
    """Half-open membership periods ``[valid_from, valid_to)`` per pair; an open end is NULL.

    Operations of one date are reduced to the last one before the window, which leaves at most one
    row per pair and date.
    """
    daily = log.groupBy(*_PAIR, "tradedate").agg(F.max_by("op", "seq").alias("op"))
    following = F.lead("tradedate").over(Window.partitionBy(*_PAIR).orderBy("tradedate"))
    return (
        daily.withColumn("valid_to", following)
        .where(F.col("op") == 1)
        .select(*_PAIR, F.col("tradedate").alias("valid_from"), "valid_to")
    )


def members_at_rows(rows: DataFrame, spans: DataFrame, horizon: DataFrame, time: str = "dt",
                    stock: str = "stock_code", chunk_seconds: int = QUARTER) -> DataFrame:
    """Join each row with the indexes its stock belongs to at the row's own time.

    Spans are laid out over the time chunks they cover up to ``horizon`` (one row, one time: the end of
    the rows), so the join has (stock, chunk) as equality keys and compares a span only with the rows of
    its own chunk. The spans of a pair never overlap, so the layout has at most one line per pair and
    chunk plus one per operation.
    """
    first = time_chunk(F.col("valid_from"), chunk_seconds)
    # Open spans end at the horizon, and no chunk beyond it holds rows.
    last = F.least(time_chunk(F.coalesce("valid_to", horizon.scalar()), chunk_seconds), time_chunk(horizon.scalar(), chunk_seconds))
    laid_out = (
        spans.withColumnRenamed("stock_code", "_stock")
        .withColumns({"_first": first, "_last": last})
        .where(F.col("_first") <= F.col("_last"))
        .withColumn("_span_chunk", F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last")
    )
    keyed = rows.withColumn(CHUNK, time_chunk(F.col(time), chunk_seconds))
    cond = (
        (F.col(stock) == F.col("_stock"))
        & (F.col(CHUNK) == F.col("_span_chunk"))
        & (F.col(time) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col(time) < F.col("valid_to")))
    )
    # Spark's size estimate does not count what explode() adds, so a broadcast must not be planned from it.
    return keyed.join(laid_out.hint("merge"), cond).drop(CHUNK, "_span_chunk", "_stock", "valid_from", "valid_to")


_SNAPSHOT = "snapshot"


def write_snapshots(log: DataFrame, path: str, months: int = 3) -> None:
    """Store a membership log for reads at a time: the log by period of ``months``, and the last operation of every pair before each period.

    ``<path>/log`` is partitioned by the first day of the period, ``<path>/state`` holds for each period what the earlier ones left. A pair has
    a line in a period's state from its first operation on, so the states grow with pairs times periods, not with operations.
    """
    period = _period(F.col("tradedate"), months)
    rows = log.where(F.col("tradedate").isNotNull()).withColumn(_SNAPSHOT, period)
    rows.repartitionByRange(_SNAPSHOT, *_PAIR, "tradedate").write.mode("overwrite").partitionBy(_SNAPSHOT).parquet(f"{path}/log")
    spark = log.sparkSession
    periods = _stored_periods(spark, path)
    if periods:
        states = _states(spark.read.parquet(f"{path}/log"), periods)
        states.repartitionByRange(_SNAPSHOT, *_PAIR).write.mode("overwrite").partitionBy(_SNAPSHOT).parquet(f"{path}/state")


def _stored_periods(spark: SparkSession, path: str) -> list[date]:
    """From the folders' names: one per period."""
    return [date.fromisoformat(n.split("=")[1]) for n in list_names(spark, f"{path}/log") if n.startswith(f"{_SNAPSHOT}=")]


def _period(time: Column, months: int) -> Column:
    """First day of the period of a time; periods are counted from 1970."""
    number = F.floor(((F.year(time) - 1970) * 12 + F.month(time) - 1) / months)
    return F.add_months(F.lit("1970-01-01").cast("date"), (number * months).cast("int"))


def _states(log: DataFrame, periods: Sequence[date]) -> DataFrame:
    """(pair, tradedate, seq, op, snapshot): the last operation of each pair before each period that has a log.

    Operations of a pair are reduced to the last one of each period; each is the state of the periods behind it up to the next one's.
    """
    last = log.groupBy(*_PAIR, _SNAPSHOT).agg(F.max_by(F.struct("tradedate", "seq", "op"), F.struct("tradedate", "seq")).alias("_last"))
    following = F.lead(_SNAPSHOT).over(Window.partitionBy(*_PAIR).orderBy(_SNAPSHOT))
    spans = last.select(*_PAIR, "_last.*", F.col(_SNAPSHOT).alias("_own"), following.alias("_next"))
    every = F.array(*map(F.lit, periods))
    covered = F.filter(every, lambda p: (p > F.col("_own")) & (F.col("_next").isNull() | (p <= F.col("_next"))))
    return spans.withColumn(_SNAPSHOT, F.explode(covered)).drop("_own", "_next")


def members_from_snapshots(
    spark: SparkSession, path: str, at: Any, index_codes: Sequence[str] | None = None, stock_codes: Sequence[str] | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """As ``members``, from a stored log: one period's state and that period's log are read, earlier and later partitions are not opened.

    The period is found among the folders' names. Operations from the period's start up to the time are replayed onto the state.
    """
    asked = spark.range(1).select(F.to_date(time_literal(at)).alias("day")).first().day
    reached = [p for p in _stored_periods(spark, path) if asked is not None and p <= asked]
    if not reached:
        return spark.createDataFrame([], "index_code string, stock_code string")
    log = spark.read.parquet(f"{path}/log")
    chosen = F.col(_SNAPSHOT) == F.lit(max(reached))
    rows = log.where(chosen).select(*_PAIR, "tradedate", "op", "seq")
    if len(reached) > 1:
        rows = rows.unionByName(spark.read.parquet(f"{path}/state").where(chosen).select(*_PAIR, "tradedate", "op", "seq"))
    return members(rows, at, index_codes, stock_codes, excluded)
