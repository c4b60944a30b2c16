"""Reads from registered tables: projections, predicates, time ranges, first and last rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspan.functions.predicates import as_literal, in_range, time_literal
from barspan.operators.adjust import asof_adjust
from barspan.operators.chunks import with_position

_SHARES = 64


def map_side_limit(spark: SparkSession) -> int:
    """The largest n up to which Spark limits ``row_number() <= n`` before the shuffle."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def best_rows(df: DataFrame, n: int, by: str, *order: Column) -> DataFrame:
    """The first ``n`` rows of every ``by`` group in a total ``order``.

    Beyond the map-side limit each group is ranked in shares first, so no task has to take a whole one.
    """
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if n > map_side_limit(df.sparkSession):
        shares = df.withColumn("_share", F.pmod(F.xxhash64(*df.columns), F.lit(_SHARES)))
        df = shares.withColumn("_rank", rank(by, "_share")).where(F.col("_rank") <= n).drop("_share", "_rank")
    return df.withColumn("_rank", rank(by)).where(F.col("_rank") <= n).drop("_rank")


def project(df: DataFrame, fields: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Keep the listed fields (``None`` keeps all), then leave out ``exclude``."""
    return (df.select(*fields) if fields else df).drop(*exclude)


def read_table(spark: SparkSession, table: str, fields: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
    """A registered table, optionally filtered by SQL predicate text and projected."""
    df = spark.table(table)
    return project(df.where(where) if where else df, fields)


def filter_project(df: DataFrame, where: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    return project(df.where(where) if where else df, fields)


def time_range(
    df: DataFrame, start: Any = None, end: Any = None, side: str | None = "both", fields: Sequence[str] | None = None,
    time: str = "dt",
) -> DataFrame:
    """Rows whose time lies in the range; ``side`` tells which ends belong to it."""
    lo = None if start is None else time_literal(start)
    hi = None if end is None else time_literal(end)
    return project(df.where(in_range(F.col(time), lo, hi, side)), fields)


def last_rows_of_table(
    df: DataFrame, n: int = 1, fields: Sequence[str] | None = None, until: Any = None, inclusive: bool = True,
    order: Sequence[str] = ("dt",),
) -> DataFrame:
    """The ``n`` newest rows of the whole table, oldest first."""
    if until is not None:
        df = time_range(df, end=until, side="right" if inclusive else None, time=order[0])
    newest = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return project(newest.orderBy(*order), fields)


def last_rows(
    df: DataFrame, n: int = 1, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("dt",),
    chunk_seconds: int | None = None,
) -> DataFrame:
    """The ``n`` newest rows of every key."""
    return _edge_rows(df, n, keys, order, chunk_seconds, newest=True)


def first_rows(
    df: DataFrame, n: int = 1, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("dt",),
    chunk_seconds: int | None = None,
) -> DataFrame:
    """The ``n`` oldest rows of every key."""
    return _edge_rows(df, n, keys, order, chunk_seconds, newest=False)


def _edge_rows(df, n, keys, order, chunk_seconds, newest) -> DataFrame:
    if n > map_side_limit(df.sparkSession):
        ranked = with_position(df, keys, order, "_rank", chunk_seconds, newest_first=newest)
    else:
        direction = [F.col(c).desc() if newest else F.col(c).asc() for c in order]
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*direction)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def capped_range(
    df: DataFrame, start: Any = None, end: Any = None, max_count: int | None = None, side: str | None = "both",
    keys: Sequence[str] = ("symbol",), time: str = "dt",
) -> DataFrame:
    """A time range with at most ``max_count`` rows per key: the newest if it has an end, else the oldest."""
    df = time_range(df, start, end, side, time=time)
    if not max_count:
        return df
    pick = last_rows if end is not None else first_rows
    return pick(df, max_count, keys, [time])


def klines(
    bars: DataFrame, symbols: Sequence[str] | None = None, intervals: Sequence[str] | None = None,
    max_count: int | None = None, start: Any = None, end: Any = None, factors: DataFrame | None = None,
    method: str = "multiply", sequence: str | None = None,
) -> DataFrame:
    """Bars of symbols and intervals in one plan: range, cap per (symbol, interval), then adjustment.

    Of several factors of one time the one with the highest ``sequence`` counts; without a sequence they are an error.

    The cap comes first: adjustment works row by row, so it only has to see the rows that stay.
    """
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(list(symbols)))
    if intervals is not None:
        bars = bars.where(F.col("interval").isin(list(intervals)))
    bars = capped_range(bars, start, end, max_count, keys=("symbol", "interval"))
    return bars if factors is None else asof_adjust(bars, factors, method, sequence)


def cross_section(
    df: DataFrame, at: Any, tags: Mapping[str, Sequence[Any]] | None = None, fields: Sequence[str] | None = None,
    time: str = "dt",
) -> DataFrame:
    """All rows at one time whose tags are in the given lists."""
    conds = [F.col(time) == time_literal(at)] + [F.col(k).isin(list(v)) for k, v in (tags or {}).items()]
    return project(df.where(reduce(lambda a, b: a & b, conds)), fields)


# Comparison operators of document queries.
_COMPARE = {
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lte": lambda c, v: c <= v,
}


def _document_predicate(query: Mapping[str, Any]):
    cond = F.lit(True)
    for key, wanted in query.items():
        if key == "$and":
            part = reduce(lambda a, b: a & b, [_document_predicate(q) for q in wanted])
        elif isinstance(wanted, Mapping):
            unknown = set(wanted) - set(_COMPARE)
            if unknown:
                raise ValueError(f"unsupported query operators: {sorted(unknown)}")
            part = reduce(lambda a, b: a & b, [_COMPARE[op](F.col(key), as_literal(v)) for op, v in wanted.items()])
        else:
            part = F.col(key).isNull() if wanted is None else F.col(key) == as_literal(wanted)
        cond = cond & part
    return cond


def find(
    df: DataFrame, query: Mapping[str, Any] | None = None, projection: Mapping[str, Any] | None = None,
    sort: Sequence[tuple[str, int]] | None = None, limit: int | None = None,
) -> DataFrame:
    """Document-style find: query by example, include or exclude projection, sort and limit."""
    if query:
        df = df.where(_document_predicate(query))
    if sort:
        df = df.orderBy(*[F.col(c).asc() if direction > 0 else F.col(c).desc() for c, direction in sort])
    if limit:
        df = df.limit(limit)
    if projection:
        included = [c for c, on in projection.items() if on]
        df = df.select(*included) if included else df.drop(*projection)
    return df


def symbol_names(info: DataFrame) -> DataFrame:
    """Symbol -> name lookup."""
    return info.select("symbol", "name")
