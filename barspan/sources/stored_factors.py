"""Forward-adjusted reads of some days of a long store, anchored to each symbol's newest stored row.

The factor of a row is a product over all later rows, so a read of a few old days would go over the history behind them. Here the
products of each period are kept beside the day store, one line per (symbol, period). A read opens the asked days, the key
columns of what is left of the last asked period, and the lines of later periods. Lines of consecutive stretches are joined by one rule at
every level, rows to days to periods to the rest of the store, so a busy symbol never meets in one task beyond a day's rows.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspan.operators.adjust import OHLC, forward_adjust
from barspan.operators.chunks import TIE, at, with_tie
from barspan.sources.day_files import DAY_COLUMN, list_days, read_days, with_unit_day
from barspan.sources.exchange import change, recover
from barspan.sources.files import exists, list_names, read_text, write_text

_PERIOD = "period"
_COVERED = "_covered.json"
_ASKED = "_read_asked"
_EPOCH = date(1970, 1, 1)


def _period_of(day: str, period_days: int) -> str:
    """First day of the period of a day; periods are counted from 1970."""
    n = (date.fromisoformat(day) - _EPOCH).days
    return (_EPOCH + timedelta(days=n - n % period_days)).isoformat()


def _joined(lines: DataFrame, group: Sequence[str], order: Column) -> DataFrame:
    """Lines of consecutive stretches to one per group: preclose of its first row, close of its last, and the product of the known
    ratios (preclose by previous close) inside it. A row is a line of itself with the product 1."""
    between = F.try_divide("first_preclose", F.lag("last_close").over(Window.partitionBy(*group).orderBy(order)))
    return lines.withColumn("_between", between).groupBy(*group).agg(
        F.min_by(F.struct("first_preclose"), order)["first_preclose"].alias("first_preclose"),
        F.max_by(F.struct("last_close"), order)["last_close"].alias("last_close"),
        (F.coalesce(F.product("inner"), F.lit(1.0)) * F.coalesce(F.product("_between"), F.lit(1.0))).alias("inner"),
    )


def _stored_state(spark: SparkSession, products: str) -> tuple[int | None, dict[str, list[str]]]:
    """(days per period, period -> days its lines cover)."""
    recover(spark, products)
    if not exists(spark, f"{products}/{_COVERED}"):
        return None, {}
    state = json.loads(read_text(spark, f"{products}/{_COVERED}"))
    return state["period_days"], state["periods"]


def _by_period(days: Iterable[str], period_days: int) -> dict[str, list[str]]:
    found = defaultdict(list)
    for day in days:
        found[_period_of(day, period_days)].append(day)
    return dict(found)


def write_products(
    spark: SparkSession, path: str, products: str, period_days: int = 91, changed: Sequence[str] = (), time: str = "dt",
    sequence: str | None = None,
) -> list[str]:
    """Bring the lines beside the day store at ``path`` up to date and return the periods that were computed.

    Periods whose list of stored days differs from the one covered are computed anew, and those of the ``changed`` days, which whoever changes rows within
    a stored day must name. Other days are not opened. ``period_days`` must be that of the first call. Lines are exchanged by a journal.
    """
    known_days, covered = _stored_state(spark, products)
    if known_days not in (None, period_days):
        raise ValueError(f"{products} has periods of {known_days} days, not {period_days}")
    stored = _by_period(list_days(spark, path), period_days)
    touched = {_period_of(d, period_days) for d in changed}
    renewed = sorted(p for p in {*stored, *covered} if p in touched or stored.get(p) != covered.get(p))
    if not renewed:
        return []
    days = [d for p in renewed for d in stored.get(p, ())]
    with change(spark, products) as planned:
        if days:
            lines = _period_lines(with_unit_day(read_days(spark, path, days)), period_days, time, sequence)
            lines.hint("rebalance", _PERIOD).write.partitionBy(_PERIOD).parquet(f"{planned.new}/lines")
        here = set(list_names(spark, products))
        made = set(list_names(spark, f"{planned.new}/lines"))
        write_text(spark, f"{planned.new}/{_COVERED}", json.dumps({"period_days": period_days, "periods": stored}))
        # The list goes away first and comes back last: between the two no reader takes old lines for new ones.
        names = [_COVERED, *(f"{_PERIOD}={p}" for p in renewed)]
        for name in names:
            if name in here:
                planned.take_out(name)
        for name in names[1:]:
            if name in made:
                planned.put_in(f"lines/{name}", name)
        planned.put_in(_COVERED, _COVERED)
    return renewed


def _period_lines(rows: DataFrame, period_days: int, time: str, sequence: str | None) -> DataFrame:
    day = F.col(DAY_COLUMN)
    offset = F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(period_days))
    keyed = with_tie(rows.select(*dict.fromkeys(["symbol", time, "close", "preclose", DAY_COLUMN, *([sequence] if sequence else [])])), sequence)
    single = keyed.select(
        "symbol", DAY_COLUMN, at(time, TIE).alias("_order"), F.col("preclose").alias("first_preclose"), F.col("close").alias("last_close"),
        F.lit(1.0).alias("inner"),
    )
    daily = _joined(single, ["symbol", DAY_COLUMN], F.col("_order")).withColumn(_PERIOD, F.date_sub(day, offset))
    return _joined(daily, ["symbol", _PERIOD], F.col(DAY_COLUMN))


def read_adjusted(
    spark: SparkSession, path: str, products: str, days: Sequence[str], fields: Sequence[str] | None = None, time: str = "dt",
    sequence: str | None = None, chunk_seconds: int | None = None,
) -> DataFrame:
    """The given days with ``adjust_factor`` and ``adj_*``, as if ``forward_adjust`` had run over the whole store.

    ``fields`` must hold symbol, time, close and preclose. Days between the asked ones are read with the key columns alone, as is what
    is left of the last asked period. Rows must be in time order by day: no time of a day lies behind its period. ValueError if a later period's lines do
    not cover its stored days; an empty list of days gives no rows.
    """
    needed = list(dict.fromkeys(["symbol", time, "close", "preclose", *([sequence] if sequence else [])]))
    if fields is not None and not set(needed) <= set(fields):
        raise ValueError(f"adjusted reads need {needed} among the fields")
    asked = sorted(set(map(str, days)))
    rows = read_days(spark, path, asked, fields).withColumn(_ASKED, F.lit(True))
    columns = rows.columns[:-1]
    if asked:
        period_days, covered = _stored_state(spark, products)
        if period_days is None:
            raise ValueError(f"no products at {products}: write them first")
        stored = list_days(spark, path)
        last = _period_of(asked[-1], period_days)
        rest = [d for d in stored if asked[0] <= d and _period_of(d, period_days) <= last and d not in set(asked)]
        later = {p: ds for p, ds in _by_period(stored, period_days).items() if p > last}
        stale = sorted(p for p in {*later, *covered} if p > last and later.get(p) != covered.get(p))
        if stale:
            raise ValueError(f"the products at {products} are older than the store in the periods from {stale}")
        if rest:
            rows = rows.unionByName(read_days(spark, path, rest, needed), allowMissingColumns=True)
        if later:
            ends = _later_rows(spark, products, sorted(later), rows.schema[time].dataType.simpleString(), time)
            rows = rows.unionByName(ends, allowMissingColumns=True)
    adjusted = forward_adjust(rows, ("symbol",), time, chunk_seconds, sequence).where(F.coalesce(_ASKED, F.lit(False)))
    return adjusted.select(*columns, "adjust_factor", *[f"adj_{c}" for c in OHLC if c in columns])


def _later_rows(spark: SparkSession, products: str, periods: Sequence[str], time_type: str, time: str) -> DataFrame:
    """Two rows per symbol that stand for all its rows in ``periods``: the first one's ratio to the row before it is the ratio over the
    border, unknown if that is; the second one's is the product inside."""
    lines = spark.read.option("basePath", products).parquet(*[f"{products}/{_PERIOD}={p}" for p in periods])
    ends = _joined(lines.withColumn(_PERIOD, F.col(_PERIOD).cast("date")), ["symbol"], F.col(_PERIOD))
    step = F.explode(F.array(
        F.struct(F.lit(0).alias("after"), F.col("first_preclose").alias("preclose"), F.lit(1.0).alias("close")),
        F.struct(F.lit(1).alias("after"), F.col("inner").alias("preclose"), F.lit(None).cast("double").alias("close")),
    ))
    # Behind all rows of earlier periods.
    begin = F.date_add(F.lit(periods[0]).cast("date"), F.col("_step.after"))
    return ends.withColumn("_step", step).select("symbol", begin.cast(time_type).alias(time), "_step.preclose", "_step.close")
