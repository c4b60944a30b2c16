"""Ordered per-key computations that survive a hot key.

A plain ``Window.partitionBy(symbol)`` puts the whole history of a symbol into one
task. That is fine as long as no symbol is hot, so the busiest one is counted first
(or the caller gives a chunk width). Beyond that each key's series is cut into time
chunks, the row work runs per (key, chunk), and only a summary with one line per
(key, chunk) is ordered per key. The number of chunks of a key is bounded by history
length / chunk width, so no task ever holds more than one chunk of rows or one key's
list of chunks. Results do not depend on the chunk width; rows without a time sort first, as in a window.

What a chunk has to know of the rest of its key comes back as extra rows of the same
union ("carried" rows) rather than through a join: the data is shuffled once, NULL keys
need no special care, and the extra rows are dropped after the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3_600
DAY = 86_400
YEAR = 366 * DAY

# Instead of a width: every key is one chunk, so nothing has to be carried over.
WHOLE = 0

# Rows a chunk should hold at most, so that one task sorts it comfortably.
TARGET_ROWS = 2_000_000
_UNEVEN = 4

CHUNK = "_chunk"
CARRIED = "_carried"

# Chunk number of rows without a time: they sort first, as NULLs do.
_NO_TIME = -(1 << 62)


TIE = "_tie"


def at(*order: str) -> Column:
    """The order of rows in ``max_by`` and ``min_by``, which skip rows whose order is NULL: a struct isn't, and a NULL
    time inside it sorts first, as it does in a window."""
    return F.struct(*order)


def with_tie(df: DataFrame, sequence: str | None = None) -> DataFrame:
    """Add what orders rows of equal time: ``sequence``, then a hash of the whole row. Only rows equal in all columns stay tied, so
    any plan orders them alike."""
    rest = F.xxhash64(*df.columns)
    return df.withColumn(TIE, F.struct(F.col(sequence).alias("sequence"), rest.alias("rest")) if sequence else F.struct(rest.alias("rest")))


def time_chunk(time: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide chunk a naive timestamp or date falls into."""
    if seconds == WHOLE:
        return F.lit(0).cast("bigint")
    moment = time.cast("timestamp_ntz")
    # Built from calendar fields, so the session time zone plays no part.
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date"))
    if seconds % DAY == 0:
        number = F.floor(days / F.lit(seconds // DAY))
    else:
        second_of_day = F.hour(moment) * HOUR + F.minute(moment) * 60 + F.second(moment)
        number = F.floor((days.cast("bigint") * DAY + second_of_day) / F.lit(seconds))
    return F.coalesce(number, F.lit(_NO_TIME))


def fitting_width(df: DataFrame, keys: Sequence[str], time: str, target_rows: int = TARGET_ROWS) -> int:
    """A chunk width that fits the data; ``WHOLE`` if no key has more rows than one task sorts comfortably.

    Counts the rows of the busiest key and, only if that is a hot one, of its busiest day. Both are passes
    over keys and times alone, combined on the map side. Only speed depends on the answer: give a width to
    save the count, for instance where ``df`` is expensive to compute.
    """
    if busiest(df, *keys) <= target_rows:
        return WHOLE
    busiest_day = busiest(df, *keys, time_chunk(F.col(time), DAY).alias(CHUNK))
    if busiest_day <= target_rows:
        return DAY
    # Trading is uneven within a day.
    return max(1, DAY * target_rows // (busiest_day * _UNEVEN))


def busiest(df: DataFrame, *groups: str | Column) -> int:
    return df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0


def chunk_window(keys: Sequence[str], *order: Column) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def with_preceding_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], n: int, seconds: int
) -> DataFrame:
    """Add to every chunk the ``n`` rows of the same key that precede it, flagged ``_carried``.

    ``order[0]`` is the time column. Only ``keys``, ``order`` and ``columns`` are filled
    in the carried rows. A window over (keys, chunk) then sees what a window over the
    whole key would see up to ``n`` rows back; drop the carried rows afterwards.
    """
    rows = df.withColumns({CHUNK: time_chunk(F.col(order[0]), seconds), CARRIED: F.lit(False)})
    if seconds == WHOLE or n == 0:
        return rows
    needed = list(dict.fromkeys([*keys, CHUNK, *order, *columns]))
    if n == 1:
        # Combined on the map side. One struct, so that all columns are of one row.
        last = F.max_by(F.struct(*[c for c in needed if c not in (*keys, CHUNK)]), at(*order))
        tails = rows.groupBy(*keys, CHUNK).agg(last.alias("_last")).select(*keys, CHUNK, "_last.*")
    else:
        newest_first = chunk_window(keys, *[F.col(c).desc() for c in order])
        # row_number() <= n is limited on the map side already, so a hot chunk ships n rows per task.
        ranked = rows.select(*needed).withColumn("_back", F.row_number().over(newest_first))
        tails = ranked.where(F.col("_back") <= n).drop("_back")
    per_key = Window.partitionBy(*keys).orderBy(CHUNK, *[F.col(c).asc_nulls_first() for c in order])
    history = F.collect_list(F.struct(*[c for c in needed if c not in (*keys, CHUNK)]))
    carried = (
        tails.select(
            *keys,
            F.col(CHUNK).alias("_own"),
            F.lead(CHUNK).over(per_key).alias(CHUNK),
            history.over(per_key.rowsBetween(1 - n, 0)).alias("_history"),
        )
        .where(F.col(CHUNK) != F.col("_own"))
        .select(*keys, CHUNK, F.inline("_history"))
        .withColumn(CARRIED, F.lit(True))
    )
    return rows.unionByName(carried, allowMissingColumns=True)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], seconds: int | None = None
) -> DataFrame:
    """``lag(column)`` per key for every ``{new name: column}``."""
    seconds = fitting_width(df, keys, order[0]) if seconds is None else seconds
    rows = with_preceding_rows(df, keys, order, list(columns.values()), 1, seconds)
    w = chunk_window(keys, *[F.col(c).asc_nulls_first() for c in order])
    return (
        rows.withColumns({new: F.lag(c).over(w) for new, c in columns.items()}).where(~F.col(CARRIED)).drop(CHUNK, CARRIED)
    )


def with_next_time(df: DataFrame, keys: Sequence[str], time: str, name: str, seconds: int | None = None) -> DataFrame:
    """Time of the key's following row, NULL on the last one."""
    seconds = fitting_width(df, keys, time) if seconds is None else seconds
    rows = df.withColumns({CHUNK: time_chunk(F.col(time), seconds), CARRIED: F.lit(False)})
    if seconds != WHOLE:
        firsts = rows.groupBy(*keys, CHUNK).agg(F.min(time).alias(time))
        following = F.lead(time).over(Window.partitionBy(*keys).orderBy(CHUNK))
        carried = firsts.withColumn(time, following).where(F.col(time).isNotNull()).withColumn(CARRIED, F.lit(True))
        rows = rows.unionByName(carried, allowMissingColumns=True)
    w = chunk_window(keys, F.col(time).asc_nulls_first())
    return rows.withColumn(name, F.lead(time).over(w)).where(~F.col(CARRIED)).drop(CHUNK, CARRIED)


def rolling_max(
    df: DataFrame, keys: Sequence[str], time: str, column: str, n: int, name: str, seconds: int | None = None, sequence: str | None = None,
) -> DataFrame:
    """Maximum of the last ``n`` rows; NULL until all ``n`` values are present. Rows of equal time are ordered by ``sequence``, then by a hash."""
    seconds = fitting_width(df, keys, time) if seconds is None else seconds
    rows = with_preceding_rows(with_tie(df, sequence), keys, [time, TIE], [column], n - 1, seconds)
    w = chunk_window(keys, F.col(time).asc_nulls_first(), F.col(TIE).asc_nulls_first()).rowsBetween(1 - n, 0)
    full = F.when(F.count(column).over(w) == n, F.max(column).over(w))
    return rows.withColumn(name, full).where(~F.col(CARRIED)).drop(CHUNK, CARRIED, TIE)


def run_lengths(
    df: DataFrame, keys: Sequence[str], time: str, runs: dict[str, Column], seconds: int | None = None, sequence: str | None = None
) -> DataFrame:
    """For every ``{new name: condition}``: how many rows in a row, up to and including each one, fulfil the condition (0 where it doesn't, or is NULL).

    Within a chunk a row's run began after the last row that breaks it. If there is none the run reaches back into earlier chunks: what
    they leave comes from a summary with one line per (key, chunk), the rows of the chunk and of the run at its end, and enters
    the chunk as its oldest row. Rows of equal time are ordered by ``sequence``, then by a hash of the row.
    """
    seconds = fitting_width(df, keys, time) if seconds is None else seconds
    names = list(runs)
    rows = with_tie(df, sequence).withColumns({CHUNK: time_chunk(F.col(time), seconds), CARRIED: F.lit(False)})
    rows = rows.withColumns({f"_hit_{n}": F.coalesce(c, F.lit(False)) for n, c in runs.items()})
    w = chunk_window(keys, F.col(CARRIED).desc(), F.col(time).asc_nulls_first(), F.col(TIE).asc_nulls_first())
    upto = w.rowsBetween(Window.unboundedPreceding, 0)

    if seconds != WHOLE:
        order = at(time, TIE)
        ends = rows.groupBy(*keys, CHUNK).agg(*[F.max(F.when(~F.col(f"_hit_{n}"), order)).alias(f"_break_{n}") for n in names])
        # Rows behind the chunk's last break: counted against it, by (key, chunk) again.
        breaks = ends.select(*[F.col(k).alias(f"_k_{k}") for k in [*keys, CHUNK]], *[f"_break_{n}" for n in names])
        cond = F.lit(True)
        for k in [*keys, CHUNK]:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        behind = rows.select(*keys, CHUNK, order.alias("_at")).join(breaks, cond)
        tails = behind.groupBy(*keys, CHUNK).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(f"_break_{n}").isNull() | (F.col("_at") > F.col(f"_break_{n}"))).alias(f"_tail_{n}") for n in names],
        )
        per_key = Window.partitionBy(*keys).orderBy(CHUNK)
        before = per_key.rowsBetween(Window.unboundedPreceding, -1)
        all_rows = F.sum("_rows").over(per_key.rowsBetween(Window.unboundedPreceding, 0))
        tails = tails.withColumn("_upto", all_rows)
        # A chunk that breaks the run leaves its tail; later whole chunks add their rows to it.
        left = {
            f"_left_{n}": F.coalesce(F.last(F.when(F.col(f"_tail_{n}") < F.col("_rows"), F.col(f"_tail_{n}") - F.col("_upto")), ignorenulls=True).over(before), F.lit(0))
            + F.col("_upto") - F.col("_rows")
            for n in names
        }
        carried = tails.select(*keys, CHUNK, *[c.alias(n) for n, c in left.items()]).withColumn(CARRIED, F.lit(True))
        merged = rows.unionByName(carried, allowMissingColumns=True)
    else:
        merged = rows.withColumns({f"_left_{n}": F.lit(None).cast("bigint") for n in names})
    place = F.count_if(~F.col(CARRIED)).over(upto)
    # A row's place grows, so the last break is the one with the largest place.
    merged = merged.withColumns({f"_break_{n}": F.when(~F.col(CARRIED) & ~F.col(f"_hit_{n}"), place) for n in names})

    def length(n: str) -> Column:
        last = F.max(f"_break_{n}").over(upto)
        reach = F.coalesce(F.first(f"_left_{n}", ignorenulls=True).over(upto), F.lit(0))
        return F.when(last.isNull(), place + reach).otherwise(place - last).cast("bigint")

    merged = merged.withColumns({n: length(n) for n in names})
    return merged.where(~F.col(CARRIED)).select(*[c for c in df.columns if c not in names], *names)


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, seconds: int | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """1-based row number per key, counted from the oldest (or newest) row."""
    seconds = fitting_width(df, keys, order[0]) if seconds is None else seconds
    rows = df.withColumn(CHUNK, time_chunk(F.col(order[0]), seconds))
    direction = [F.col(c).desc() if newest_first else F.col(c).asc() for c in order]
    merged = rows.withColumns({"_n": F.lit(1).cast("bigint"), CARRIED: F.lit(False)})
    if seconds != WHOLE:
        chunk_order = F.col(CHUNK).desc() if newest_first else F.col(CHUNK).asc()
        before = Window.partitionBy(*keys).orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
        counts = rows.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
        offsets = counts.withColumn("_n", F.sum("_n").over(before)).where(F.col("_n").isNotNull())
        merged = merged.unionByName(offsets.withColumn(CARRIED, F.lit(True)), allowMissingColumns=True)
    # The carried row comes first and counts for all rows ahead of the chunk.
    upto = chunk_window(keys, F.col(CARRIED).desc(), *direction).rowsBetween(Window.unboundedPreceding, 0)
    return merged.withColumn(name, F.sum("_n").over(upto)).where(~F.col(CARRIED)).drop(CHUNK, CARRIED, "_n")


def _latest_before(occupied: DataFrame, known: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """For each occupied (key, chunk): the last ``value`` of an earlier chunk, where there is one."""
    merged = (
        occupied.withColumn("_used", F.lit(True))
        .unionByName(known, allowMissingColumns=True)
        .groupBy(*keys, CHUNK)
        .agg(F.max("_used").alias("_used"), F.max(value).alias(value))
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        merged.withColumn(value, F.last(value, ignorenulls=True).over(earlier))
        .where(F.col("_used") & F.col(value).isNotNull())
        .drop("_used")
    )


def asof_merge(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, right_time: str, value: str,
    seconds: int | None = None,
) -> DataFrame:
    """Attach to each left row the ``value`` with the greatest ``right_time <= time``, else NULL.

    One linear pass: both sides are merged in time order per (keys, chunk), and the value in
    force at the start of a chunk is added as one extra row. ``right`` must be unique on
    (keys, right_time) and free of NULL values.
    """
    if seconds is None:
        both = left.select(*keys, time).unionByName(right.select(*keys, F.col(right_time).alias(time)))
        seconds = fitting_width(both, keys, time)
    rows = left.withColumn(CHUNK, time_chunk(F.col(time), seconds)).withColumns(
        {"_t": F.col(time), "_side": F.lit(2), "_v": F.lit(None).cast(right.schema[value].dataType)}
    )
    points = right.select(*keys, F.col(right_time).alias("_t"), F.col(value).alias("_v")).withColumn(
        CHUNK, time_chunk(F.col("_t"), seconds)
    )
    merged = rows.unionByName(points.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    if seconds != WHOLE:
        known = points.groupBy(*keys, CHUNK).agg(F.max_by("_v", at("_t")).alias("_v"))
        in_force = _latest_before(rows.select(*keys, CHUNK).distinct(), known, keys, "_v")
        merged = merged.unionByName(in_force.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    w = chunk_window(keys, F.col("_t").asc_nulls_first(), F.col("_side")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        merged.withColumn(value, F.last("_v", ignorenulls=True).over(w))
        .where(F.col("_side") == 2)
        .drop(CHUNK, "_t", "_v", "_side")
    )


def forward_fill(
    df: DataFrame, keys: Sequence[str], time: str, column: str, name: str, seconds: int | None = None, sequence: str | None = None
) -> DataFrame:
    """Last non-NULL value of ``column`` up to and including each row. Rows of equal time are ordered by ``sequence``, then by a hash."""
    seconds = fitting_width(df, keys, time) if seconds is None else seconds
    rows = with_tie(df, sequence).withColumn(CHUNK, time_chunk(F.col(time), seconds)).withColumn("_v", F.col(column))
    merged = rows.withColumn("_side", F.lit(1))
    if seconds != WHOLE:
        known = rows.where(F.col("_v").isNotNull()).groupBy(*keys, CHUNK).agg(F.max_by("_v", at(time, TIE)).alias("_v"))
        in_force = _latest_before(rows.select(*keys, CHUNK).distinct(), known, keys, "_v")
        merged = merged.unionByName(in_force.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    w = chunk_window(keys, F.col("_side"), F.col(time).asc_nulls_first(), F.col(TIE)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        merged.withColumn(name, F.last("_v", ignorenulls=True).over(w)).where(F.col("_side") == 1).drop(CHUNK, "_v", "_side", TIE)
    )
