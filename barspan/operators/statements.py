"""Financial statements: clean-up of restated reports and N-way merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspan.operators.chunks import CARRIED, CHUNK, chunk_window, fitting_width, with_preceding_rows

KEYS = ["ts_code", "f_ann_date", "end_date"]

# A key for which the merge would pair more rows than this in one task is salted.
HOT_ROWS = 1_000_000
COPIES = 10_000


def clean_statements(df: DataFrame, fields: Sequence[str] | None = None, chunk_seconds: int | None = None) -> DataFrame:
    """Drop late restatements of older periods.

    In (ts_code, f_ann_date, end_date) order a row stays if it is the first of its company or its
    ``end_date`` is not before that of the row just ahead of it, kept or not. The keys are always part
    of the result.
    """
    if fields is not None:
        df = df.select(*dict.fromkeys([*KEYS, *fields]))
    if chunk_seconds is None:
        chunk_seconds = fitting_width(df, ["ts_code"], "f_ann_date")
    rows = with_preceding_rows(df, ["ts_code"], ["f_ann_date", "end_date"], [], 1, chunk_seconds)
    # The hash settles which of several rows without an end_date comes first.
    w = chunk_window(
        ["ts_code"], F.col(CARRIED).desc(), F.col("f_ann_date").asc_nulls_first(), F.col("end_date").asc_nulls_first(),
        F.xxhash64(*df.columns),
    )
    first = F.lag(F.lit(True)).over(w).isNull()
    return (
        rows.withColumns({"_first": first, "_previous": F.lag("end_date").over(w)})
        .where(~F.col(CARRIED) & (F.col("_first") | (F.col("end_date") >= F.col("_previous"))))
        .drop(CHUNK, CARRIED, "_first", "_previous")
    )


def _key_counts(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _complete(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _salts(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """(keys, _nl, _nr): over how many salts the two sides of a hot key are dealt, from its counts.

    A key is hot if either side, or the pairs of both, exceed ``hot_rows``; then no task gets more than that.
    """
    both = _key_counts(left, keys).withColumnRenamed("_n", "_cl").join(_key_counts(right, keys).withColumnRenamed("_n", "_cr"), list(keys), "full")
    l, r = F.coalesce("_cl", F.lit(0)).cast("double"), F.coalesce("_cr", F.lit(0)).cast("double")
    paired = (l > 0) & (r > 0)
    # Equal shares of the root on both sides bound the pairs; a side without partner is only cut.
    share = F.when(paired, F.sqrt(F.lit(float(hot_rows)))).otherwise(F.lit(float(hot_rows)))
    hot = F.greatest(l, r, l * r) > hot_rows
    return both.where(hot).select(*keys, *[F.greatest(F.lit(1), F.ceil(n / share)).cast("int").alias(name) for n, name in ((l, "_nl"), (r, "_nr"))])


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer join whose hot keys are spread over several tasks; the keys come first.

    Spark cannot split a skewed full outer join. Here the rows of a hot key get a salt, and the other side's rows of that key are repeated
    once per salt. A repeated row that meets no partner under its salt is dropped if its key exists on the other side at all, because it has its
    partners under other salts. The result is the plain full outer join. Rows whose key has a NULL never match: they stay out of the join.

    The salt is a hash of the row, so a task that runs again draws the same one. Identical copies would share
    it; they are counted before the shuffle, cut into pieces of at most ``COPIES`` and multiplied out again
    after the join.
    """
    keys = list(keys)
    salts = _salts(left.where(_complete(keys)), right.where(_complete(keys)), keys, hot_rows)

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        pieces = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES).cast("int"))
        counted = _key_counts(df.where(_complete(keys)), df.columns).withColumn("_piece", F.explode(pieces))
        dealt = counted.join(salts, keys, "left").na.fill(1, ["_nl", "_nr"])
        return (
            dealt.withColumn(f"_s{own}", F.pmod(F.xxhash64(*df.columns, "_piece"), F.col(f"_n{own}")).cast("int"))
            .withColumn(f"_s{other}", F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)))
            .withColumn(f"_copies{own}", F.least(F.lit(COPIES), F.col("_n") - F.col("_piece") * COPIES))
            .withColumn(f"_repeated{own}", F.col(f"_n{other}") > 1)
            .drop("_nl", "_nr", "_n", "_piece")
        )

    joined = side(left, "l", "r").join(side(right, "r", "l"), [*keys, "_sl", "_sr"], "full")
    lonely_left = F.col("_copiesr").isNull() & F.col("_repeatedl")
    lonely_right = F.col("_copiesl").isNull() & F.col("_repeatedr")
    whole = joined.where(~(F.coalesce(lonely_left, F.lit(False)) | F.coalesce(lonely_right, F.lit(False))))
    for copies in ("_copiesl", "_copiesr"):
        whole = whole.withColumn(copies, F.explode(F.sequence(F.lit(1), F.coalesce(copies, F.lit(1)))))
    out = whole.select(*keys, *[c for df in (left, right) for c in df.columns if c not in keys])
    for df in (left, right):
        out = out.unionByName(df.where(~_complete(keys)), allowMissingColumns=True)
    return out


def merge_statements(*tables: DataFrame, sort: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Full outer merge of statement tables on (ts_code, f_ann_date, end_date), which come first.

    Fields that occur in several tables get the suffix ``_2``, ``_3``, ... of their table's place. No table,
    or an empty one among several, gives ``None``. One job counts the rows per key of all tables first; if no key
    pairs more rows than ``hot_rows``, the plain join does the same.
    """
    if not tables:
        return None
    if len(tables) == 1:
        return tables[0]
    seen: set[str] = set()
    prepared = []
    for place, table in enumerate(tables, start=1):
        table = table.withColumnsRenamed({c: f"{c}_{place}" for c in table.columns if c not in KEYS and c in seen})
        seen |= set(table.columns) - set(KEYS)
        prepared.append(table)
    places = range(len(prepared))
    tagged = [table.select(*KEYS, F.lit(place).alias("place")) for place, table in enumerate(prepared)]
    counts = reduce(DataFrame.unionByName, tagged).groupBy(*KEYS).agg(*[F.count_if(F.col("place") == p).alias(f"n{p}") for p in places])
    pairs = reduce(mul, [F.greatest(F.col(f"n{p}"), F.lit(1)).cast("double") for p in places])
    # Rows without a complete key are as many as they are: they meet no partner.
    most = F.max(F.when(_complete(KEYS), pairs).otherwise(F.greatest(*[F.col(f"n{p}") for p in places]).cast("double")))
    found = counts.agg(most.alias("most"), *[F.sum(f"n{p}").alias(f"n{p}") for p in places]).first()
    if not all(found[f"n{p}"] for p in places):
        return None
    merged = prepared[0]
    for table in prepared[1:]:
        merged = full_join(merged, table, KEYS, hot_rows) if found["most"] > hot_rows else merged.join(table, KEYS, "full")
    merged = merged.select(*KEYS, *[c for c in merged.columns if c not in KEYS])
    return merged.orderBy(*KEYS) if sort else merged
