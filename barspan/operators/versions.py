"""Versions of cells in a day store: batches are added beside what they replace, and reads take the newest visible one.

A batch adds rows with its number and the names of the columns it writes; nothing stored is touched. Reading folds the rows of a cell: each
column comes from the newest batch that wrote it. So undoing a batch, which removes its rows (``maintenance.undo_batches``), or
reading as of an earlier batch brings back what was there before. ``settle`` folds a store for good.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspan.operators import maintenance
from barspan.sources.day_files import DAY_COLUMN, day_units, with_day_column

KEYS = ["symbol", "dt", DAY_COLUMN]
#: Names of the value columns that a row writes; NULL in rows that write all of them.
WRITTEN = "_written"


def write_batch(df: DataFrame, path: str, batch_id: int, batch: str = "batch_id") -> None:
    """Add ``df``, cells by (symbol, dt) with some or all value columns, as batch ``batch_id``. A NULL value is written as such.

    The same cells may come again under the same number, as when a job is repeated. A column new to the store is NULL before this batch.
    """
    df = with_day_column(df)
    values = [c for c in df.columns if c not in (*KEYS, batch)]
    marks = {batch: F.lit(batch_id).cast("bigint"), WRITTEN: F.array(*map(F.lit, values)).cast("array<string>")}
    maintenance.append(df.withColumns(marks), path)


def newest(rows: DataFrame, until: int | None = None, batch: str = "batch_id") -> DataFrame:
    """One row per cell: each column from the newest batch up to ``until`` that wrote it, and the number of the newest batch of the cell.

    Rows without a number are older than all others. Of rows of one batch that differ the largest value counts. One aggregate, combined
    on the map side: a cell with any number of versions sends one row per task.
    """
    visible = rows if until is None else rows.where(F.col(batch).isNull() | (F.col(batch) <= until))
    values = [c for c in rows.columns if c not in (*KEYS, batch, WRITTEN)]
    writes = F.col(WRITTEN) if WRITTEN in rows.columns else F.lit(None).cast("array<string>")

    def last(c: str):
        wrote = writes.isNull() | F.array_contains(writes, c)
        # A struct is never NULL, so a NULL that was written counts.
        return F.max_by(F.struct(c), F.when(wrote, F.struct(batch, c)))[c].alias(c)

    return visible.groupBy(*KEYS).agg(*[last(c) for c in values], F.max(batch).alias(batch)).select(*[c for c in rows.columns if c != WRITTEN])


def read_versions(
    spark: SparkSession, path: str, days: Sequence[date | str] | None = None, until: int | None = None, batch: str = "batch_id"
) -> DataFrame:
    """The newest visible values of the given days (default: all), as of batch ``until`` if given."""
    return newest(maintenance.read_dataset(spark, path, days), until, batch)


def batches(spark: SparkSession, path: str, batch: str = "batch_id") -> DataFrame:
    """(batch, rows, days) of every batch that the store still holds."""
    rows = maintenance.read_dataset(spark, path)
    return rows.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(DAY_COLUMN).alias("days"))


def settle(spark: SparkSession, path: str, until: int | None = None, days: Sequence[date] | None = None, batch: str = "batch_id") -> None:
    """Fold the versions up to batch ``until`` (default: all) to one row per cell, which can't be undone any more; later ones stay.

    Days without a cell of several rows are neither folded nor written.
    """
    chosen = [d for d in day_units(spark, path) if days is None or date.fromisoformat(d) in days]
    if not chosen:
        return
    rows = maintenance.read_dataset(spark, path, chosen)
    old = F.lit(True) if until is None else F.col(batch).isNull() | (F.col(batch) <= until)
    several = rows.where(old).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(DAY_COLUMN).distinct()
    touched = [r[0] for r in several.collect()]
    if not touched:
        return
    rows = maintenance.read_dataset(spark, path, touched)
    folded = newest(rows.where(old), None, batch)
    if WRITTEN in rows.columns:
        # A folded row writes what any of its versions wrote: all columns, if one of them did.
        wrote = F.when(F.max(F.col(WRITTEN).isNull()), F.lit(None)).otherwise(F.array_sort(F.array_distinct(F.flatten(F.collect_set(WRITTEN)))))
        written = rows.where(old).groupBy(*KEYS).agg(wrote.alias(WRITTEN))
        folded = folded.join(written, KEYS).select(*rows.columns)
    if until is not None:
        folded = folded.unionByName(rows.where(~old))
    maintenance.replace_days(spark, folded, path, touched)
