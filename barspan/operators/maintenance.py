"""Table maintenance on Parquet stores with one unit per trading day, in either layout of ``sources.day_files``.

A store cannot be overwritten while it is read. The changed days are written once, beside the store; then they are exchanged
by journalled renames (``sources.exchange``), so that a break at any moment loses no row. Other days are neither written nor opened. The layout
stays what it is: a store of ``YYYY-MM-DD.parquet`` files gets such files. A row without a trading day is an error when written.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from barspan.functions.bar_columns import nan_to_null
from barspan.session import scratch_dir
from barspan.sources.day_files import DAY_COLUMN, day_schema, day_units, is_flat, read_days, with_day_column, with_unit_day
from barspan.sources.exchange import change, recover
from barspan.sources.files import exists, list_names, list_sizes

_MAX_ROWS_PER_FILE = 20_000_000

#: Files below this size are joined by ``compact``.
SMALL_BYTES = 64 << 20


def _order(df: DataFrame) -> list[str]:
    return [DAY_COLUMN] + [c for c in ("symbol", "dt") if c in df.columns]


def write_days(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write range-partitioned by day, symbol and time: few files per day, a busy day or symbol is split, and
    each file covers a narrow symbol range that row-group statistics can skip. NaN becomes NULL."""
    df = nan_to_null(with_day_column(df))
    df = df.withColumn(DAY_COLUMN, F.coalesce(DAY_COLUMN, F.raise_error(F.lit("a row has no trading day")).cast("date")))
    order = _order(df)
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(DAY_COLUMN)
    writer.option("maxRecordsPerFile", _MAX_ROWS_PER_FILE).parquet(path)


def _write_flat(df: DataFrame, path: str) -> None:
    """Write one folder per day in ``path``, usually of one file: Spark joins the small parts of a shuffle by day and splits only days that
    are too much for one task. Rows hold their columns alone; the day is the folder's name."""
    df = nan_to_null(df)
    order = [_UNIT] + [c for c in ("symbol", "dt") if c in df.columns]
    df.hint("rebalance", _UNIT).sortWithinPartitions(*order).write.partitionBy(_UNIT).parquet(path)


_UNIT = "_unit_day"


def create_if_absent(df: DataFrame, path: str) -> None:
    """Create the dataset from ``df`` unless it exists."""
    recover(df.sparkSession, path)
    if not exists(df.sparkSession, path):
        write_days(df, path)


def create_flat(df: DataFrame, path: str) -> None:
    """Create a store of one ``YYYY-MM-DD.parquet`` per day from rows with a trading day or ``dt``."""
    _exchange_days(df.sparkSession, with_day_column(df), path, [], flat=True, keep_day=DAY_COLUMN in df.columns)


def reload(df: DataFrame, path: str) -> None:
    """Drop the dataset and write it anew; the old one stays in place until the new one is whole."""
    spark = df.sparkSession
    with change(spark, path) as c:
        write_days(df, c.new)
        if exists(spark, path):
            c.take_out("")
        c.put_in("", "")


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None, where: str | None = None) -> None:
    """Append the chosen rows and columns. In the flat layout the days that get rows are written anew with them."""
    spark = df.sparkSession
    df = df.where(where) if where else df
    df = df.select(*columns) if columns else df
    units = day_units(spark, path)
    if not (units and is_flat(next(iter(units.values())))):
        write_days(df, path, "append")
        return
    staged, days = _staged(with_day_column(df))
    stored = [d for d in days if d.isoformat() in units]
    if stored:
        staged = read_dataset(spark, path, stored).unionByName(staged, allowMissingColumns=True)
    if days:
        replace_days(spark, staged, path, days)


def _staged(df: DataFrame) -> tuple[DataFrame, list[date]]:
    """The rows, computed once and written to shared scratch by day, and their days: the names of the folders. Rows without a day are an error."""
    spark, folder = df.sparkSession, scratch_dir(df.sparkSession, "staged")
    day = F.coalesce(DAY_COLUMN, F.raise_error(F.lit("a row has no trading day")).cast("date"))
    df = df.withColumn(_UNIT, day)
    df.hint("rebalance", _UNIT).write.partitionBy(_UNIT).parquet(folder)
    days = sorted(date.fromisoformat(n.split("=")[1]) for n in list_names(spark, folder) if n.startswith(f"{_UNIT}="))
    return spark.read.schema(df.drop(_UNIT).schema).parquet(folder).drop(_UNIT), days


def _read_units(spark: SparkSession, path: str, names: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Day units, or files in them, with all their columns (or those of ``schema``) and the trading day."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    if is_flat(names[0].split("/")[0]):
        return with_unit_day(reader.parquet(*[f"{path}/{n}" for n in names]))
    return reader.option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


def read_dataset(spark: SparkSession, path: str, days: Sequence[date | str] | None = None) -> DataFrame:
    """The given days (default: all) with all columns that they have, so that a rewrite loses none of them.

    Only the footers of these days are opened.
    """
    units = day_units(spark, path)
    if not units:
        return spark.read.option("mergeSchema", True).parquet(path)
    chosen = units if days is None else [str(d) for d in days]
    return _read_units(spark, path, [units[d] for d in chosen])


def _days_of(df: DataFrame) -> list[date]:
    """Trading days of the rows; one value per day, so it is safe to hold on the driver."""
    return [r[0] for r in df.select(DAY_COLUMN).where(F.col(DAY_COLUMN).isNotNull()).distinct().collect()]


def replace_days(spark: SparkSession, changed: DataFrame, path: str, days: Sequence[date]) -> None:
    """Exchange the given days of the store for the rows of ``changed``; a day that lost its last row goes."""
    units = day_units(spark, path)
    flat = bool(units) and is_flat(next(iter(units.values())))
    # A flat file holds the trading day as a column only if the store's files did.
    keep_day = flat and DAY_COLUMN in day_schema(spark, path, max(units)).fieldNames()
    _exchange_days(spark, changed, path, days, flat, keep_day)


def _exchange_days(spark: SparkSession, changed: DataFrame, path: str, days: Sequence[date], flat: bool, keep_day: bool) -> None:
    with change(spark, path) as c:
        units = day_units(spark, path)
        if flat:
            day = F.coalesce(DAY_COLUMN, F.raise_error(F.lit("a row has no trading day")).cast("date"))
            changed = changed.withColumn(_UNIT, day)
            _write_flat(changed if keep_day else changed.drop(DAY_COLUMN), c.new)
            staged = {n.split("=")[1]: n for n in list_names(spark, c.new) if n.startswith(f"{_UNIT}=")}
        else:
            write_days(changed, c.new)
            staged = day_units(spark, c.new)
        for day in sorted({*(d.isoformat() for d in days), *staged}):
            if day in units:
                c.take_out(units[day])
            if day in staged:
                files = list(list_sizes(spark, f"{c.new}/{staged[day]}")) if flat else []
                new = f"{staged[day]}/{files[0]}" if len(files) == 1 else staged[day]
                c.put_in(new, units.get(day) or (f"{day}.parquet" if flat else f"{DAY_COLUMN}={day}"))


def delete_rows(spark: SparkSession, path: str, where: str) -> None:
    """Delete rows that match; rows where the predicate is unknown stay. No match is no error.

    The predicate is over columns that the newest day has.
    """
    units = day_units(spark, path)
    if not units:
        return
    df = _read_units(spark, path, list(units.values()), day_schema(spark, path, max(units)))
    # The bare predicate reaches the scan; the null-safe form is only needed for the rows that stay.
    days = _days_of(df.where(where))
    if days:
        stays = ~F.coalesce(F.expr(where), F.lit(False))
        replace_days(spark, read_dataset(spark, path, days).where(stays), path, days)


def merge_columns(
    spark: SparkSession, path: str, day: date | str, new: DataFrame, on: str = "symbol", check_integrity: bool = True,
    replace_origin: bool = False,
) -> None:
    """Left-join new columns onto one day. Shared columns keep the stored values unless ``replace_origin``.

    The day must hold rows, and with ``check_integrity`` the joined rows must be as many as ``new`` has.
    """
    origin = read_dataset(spark, path, [str(day)[:10]]) if str(day)[:10] in day_units(spark, path) else read_days(spark, path, [day])
    shared = [c for c in new.columns if c in origin.columns and c not in (on, DAY_COLUMN)]
    new = new.drop(DAY_COLUMN)
    if replace_origin:
        origin = origin.drop(*shared)
    else:
        new = new.drop(*shared)
    # Joined once; the counts and the exchange read what was written.
    joined, days = _staged(origin.join(new, on, "left"))
    if not days:
        raise ValueError(f"{path} has no rows for {day}")
    if check_integrity:
        n_joined, n_new = joined.count(), new.count()
        if n_joined != n_new:
            raise ValueError(f"cannot merge {n_new} rows into {day}: the joined day has {n_joined}")
    replace_days(spark, joined, path, days)


def upsert(spark: SparkSession, path: str, updates: DataFrame, batch: str = "batch_id") -> None:
    """Write rows, columns or cells of the grid: a later batch replaces an earlier one at the same coordinates.

    Of several updates of a cell the one of the latest batch counts, and of several in that batch the one with the largest values, column by
    column. Updates may carry only some columns; an existing row keeps its other values. A column that the store lacks is added,
    NULL elsewhere. What was replaced is gone; ``operators.versions`` keeps it. The updates are computed once.
    """
    keys = ["symbol", "dt", DAY_COLUMN]
    updates, days = _staged(with_day_column(updates))
    units = day_units(spark, path)
    stored_days = [d for d in days if d.isoformat() in units]
    if not days:
        return
    base = read_dataset(spark, path, stored_days) if stored_days else read_dataset(spark, path, [max(units)]).limit(0)
    new = [c for c in updates.columns if c not in keys]
    old = [c for c in base.columns if c not in keys]
    kinds = {c: (base if c in old else updates).schema[c].dataType for c in [*old, *new]}
    side = lambda df, columns, mine: df.select(
        *keys, *[F.struct(*[F.col(c).cast(kinds[c]).alias(c) for c in cs]).alias(n) if mine == n else F.lit(None).cast(_struct(cs, kinds)).alias(n)
                 for n, cs in (("_old", old), ("_new", new))], F.col(batch).alias("_batch"), F.lit(mine).alias("_side"),
    )
    both = side(base, old, "_old").unionByName(side(updates, new, "_new"))
    # One hash aggregate, combined on the map side: the latest row of either side in each cell.
    latest = lambda n: F.max_by(F.when(F.col("_side") == n, F.col(n)), F.when(F.col("_side") == n, F.struct("_batch", n))).alias(n)
    batches = [F.max(F.when(F.col("_side") == n, F.col("_batch"))).alias(f"{n}_batch") for n in ("_old", "_new")]
    cells = both.groupBy(*keys).agg(latest("_old"), latest("_new"), *batches)
    newer = F.col("_new").isNotNull() & (F.col("_old_batch").isNull() | (F.col("_new_batch") >= F.col("_old_batch")))

    def value(c: str) -> Column:
        if c not in new:
            return F.col(f"_old.{c}")
        if c not in old:
            return F.when(newer, F.col(f"_new.{c}"))
        return F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))

    names = [*base.columns, *[c for c in new if c not in old]]
    out = cells.select(*[F.col(c) if c in keys else value(c).alias(c) for c in names])
    replace_days(spark, out, path, days)


def _struct(columns: Sequence[str], kinds: dict[str, DataType]) -> StructType:
    return StructType([StructField(c, kinds[c]) for c in columns])


def compact(spark: SparkSession, path: str, days: Sequence[date] | None = None, small_bytes: int = SMALL_BYTES) -> None:
    """Join the small files of the given days (default: all) to few sorted ones; files of ``small_bytes`` or more stay as they are.

    A day with less than two small files is neither read nor written. In the flat layout a day is written anew if it has several files.
    """
    units = day_units(spark, path)
    chosen = list(units) if days is None else [d.isoformat() for d in days if d.isoformat() in units]
    small = {d: sorted(n for n, size in list_sizes(spark, f"{path}/{units[d]}").items() if size < small_bytes) for d in chosen}
    small = {d: names for d, names in small.items() if len(names) > 1}
    if not small:
        return
    if is_flat(units[max(units)]):
        replace_days(spark, read_dataset(spark, path, list(small)), path, [date.fromisoformat(d) for d in small])
        return
    with change(spark, path) as c:
        write_days(_read_units(spark, path, [f"{units[d]}/{n}" for d, names in small.items() for n in names]), c.new)
        for day, folder in day_units(spark, c.new).items():
            for name in small[day]:
                c.take_out(f"{units[day]}/{name}")
            for name in list_sizes(spark, f"{c.new}/{folder}"):
                c.put_in(f"{folder}/{name}", f"{units[day]}/{name}")


def undo_batches(spark: SparkSession, path: str, first: int, last: int, batch: str = "batch_id") -> None:
    """Remove the rows written by batches ``first`` to ``last``; unknown batches are no error.

    Where ``operators.versions`` wrote the batches, what they had replaced is visible again.
    """
    delete_rows(spark, path, f"{batch} BETWEEN {int(first)} AND {int(last)}")


def write_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write JSON documents that leave out NaN and NULL fields."""
    nan_to_null(df).write.mode(mode).option("ignoreNullFields", True).json(path)


def drop_fields(
    spark: SparkSession, path: str, fields: Sequence[str], fmt: str = "parquet", schema: StructType | None = None
) -> None:
    """Remove fields from every row of a dataset: it is written anew once, and exchanged when it is whole. A day store keeps its layout.

    JSON documents should come with their ``schema``; without it Spark reads them twice to find one.
    """
    units = day_units(spark, path) if fmt == "parquet" else {}
    if units:
        replace_days(spark, read_dataset(spark, path).drop(*fields), path, [date.fromisoformat(d) for d in units])
        return
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    with change(spark, path) as c:
        reader.load(path).drop(*fields).write.format(fmt).save(c.new)
        c.take_out("")
        c.put_in("", "")
