"""Cross-section datasets with one unit per trading day.

Two layouts are read: ``<dir>/trade_date=YYYY-MM-DD/`` (written by this package) and
``<dir>/YYYY-MM-DD.parquet``. Days are resolved from the folder listing, which is metadata
bounded by the number of trading days; only the chosen days are opened.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from barspan.operators.adjust import forward_adjust
from barspan.sources.exchange import recover
from barspan.sources.files import list_names

DAY_COLUMN = "trade_date"
_PREFIX = DAY_COLUMN + "="
_SUFFIX = ".parquet"


def _day_text(day: date | datetime | str) -> str:
    if isinstance(day, datetime):
        day = day.date()
    return day if isinstance(day, str) else day.isoformat()


def _units(spark: SparkSession, path: str) -> dict[str, str]:
    """Day -> entry name, in day order. Entries that name no day (rows without one, other folders) are passed over.

    A change of the store that broke off is finished first.
    """
    recover(spark, path)
    found = {}
    for name in list_names(spark, path):
        day = name[len(_PREFIX) :] if name.startswith(_PREFIX) else name.removesuffix(_SUFFIX) if name.endswith(_SUFFIX) else ""
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
            found[day] = name
    return dict(sorted(found.items()))


def day_units(spark: SparkSession, path: str) -> dict[str, str]:
    """Day -> name of the folder or file that holds it."""
    return _units(spark, path)


def is_flat(name: str) -> bool:
    """Whether a unit is of the ``YYYY-MM-DD.parquet`` layout."""
    return name.endswith(_SUFFIX)


def list_days(spark: SparkSession, path: str) -> list[str]:
    return list(_units(spark, path))


def day_schema(spark: SparkSession, path: str, day: date | datetime | str) -> StructType:
    """Columns stored for one day."""
    return spark.read.parquet(f"{path}/{_units(spark, path)[_day_text(day)]}").schema


def read_parquet(spark: SparkSession, path: str, fields: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*fields) if fields else df


def read_days(
    spark: SparkSession,
    path: str,
    days: Sequence[date | datetime | str],
    fields: Sequence[str] | None = None,
    adjust: bool = False,
) -> DataFrame:
    """The given days under the earliest one's columns: missing columns are NULL, extra ones ignored.

    An empty list gives an empty frame with the store's columns; a day that is not stored fails.
    """
    units = _units(spark, path)
    wanted = sorted({_day_text(d) for d in days})
    missing = [d for d in wanted if d not in units]
    if missing:
        raise FileNotFoundError(f"{path} has no data for {missing}")
    if not units:
        raise ValueError(f"{path} holds no days")
    first = (wanted or list(units))[0]
    schema = day_schema(spark, path, first)
    if adjust and fields is not None and not {"symbol", "close", "preclose"} <= set(fields):
        raise ValueError("adjusted prices need symbol, close and preclose among the fields")
    if not wanted:
        if units[first].startswith(_PREFIX):
            schema = StructType([*schema.fields, StructField(DAY_COLUMN, DateType())])
        df = spark.createDataFrame([], schema)
    else:
        reader = spark.read.schema(schema)
        if units[first].startswith(_PREFIX):
            reader = reader.option("basePath", path)
        df = reader.parquet(*[f"{path}/{units[d]}" for d in wanted])
    if fields is not None:
        df = df.select(*fields)
    if adjust:
        df = forward_adjust(df, time="dt" if "dt" in df.columns else DAY_COLUMN)
    return df


def read_between(
    spark: SparkSession,
    path: str,
    start: date | datetime | str,
    end: date | datetime | str,
    fields: Sequence[str] | None = None,
    adjust: bool = False,
) -> DataFrame:
    """Stored days from ``start`` to ``end``, both included; ValueError if there are none."""
    lo, hi = _day_text(start), _day_text(end)
    days = [d for d in list_days(spark, path) if lo <= d <= hi]
    if not days:
        raise ValueError(f"{path} has no day between {lo} and {hi}")
    return read_days(spark, path, days, fields, adjust)


def read_at(spark: SparkSession, path: str, day, fields: Sequence[str] | None = None, adjust: bool = False) -> DataFrame:
    return read_between(spark, path, day, day, fields, adjust)


def read_first_days(
    spark: SparkSession, path: str, day, n: int = 1, fields: Sequence[str] | None = None, adjust: bool = False
) -> DataFrame:
    """The first ``n`` stored days on or after ``day``."""
    days = [d for d in list_days(spark, path) if d >= _day_text(day)][:n]
    if not days:
        raise ValueError(f"{path} has no day from {day} on")
    return read_days(spark, path, days, fields, adjust)


def read_last_days(
    spark: SparkSession, path: str, day, n: int = 1, fields: Sequence[str] | None = None, adjust: bool = False
) -> DataFrame:
    """The last ``n`` stored days on or before ``day``."""
    days = [d for d in list_days(spark, path) if d <= _day_text(day)]
    days = days[max(0, len(days) - n) :]
    if not days:
        raise ValueError(f"{path} has no day up to {day}")
    return read_days(spark, path, days, fields, adjust)


def first_days(df: DataFrame, n: int, day=None, day_column: str = DAY_COLUMN) -> DataFrame:
    """Rows of the first ``n`` days present in ``df`` on or after ``day``.

    The day list has at most ``n`` rows and reaches a partitioned scan as a dynamic pruning filter.
    """
    days = df.select(day_column).distinct()
    if day is not None:
        days = days.where(F.col(day_column) >= F.lit(day).cast("date"))
    return df.join(days.orderBy(day_column).limit(n), day_column, "left_semi")


def last_days(df: DataFrame, n: int, day=None, day_column: str = DAY_COLUMN) -> DataFrame:
    days = df.select(day_column).distinct()
    if day is not None:
        days = days.where(F.col(day_column) <= F.lit(day).cast("date"))
    return df.join(days.orderBy(F.col(day_column).desc()).limit(n), day_column, "left_semi")


def listed_days(df: DataFrame, days: Sequence[date | datetime | str], day_column: str = DAY_COLUMN) -> DataFrame:
    """Rows of the given days; an empty list gives no rows."""
    wanted = [F.lit(_day_text(d)).cast("date") for d in days]
    return df.where(F.col(day_column).isin(wanted)) if wanted else df.where(F.lit(False))


def has_columns(df: DataFrame, fields: Sequence[str]) -> list[bool]:
    present = set(df.columns)
    return [f in present for f in fields]


def has_any_columns(df: DataFrame, fields: Sequence[str]) -> bool:
    return any(has_columns(df, fields))


def has_all_columns(df: DataFrame, fields: Sequence[str]) -> bool:
    return all(has_columns(df, fields))


def with_unit_day(df: DataFrame, name: str = DAY_COLUMN) -> DataFrame:
    """Add the day that the name of each row's flat unit says, unless the rows have that column."""
    named = F.regexp_extract("_metadata.file_path", r"(\d{4}-\d{2}-\d{2})\.parquet", 1)
    return df if name in df.columns else df.withColumn(name, F.to_date(named))


def with_day_column(df: DataFrame, time: str = "dt") -> DataFrame:
    """Add the trading day of each row, unless it is there already."""
    return df if DAY_COLUMN in df.columns else df.withColumn(DAY_COLUMN, F.to_date(time))
