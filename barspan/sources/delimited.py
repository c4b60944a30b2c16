"""Typed CSV loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barspan.schemas import DAILY, TICKS


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """CSV with a header under a declared schema; a malformed row fails the read."""
    return (
        spark.read.schema(schema)
        .options(header=True, mode="FAILFAST", enforceSchema=False)
        .csv(path)
    )


def read_daily_csv(spark: SparkSession, path: str | list[str], schema: StructType | str = DAILY) -> DataFrame:
    return read_csv(spark, path, schema)


def read_ticks_csv(spark: SparkSession, path: str | list[str], schema: StructType | str = TICKS) -> DataFrame:
    return read_csv(spark, path, schema)


def read_packed_dates_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    date_columns: Sequence[str],
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    fill_text: str | None = None,
) -> DataFrame:
    """CSV whose dates are written ``yyyyMMdd``; ``schema`` declares those columns as strings."""
    df = read_csv(spark, path, schema)
    df = df.withColumns({c: F.to_date(F.col(c), "yyyyMMdd") for c in date_columns})
    df = df.drop(*drop).withColumnsRenamed(dict(rename or {}))
    return df if fill_text is None else df.na.fill(fill_text)
