"""Bars in a table bucketed by symbol: ordered operators read them without moving rows.

Rows of a symbol are in one bucket, sorted by symbol and time. A window by symbol, or by symbol and time chunk, takes the
buckets as they are: no exchange, and previous rows, forward adjustment, streaks and fills of a stored history cost one scan. Two tables with
the same buckets are joined on the symbol in place too.

A bucket holds whole symbols, so a symbol must be small enough for one task; a table with a busier one is refused, and
a day store with chunked operators is its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from barspan.operators.chunks import TARGET_ROWS, busiest


def write_bucketed(
    df: DataFrame, table: str, buckets: int, keys: Sequence[str] = ("symbol",), time: str = "dt", path: str | None = None, mode: str = "errorifexists",
    most_rows: int = TARGET_ROWS,
) -> None:
    """Save ``df`` as ``table`` in ``buckets`` buckets of whole keys, in the warehouse or below ``path``.

    The rows are dealt to the buckets first, so each gets one file. ValueError if a key has more than ``most_rows`` rows (counted by a pass over the keys
    alone, combined on the map side); NULL keys are one key.
    """
    rows = busiest(df, *keys)
    if rows > most_rows:
        raise ValueError(f"a key has {rows} rows, more than one bucket should hold: keep the table by day")
    writer = df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys, time)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
