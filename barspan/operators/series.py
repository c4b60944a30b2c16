"""Per-symbol series: counts, positions, bounded blocks, field gathering, row callbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barspan.operators.chunks import with_position


def row_counts(df: DataFrame, keys: Sequence[str] = ("symbol",), time: str = "dt") -> DataFrame:
    """Rows with a time, per key."""
    return df.groupBy(*keys).agg(F.count(time).alias("n_rows"))


def series_blocks(
    df: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("symbol",), time: str = "dt", block_rows: int = 1000,
    chunk_seconds: int | None = None,
) -> DataFrame:
    """Each symbol's series in time order as arrays of at most ``block_rows`` elements.

    Block ``b`` holds rows ``b * block_rows + 1`` and following; a long series is many blocks, never one
    value, so no task has to hold a whole symbol.
    """
    numbered = with_position(df.select(*keys, time, *[f for f in fields if f != time]), keys, [time], "_pos", chunk_seconds)
    return _blocks(numbered, keys, time, fields, block_rows)


def _blocks(numbered: DataFrame, keys: Sequence[str], time: str, fields: Sequence[str], block_rows: int) -> DataFrame:
    block = F.floor((F.col("_pos") - 1) / F.lit(block_rows)).alias("block")
    rows = F.array_sort(F.collect_list(F.struct("_pos", *fields)))
    return (
        numbered.groupBy(*keys, block)
        .agg(rows.alias("_rows"))
        .select(*keys, "block", F.size("_rows").alias("n_rows"), *[F.col(f"_rows.{f}").alias(f) for f in fields])
    )


def gather_fields(
    df: DataFrame, fields: Sequence[str], keys: Sequence[str], order: Sequence[str], block_values: int = 1000,
    chunk_seconds: int | None = None,
) -> DataFrame:
    """Column-wise gather of ragged rows: per key and field the present values in order, in bounded blocks.

    Values are given as text, so fields of different types share one column.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = df.select(*keys, *order, F.inline(pairs)).where(F.col("value").isNotNull())
    numbered = with_position(long, [*keys, "field"], order, "_pos", chunk_seconds)
    out = _blocks(numbered, [*keys, "field"], order[0], ["value"], block_values)
    return out.withColumnsRenamed({"n_rows": "n_values", "value": "present_values"})


def map_rows(df: DataFrame, convert: Callable[[Mapping[str, Any]], tuple], schema: StructType | str) -> DataFrame:
    """Turn every row into a typed tuple with a Python callback, in Arrow batches.

    Only for conversions that have no built-in expression; use ``select`` otherwise.
    """
    out_schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names, arrow_schema = out_schema.names, to_arrow_schema(out_schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [dict(zip(names, convert(row))) for row in part.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    return df.mapInArrow(batches, out_schema)
