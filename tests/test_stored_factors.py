"""Adjusted reads from stored products: rows as from the adjustment of the whole store, and files that are not opened."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from barspan.operators import maintenance
from barspan.operators.adjust import forward_adjust
from barspan.sources import day_files
from barspan.sources.stored_factors import read_adjusted, write_products

SCHEMA = "symbol string, dt timestamp_ntz, open double, close double, preclose double"
FIELDS = ["symbol", "dt", "open", "close", "preclose"]


def _rows(days, seed=3):
    """Suspended symbols, unknown and zero prices, several bars a day, a NULL symbol, rows repeated, and one symbol that ends early."""
    rng = random.Random(seed)
    out = []
    for symbol in [*(f"S{i}" for i in range(12)), None]:
        for d in days:
            if rng.random() < 0.3 or (symbol == "S0" and d > 40):
                continue
            for hour in (9, 13):
                price = lambda: rng.choice([None, 0.0, *[rng.uniform(5, 9)] * 9])
                out.append((symbol, dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=d), 2.0, price(), price()))
    return out + out[:3]


def _plain(spark, path):
    return forward_adjust(day_files.read_days(spark, path, day_files.list_days(spark, path), FIELDS))


def _collected(df):
    shown = df.select("symbol", "dt", "close", *[F.format_string("%.9e", c).alias(c) for c in ("adjust_factor", "adj_open", "adj_close")])
    return sorted(map(tuple, shown.collect()), key=repr)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("factors"))
    maintenance.write_days(spark.createDataFrame(_rows(range(90)), SCHEMA), f"{base}/days")
    assert len(write_products(spark, f"{base}/days", f"{base}/products", 10)) >= 9
    return f"{base}/days", f"{base}/products"


@pytest.mark.parametrize("first, n", [(0, 1), (17, 5), (38, 12), (86, 4)])
@pytest.mark.parametrize("chunk_seconds", [None, 86_400])
def test_equals_adjustment_of_all(spark, store, first, n, chunk_seconds):
    path, products = store
    asked = day_files.list_days(spark, path)[first : first + n]
    found = read_adjusted(spark, path, products, asked, FIELDS, chunk_seconds=chunk_seconds)
    assert _collected(found) == _collected(_plain(spark, path).where(F.to_date("dt").isin([dt.date.fromisoformat(d) for d in asked])))
    assert len(found.columns) == len(FIELDS) + 3


def test_files_opened(spark, store):
    path, products = store
    stored = day_files.list_days(spark, path)
    found = read_adjusted(spark, path, products, stored[20:22], FIELDS)
    days = {re.search(r"trade_date=([\d-]+)", f)[1] for f in found.inputFiles() if "trade_date=" in f}
    assert set(stored[20:22]) <= days and len(days) <= 11 and min(days) == stored[20]
    assert any("/products/" in f for f in found.inputFiles())


def test_scattered_days_and_no_days(spark, store):
    path, products = store
    stored = day_files.list_days(spark, path)
    asked = [stored[3], stored[30], stored[70]]
    plain = _plain(spark, path).where(F.to_date("dt").isin([dt.date.fromisoformat(d) for d in asked]))
    assert _collected(read_adjusted(spark, path, products, asked, FIELDS)) == _collected(plain)
    assert read_adjusted(spark, path, products, [], FIELDS).count() == 0


def test_growing_store(spark, tmp_path):
    path, products = str(tmp_path / "days"), str(tmp_path / "products")
    maintenance.write_days(spark.createDataFrame(_rows(range(35)), SCHEMA), path)
    write_products(spark, path, products, 10)
    assert write_products(spark, path, products, 10) == []
    maintenance.append(spark.createDataFrame(_rows(range(35, 45), 4), SCHEMA), path)
    first = day_files.list_days(spark, path)[:2]
    with pytest.raises(ValueError, match="older than the store"):
        read_adjusted(spark, path, products, first, FIELDS)
    renewed = write_products(spark, path, products, 10)
    assert 1 <= len(renewed) <= 3
    plain = lambda: _plain(spark, path).where(F.to_date("dt").isin([dt.date.fromisoformat(d) for d in first]))
    assert _collected(read_adjusted(spark, path, products, first, FIELDS)) == _collected(plain())
    # Rows within a stored day change: the day is named.
    last = day_files.list_days(spark, path)[-1]
    maintenance.delete_rows(spark, path, f"symbol = 'S3' AND to_date(dt) = DATE'{last}'")
    assert len(write_products(spark, path, products, 10, changed=[last])) == 1
    assert _collected(read_adjusted(spark, path, products, first, FIELDS)) == _collected(plain())
    with pytest.raises(ValueError, match="periods of 10 days"):
        write_products(spark, path, products, 20)


def test_flat_store(spark, tmp_path):
    path, products = str(tmp_path / "flat"), str(tmp_path / "products")
    frame = spark.createDataFrame(_rows(range(25)), SCHEMA).withColumn("day", F.to_date("dt"))
    for r in frame.select("day").distinct().collect():
        frame.where(F.col("day") == F.lit(r.day)).drop("day").coalesce(1).write.parquet(f"{path}/{r.day}.parquet")
    write_products(spark, path, products, 7)
    asked = day_files.list_days(spark, path)[4:7]
    plain = _plain(spark, path).where(F.to_date("dt").isin([dt.date.fromisoformat(d) for d in asked]))
    assert _collected(read_adjusted(spark, path, products, asked, FIELDS)) == _collected(plain)


def test_missing_products_and_fields(spark, store, tmp_path):
    path, products = store
    day = day_files.list_days(spark, path)[:1]
    with pytest.raises(ValueError, match="write them first"):
        read_adjusted(spark, path, str(tmp_path / "none"), day, FIELDS)
    with pytest.raises(ValueError, match="among the fields"):
        read_adjusted(spark, path, products, day, ["symbol", "close"])
