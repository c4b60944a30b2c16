"""Writes: what is stored before and after."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barspan.operators import maintenance as m
from barspan.sources.day_files import list_days, read_at
from barspan.sources.files import list_names

SCHEMA = "symbol string, dt timestamp_ntz, close double, batch_id bigint"


@pytest.fixture
def store(spark, tmp_path):
    rows = [(s, dt.datetime(2024, 1, d, 9), float(d), d % 2) for s in "ABC" for d in range(1, 6)]
    path = str(tmp_path / "bars")
    m.write_days(spark.createDataFrame(rows, SCHEMA), path)
    return path


def _rows(spark, path):
    return sorted((r.symbol, r.dt.day, r.close) for r in m.read_dataset(spark, path).collect())


def test_create_if_absent_and_reload(spark, store):
    one = spark.createDataFrame([("Z", dt.datetime(2024, 3, 1), 1.0, 1)], SCHEMA)
    m.create_if_absent(one, store)
    assert len(_rows(spark, store)) == 15
    m.reload(one, store)
    assert _rows(spark, store) == [("Z", 1, 1.0)]


def test_delete(spark, store):
    m.delete_rows(spark, store, "close = 3 OR symbol = 'A' AND close > 4")
    assert list_days(spark, store) == ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05"]
    assert len(_rows(spark, store)) == 11
    before = _rows(spark, store)
    m.delete_rows(spark, store, "close = 77")
    m.delete_rows(spark, store, "CAST(NULL AS BOOLEAN)")
    assert _rows(spark, store) == before


def test_undo(spark, store):
    m.undo_batches(spark, store, 1, 1)
    assert {d for _, d, _ in _rows(spark, store)} == {2, 4}
    m.undo_batches(spark, store, 50, 60)
    m.undo_batches(spark, store, 0, 0)
    assert list_days(spark, store) == []


def test_untouched_days_stay(spark, store):
    names = lambda day: list_names(spark, f"{store}/trade_date={day}")
    before = names("2024-01-01"), names("2024-01-03")
    m.delete_rows(spark, store, "close = 3 AND symbol = 'A'")
    assert names("2024-01-01") == before[0] and names("2024-01-03") != before[1]


def test_merge_columns(spark, store):
    day = "2024-01-02"
    new = spark.createDataFrame([(s, 9.0, i) for i, s in enumerate("ABC")], "symbol string, close double, extra int")
    m.merge_columns(spark, store, day, new)
    got = {r.symbol: (r.close, r.extra) for r in read_at(spark, store, day).collect()}
    assert got == {"A": (2.0, 0), "B": (2.0, 1), "C": (2.0, 2)}
    m.merge_columns(spark, store, day, new, replace_origin=True)
    m.merge_columns(spark, store, day, new, replace_origin=True)
    got = {r.symbol: (r.close, r.extra) for r in read_at(spark, store, day).collect()}
    assert got == {"A": (9.0, 0), "B": (9.0, 1), "C": (9.0, 2)}
    assert "extra" not in read_at(spark, store, "2024-01-01").columns
    # Columns only some days have survive a rewrite of the whole store.
    m.compact(spark, store)
    assert m.read_dataset(spark, store).where("extra IS NOT NULL").count() == 3


def test_merge_integrity(spark, store):
    short = spark.createDataFrame([("A", 1)], "symbol string, extra int")
    with pytest.raises(ValueError, match="cannot merge"):
        m.merge_columns(spark, store, "2024-01-02", short)
    m.merge_columns(spark, store, "2024-01-02", short, check_integrity=False)
    assert read_at(spark, store, "2024-01-02").where("extra IS NULL").count() == 2


def test_merge_other_key_keeps_symbol(spark, store):
    new = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9), "X", 5)], "dt timestamp_ntz, symbol string, extra int")
    m.merge_columns(spark, store, "2024-01-02", new, on="dt", check_integrity=False)
    assert {(r.symbol, r.extra) for r in read_at(spark, store, "2024-01-02").collect()} == {("A", 5), ("B", 5), ("C", 5)}


def test_upsert_is_idempotent(spark, store):
    at = dt.datetime(2024, 1, 1, 9)
    updates = spark.createDataFrame(
        [("A", at, 50.0, 7), ("A", at, 60.0, 8), ("A", at, 40.0, 3), ("N", dt.datetime(2024, 2, 1), 1.0, 7), ("B", at, 99.0, 0)], SCHEMA
    )
    for _ in range(2):
        m.upsert(spark, store, updates)
        got = {(r.symbol, r.dt.day): r.close for r in m.read_dataset(spark, store).where("dt < '2024-01-02' OR symbol = 'N'").collect()}
        # Batch 0 is older than what B has.
        assert got == {("A", 1): 60.0, ("B", 1): 1.0, ("C", 1): 1.0, ("N", 1): 1.0}
    assert len(_rows(spark, store)) == 16


def test_compact(spark, store):
    for i in range(4):
        extra = spark.createDataFrame([(f"X{i}", dt.datetime(2024, 1, 1), 1.0, 1)], SCHEMA)
        m.append(extra, store)
    files = lambda: [n for n in list_names(spark, f"{store}/trade_date=2024-01-01") if n.endswith(".parquet")]
    before, rows = len(files()), _rows(spark, store)
    m.compact(spark, store, [dt.date(2024, 1, 1)])
    assert len(files()) < before and _rows(spark, store) == rows
    assert not [n for n in list_names(spark, store.rsplit("/", 1)[0]) if "staging" in n]


def test_documents(spark, tmp_path):
    path = str(tmp_path / "docs")
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.5, None)], "id int, v double, s string")
    m.write_documents(df, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['{"id":1,"s":"x"}', '{"id":2,"v":1.5}']
    m.drop_fields(spark, path, ["s"], "json", df.schema)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['{"id":1}', '{"id":2,"v":1.5}']


def test_drop_fields_of_days(spark, store):
    m.drop_fields(spark, store, ["batch_id"])
    df = m.read_dataset(spark, store)
    assert "batch_id" not in df.columns and df.count() == 15 and len(list_days(spark, store)) == 5
    assert df.where(F.col("trade_date") != F.to_date("dt")).count() == 0
