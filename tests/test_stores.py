"""Stores in both layouts: broken exchanges, versions of cells, compaction by size."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barspan.operators import maintenance as m
from barspan.operators import versions as v
from barspan.sources import exchange
from barspan.sources.day_files import list_days, read_between
from barspan.sources.files import list_names, list_sizes

SCHEMA = "symbol string, dt timestamp_ntz, close double, volume bigint, batch_id bigint"


def bars(spark, days=range(1, 6), symbols="ABC", batch=1):
    rows = [(s, dt.datetime(2024, 1, d, 9), float(d), d * 10, batch) for s in symbols for d in days]
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted((r.symbol, r.dt.day, r.close, r.volume) for r in df.collect())


def stored(spark, path):
    return content(m.read_dataset(spark, path))


@pytest.fixture(params=["folders", "flat"])
def store(request, spark, tmp_path):
    path = str(tmp_path / "bars")
    (m.create_flat if request.param == "flat" else m.write_days)(bars(spark), path)
    return path


def is_flat_store(path):
    names = os.listdir(path)
    return [n for n in names if n.endswith(".parquet")] and all(os.path.isfile(f"{path}/{n}") for n in names if n.endswith(".parquet"))


def names_kept(path, before):
    """Whether the layout is still that of ``before``: single files per day, or folders."""
    return bool(is_flat_store(path)) == bool(before) and not any("part-" in n for n in os.listdir(path))


CHANGES = {
    "delete": lambda spark, path: m.delete_rows(spark, path, "close >= 4 OR symbol = 'A' AND close = 2"),
    "append": lambda spark, path: m.append(bars(spark, [5, 6], "N"), path),
    "upsert": lambda spark, path: m.upsert(spark, path, bars(spark, [1, 7], "BX", 2).withColumn("close", F.lit(9.0))),
    "merge": lambda spark, path: m.merge_columns(spark, path, "2024-01-02", bars(spark, [2]).select("symbol", F.lit(7.5).alias("close")), replace_origin=True),
    "drop": lambda spark, path: m.drop_fields(spark, path, ["batch_id"]),
    "reload": lambda spark, path: m.reload(bars(spark, [8]), path),
}


@pytest.mark.parametrize("name", list(CHANGES))
def test_change(spark, store, name):
    flat = is_flat_store(store)
    CHANGES[name](spark, store)
    base = {(s, d): (float(d), d * 10) for s in "ABC" for d in range(1, 6)}
    if name == "delete":
        base = {k: x for k, x in base.items() if k[1] < 4 and k != ("A", 2)}
    elif name == "append":
        base |= {("N", d): (float(d), d * 10) for d in (5, 6)}
    elif name == "upsert":
        base |= {(s, d): (9.0, d * 10) for s in "BX" for d in (1, 7)}
    elif name == "merge":
        base |= {(s, 2): (7.5, 20) for s in "ABC"}
    elif name == "reload":
        base = {(s, 8): (8.0, 80) for s in "ABC"}
    assert stored(spark, store) == sorted((s, d, *x) for (s, d), x in base.items())
    assert name == "reload" or names_kept(store, flat)
    assert ("batch_id" in m.read_dataset(spark, store).columns) == (name != "drop")
    assert not [n for n in os.listdir(os.path.dirname(store)) if "__changes" in n]


@pytest.mark.parametrize("name", ["delete", "upsert", "append", "reload", "drop"])
def test_every_broken_rename(spark, tmp_path, monkeypatch, name):
    """Break the n-th rename, for each n: before the journal nothing has changed, after it the next one to open finds the whole change."""
    kinds = ["flat"] if name == "append" else ["flat", "folders"]
    for kind in kinds:
        whole = str(tmp_path / f"{kind}-whole")
        create = m.create_flat if kind == "flat" else m.write_days
        create(bars(spark), whole)
        before = stored(spark, whole)
        CHANGES[name](spark, whole)
        after = stored(spark, whole)
        real, n = exchange.move, 0
        while True:
            path = str(tmp_path / f"{kind}-{n}")
            create(bars(spark), path)
            calls = []

            def breaks(s, source, target):
                calls.append(target)
                if len(calls) == n + 1:
                    raise OSError("lost the storage")
                real(s, source, target)

            monkeypatch.setattr(exchange, "move", breaks)
            monkeypatch.setattr("barspan.sources.files.move", breaks)  # the journal's own rename
            try:
                CHANGES[name](spark, path)
                broken = False
            except OSError:
                broken = True
            monkeypatch.setattr(exchange, "move", real)
            monkeypatch.setattr("barspan.sources.files.move", real)
            assert stored(spark, path) == (before if n == 0 else after)
            # The next change starts from there.
            m.append(bars(spark, [9], "Z"), path)
            assert len(stored(spark, path)) == len(before if n == 0 else after) + 1
            exchange.clean_up(spark, path)
            assert not [x for x in os.listdir(tmp_path) if x == f"{kind}-{n}__changes"]
            if not broken:
                break
            n += 1
        assert n >= 2


def test_broken_write(spark, store):
    before = stored(spark, store)
    bad = bars(spark, [2]).withColumn("close", F.when(F.col("symbol") == "B", F.raise_error(F.lit("bad")).cast("double")).otherwise(1.0))
    for change in (lambda: m.upsert(spark, store, bad), lambda: m.reload(bad, store)):
        with pytest.raises(Exception, match="bad"):
            change()
        assert stored(spark, store) == before


def test_flat_columns_and_days(spark, tmp_path):
    """A file that another program wrote, without a trading day in it; its name says the day."""
    path = tmp_path / "plain"
    path.mkdir()
    one = bars(spark, [3]).drop("batch_id").toPandas()
    one.to_parquet(path / "2024-01-03.parquet", index=False, coerce_timestamps="us")
    m.append(bars(spark, [3, 4], "N").drop("batch_id"), str(path))
    assert list_days(spark, str(path)) == ["2024-01-03", "2024-01-04"]
    assert is_flat_store(str(path)) and "trade_date" not in spark.read.parquet(f"{path}/2024-01-03.parquet").columns
    assert len(stored(spark, str(path))) == 5
    assert read_between(spark, str(path), "2024-01-03", "2024-01-03").count() == 4


def test_versions(spark, store):
    cells = lambda **c: [tuple(r) for r in v.read_versions(spark, store, **c).where("symbol = 'A' AND dt < '2024-01-03'").orderBy("dt").select("close", "volume", "batch_id").collect()]
    at = bars(spark, [1], "A")
    v.write_batch(at.select("symbol", "dt", F.lit(9.0).alias("close")), store, 2)
    v.write_batch(at.select("symbol", "dt", F.lit(None).cast("bigint").alias("volume")), store, 3)
    v.write_batch(at.select("symbol", "dt", F.lit(11.0).alias("close"), F.lit("x").alias("note")), store, 4)
    assert cells() == [(11.0, None, 4), (2.0, 20, 1)]
    assert cells(until=3) == [(9.0, None, 3), (2.0, 20, 1)]
    assert cells(until=2) == [(9.0, 10, 2), (2.0, 20, 1)]
    # The newest, then one in the middle, then the first.
    m.undo_batches(spark, store, 4, 4)
    assert cells() == [(9.0, None, 3), (2.0, 20, 1)]
    m.undo_batches(spark, store, 2, 2)
    assert cells() == [(1.0, None, 3), (2.0, 20, 1)]
    m.undo_batches(spark, store, 3, 90)
    assert cells() == [(1.0, 10, 1), (2.0, 20, 1)]
    assert content(v.read_versions(spark, store)) == content(bars(spark))


def test_repeated_batch_and_new_cells(spark, store):
    for _ in range(2):
        v.write_batch(bars(spark, [5, 7], "AN").drop("batch_id"), store, 2)
    v.write_batch(bars(spark, [5], "A").select("symbol", "dt", F.lit(3.0).alias("close")), store, 2)
    got = {(r.symbol, r.dt.day): r.close for r in v.read_versions(spark, store).collect()}
    assert len(got) == 15 + 3 and got["A", 5] == 5.0 and got["N", 7] == 7.0
    assert {(r.batch_id, r.rows) for r in v.batches(spark, store).collect()} == {(1, 15), (2, 9)}


def test_settle(spark, store):
    at = bars(spark, [1], "A").select("symbol", "dt")
    v.write_batch(at.withColumn("close", F.lit(9.0)), store, 2)
    v.write_batch(at.withColumn("close", F.lit(8.0)), store, 3)
    v.write_batch(at.withColumn("volume", F.lit(1).cast("bigint")), store, 5)
    names = lambda: {n: os.stat(f"{store}/{n}").st_mtime_ns for n in os.listdir(store) if n[0] != "."}
    before = names()
    v.settle(spark, store, until=3)
    rows = m.read_dataset(spark, store).where("symbol = 'A' AND dt < '2024-01-02'")
    assert {(r.close, r.volume, r.batch_id) for r in rows.collect()} == {(8.0, 10, 3), (None, 1, 5)}
    m.undo_batches(spark, store, 5, 5)
    assert content(v.read_versions(spark, store)) == sorted([("A", 1, 8.0, 10), *[r for r in content(bars(spark)) if r[:2] != ("A", 1)]])
    assert sum(before[n] != t for n, t in names().items() if n in before) == 1
    v.settle(spark, store)
    assert content(m.read_dataset(spark, store)) == content(v.read_versions(spark, store))


def test_compact_leaves_large_files(spark, tmp_path):
    path = str(tmp_path / "sizes")
    big = spark.range(20_000).select(F.concat(F.lit("S"), "id").alias("symbol"), F.lit("2024-01-01").cast("timestamp_ntz").alias("dt"), F.rand(1).alias("close"))
    m.write_days(big, path)
    unit = f"{path}/trade_date=2024-01-01"
    large = max(list_sizes(spark, unit).values())
    for i in range(5):
        m.append(big.limit(10).withColumn("symbol", F.lit(f"X{i}")), path)
    m.append(big.limit(10).withColumn("dt", F.lit("2024-01-02").cast("timestamp_ntz")), path)
    before = {d: set(list_sizes(spark, f"{path}/trade_date={d}")) for d in list_days(spark, path)}
    rows = m.read_dataset(spark, path).groupBy("symbol", "trade_date").count().collect()
    m.compact(spark, path, small_bytes=large)
    after = {d: list_sizes(spark, f"{path}/trade_date={d}") for d in list_days(spark, path)}
    kept = before["2024-01-01"] & set(after["2024-01-01"])
    assert len(kept) == 1 and after["2024-01-01"][kept.pop()] == large and len(after["2024-01-01"]) == 2
    assert before["2024-01-02"] == set(after["2024-01-02"])
    assert sorted(rows) == sorted(m.read_dataset(spark, path).groupBy("symbol", "trade_date").count().collect())
    assert list_names(spark, f"{path}__changes") == []
