"""NULL, NaN and duplicate inputs: every plan of an operator gives the same rows and columns."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barspan.functions import timestamps
from barspan.operators import adjust, breadth, chunks, maintenance, resample, statements
from barspan.session import scratch_dir
from barspan.sources import day_files, reads, registry
from barspan.sources.files import list_names

START = datetime(2024, 1, 1)
WIDTHS = [chunks.WHOLE, chunks.YEAR, chunks.DAY, chunks.HOUR]


def rows(df):
    return df.columns, sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_bars(spark):
    """One row without a time per key, a NULL key, several days, rows of one day."""
    data = []
    for s in ("a", "b", None):
        for i in range(9):
            at = None if i == 0 else START + timedelta(hours=11 * i)
            data.append((float(i), s, at, 10.0 + i, 9.5 + i, i % 4, None if i % 3 else float(i)))
    return spark.createDataFrame(
        data, "open double, symbol string, dt timestamp_ntz, close double, preclose double, flag int, sparse double"
    )


@pytest.mark.parametrize("run", [
    lambda d, w: chunks.with_previous(d, ["symbol"], ["dt"], {"p": "close"}, w),
    lambda d, w: chunks.with_next_time(d, ["symbol"], "dt", "next", w),
    lambda d, w: chunks.rolling_max(d, ["symbol"], "dt", "flag", 2, "m", w),
    lambda d, w: chunks.rolling_max(d, ["symbol"], "dt", "flag", 4, "m", w),
    lambda d, w: chunks.with_position(d, ["symbol"], ["dt"], "n", w),
    lambda d, w: chunks.with_position(d, ["symbol"], ["dt"], "n", w, newest_first=True),
    lambda d, w: chunks.forward_fill(d, ["symbol"], "dt", "sparse", "f", w),
    lambda d, w: adjust.forward_adjust(d, chunk_seconds=w).withColumns({c: F.round(c, 9) for c in ("adjust_factor", "adj_close", "adj_open")}),
])
def test_null_times_and_keys_in_all_widths(odd_bars, run):
    want = rows(run(odd_bars, WIDTHS[0]))
    assert all(rows(run(odd_bars, w)) == want for w in WIDTHS[1:])


@pytest.mark.parametrize("method", ["multiply", "minus"])
def test_asof_adjust_ways_agree_on_nulls(spark, odd_bars, method):
    points = [("a", START, 2.0), ("a", None, 5.0), (None, START, 3.0), ("b", START + timedelta(days=1), None), ("b", START + timedelta(days=2), 4.0)]
    factors = spark.createDataFrame(points, "symbol string, tradedate timestamp_ntz, adjust_factor double")
    want = rows(adjust.asof_adjust(odd_bars, factors, method))
    for w in WIDTHS:
        assert rows(adjust.asof_adjust(odd_bars, factors, method, broadcast=False, chunk_seconds=w)) == want
    by_key = {(r.symbol, r.dt): r.close for r in adjust.asof_adjust(odd_bars, factors, method).collect()}
    assert by_key[(None, START + timedelta(hours=11))] == 11.0 and by_key[("a", None)] == 10.0


def test_several_factors_of_one_time(spark):
    bars = spark.createDataFrame([("a", "1d", START, 10.0), ("a", "1h", START, 10.0)], "symbol string, interval string, dt timestamp_ntz, close double")
    factors = spark.createDataFrame([("a", START, 3.0, 1), ("a", START, 2.5, 2)], "symbol string, tradedate timestamp_ntz, adjust_factor double, seq int")
    got = reads.klines(bars, ["a"], ["1d"], start=START, factors=factors, sequence="seq").collect()
    assert [r.close for r in got] == [25.0]
    with pytest.raises(Exception, match="give a sequence"):
        reads.klines(bars, ["a"], factors=factors.drop("seq")).collect()


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_merge_statements_puts_keys_first_and_keeps_null_keys(spark, hot_rows):
    schema = "v1 int, ts_code string, f_ann_date timestamp_ntz, end_date timestamp_ntz"
    left = [(i, "a", START, START) for i in range(5)] + [(9, None, START, START), (9, None, START, START), (7, "x", START, START)]
    right = [(10 + i, "a", START, START) for i in range(4)] + [(19, None, START, START), (8, "y", START, None)]
    tables = [spark.createDataFrame(d, schema) for d in (left, right, left[:2])]
    columns, got = rows(statements.merge_statements(*tables, hot_rows=hot_rows))
    assert columns == [*statements.KEYS, "v1", "v1_2", "v1_3"]
    want = [("a", START, START, i, 10 + j, k) for i in range(5) for j in range(4) for k in range(2)]
    want += [(None, START, START, 9, None, None)] * 2 + [("x", START, START, 7, None, None)]
    want += [(None, START, START, None, 19, None), ("y", START, None, None, 8, None)]
    assert got == sorted(want, key=repr)
    assert statements.merge_statements(tables[0], tables[1].limit(0)) is None


def test_nan_is_no_rise_and_no_high(spark):
    nan = float("nan")
    bars = spark.createDataFrame(
        [("a", "A", START, nan, 10.0), ("b", "B", START, 10.0, 10.0), ("c", "C", START, 12.0, nan), ("d", "D", START, 20.0, 10.0)],
        "symbol string, name string, dt timestamp_ntz, close double, preclose double",
    )
    assert breadth.market_breadth(bars, 0.5).first().ratio_of_perctg_gt == 0.25
    ticks = spark.createDataFrame([("a", START, p, 1, 1.0) for p in (1.0, nan, 3.0)], "symbol string, dt timestamp_ntz, last_price double, volume long, amount double")
    bar = resample.bars_from_ticks(ticks, "1w").first()
    assert (bar.high, bar.low) == (3.0, 1.0)


def test_sequence_settles_ticks_of_equal_times(spark):
    ticks = spark.createDataFrame(
        [("a", START, 5.0, 1, 1.0, 3), ("a", START, 7.0, 1, 1.0, 1), ("a", START, 6.0, 1, 1.0, 2)],
        "symbol string, dt timestamp_ntz, last_price double, volume long, amount double, seq int",
    )
    bar = resample.bars_from_ticks(ticks.repartition(3), "1d", sequence="seq").first()
    assert (bar.open, bar.close) == (7.0, 5.0)


def test_best_rows_beyond_the_map_side_limit(spark, monkeypatch):
    df = spark.range(500).select(F.lit("g").alias("by"), (F.col("id") % 40).alias("v"))
    want = [r.v for r in reads.best_rows(df, 30, "by", F.desc("v")).orderBy("v").collect()]
    monkeypatch.setattr(reads, "map_side_limit", lambda spark: 4)
    assert [r.v for r in reads.best_rows(df, 30, "by", F.desc("v")).orderBy("v").collect()] == want


def test_limit_up_concepts_of_days_equals_the_unbounded_form(spark):
    days = [START + timedelta(days=i) for i in range(6)]
    bars = spark.createDataFrame([(f"s{i % 3}", d, int((i + k) % 4 == 0)) for i in range(6) for k, d in enumerate(days)][:18], "symbol string, dt timestamp_ntz, maxupordown int")
    bars = bars.dropDuplicates(["symbol", "dt"])
    log = spark.createDataFrame([(f"c{i}.TI", f"s{i % 3}", days[i], 1, i) for i in range(6)], "index_code string, stock_code string, tradedate timestamp_ntz, op int, seq long")
    every = breadth.limit_up_concepts(bars, log, 3, 2)
    some = breadth.limit_up_concepts(bars, log, 3, 2, days=days[2:4])
    assert rows(some)[1] == rows(every.where(F.col("dt").isin(days[2:4])))[1]
    assert breadth.limit_up_concepts(bars, log, 3, 2, days=[]).count() == 0


SCHEMA = "symbol string, dt timestamp_ntz, close double, batch_id long"


@pytest.fixture
def flat_store(spark, tmp_path):
    """One file per day, named by the day, without a day column."""
    path = str(tmp_path / "flat")
    for i in range(3):
        day = START + timedelta(days=i)
        data = [("a", day, 1.0 + i, 1), ("b", day, 2.0 + i, 1)]
        spark.createDataFrame(data, SCHEMA).write.parquet(f"{path}/{day.date()}.parquet")
    return path


def test_maintenance_of_the_flat_layout(spark, flat_store):
    new = spark.createDataFrame([("a", 7.0), ("b", 8.0)], "symbol string, extra double")
    maintenance.merge_columns(spark, flat_store, "2024-01-02", new)
    assert rows(day_files.read_at(spark, flat_store, "2024-01-02", ["symbol", "extra"]))[1] == [("a", 7.0), ("b", 8.0)]
    maintenance.delete_rows(spark, flat_store, "symbol = 'a' AND dt < '2024-01-02'")
    maintenance.compact(spark, flat_store)
    maintenance.upsert(spark, flat_store, spark.createDataFrame([("b", START, 9.0, 2), ("c", START + timedelta(days=7), 4.0, 2)], SCHEMA))
    got = sorted((r.symbol, r.dt.day, r.close) for r in maintenance.read_dataset(spark, flat_store).collect())
    assert got == [("a", 2, 2.0), ("a", 3, 3.0), ("b", 1, 9.0), ("b", 2, 3.0), ("b", 3, 4.0), ("c", 8, 4.0)]
    assert day_files.list_days(spark, flat_store) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-08"]
    assert not [n for n in list_names(spark, flat_store.rsplit("/", 1)[0]) if "staging" in n]


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "days")
    data = [(s, START + timedelta(days=i), float(i), 1) for i in range(3) for s in "ab"]
    maintenance.write_days(spark.createDataFrame(data, SCHEMA), path)
    return path


def test_upsert_adds_a_new_column_and_keeps_the_latest_batch(spark, store):
    wide = SCHEMA + ", extra string"
    changes = [("a", START, 5.0, 3, "late"), ("a", START, 4.0, 2, "early"), ("b", START, 6.0, 0, "stale"), ("z", START, 1.0, 2, None)]
    maintenance.upsert(spark, store, spark.createDataFrame(changes, wide))
    got = {(r.symbol, r.dt.day): (r.close, r.batch_id, r.extra) for r in maintenance.read_dataset(spark, store).collect()}
    assert got[("a", 1)] == (5.0, 3, "late") and got[("b", 1)] == (0.0, 1, None) and got[("z", 1)] == (1.0, 2, None)
    assert got[("a", 2)] == (1.0, 1, None) and len(got) == 7


def test_rows_without_a_day(spark, store):
    with pytest.raises(Exception, match="no trading day"):
        maintenance.append(spark.createDataFrame([("a", None, 1.0, 2)], SCHEMA), store)
    # As another writer may leave them.
    stray = spark.createDataFrame([("q", None, 1.0, 2)], SCHEMA).withColumn("trade_date", F.lit(None).cast("date"))
    stray.write.mode("append").partitionBy("trade_date").parquet(store)
    assert day_files.list_days(spark, store) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    with pytest.raises(ValueError):
        day_files.read_first_days(spark, store, "2024-01-04")
    maintenance.delete_rows(spark, store, "symbol IN ('a', 'q')")
    maintenance.compact(spark, store)
    assert {r.symbol for r in maintenance.read_dataset(spark, store).collect()} == {"b"}


def test_staging_goes_even_on_failure(spark, store, monkeypatch):
    # The rename that makes the change certain.
    monkeypatch.setattr("barspan.sources.files.move", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        maintenance.delete_rows(spark, store, "symbol = 'a'")
    assert list_names(spark, store.rsplit("/", 1)[0]) == ["days"]
    assert maintenance.read_dataset(spark, store).count() == 6


def test_a_change_opens_only_its_own_days(spark, store):
    """A broken file of another day does no harm."""
    (part,) = [n for n in list_names(spark, f"{store}/trade_date=2024-01-02") if n.endswith(".parquet")]
    with open(f"{store}/trade_date=2024-01-02/{part}", "wb") as f:
        f.write(b"broken")
    maintenance.upsert(spark, store, spark.createDataFrame([("a", START, 5.0, 3)], SCHEMA))
    maintenance.compact(spark, store, [START.date()])
    got = maintenance.read_dataset(spark, store, ["2024-01-01"]).collect()
    assert sorted((r.symbol, r.close) for r in got) == [("a", 5.0), ("b", 0.0)]


def test_text_of_times_does_not_know_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS t, 1710037800123456789L AS n")
    df = df.select(*[timestamps.format_time(F.col("t"), u).alias(u) for u in ("s", "ms", "us")], timestamps.format_nanos(F.col("n")).alias("ns"))
    want = ("2024-03-10 02:30:00", "2024-03-10 02:30:00.123", "2024-03-10 02:30:00.123456", "2024-03-10 02:30:00.123456789")
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert tuple(df.first()) == want


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
    assert "/x-" in scratch_dir(spark, "x")


def test_two_files_of_one_name_are_no_view(spark, tmp_path):
    for year in ("2024", "2025"):
        spark.range(1).write.parquet(str(tmp_path / year / "bars.parquet"))
    with pytest.raises(ValueError, match="bars"):
        registry.register_sources(spark, {"x": {"uris": [str(tmp_path / y / "bars.parquet") for y in ("2024", "2025")]}})
