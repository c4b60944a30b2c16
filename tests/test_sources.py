"""Reads: CSV, day stores, ranges, document queries, labels, named sources."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barspan import schemas
from barspan.functions.predicates import in_range
from barspan.operators import adjust, maintenance, resample, series
from barspan.sources import day_files, delimited, grid, reads, registry


def _d(day, hour=0):
    return dt.datetime(2024, 4, day, hour)


@pytest.fixture(scope="module")
def daily(spark):
    rows, close = [], {}
    day = dt.date(2025, 4, 30)
    while day <= dt.date(2025, 8, 14):
        if day.weekday() < 5:
            for i, symbol in enumerate(["000001.SZ", "000006.SZ", "600000.SH"]):
                before = close.get(symbol, 10.0 + i)
                close[symbol] = round(before * (1 + ((day.toordinal() * 7 + i * 13) % 11 - 5) / 100), 2)
                pre = round(before * 0.9, 2) if (day.day + i) % 17 == 0 else before
                at = dt.datetime.combine(day, dt.time())
                rows.append((symbol, at, before, close[symbol] + 1, before - 1, close[symbol], pre, 100 + i, 1000.0))
        day += dt.timedelta(days=1)
    return spark.createDataFrame(
        rows, "symbol string, dt timestamp_ntz, open double, high double, low double, close double, preclose double, volume bigint, amount double"
    )


@pytest.fixture(scope="module")
def store(daily, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "daily_bars")
    maintenance.write_days(daily, path)
    return path


ADJ = ["dt", "symbol", "open", "high", "low", "close", "preclose"]


def test_inverted_range_fails(spark, store):
    with pytest.raises(ValueError):
        day_files.read_between(spark, store, "2025-08-16", "2025-08-14", ADJ, adjust=True)


def test_single_day_is_unadjusted(spark, store):
    one = day_files.read_between(spark, store, "2025-08-14", "2025-08-14", ADJ, adjust=True)
    assert {r.adjust_factor for r in one.collect()} == {1.0}
    same = day_files.read_at(spark, store, dt.date(2025, 8, 14), ADJ, adjust=True)
    assert sorted(one.collect()) == sorted(same.collect())
    assert one.select("dt").distinct().count() == 1


def test_n_days(spark, store):
    for df in (day_files.read_first_days(spark, store, "2025-07-14", 10), day_files.read_last_days(spark, store, "2025-08-14", 10)):
        assert df.where("symbol = '000006.SZ'").count() == 10
    assert day_files.read_last_days(spark, store, "2025-05-02", 50).select("trade_date").distinct().count() == 3
    with pytest.raises(ValueError):
        day_files.read_first_days(spark, store, "2026-01-01", 3)


def test_listed_days(spark, store):
    wanted = [dt.datetime(2025, 5, 6, 9), dt.date(2025, 5, 7), "2025-05-08"]
    assert day_files.read_days(spark, store, wanted).count() == 9
    empty = day_files.read_days(spark, store, [])
    assert empty.count() == 0 and "trade_date" in empty.columns
    with pytest.raises(FileNotFoundError):
        day_files.read_days(spark, store, ["2025-05-03"])


def test_adjust_needs_prices(spark, store):
    with pytest.raises(ValueError):
        day_files.read_at(spark, store, "2025-05-06", ["dt", "symbol", "open"], adjust=True)
    assert "adj_close" in day_files.read_at(spark, store, "2025-05-06", adjust=True).columns


def test_only_chosen_days_are_read(spark, store):
    plan = day_files.read_between(spark, store, "2025-05-06", "2025-05-07", ["symbol", "close"])
    assert len({f.split("trade_date=")[1][:10] for f in plan.inputFiles()}) == 2
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<symbol:string,close:double>" in text


def test_flat_files(spark, daily, tmp_path):
    for day in ("2025-05-06", "2025-05-07"):
        one = daily.where(F.to_date("dt") == F.lit(day).cast("date"))
        (one if day.endswith("06") else one.drop("volume").withColumn("extra", F.lit(1))).toPandas().astype(
            {"dt": "datetime64[us]"}
        ).to_parquet(tmp_path / f"{day}.parquet")
    df = day_files.read_between(spark, str(tmp_path), "2025-05-01", "2025-05-31")
    assert df.count() == 6 and "extra" not in df.columns
    assert df.where("volume IS NULL").count() == 3
    assert day_files.has_columns(df, ["volume", "non"]) == [True, False]
    assert not day_files.has_all_columns(df, ["name", "open", "non"])
    assert not day_files.has_any_columns(df, ["abc", "non", "foo"])


@pytest.mark.parametrize("freq, periods", [("1mo", 5), ("1w", 16)])
def test_resample(daily, freq, periods):
    days = adjust.forward_adjust(daily).where("symbol = '000001.SZ'").orderBy("dt").collect()
    bars = resample.resample_adjusted(daily, freq).where("symbol = '000001.SZ'").orderBy("dt").collect()
    assert len(bars) == periods
    assert bars[0][f"open_{freq}"] == days[0].adj_open
    assert bars[-1][f"close_{freq}"] == days[-1].adj_close == days[-1].close
    assert sum(b[f"volume_{freq}"] for b in bars) == sum(d.volume for d in days)
    assert bars[0].dt.weekday() == 0 if freq == "1w" else bars[0].dt.day == 1


# The header of the published sample.
CSV_HEADER = (
    "symbol,dt,name,_open,_high,_low,_close,volume,amount,preclose,net_profit_ttm,cashflow_ttm,equity,asset,debt,debttoasset,"
    "net_profit_q,pe_ttm,pb,mkt_cap,mkt_cap_ashare,vip_buy_amt,vip_sell_amt,inst_buy_amt,inst_sell_amt,mid_buy_amt,mid_sell_amt,"
    "indi_buy_amt,indi_sell_amt,master_net_flow_in,master2_net_flow_in,vip_net_flow_in,mid_net_flow_in,inst_net_flow_in,"
    "indi_net_flow_in,total_sell_amt,total_buy_amt,net_flow_in,turnover,free_shares,total_shares,maxupordown,maxupordown_at_open,"
    "lb_up_count,lb_down_count,close,open,high,low"
)
# One published daily bar.
CSV_ROW = (
    '"000001.SZ","2024-09-02 00:00:00.000","平安银行",10.08000,10.21000,10.05000,10.13000,126036761,1277042001,10.03000,'
    "46947000320.00000,161941995520.00000,481869004800.00000,5754033012736.00000,5272164106240.00000,0.91626,10947000320.00000,"
    "4.18730,0.47720,196581951346.000000000,196578905559.000000000,36871.17188,47651.91016,41308.48828,27590.83984,29032.00000,"
    "29776.36914,20492.53906,22685.08008,2936.90991,2192.54004,-10780.74023,-744.37000,13717.65039,-2192.54004,127704.20312,"
    "127704.20312,-0.00000,0.00649,19405617528,19405918198,0,0,0,0,10.13000,10.08000,10.21000,10.05000"
)


def test_daily_csv_and_derived_columns(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text(f"{CSV_HEADER}\n{CSV_ROW}\n", encoding="utf-8")
    df = delimited.read_daily_csv(spark, str(path), schemas.DAILY_WITH_SYMBOL)
    from barspan.functions import bar_columns

    got = df.first()
    assert (got.symbol, got.dt, got.volume, got.maxupordown) == ("000001.SZ", dt.datetime(2024, 9, 2), 126036761, 0)
    again = bar_columns.valuation(bar_columns.money_flow(df)).first()
    for c in ["mkt_cap", "mkt_cap_ashare", "pe_ttm", "turnover", "debttoasset", "master_net_flow_in", "master2_net_flow_in",
              "vip_net_flow_in", "mid_net_flow_in", "inst_net_flow_in", "indi_net_flow_in"]:
        assert again[c] == pytest.approx(got[c], rel=1e-3), c


def test_bad_csv_fails(spark, tmp_path):
    path = tmp_path / "ticks.csv"
    names = [f.split()[0] for f in schemas.TICKS.split(", ")]
    path.write_text(",".join(names) + "\n2024-01-02 09:30:00.500000,1.5,oops,1,1,1,1,1,1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|oops"):
        delimited.read_ticks_csv(spark, str(path)).collect()


def test_ticks_csv(spark, tmp_path):
    path = tmp_path / "ticks.csv"
    names = [f.split()[0] for f in schemas.TICKS.split(", ")]
    path.write_text(",".join(names) + "\n2024-01-02 09:30:00.500123,1.5,3,1,1,1.4,1.6,1,1\n")
    assert delimited.read_ticks_csv(spark, str(path)).first().dt == dt.datetime(2024, 1, 2, 9, 30, 0, 500123)


@pytest.mark.parametrize("side, days", [("both", [2, 3, 4]), ("left", [2, 3]), ("right", [3, 4]), (None, [3])])
def test_sides(spark, side, days):
    df = spark.createDataFrame([(_d(d),) for d in range(1, 6)], "dt timestamp_ntz")
    assert [r.dt.day for r in reads.time_range(df, _d(2), _d(4), side).orderBy("dt").collect()] == days
    assert reads.time_range(df, start=_d(3)).count() == 3
    assert reads.time_range(df, end=dt.datetime(1970, 1, 1)).count() == 0
    with pytest.raises(ValueError):
        in_range(F.col("dt"), side="neither")


@pytest.mark.parametrize("n", [1, 5, 1000])
@pytest.mark.parametrize("fields", [None, ["symbol", "open"]])
def test_last_rows_of_table(daily, n, fields):
    out = reads.last_rows_of_table(daily, n, fields, order=("dt", "symbol"))
    assert out.count() == min(n, daily.count())
    assert out.collect()[-1].symbol == "600000.SH"
    if fields is None:
        assert out.collect()[-1].dt == dt.datetime(2025, 8, 14)


def test_label_slice_golden(spark):
    days = [dt.datetime(2024, 4, d) for d in (23, 24, 25, 26, 29, 30)]
    df = spark.createDataFrame([(s, d, "n") for s in ("000001.SZ", "000002.SZ") for d in days], "symbol string, dt timestamp_ntz, name string")
    got = grid.label_slice(df, {"symbol": "000001.SZ", "dt": slice(days[2], days[4])}, ["name"])
    assert [r.dt.day for r in got.orderBy("dt").collect()] == [25, 26, 29]
    mixed = grid.label_slice(df, {"dt": [(days[0], days[1]), days[5], days[1]]})
    assert mixed.count() == 6
    assert grid.label_slice(df, {"symbol": slice(None, None)}).count() == 12
    assert {r.dt for r in grid.last_dts(df).collect()} == {days[-1]}


def test_find(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 3.0), (3, "b", 5.0)], "id int, k string, v double")
    assert [r.id for r in reads.find(df, {"k": "b", "v": {"$gt": 2, "$lte": 5}}, sort=[("v", -1)], limit=1).collect()] == [3]
    assert reads.find(df, {"v": None}, {"id": 1}).collect() == [(1,)]
    assert reads.find(df, projection={"v": 0}).columns == ["id", "k"]
    assert reads.find(df, {"$and": [{"id": {"$gte": 2}}, {"k": "b"}]}).count() == 2
    with pytest.raises(ValueError):
        reads.find(df, {"v": {"$regex": "x"}})


def test_registry(spark, daily, tmp_path):
    daily.write.parquet(str(tmp_path / "reg_bars.parquet"))
    daily.limit(2).select("symbol").write.json(str(tmp_path / "reg_docs.json"))
    config = {
        "bars": {"uris": [str(tmp_path / "reg_bars.parquet")]},
        "docs": {"uri": str(tmp_path / "reg_docs.json"), "format": "json", "schema": "symbol string"},
        "services": {"live": {"documents": "docs"}},
    }
    (tmp_path / "config.json").write_text(json.dumps(config))
    loaded = registry.load_config(str(tmp_path / "config.json"))
    assert registry.register_sources(spark, loaded, "live") == ["reg_docs"]
    assert registry.register_sources(spark, loaded) == ["reg_bars", "reg_docs"]
    assert spark.table("reg_bars").count() == daily.count()


def test_series_blocks_cover_all_rows(daily):
    blocks = series.series_blocks(daily, ["dt", "close"], block_rows=7).collect()
    assert max(b.n_rows for b in blocks) == 7
    for symbol in {b.symbol for b in blocks}:
        mine = sorted((b for b in blocks if b.symbol == symbol), key=lambda b: b.block)
        joined = [t for b in mine for t in b.dt]
        assert joined == sorted(joined) and len(joined) == daily.where(F.col("symbol") == symbol).count()


def test_map_rows_keeps_types(spark):
    df = spark.createDataFrame([(1, None, _d(1)), (None, "x", None)], "a bigint, b string, t timestamp_ntz")
    out = series.map_rows(df, lambda r: (r["a"], r["b"], r["t"]), "a bigint, b string, t timestamp_ntz")
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_read_one_file(spark, daily, tmp_path):
    daily.write.parquet(str(tmp_path / "one.parquet"))
    df = day_files.read_parquet(spark, str(tmp_path / "one.parquet"), ["dt", "close"])
    assert df.columns == ["dt", "close"] and df.count() == daily.count()
    assert day_files.read_parquet(spark, str(tmp_path / "one.parquet")).columns == daily.columns


def test_filters_reach_the_scan(spark, daily, tmp_path):
    daily.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    df = reads.time_range(stored, "2025-05-06", "2025-05-20", "left", ["symbol", "close"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(dt,2025-05-06" in plan and "LessThan(dt,2025-05-20" in plan
    assert "ReadSchema: struct<symbol:string,dt:timestamp_ntz,close:double>" in plan


def test_unknown_frequency(daily):
    for freq in ("1q", "min", "x5min"):
        with pytest.raises(ValueError):
            resample.resample(daily, freq)
