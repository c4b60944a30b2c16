"""Registered queries: every operator over the whole test tables, all symbols at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barspan.functions import bar_columns, timestamps
from barspan.functions.predicates import legacy_table_name
from barspan.operators import adjust, breadth, chunks, maintenance, membership, resample, series, statements, versions
from barspan.operators import trading_calendar as cal
from barspan.plans import standins as data
from barspan.schemas import DAILY_WITH_SYMBOL, TICKS_WITH_SYMBOL
from barspan.session import scratch_dir
from barspan.sources import day_files, delimited, grid, reads, registry, stored_factors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Points in time used as parameters.
RANGE = ("2024-01-08 00:00:00", "2024-01-20 00:00:00")
MEMBERS_AT = "1999-01-01 00:00:00"
MEMBERS_ATS = ("1992-02-01 00:00:00", "1995-07-01 00:00:00", "1998-12-31 00:00:00")
BAR_COLUMNS = ["symbol", "dt", "open", "high", "low", "close", "volume"]
CONCEPTS = ["885503.TI", "885507.TI", "885511.TI", "885514.TI"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in columns})


# Range reads, projections, first and last rows


def _range_read(side: str | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return reads.time_range(data.daily_bars(spark, sf), *RANGE, side=side, fields=BAR_COLUMNS)

    return run


for _name, _side in {"both": "both", "left": "left", "right": "right", "none": None}.items():
    QUERIES[f"range_read_{_name}"] = _range_read(_side)


@query
def sql_filter_project(spark, sf):
    data.daily_bars(spark, sf).createOrReplaceTempView("bars_daily")
    where = "dt > TIMESTAMP_NTZ'2024-01-10 00:00:00' AND open > 20.5"
    return reads.read_table(spark, "bars_daily", ["symbol", "dt", "name", "open"], where)


@query
def full_table(spark, sf):
    return rounded(data.daily_bars(spark, sf), "amount", "preclose")


@query
def doc_find(spark, sf):
    docs = data.table(spark, sf, "orders")
    picked = reads.find(
        docs,
        {"$and": [{"o_orderstatus": "O"}, {"o_totalprice": {"$gte": 100000.0}}], "o_orderkey": {"$gt": 10}},
        projection={"o_orderpriority": 0},
        sort=[("o_totalprice", -1), ("o_orderkey", 1)],
        limit=250,
    )
    return picked


@query
def last_n_per_symbol(spark, sf):
    return reads.last_rows(data.all_quotes(spark, sf), 5)


@query
def first_n_per_symbol(spark, sf):
    return reads.first_rows(data.all_quotes(spark, sf), 5)


@query
def last_n_table(spark, sf):
    q = data.all_quotes(spark, sf)
    return reads.last_rows_of_table(q, 1000, ["symbol", "last_price"], RANGE[1], order=("dt", "symbol"))


@query
def capped_range(spark, sf):
    return reads.capped_range(data.all_quotes(spark, sf), *RANGE, max_count=7, side="left")


@query
def capped_range_from(spark, sf):
    return reads.capped_range(data.all_quotes(spark, sf), RANGE[0], max_count=3)


@query
def first_n_days(spark, sf):
    return day_files.first_days(data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date"), 10, "2024-01-14")


@query
def last_n_days(spark, sf):
    return day_files.last_days(data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date"), 10, "2024-01-14")


@query
def days_list(spark, sf):
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date")
    return day_files.listed_days(bars, ["2024-01-03", "2024-01-09", "2024-01-28"])


@query
def cross_section_tags(spark, sf):
    info = data.basic_info(spark, sf).select("symbol", "industry", "status")
    tagged = data.daily_bars(spark, sf).join(info, "symbol")
    tags = {"industry": ["BUILDING", "MACHINERY", "FURNITURE"], "status": ["L"]}
    return reads.cross_section(tagged, "2024-01-17 00:00:00", tags, ["symbol", "dt", "close", "industry"])


# Label access on the grid


@query
def label_slice(spark, sf):
    at = [F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in ("05", "08", "11", "20")]
    axes = {"dt": [(at[0], at[1]), at[2], slice(at[3], None)], "symbol": slice("1", "7")}
    return grid.label_slice(data.daily_bars(spark, sf), axes, ["name", "close"])


@query
def last_dt_slice(spark, sf):
    return grid.last_dts(data.daily_bars(spark, sf), 2, ["name", "close"])


@query
def axis_labels_symbol(spark, sf):
    return grid.axis_labels(data.ticks(spark, sf), "symbol")


@query
def axis_labels_dt(spark, sf):
    return grid.axis_labels(data.daily_bars(spark, sf), "dt")


@query
def grid_shape(spark, sf):
    return grid.grid_shape(data.daily_bars(spark, sf))


@query
def dense_grid(spark, sf):
    return grid.dense_grid(data.daily_bars(spark, sf).select("symbol", "dt", "close", "volume"))


# Adjustment and resampling


@query
def forward_adjust(spark, sf):
    out = adjust.forward_adjust(data.daily_bars(spark, sf).select(*BAR_COLUMNS, "preclose"))
    out = out.drop("volume")
    return rounded(out, "preclose", "adjust_factor", "adj_open", "adj_high", "adj_low", "adj_close")


@query
def forward_adjust_chunked(spark, sf):
    """The way taken for hot symbols."""
    bars = data.daily_bars(spark, sf).select("symbol", "dt", "close", "preclose")
    return rounded(adjust.forward_adjust(bars, chunk_seconds=7 * chunks.DAY), "preclose", "adjust_factor", "adj_close")


@query
def previous_close(spark, sf):
    bars = data.daily_bars(spark, sf).select("symbol", "dt", "close")
    return chunks.with_previous(bars, ["symbol"], ["dt"], {"previous_close": "close"}, 7 * chunks.DAY)


def _asof(method: str, broadcast: bool | None, chunk_seconds: int | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = adjust.asof_adjust(data.quotes(spark, sf), data.factors(spark, sf), method, "seq", broadcast, chunk_seconds)
        return rounded(out, "last_price", "bid_price1")

    return run


QUERIES["asof_adjust_multiply"] = _asof("multiply", None)
QUERIES["asof_adjust_minus"] = _asof("minus", None)
# The way taken for factor tables too large to broadcast.
QUERIES["asof_adjust_merged"] = _asof("multiply", False)
QUERIES["asof_adjust_chunked"] = _asof("multiply", False, chunks.DAY)


@query
def factor_spans(spark, sf):
    points = adjust.latest_factors(data.factors(spark, sf), ["symbol"], "tradedate", "adjust_factor", "seq")
    return rounded(adjust.validity_spans(points, ["symbol"], "tradedate"), "adjust_factor")


@query
def forward_fill(spark, sf):
    filled = chunks.forward_fill(data.sparse_factors(spark, sf), ["symbol"], "dt", "factor", "filled")
    return rounded(filled, "factor", "filled")


@query
def forward_fill_chunked(spark, sf):
    filled = chunks.forward_fill(data.sparse_factors(spark, sf), ["symbol"], "dt", "factor", "filled", chunks.DAY)
    return rounded(filled, "factor", "filled")


@query
def klines(spark, sf):
    bars = data.interval_bars(spark, sf).select(*BAR_COLUMNS, "interval")
    out = reads.klines(
        bars, intervals=["1h", "1d"], max_count=5, end=RANGE[1], factors=data.factors(spark, sf).drop("seq")
    )
    return rounded(out, "open", "high", "low", "close")


@query
def klines_of_symbols(spark, sf):
    """The listed symbols in a range with a start, and two factors of each time of which the later one counts."""
    bars = data.interval_bars(spark, sf).select(*BAR_COLUMNS, "interval")
    factors = data.factors(spark, sf)
    again = factors.withColumns({"adjust_factor": F.col("adjust_factor") - 0.5, "seq": F.col("seq") + 1_000_000_000})
    listed = breadth.listed_only(bars, data.listed_info(spark, sf))
    out = reads.klines(listed, None, ["1d"], 4, start=RANGE[0], factors=factors.unionByName(again), sequence="seq")
    return rounded(out, "open", "high", "low", "close")


def _resampled(freq: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = resample.resample_adjusted(data.daily_bars(spark, sf), freq)
        return rounded(out, *[f"{c}_{freq}" for c in ("open", "high", "low", "close", "amount")])

    return run


QUERIES["resample_week"] = _resampled("1w")
QUERIES["resample_month"] = _resampled("1mo")


@query
def bars_5min(spark, sf):
    return rounded(resample.bars_from_ticks(data.ticks(spark, sf), "5min"), "amount")


@query
def bars_2h(spark, sf):
    five = resample.bars_from_ticks(data.ticks(spark, sf), "5min")
    return rounded(resample.resample(five, "2h"), "amount")


# Series of one symbol


@query
def row_counts(spark, sf):
    return series.row_counts(data.ticks(spark, sf))


@query
def series_by_symbol(spark, sf):
    blocks = series.series_blocks(
        data.ticks(spark, sf).withColumn("cents", F.round(F.col("last_price") * 100).cast("bigint")),
        ["cents"], block_rows=20,
    )
    return blocks.withColumn("cents", F.array_join(F.col("cents").cast("array<string>"), ","))


@query
def gather_fields(spark, sf):
    docs = data.statements(spark, sf).select(
        "ts_code",
        "f_ann_date",
        "report_id",
        F.when(F.col("status") != "F", F.round(F.col("amount") * 100).cast("bigint")).alias("amount"),
        F.when(F.col("priority") != "5-LOW", F.col("priority")).alias("priority"),
    )
    out = series.gather_fields(
        docs, ["amount", "priority"], ["ts_code"], ["f_ann_date", "report_id"], 25, chunks.YEAR
    )
    return out.withColumn("present_values", F.array_join("present_values", "|"))


@query
def map_rows(spark, sf):
    def convert(row):
        price = row["last_price"]
        return row["event_id"], row["symbol"].zfill(6), "high" if price >= 100 else "low", int(price * 100 + 0.5)

    out = "event_id bigint, symbol string, band string, cents bigint"
    return series.map_rows(data.ticks(spark, sf).select("event_id", "symbol", "last_price"), convert, out)


# Market statistics


@query
def market_breadth(spark, sf):
    out = breadth.market_breadth(data.daily_bars(spark, sf), 0.5, data.listed_info(spark, sf))
    return rounded(out, "ratio_of_perctg_gt")


@query
def market_breadth_nan(spark, sf):
    """NaN closes are unknown returns."""
    bars = data.daily_bars(spark, sf)
    bars = bars.withColumn("close", F.when(F.col("volume") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("close")))
    return rounded(breadth.market_breadth(bars, 0.5), "ratio_of_perctg_gt")


@query
def resample_nan(spark, sf):
    """Weekly bars of daily bars with NaN prices, which are no high and no low."""
    bars = data.daily_bars(spark, sf)
    bars = bars.withColumn("high", F.when(F.col("volume") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("high")))
    return rounded(resample.resample(bars, "1w").select("symbol", "dt", "high", "low", "volume"), "high", "low")


@query
def recent_limit_up(spark, sf):
    return breadth.recent_limit_up(data.daily_bars(spark, sf), 10)


@query
def limit_up_streaks(spark, sf):
    return breadth.limit_streaks(data.daily_bars(spark, sf).select("symbol", "dt", "maxupordown"))


@query
def limit_up_streaks_chunked(spark, sf):
    """The way taken for hot symbols: five days a chunk, and streaks that go on over their bounds."""
    bars = data.daily_bars(spark, sf).select("symbol", "dt", "maxupordown")
    return breadth.limit_streaks(bars.withColumn("maxupordown", F.abs("maxupordown").cast("tinyint")), 5 * chunks.DAY)


@query
def limitup_concepts(spark, sf):
    return breadth.limit_up_concepts(
        data.daily_bars(spark, sf), data.recent_membership_log(spark, sf), m=5, n=3, basic_info=data.basic_info(spark, sf)
    )


@query
def limitup_concepts_days(spark, sf):
    days = ["2024-01-10", "2024-01-16", "2024-01-17"]
    log, info = data.recent_membership_log(spark, sf), data.basic_info(spark, sf)
    return breadth.limit_up_concepts(data.daily_bars(spark, sf), log, m=5, n=3, days=days, basic_info=info)


@query
def top_rank_concepts(spark, sf):
    return breadth.top_rank_concepts(data.index_bars(spark, sf), top_n=3, m=12, until=RANGE[1])


@query
def hot_list(spark, sf):
    return breadth.hot_list(data.hot_ranking(spark, sf), 10)


@query
def hot_list_of_day(spark, sf):
    return breadth.hot_list(data.hot_ranking(spark, sf), 10, "2024-01-16 00:00:00")


@query
def market_stats(spark, sf):
    out = breadth.market_stats(data.daily_bars(spark, sf))
    out = out.withColumn("lb", F.array_join(F.col("lb").cast("array<string>"), ","))
    return rounded(out, *[c for c in out.columns if c.startswith("ratio_of_")])


@query
def derived_columns(spark, sf):
    bars = data.daily_bars(spark, sf)
    # Fixed stand-ins for the fundamental and money-flow inputs, all taken from the bar itself.
    inputs = {
        "_close": F.col("close"),
        "total_shares": F.col("volume") * 1000,
        "free_shares": F.col("volume") * 600,
        "net_profit_ttm": F.col("low"),
        "debt": F.col("low"),
        "asset": F.col("high"),
        "vip_buy_amt": F.col("high"),
        "vip_sell_amt": F.col("low"),
        "inst_buy_amt": F.col("open"),
        "inst_sell_amt": F.col("close"),
        "mid_buy_amt": F.col("close"),
        "mid_sell_amt": F.col("low"),
        "indi_buy_amt": F.col("low"),
        "indi_sell_amt": F.col("open"),
        "total_buy_amt": F.col("high") * 2,
        "total_sell_amt": F.col("open"),
    }
    out = bar_columns.valuation(bar_columns.money_flow(bars.withColumns(inputs)))
    names = [
        "mkt_cap", "mkt_cap_ashare", "pe_ttm", "turnover", "debttoasset", "vip_net_flow_in", "inst_net_flow_in",
        "mid_net_flow_in", "indi_net_flow_in", "master_net_flow_in", "master2_net_flow_in", "net_flow_in",
    ]
    return out.select("symbol", "dt", *names)


# Membership


@query
def members_of_index(spark, sf):
    return membership.members(data.membership_log(spark, sf), MEMBERS_AT)


@query
def members_from_snapshots(spark, sf):
    """Members at three times from a stored log: in its first period, in the middle and at the end."""
    path = scratch_dir(spark, "membership")
    membership.write_snapshots(data.membership_log(spark, sf), path, months=6)
    found = [membership.members_from_snapshots(spark, path, at).withColumn("at", F.lit(at)) for at in MEMBERS_ATS]
    return reduce(DataFrame.unionByName, found)


@query
def indexes_of_stock(spark, sf):
    return membership.indexes_of_stocks(data.membership_log(spark, sf), MEMBERS_AT)


@query
def stocks_in_concepts(spark, sf):
    return membership.in_concepts(data.stocks(spark, sf), data.membership_log(spark, sf), MEMBERS_AT, CONCEPTS)


@query
def top_concepts(spark, sf):
    return membership.top_concepts(data.stocks(spark, sf), data.membership_log(spark, sf), MEMBERS_AT, 12)


@query
def concepts_per_stock(spark, sf):
    out = membership.concepts_per_stock(data.stocks(spark, sf), data.membership_log(spark, sf), MEMBERS_AT)
    return out.withColumn("concepts", F.array_join("concepts", ","))


@query
def membership_spans(spark, sf):
    return membership.membership_spans(data.membership_log(spark, sf))


# Calendar and times


@query
def calendar_list(spark, sf):
    return cal.open_days(data.calendar(spark, sf), "1996-02-10 12:00:00", "2001-03-05 00:00:00")


@query
def calendar_prev_next(spark, sf):
    return cal.last_and_next_open(data.calendar(spark, sf), "1998-08-18 23:00:00")


@query
def align_to_calendar(spark, sf):
    shifted = data.statements(spark, sf).select("report_id", F.col("end_date").alias("dt"))
    return cal.align_to_calendar(shifted, data.calendar(spark, sf))


@query
def calendar_dimension(spark, sf):
    span = data.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return cal.calendar_dimension(cal.date_range(F.to_date("lo"), F.to_date("hi"), span))


def _time_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as text in accepted and rejected layouts."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    layout = F.col("event_id") % 7
    return data.table(spark, sf, "events").select(
        "event_id",
        F.when(layout == 0, text)
        .when(layout == 1, F.substring(text, 1, 23))
        .when(layout == 2, F.substring(text, 1, 19))
        .when(layout == 3, F.concat(text, F.lit("789")))
        .when(layout == 4, F.substring(text, 1, 22))
        .when(layout == 5, F.concat(F.substring(text, 1, 21), F.lit("g99")))
        .otherwise(F.concat(F.lit("2024-02-30"), F.substring(text, 11, 9)))
        .alias("text"),
    )


@query
def normalise_timestamps(spark, sf):
    parsed, _ = timestamps.split_parsed(_time_texts(spark, sf), "text")
    us = timestamps.to_epoch(F.col("dt"), "us")
    return parsed.select(
        "event_id",
        "dt",
        us.alias("epoch_us"),
        timestamps.format_time(F.col("dt"), "ms").alias("text_ms"),
        timestamps.format_nanos(us * 1000 + 7).alias("text_ns"),
        timestamps.from_epoch(timestamps.to_epoch(F.col("dt"), "ms"), "ms").alias("dt_ms"),
        timestamps.from_epoch(us * 1000 + 999, "ns").alias("dt_ns"),
        timestamps.from_epoch(timestamps.to_epoch(F.col("dt"), "s"), "s").alias("dt_s"),
        timestamps.micros_between(F.lit("2000-01-01").cast("timestamp_ntz"), F.col("dt")).alias("micros_since_2000"),
    )


@query
def rejected_timestamps(spark, sf):
    """Texts that are no time, and epochs beyond the range of times, as text."""
    _, rejected = timestamps.split_parsed(_time_texts(spark, sf), "text")
    # Event numbers scaled up to where some fit and others don't, or not even a 64-bit number of microseconds does.
    # Decimals, as the epochs of event numbers from 922,438 on don't fit 64 bits; any 64-bit event number gives at most 33 digits.
    number = F.col("event_id").cast("decimal(20,0)")
    epochs = data.table(spark, sf, "events").select("event_id", ((number - 100) * 1_000_000_000_000_0).alias("epoch"))
    _, beyond = timestamps.split_epochs(epochs, "epoch", "s")
    return rejected.unionByName(beyond.select("event_id", F.col("epoch").cast("string").alias("text")))



# Statements


@query
def statements_clean(spark, sf):
    return statements.clean_statements(data.statements(spark, sf), ["amount", "report_id"])


@query
def statements_merge(spark, sf):
    return statements.merge_statements(*_statement_tables(spark, sf))


@query
def statements_merge_salted(spark, sf):
    """The way taken when a key pairs very many rows."""
    return statements.merge_statements(*_statement_tables(spark, sf), hot_rows=1)


def _statement_tables(spark: SparkSession, sf: str) -> list[DataFrame]:
    s = data.statements(spark, sf)
    income = s.select("ts_code", "f_ann_date", "end_date", "amount", F.col("report_id").alias("income_id"))
    urgent = F.col("priority").isin("1-URGENT", "2-HIGH")
    balance = s.where(urgent).select(*statements.KEYS, "amount", F.col("report_id").alias("balance_id"))
    cashflow = s.where(F.col("status") != "F").select(*statements.KEYS, "status")
    return [statements.clean_statements(t) for t in (income, balance, cashflow)]


# Ingest and maintenance: datasets are written below the shared scratch folder


def _dataset(spark: SparkSession, sf: str, label: str, bars: DataFrame | None = None) -> tuple[str, DataFrame]:
    path = scratch_dir(spark, label)
    bars = bars if bars is not None else data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date")
    maintenance.create_if_absent(bars, path)
    return path, bars


@query
def csv_ingest(spark, sf):
    path = scratch_dir(spark, "csv")
    bars = data.daily_bars(spark, sf)
    known = set(bars.columns)
    fields = StructType.fromDDL(DAILY_WITH_SYMBOL)
    wide = bars.select(
        *[F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    ).withColumn("amount", F.round("amount").cast("bigint"))
    wide.write.option("header", True).csv(path)
    back = delimited.read_daily_csv(spark, path, DAILY_WITH_SYMBOL)
    return back.select(*BAR_COLUMNS, "name", "amount", "maxupordown", "pe_ttm").withColumn(
        "table_name", F.concat(F.lit("bars_daily_"), legacy_table_name(F.concat("symbol", F.lit(".SZ"))))
    )


@query
def ticks_csv_ingest(spark, sf):
    path = scratch_dir(spark, "ticks-csv")
    ticks = data.ticks(spark, sf).select(
        "symbol", "dt", "last_price", "volume", F.lit(None).cast("bigint").alias("amount"), F.col("event_id").alias("open_interest"),
        (F.col("last_price") - 0.5).alias("bid_price1"), (F.col("last_price") + 0.5).alias("ask_price1"),
        F.lit(None).cast("bigint").alias("bid_volume1"), F.col("volume").alias("ask_volume1"),
    )
    # Spark writes milliseconds unless told otherwise; ticks have microseconds.
    ticks.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return delimited.read_ticks_csv(spark, path, TICKS_WITH_SYMBOL)


@query
def packed_dates_ingest(spark, sf):
    path = scratch_dir(spark, "calendar-csv")
    days = data.calendar(spark, sf).select(F.date_format("day", "yyyyMMdd").alias("dt"), "status", F.lit("x").alias("note"))
    days.withColumnRenamed("status", "is_open").write.option("header", True).csv(path)
    schema = "dt string, is_open tinyint, note string"
    return delimited.read_packed_dates_csv(spark, path, schema, ["dt"], {"dt": "day", "is_open": "status"}, ["note"], "")


@query
def create_and_reload(spark, sf):
    path, bars = _dataset(spark, sf, "reload")
    # The dataset exists, so this changes nothing; the reload does.
    maintenance.create_if_absent(bars.limit(0), path)
    stored = maintenance.read_dataset(spark, path).select("symbol", "dt", "close")
    later = scratch_dir(spark, "reload")
    maintenance.create_if_absent(bars.where("volume > 5"), later)
    maintenance.reload(stored, later)
    return maintenance.read_dataset(spark, later)


@query
def append(spark, sf):
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "maxupordown", "trade_date")
    path, _ = _dataset(spark, sf, "append", bars.where("dt < '2024-01-16'"))
    maintenance.append(bars, path, where="dt >= '2024-01-16' AND maxupordown <> 0")
    return maintenance.read_dataset(spark, path)


@query
def delete(spark, sf):
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "preclose", "trade_date")
    path, _ = _dataset(spark, sf, "delete", bars)
    maintenance.delete_rows(spark, path, "close > preclose OR dt = '2024-01-09 00:00:00'")
    maintenance.delete_rows(spark, path, "dt = '1990-01-01 00:00:00'")
    return rounded(maintenance.read_dataset(spark, path), "preclose")


@query
def day_merge(spark, sf):
    path, bars = _dataset(spark, sf, "merge")
    day = "2024-01-15"
    one = bars.where(F.col("trade_date") == F.lit(day).cast("date"))
    extra = one.select("symbol", (F.col("close") * 2).alias("close"), (F.col("high") - F.col("low")).alias("spread"))
    maintenance.merge_columns(spark, path, day, extra)
    replaced = one.select("symbol", (F.col("volume") + 100).alias("volume"))
    maintenance.merge_columns(spark, path, day, replaced, replace_origin=True)
    return rounded(maintenance.read_dataset(spark, path), "spread")


def _flat_dataset(spark: SparkSession, sf: str, label: str, *columns: str) -> tuple[str, DataFrame]:
    """A store of one file per trading day."""
    path = scratch_dir(spark, label)
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, *columns)
    maintenance.create_flat(bars, path)
    return path, bars


@query
def day_merge_flat(spark, sf):
    """The same on a store of one file per day; the other days are neither read nor written."""
    path, _ = _flat_dataset(spark, sf, "flat")
    one = day_files.read_at(spark, path, "2024-01-15")
    extra = one.select("symbol", (F.col("close") * 2).alias("close"), (F.col("high") - F.col("low")).alias("spread"))
    maintenance.merge_columns(spark, path, "2024-01-15", extra, replace_origin=True)
    return rounded(maintenance.read_dataset(spark, path), "close", "spread")


@query
def append_flat(spark, sf):
    """Rows for days that have a file and for new ones; each day stays one file."""
    path = scratch_dir(spark, "flat")
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "maxupordown")
    maintenance.create_flat(bars.where("dt < '2024-01-16' AND volume <= 2"), path)
    maintenance.append(bars.drop("maxupordown"), path, where="dt >= '2024-01-16' OR volume > 2")
    return maintenance.read_dataset(spark, path)


@query
def drop_fields_flat(spark, sf):
    path, _ = _flat_dataset(spark, sf, "flat", "maxupordown", "name")
    maintenance.drop_fields(spark, path, ["name", "volume"])
    return maintenance.read_dataset(spark, path)


@query
def undo_upsert(spark, sf):
    """Four batches of cells, of which two are undone: what they had replaced is back, and later batches stay."""
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date")
    path, _ = _dataset(spark, sf, "versions", bars.withColumn("batch_id", F.lit(1).cast("bigint")))
    cell = lambda where, **new: bars.where(where).select("symbol", "dt", *[c.alias(n) for n, c in new.items()])
    versions.write_batch(cell("volume >= 2", close=F.col("close") + 1, high=F.lit(None).cast("double")), path, 2)
    versions.write_batch(cell("volume >= 3", close=F.col("close") + 2), path, 3)
    versions.write_batch(cell("volume >= 4", close=F.col("close") + 3), path, 4)
    new = cell("volume = 1", close=F.col("close")).withColumn("symbol", F.concat(F.lit("N"), "symbol"))
    versions.write_batch(new, path, 5)
    maintenance.undo_batches(spark, path, 3, 3)
    maintenance.undo_batches(spark, path, 5, 9)
    return rounded(versions.read_versions(spark, path), "close")


@query
def versions_as_of(spark, sf):
    """The same cells after the first of three batches, from a store whose history up to the second was folded elsewhere."""
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date")
    path, _ = _dataset(spark, sf, "versions", bars.withColumn("batch_id", F.lit(1).cast("bigint")))
    for batch, least in ((2, 2), (3, 3), (4, 4)):
        versions.write_batch(bars.where(F.col("volume") >= least).select("symbol", "dt", (F.col("close") + batch).alias("close")), path, batch)
    early = versions.read_versions(spark, path, until=2)
    # Written before the store is folded up to batch 3.
    folder = scratch_dir(spark, "early")
    early.write.parquet(folder)
    versions.settle(spark, path, until=3)
    late = versions.read_versions(spark, path, until=3)
    both = spark.read.parquet(folder).withColumn("part", F.lit("early")).unionByName(late.withColumn("part", F.lit("late")))
    return rounded(both, "close")


@query
def upsert(spark, sf):
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date")
    path, _ = _dataset(spark, sf, "upsert", bars.withColumn("batch_id", F.lit(1).cast("bigint")))
    cells = bars.where("volume >= 3").select("symbol", "dt", (F.col("close") + 1).alias("close"))
    later = bars.where("volume >= 4").select("symbol", "dt", (F.col("close") + 2).alias("close"))
    new = bars.where("volume = 1").select(F.concat(F.lit("N"), "symbol").alias("symbol"), "dt", "close")
    updates = (
        cells.withColumn("batch_id", F.lit(2).cast("bigint"))
        .unionByName(later.withColumn("batch_id", F.lit(3).cast("bigint")))
        .unionByName(new.withColumn("batch_id", F.lit(4).cast("bigint")))
    )
    maintenance.upsert(spark, path, updates)
    return rounded(maintenance.read_dataset(spark, path), "close")


@query
def compact(spark, sf):
    path, bars = _dataset(spark, sf, "compact")
    maintenance.append(bars.withColumn("symbol", F.concat(F.lit("B"), "symbol")), path)
    maintenance.compact(spark, path)
    return maintenance.read_dataset(spark, path)


@query
def undo_batch(spark, sf):
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "trade_date")
    path, _ = _dataset(spark, sf, "undo", bars.withColumn("batch_id", F.col("volume") + 100))
    maintenance.undo_batches(spark, path, 102, 103)
    maintenance.undo_batches(spark, path, 999_000, 999_001)
    return maintenance.read_dataset(spark, path)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Reports in which some amounts are not a number and some priorities are missing."""
    return data.statements(spark, sf).select(
        "report_id",
        F.when(F.col("status") == "P", F.lit(float("nan"))).otherwise(F.col("amount")).alias("amount"),
        F.when(F.col("status") != "O", F.col("priority")).alias("priority"),
    )


@query
def sparse_docs(spark, sf):
    docs = _documents(spark, sf)
    path = scratch_dir(spark, "documents")
    maintenance.write_documents(docs, path)
    # The number of stored fields shows what was left out.
    text = spark.read.text(path)
    n_fields = F.json_object_keys("value")
    schema = docs.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    return text.select(F.from_json("value", schema).alias("d"), F.size(n_fields).alias("n_fields")).select("d.*", "n_fields")


@query
def drop_fields(spark, sf):
    docs = _documents(spark, sf)
    path = scratch_dir(spark, "documents")
    maintenance.write_documents(docs, path)
    maintenance.drop_fields(spark, path, ["priority"], "json", docs.schema)
    return spark.read.json(path, schema=docs.drop("priority").schema)


def _evolving(spark: SparkSession, sf: str) -> str:
    """A store whose later days lack ``volume`` and have a column the first day does not know."""
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "preclose", "trade_date")
    path, _ = _dataset(spark, sf, "evolving", bars.where("dt < '2024-01-11'"))
    maintenance.append(bars.where("dt >= '2024-01-11'").drop("volume").withColumn("later", F.lit(1)), path)
    return path


@query
def schema_evolution(spark, sf):
    path = _evolving(spark, sf)
    return rounded(day_files.read_between(spark, path, "2024-01-05", "2024-01-18"), "preclose")


@query
def day_store_adjusted(spark, sf):
    path = _evolving(spark, sf)
    fields = ["dt", "symbol", "open", "close", "preclose"]
    before = day_files.read_last_days(spark, path, "2024-01-20", 12, fields, adjust=True).withColumn("part", F.lit("before"))
    after = day_files.read_first_days(spark, path, "2024-01-20", 6, fields, adjust=True).withColumn("part", F.lit("after"))
    at = day_files.read_at(spark, path, "2024-01-07", fields, adjust=True).withColumn("part", F.lit("at"))
    out = before.unionByName(after).unionByName(at)
    return rounded(out, "preclose", "adjust_factor", "adj_open", "adj_close")


@query
def day_store_long_adjusted(spark, sf):
    """Days in the middle of a store, anchored to the newest stored row by stored products; half the days were appended after the first products."""
    bars = data.daily_bars(spark, sf).select(*BAR_COLUMNS, "preclose", "trade_date")
    path, products = _dataset(spark, sf, "long_adjusted", bars.where("dt < '2024-01-17'"))[0], scratch_dir(spark, "products")
    stored_factors.write_products(spark, path, products, period_days=5)
    maintenance.append(bars.where("dt >= '2024-01-17'"), path)
    stored_factors.write_products(spark, path, products, period_days=5)
    days = [d for d in day_files.list_days(spark, path) if d <= "2024-01-14"][-10:]
    out = stored_factors.read_adjusted(spark, path, products, days, ["dt", "symbol", "open", "close", "preclose"])
    return rounded(out, "preclose", "adjust_factor", "adj_open", "adj_close")


@query
def named_sources(spark, sf):
    config = {
        "market": {"uris": [f"{sf}/events.parquet", f"{sf}/customer.parquet"]},
        "reports": {"uri": f"{sf}/orders.parquet"},
        "services": {"backtest": {"store": "market"}, "live": {"documents": "reports"}},
    }
    registry.register_sources(spark, config, "backtest")
    return spark.sql(
        """SELECT c.c_name AS name, count(*) AS n_ticks, max(e.ts) AS last_dt
        FROM events e JOIN customer c ON e.user_id = c.c_custkey GROUP BY c.c_name"""
    )


@query
def field_presence(spark, sf):
    bars = data.daily_bars(spark, sf)
    asked = ["symbol", "preclose", "pe_ttm", "maxupordown", "non"]
    filled = bars.agg(*[F.count(f).alias(f) for f in asked if f in bars.columns])
    counts = filled.unpivot([], [f for f in asked if f in bars.columns], "field", "n_values")
    return grid.field_presence(bars, asked).join(counts, "field", "left")


@query
def symbol_names(spark, sf):
    return reads.symbol_names(data.basic_info(spark, sf))
