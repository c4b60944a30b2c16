"""Market-data tables derived from the generic test tables (events, orders, customer)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspan.operators.resample import bars_from_ticks
from barspan.sources.day_files import with_day_column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("symbol"),
        F.col("ts").alias("dt"),
        F.col("value").alias("last_price"),
        F.lit(1).cast("bigint").alias("volume"),
        F.col("value").alias("amount"),
        "event_type",
        "event_id",
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = bars_from_ticks(ticks(spark, sf_dir), "1d")
    # One bar per symbol and trading day after the aggregation, so this window holds one row per day.
    previous = F.lag("close").over(Window.partitionBy("symbol").orderBy("dt"))
    ex_day = F.day("dt") % 7 == 0
    limit_step = F.when(F.col("volume") >= 4, 2).otherwise(1)
    state = (
        F.when(F.col("close") > 2 * F.col("open"), limit_step)
        .when(F.col("close") < 0.5 * F.col("open"), -limit_step)
        .otherwise(0)
    )
    return with_day_column(
        bars.withColumns(
            {
                "preclose": previous * F.when(ex_day, F.lit(0.9)).otherwise(F.lit(1.0)),
                "name": F.concat(F.when(F.col("symbol").cast("bigint") % 10 == 0, "ST").otherwise("S"), "symbol"),
                "maxupordown": state.cast("tinyint"),
            }
        ).withColumn(
            "lb_up_count", F.when(F.col("maxupordown") > 0, F.col("volume") % 3 + 1).otherwise(0).cast("smallint")
        )
    )


def interval_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly and daily bars with the interval as a column."""
    t = ticks(spark, sf_dir)
    return bars_from_ticks(t, "1h").withColumn("interval", F.lit("1h")).unionByName(
        bars_from_ticks(t, "1d").withColumn("interval", F.lit("1d"))
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks to be adjusted: everything that is not an entry of the factor table."""
    t = ticks(spark, sf_dir).where(F.col("event_type") != "signup")
    return t.select("symbol", "dt", "last_price", (F.col("last_price") * 2).alias("bid_price1"), "volume")


def all_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).select("symbol", "dt", "last_price", (F.col("last_price") * 2).alias("bid_price1"), "volume")


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).where(F.col("event_type") == "signup")
    return t.select(
        "symbol",
        F.col("dt").alias("tradedate"),
        (1 + F.col("last_price") / 1000).alias("adjust_factor"),
        F.col("event_id").alias("seq"),
    )


def sparse_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks with a factor that is known only at sign-ups."""
    return ticks(spark, sf_dir).select(
        "symbol", "dt", "last_price", F.when(F.col("event_type") == "signup", 1 + F.col("last_price") / 1000).alias("factor")
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date of the order history; open if there are orders."""
    open_dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    span = open_dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    every = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    is_open = open_dates.withColumn("status", F.lit(1).cast("tinyint"))
    return every.join(is_open, "date", "left").select(
        F.col("date").cast("timestamp_ntz").alias("day"), F.coalesce("status", F.lit(0).cast("tinyint")).alias("status")
    )


def _concept_code(number: Column) -> Column:
    return F.concat(F.lit("88"), (5500 + number).cast("string"), F.lit(".TI"))


def membership_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _concept_code(F.col("o_orderkey") % 20).alias("index_code"),
        (F.col("o_custkey") % 500).cast("string").alias("stock_code"),
        F.col("o_orderdate").alias("tradedate"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("op"),
        F.col("o_orderkey").alias("seq"),
    )


def recent_membership_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with its dates folded into the month the bars cover."""
    day = F.day("tradedate").cast("int")
    return membership_log(spark, sf_dir).withColumn(
        "tradedate", F.date_add(F.lit("2023-12-31").cast("date"), day).cast("timestamp_ntz")
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as a stock list; some never occur in the membership log."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("stock_code"))


def basic_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(F.col("c_acctbal") >= 0, "L").otherwise("D").alias("status"),
    )


def listed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basic_info(spark, sf_dir).where(F.col("status") == "L")


def index_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(spark, sf_dir).select(
        F.concat(F.lit("88"), (5300 + F.col("symbol").cast("bigint")).cast("string"), F.lit(".TI")).alias("symbol"),
        "dt",
        F.try_divide(F.col("close") - F.col("preclose"), F.col("preclose")).alias("pct_change"),
    )


def hot_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols of a day with an ``order`` that falls as their turnover grows."""
    return (
        ticks(spark, sf_dir)
        .groupBy(F.to_date("dt").cast("timestamp_ntz").alias("date"), "symbol")
        .agg((1_000_000 - F.round(F.sum("amount") * 100)).cast("int").alias("order"))
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("ts_code"),
        F.col("o_orderdate").alias("f_ann_date"),
        F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 400).cast("int")).cast("timestamp_ntz").alias("end_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("report_id"),
    )
