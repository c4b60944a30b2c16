"""Columns of the daily-bar schema that follow from other columns of the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money-flow groups of the daily-bar schema.
FLOW_GROUPS = ["vip", "inst", "mid", "indi"]


def money_flow(df: DataFrame) -> DataFrame:
    """Net inflow per trader group, for the master groups and in total (buy minus sell)."""
    net = {g: F.col(f"{g}_buy_amt") - F.col(f"{g}_sell_amt") for g in FLOW_GROUPS}
    master = net["vip"] + net["inst"]
    return df.withColumns(
        {
            **{f"{g}_net_flow_in": c for g, c in net.items()},
            "master_net_flow_in": master,
            "master2_net_flow_in": master + net["mid"],
            "net_flow_in": F.col("total_buy_amt") - F.col("total_sell_amt"),
        }
    )


def valuation(df: DataFrame) -> DataFrame:
    """Market values, trailing price/earnings, turnover and debt ratio from raw close and share counts."""
    raw_close = F.col("_close")
    cap: Column = F.col("total_shares") * raw_close
    return df.withColumns(
        {
            "mkt_cap": cap,
            "mkt_cap_ashare": F.col("free_shares") * raw_close,
            "pe_ttm": F.try_divide(cap, F.col("net_profit_ttm")),
            "turnover": F.try_divide(F.col("volume"), F.col("free_shares")),
            "debttoasset": F.try_divide(F.col("debt"), F.col("asset")),
        }
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark and would win every ``max``; ingest turns it into NULL."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in floats}) if floats else df
