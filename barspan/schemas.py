"""Declared schemas of the input tables, as DDL text (readers take it as it is)."""

from __future__ import annotations

# Column names, order and types of the daily-bar CSV layout.
_DAILY_COLUMNS = """
dt timestamp_ntz, name string, _open double, _high double, _low double, _close double, volume bigint, amount bigint,
preclose double, net_profit_ttm double, cashflow_ttm double, equity double, asset double, debt double,
debttoasset double, net_profit_q double, pe_ttm double, pb double, mkt_cap double, mkt_cap_ashare double,
vip_buy_amt double, vip_sell_amt double, inst_buy_amt double, inst_sell_amt double, mid_buy_amt double,
mid_sell_amt double, indi_buy_amt double, indi_sell_amt double, master_net_flow_in double,
master2_net_flow_in double, vip_net_flow_in double, mid_net_flow_in double, inst_net_flow_in double,
indi_net_flow_in double, total_sell_amt double, total_buy_amt double, net_flow_in double, turnover double,
free_shares bigint, total_shares bigint, maxupordown tinyint, maxupordown_at_open tinyint, lb_up_count smallint,
lb_down_count smallint, close double, open double, high double, low double
"""

# The same of the tick CSV layout.
_TICK_COLUMNS = """
dt timestamp_ntz, last_price double, volume bigint, amount bigint, open_interest bigint, bid_price1 double,
ask_price1 double, bid_volume1 bigint, ask_volume1 bigint
"""


def _schema(ddl: str) -> str:
    return " ".join(ddl.split())


DAILY = _schema(_DAILY_COLUMNS)
DAILY_WITH_SYMBOL = _schema("symbol string, " + _DAILY_COLUMNS)
TICKS = _schema(_TICK_COLUMNS)
TICKS_WITH_SYMBOL = _schema("symbol string, " + _TICK_COLUMNS)
