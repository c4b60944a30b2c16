"""The registered queries as SQL over the same tables (DuckDB dialect)."""

from __future__ import annotations

import re

from barspan.functions.predicates import EXCLUDED_CONCEPTS

_EXCLUDED = ", ".join(f"'{code}'" for code in EXCLUDED_CONCEPTS)

# Derived tables, in dependency order.
DERIVED = {
    "ticks": """SELECT CAST(user_id AS VARCHAR) AS symbol, ts AS dt, value AS last_price, event_type, event_id FROM events""",
    "day_groups": """SELECT symbol, CAST(CAST(dt AS DATE) AS TIMESTAMP) AS dt, arg_min(last_price, dt) AS open,
        max(last_price) AS high, min(last_price) AS low, arg_max(last_price, dt) AS close,
        count(*) AS volume, sum(last_price) AS amount FROM ticks GROUP BY 1, 2""",
    "states": """SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY dt)
            * CASE WHEN day(dt) % 7 = 0 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS preclose,
        CASE WHEN CAST(symbol AS BIGINT) % 10 = 0 THEN 'ST' ELSE 'S' END || symbol AS name,
        CAST(CASE WHEN close > 2 * open THEN CASE WHEN volume >= 4 THEN 2 ELSE 1 END
            WHEN close < 0.5::DOUBLE * open THEN CASE WHEN volume >= 4 THEN -2 ELSE -1 END ELSE 0 END AS TINYINT) AS maxupordown
        FROM day_groups""",
    "bars": """SELECT *, CAST(CASE WHEN maxupordown > 0 THEN volume % 3 + 1 ELSE 0 END AS SMALLINT) AS lb_up_count,
        CAST(dt AS DATE) AS trade_date FROM states""",
    "quotes": """SELECT symbol, dt, last_price, last_price * 2 AS bid_price1, CAST(1 AS BIGINT) AS volume
        FROM ticks WHERE event_type <> 'signup'""",
    "all_quotes": """SELECT symbol, dt, last_price, last_price * 2 AS bid_price1, CAST(1 AS BIGINT) AS volume FROM ticks""",
    "factors": """SELECT symbol, dt AS tradedate, 1 + last_price / 1000 AS adjust_factor FROM ticks
        WHERE event_type = 'signup'""",
    "interval_bars": """SELECT symbol, date_trunc('hour', dt) AS dt, arg_min(last_price, dt) AS open, max(last_price) AS high,
            min(last_price) AS low, arg_max(last_price, dt) AS close, count(*) AS volume, '1h' AS interval
        FROM ticks GROUP BY 1, 2
        UNION ALL SELECT symbol, dt, open, high, low, close, volume, '1d' AS interval FROM day_groups""",
    "open_dates": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders""",
    "calendar": """SELECT CAST(a.d AS TIMESTAMP) AS day,
            CAST(CASE WHEN o.date IS NULL THEN 0 ELSE 1 END AS TINYINT) AS status
        FROM (SELECT unnest(generate_series(CAST((SELECT min(date) FROM open_dates) AS TIMESTAMP),
            CAST((SELECT max(date) FROM open_dates) AS TIMESTAMP), INTERVAL 1 DAY)) AS d) a
        LEFT JOIN open_dates o ON o.date = CAST(a.d AS DATE)""",
    "log": """SELECT '88' || CAST(5500 + o_orderkey % 20 AS VARCHAR) || '.TI' AS index_code,
        CAST(o_custkey % 500 AS VARCHAR) AS stock_code, o_orderdate AS tradedate,
        CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS op, o_orderkey AS seq FROM orders""",
    "recent_log": """SELECT index_code, stock_code, TIMESTAMP '2023-12-31' + to_days(CAST(day(tradedate) AS INTEGER)) AS tradedate,
        op, seq FROM log""",
    "live": """SELECT index_code, stock_code FROM log WHERE tradedate <= TIMESTAMP '1999-01-01'
        GROUP BY 1, 2 HAVING arg_max(op, {'t': tradedate, 's': seq}) = 1""",
    # 885514.TI is the one stand-in code that the excluded concepts contain.
    "live_kept": """SELECT * FROM live WHERE index_code <> '885514.TI'""",
    "stocks": """SELECT CAST(c_custkey AS VARCHAR) AS stock_code FROM customer""",
    "info": """SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name, c_mktsegment AS industry,
        CASE WHEN c_acctbal >= 0 THEN 'L' ELSE 'D' END AS status FROM customer""",
    "ratios": """SELECT *, preclose / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY dt), 0) AS ratio FROM bars""",
    "adjusted": """SELECT *, CASE WHEN lead(dt) OVER (PARTITION BY symbol ORDER BY dt) IS NULL THEN 1.0::DOUBLE
            WHEN lead(ratio) OVER (PARTITION BY symbol ORDER BY dt) IS NULL THEN NULL
            ELSE product(ratio) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
            END AS adjust_factor FROM ratios""",
    "ten_bars": """SELECT symbol, dt, CASE WHEN count(maxupordown) OVER w = 10 THEN max(maxupordown) OVER w END AS top
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "three_bars": """SELECT symbol, dt, CASE WHEN count(maxupordown) OVER w = 3 THEN max(maxupordown) OVER w END AS top
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "log_days": """SELECT index_code, stock_code, tradedate, arg_max(op, seq) AS op FROM recent_log GROUP BY 1, 2, 3""",
    "log_spans": """SELECT *, lead(tradedate) OVER (PARTITION BY index_code, stock_code ORDER BY tradedate) AS valid_to
        FROM log_days""",
    "statements": """SELECT CAST(o_custkey AS VARCHAR) AS ts_code, o_orderdate AS f_ann_date,
        CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 400 AS INTEGER) AS TIMESTAMP) AS end_date,
        o_totalprice AS amount, o_orderpriority AS priority, o_orderstatus AS status, o_orderkey AS report_id FROM orders""",
    "time_texts": """SELECT event_id, CASE event_id % 7 WHEN 0 THEN t WHEN 1 THEN t[1:23] WHEN 2 THEN t[1:19]
            WHEN 3 THEN t || '789' WHEN 4 THEN t[1:22] WHEN 5 THEN t[1:21] || 'g99'
            ELSE '2024-02-30' || t[11:19] END AS text
        FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t FROM events)""",
    "time_parsed": """SELECT event_id, text, CASE WHEN regexp_full_match(text,
            '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}(\\.(\\d{3}|\\d{6}|\\d{9}))?')
            THEN TRY_CAST(text[1:26] AS TIMESTAMP) END AS dt FROM time_texts""",
    "documents_": """SELECT report_id, CASE WHEN status <> 'P' THEN amount END AS amount,
        CASE WHEN status <> 'O' THEN priority END AS priority FROM statements""",
}


def _clean(table: str) -> str:
    """Statement clean-up of one derived table."""
    w = "(PARTITION BY ts_code ORDER BY f_ann_date, end_date)"
    return f"""SELECT * FROM {table} QUALIFY row_number() OVER {w} = 1 OR end_date >= lag(end_date) OVER {w}"""


def _streaks(bars: str) -> str:
    """Rows since the last one outside the state, by symbol."""
    length = "CAST(n - coalesce(max(n) FILTER (NOT {0}) OVER w, 0) AS INTEGER)"
    up, down = "maxupordown > 0", "maxupordown < 0"
    return f"""SELECT symbol, dt, maxupordown, {length.format(f'({up})')} AS lb_up_count, {length.format(f'({down})')} AS lb_down_count
        FROM (SELECT symbol, dt, maxupordown, row_number() OVER (PARTITION BY symbol ORDER BY dt) AS n FROM {bars})
        WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 8) AS {c}" for c in columns)


_BAR = "symbol, dt, open, high, low, close, volume"
_LO, _HI = "TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-20'"


def _resample(freq: str, unit: str) -> str:
    # The first and last bar of a period count even where their adjusted price is unknown.
    parts = {
        "open": "arg_min_null(open * adjust_factor, dt)", "high": "max(high * adjust_factor)", "low": "min(low * adjust_factor)",
        "close": "arg_max_null(close * adjust_factor, dt)", "amount": "sum(amount)",
    }
    cols = ", ".join(f"round({e}, 8) AS {n}_{freq}" for n, e in parts.items())
    return f"""SELECT symbol, CAST(date_trunc('{unit}', dt) AS TIMESTAMP) AS dt, {cols}, CAST(sum(volume) AS BIGINT) AS volume_{freq}
        FROM adjusted GROUP BY 1, 2"""


def _asof(price: str, bid: str) -> str:
    return f"""SELECT q.symbol, q.dt, round({price}, 8) AS last_price, round({bid}, 8) AS bid_price1, q.volume
        FROM quotes q ASOF LEFT JOIN factors f ON q.symbol = f.symbol AND q.dt >= f.tradedate"""


_MULTIPLY = _asof("last_price * coalesce(adjust_factor, 1)", "bid_price1 * coalesce(adjust_factor, 1)")
_MINUS = _asof("last_price - coalesce(adjust_factor, 0)", "bid_price1 - coalesce(adjust_factor, 0)")


_FILL = """SELECT symbol, dt, last_price, round(factor, 8) AS factor,
            round(last_value(factor IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY dt
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 8) AS filled
        FROM (SELECT *, CASE WHEN event_type = 'signup' THEN 1 + last_price / 1000 END AS factor FROM ticks)"""


def _tick_bars(bucket: str) -> str:
    return f"""SELECT symbol, time_bucket(INTERVAL '{bucket}', dt, TIMESTAMP '1970-01-01') AS dt, arg_min(last_price, dt) AS open,
        max(last_price) AS high, min(last_price) AS low, arg_max(last_price, dt) AS close, count(*) AS volume,
        round(sum(last_price), 8) AS amount FROM ticks GROUP BY 1, 2"""


_MONEY = {
    "mkt_cap": "volume * 1000 * close", "mkt_cap_ashare": "volume * 600 * close",
    "pe_ttm": "volume * 1000 * close / nullif(low, 0)", "turnover": "volume / (volume * 600)",
    "debttoasset": "low / nullif(high, 0)", "vip_net_flow_in": "high - low", "inst_net_flow_in": "open - close",
    "mid_net_flow_in": "close - low", "indi_net_flow_in": "low - open",
    "master_net_flow_in": "(high - low) + (open - close)",
    "master2_net_flow_in": "(high - low) + (open - close) + (close - low)", "net_flow_in": "high * 2 - open",
}

_STATES = {
    "uplimit": "maxupordown IN (1, 2)", "downlimit": "maxupordown IN (-1, -2)",
    "yiziup": "maxupordown = 2", "yizidown": "maxupordown = -2",
}


BODIES = {
    "range_read_both": f"SELECT {_BAR} FROM bars WHERE dt >= {_LO} AND dt <= {_HI}",
    "range_read_left": f"SELECT {_BAR} FROM bars WHERE dt >= {_LO} AND dt < {_HI}",
    "range_read_right": f"SELECT {_BAR} FROM bars WHERE dt > {_LO} AND dt <= {_HI}",
    "range_read_none": f"SELECT {_BAR} FROM bars WHERE dt > {_LO} AND dt < {_HI}",
    "sql_filter_project": "SELECT symbol, dt, name, open FROM bars WHERE dt > TIMESTAMP '2024-01-10' AND open > 20.5",
    "full_table": f"""SELECT {_BAR}, {_round('amount', 'preclose')}, name, maxupordown, lb_up_count, trade_date FROM bars""",
    "doc_find": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
        WHERE o_orderstatus = 'O' AND o_totalprice >= 100000 AND o_orderkey > 10
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 250""",
    "last_n_per_symbol": """SELECT * FROM all_quotes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) <= 5""",
    "first_n_per_symbol": """SELECT * FROM all_quotes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt) <= 5""",
    "last_n_table": f"""SELECT symbol, last_price FROM all_quotes WHERE dt <= {_HI} ORDER BY dt DESC, symbol DESC LIMIT 1000""",
    "capped_range_from": f"""SELECT * FROM all_quotes WHERE dt >= {_LO} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt) <= 3""",
    "capped_range": f"""SELECT * FROM all_quotes WHERE dt >= {_LO} AND dt < {_HI}
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) <= 7""",
    "first_n_days": f"""SELECT {_BAR}, trade_date FROM bars WHERE trade_date IN (SELECT DISTINCT trade_date FROM bars
        WHERE trade_date >= DATE '2024-01-14' ORDER BY 1 LIMIT 10)""",
    "last_n_days": f"""SELECT {_BAR}, trade_date FROM bars WHERE trade_date IN (SELECT DISTINCT trade_date FROM bars
        WHERE trade_date <= DATE '2024-01-14' ORDER BY 1 DESC LIMIT 10)""",
    "days_list": f"""SELECT {_BAR}, trade_date FROM bars
        WHERE trade_date IN (DATE '2024-01-03', DATE '2024-01-09', DATE '2024-01-28')""",
    "cross_section_tags": """SELECT b.symbol, b.dt, b.close, i.industry FROM bars b JOIN info i USING (symbol)
        WHERE b.dt = TIMESTAMP '2024-01-17' AND i.industry IN ('BUILDING', 'MACHINERY', 'FURNITURE') AND i.status = 'L'""",
    "label_slice": """SELECT symbol, dt, name, close FROM bars WHERE symbol BETWEEN '1' AND '7' AND
        (dt BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-08' OR dt = TIMESTAMP '2024-01-11' OR dt >= TIMESTAMP '2024-01-20')""",
    "last_dt_slice": """SELECT symbol, dt, name, close FROM bars WHERE dt IN (SELECT DISTINCT dt FROM bars ORDER BY dt DESC LIMIT 2)""",
    "axis_labels_symbol": "SELECT DISTINCT symbol FROM ticks",
    "axis_labels_dt": "SELECT DISTINCT dt FROM bars",
    "grid_shape": "SELECT count(DISTINCT symbol) AS n_symbols, count(DISTINCT dt) AS n_dts FROM bars",
    "dense_grid": """SELECT s.symbol, d.dt, b.close, b.volume FROM (SELECT DISTINCT symbol FROM bars) s
        CROSS JOIN (SELECT DISTINCT dt FROM bars) d LEFT JOIN bars b ON b.symbol = s.symbol AND b.dt = d.dt""",
    "forward_adjust": f"""SELECT symbol, dt, open, high, low, close, {_round('preclose', 'adjust_factor')},
        round(open * adjust_factor, 8) AS adj_open, round(high * adjust_factor, 8) AS adj_high,
        round(low * adjust_factor, 8) AS adj_low, round(close * adjust_factor, 8) AS adj_close FROM adjusted""",
    "forward_adjust_chunked": f"""SELECT symbol, dt, close, {_round('preclose', 'adjust_factor')},
        round(close * adjust_factor, 8) AS adj_close FROM adjusted""",
    "previous_close": "SELECT symbol, dt, close, lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS previous_close FROM bars",
    "asof_adjust_multiply": _MULTIPLY,
    "asof_adjust_minus": _MINUS,
    "asof_adjust_merged": _MULTIPLY,
    "asof_adjust_chunked": _MULTIPLY,
    "forward_fill": _FILL,
    "forward_fill_chunked": _FILL,
    "klines": f"""SELECT b.symbol, b.dt, b.interval, round(open * coalesce(adjust_factor, 1), 8) AS open,
            round(high * coalesce(adjust_factor, 1), 8) AS high, round(low * coalesce(adjust_factor, 1), 8) AS low,
            round(close * coalesce(adjust_factor, 1), 8) AS close, volume
        FROM (SELECT * FROM interval_bars WHERE dt <= {_HI}
            QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY dt DESC) <= 5) b
        ASOF LEFT JOIN factors f ON b.symbol = f.symbol AND b.dt >= f.tradedate""",
    "klines_of_symbols": f"""SELECT b.symbol, b.dt, b.interval, round(open * coalesce(adjust_factor - 0.5::DOUBLE, 1), 8) AS open,
            round(high * coalesce(adjust_factor - 0.5::DOUBLE, 1), 8) AS high, round(low * coalesce(adjust_factor - 0.5::DOUBLE, 1), 8) AS low,
            round(close * coalesce(adjust_factor - 0.5::DOUBLE, 1), 8) AS close, volume
        FROM (SELECT * FROM interval_bars WHERE interval = '1d' AND dt >= {_LO}
                AND symbol IN (SELECT symbol FROM info WHERE status = 'L')
            QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY dt) <= 4) b
        ASOF LEFT JOIN factors f ON b.symbol = f.symbol AND b.dt >= f.tradedate""",
    "resample_nan": """SELECT symbol, date_trunc('week', dt)::TIMESTAMP AS dt, round(max(CASE WHEN volume % 2 <> 0 THEN high END), 8) AS high,
        round(min(low), 8) AS low, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1, 2""",
    "market_breadth_nan": """SELECT dt, round(avg(CASE WHEN volume % 2 <> 0 AND (close - preclose) / nullif(preclose, 0) > 0.5
            THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 8) AS ratio_of_perctg_gt
        FROM bars WHERE name NOT LIKE '%ST%' AND name NOT LIKE '%退%' GROUP BY dt""",
    "day_merge_flat": """SELECT symbol, dt, open, high, low, round(CASE WHEN trade_date = DATE '2024-01-15' THEN close * 2 ELSE close END, 8) AS close,
        volume, trade_date, CASE WHEN trade_date = DATE '2024-01-15' THEN round(high - low, 8) END AS spread FROM bars""",
    "append_flat": f"SELECT {_BAR}, CASE WHEN dt < TIMESTAMP '2024-01-16' AND volume <= 2 THEN maxupordown END AS maxupordown, trade_date FROM bars",
    "drop_fields_flat": "SELECT symbol, dt, open, high, low, close, maxupordown, trade_date FROM bars",
    "undo_upsert": """SELECT symbol, dt, open, CASE WHEN volume < 2 THEN high END AS high, low,
            round(CASE WHEN volume >= 4 THEN close + 3 WHEN volume >= 2 THEN close + 1 ELSE close END, 8) AS close, volume, trade_date,
            CAST(CASE WHEN volume >= 4 THEN 4 WHEN volume >= 2 THEN 2 ELSE 1 END AS BIGINT) AS batch_id FROM bars""",
    "versions_as_of": """SELECT symbol, dt, open, high, low, round(close + CASE WHEN volume >= 2 THEN 2 ELSE 0 END, 8) AS close, volume, trade_date,
            CAST(CASE WHEN volume >= 2 THEN 2 ELSE 1 END AS BIGINT) AS batch_id, 'early' AS part FROM bars
        UNION ALL SELECT symbol, dt, open, high, low, round(close + CASE WHEN volume >= 3 THEN 3 WHEN volume >= 2 THEN 2 ELSE 0 END, 8), volume, trade_date,
            CAST(CASE WHEN volume >= 3 THEN 3 WHEN volume >= 2 THEN 2 ELSE 1 END AS BIGINT), 'late' FROM bars""",
    "resample_week": _resample("1w", "week"),
    "resample_month": _resample("1mo", "month"),
    "bars_5min": _tick_bars("5 minutes"),
    "bars_2h": _tick_bars("2 hours"),
    "row_counts": "SELECT symbol, count(dt) AS n_rows FROM ticks GROUP BY 1",
    "series_by_symbol": """SELECT symbol, CAST(floor((pos - 1) / 20) AS BIGINT) AS block, CAST(count(*) AS INTEGER) AS n_rows,
            string_agg(CAST(CAST(round(last_price * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS cents
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt) AS pos FROM ticks) GROUP BY 1, 2""",
    "gather_fields": """SELECT ts_code, field, CAST(floor((pos - 1) / 25) AS BIGINT) AS block, CAST(count(*) AS INTEGER) AS n_values,
            string_agg(value, '|' ORDER BY pos) AS present_values
        FROM (SELECT *, row_number() OVER (PARTITION BY ts_code, field ORDER BY f_ann_date, report_id) AS pos
            FROM (SELECT ts_code, f_ann_date, report_id, 'amount' AS field, CAST(CAST(round(amount * 100) AS BIGINT) AS VARCHAR) AS value
                FROM statements WHERE status <> 'F'
                UNION ALL SELECT ts_code, f_ann_date, report_id, 'priority', priority FROM statements WHERE priority <> '5-LOW'))
        GROUP BY 1, 2, 3""",
    "map_rows": """SELECT event_id, lpad(symbol, CAST(greatest(6, length(symbol)) AS INTEGER), '0') AS symbol,
        CASE WHEN last_price >= 100 THEN 'high' ELSE 'low' END AS band,
        CAST(floor(last_price * 100 + 0.5::DOUBLE) AS BIGINT) AS cents FROM ticks""",
    "market_breadth": """SELECT dt, round(avg(CASE WHEN (close - preclose) / nullif(preclose, 0) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 8)
            AS ratio_of_perctg_gt
        FROM bars WHERE symbol IN (SELECT symbol FROM info WHERE status = 'L') AND name NOT LIKE '%ST%' AND name NOT LIKE '%退%' GROUP BY dt""",
    "recent_limit_up": "SELECT symbol, dt FROM ten_bars WHERE top > 0",
    "limitup_concepts": """SELECT dt, index_code, count(*) AS n_stocks,
            CAST(row_number() OVER (PARTITION BY dt ORDER BY count(*) DESC, index_code) AS INTEGER) AS rank
        FROM three_bars t JOIN log_spans s ON s.stock_code = t.symbol AND t.dt >= s.tradedate
            AND (s.valid_to IS NULL OR t.dt < s.valid_to)
        WHERE t.top > 0 AND s.op = 1 AND s.index_code <> '885514.TI' AND t.symbol IN (SELECT symbol FROM info)
        GROUP BY dt, index_code QUALIFY rank <= 5""",
    "top_rank_concepts": f"""SELECT DISTINCT symbol FROM (
            SELECT symbol, rank() OVER (PARTITION BY dt ORDER BY pct DESC) AS place FROM (
                SELECT '88' || CAST(5300 + CAST(symbol AS BIGINT) AS VARCHAR) || '.TI' AS symbol, dt,
                    (close - preclose) / nullif(preclose, 0) AS pct FROM bars
                WHERE dt <= {_HI} AND '88' || CAST(5300 + CAST(symbol AS BIGINT) AS VARCHAR) || '.TI' NOT IN ({_EXCLUDED})
                QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) <= 12)
            WHERE pct IS NOT NULL) WHERE place <= 3""",
    "hot_list": """SELECT CAST(CAST(dt AS DATE) AS TIMESTAMP) AS date, symbol, CAST(1000000 - round(sum(last_price) * 100) AS INTEGER) AS "order"
        FROM ticks GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY date ORDER BY "order", symbol) <= 10""",
    "hot_list_of_day": """SELECT CAST(CAST(dt AS DATE) AS TIMESTAMP) AS date, symbol,
            CAST(1000000 - round(sum(last_price) * 100) AS INTEGER) AS "order"
        FROM ticks WHERE CAST(dt AS DATE) = DATE '2024-01-16' GROUP BY 1, 2 ORDER BY 3, 2 LIMIT 10""",
    "market_stats": "SELECT d.dt, "
    + ", ".join(f"CAST(count(*) FILTER ({c}) AS INTEGER) AS count_of_{k}" for k, c in _STATES.items())
    + ", "
    + ", ".join(f"round(count(*) FILTER ({c}) / count(*), 8) AS ratio_of_{k}" for k, c in _STATES.items())
    + """, coalesce((SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY step) FROM (
            SELECT s.step, (SELECT count(*) FROM bars x WHERE x.dt = d.dt AND x.lb_up_count = s.step AND x.name NOT LIKE '%ST%') AS n
            FROM (SELECT unnest(generate_series(1, CAST(max(d.lb_up_count) AS BIGINT))) AS step) s)), '') AS lb
        FROM bars d WHERE d.name NOT LIKE '%ST%' GROUP BY d.dt""",
    "derived_columns": "SELECT symbol, dt, " + ", ".join(f"{e} AS {n}" for n, e in _MONEY.items()) + " FROM bars",
    "members_of_index": "SELECT index_code, stock_code FROM live",
    "indexes_of_stock": "SELECT index_code, stock_code FROM live_kept",
    "stocks_in_concepts": """SELECT stock_code FROM stocks WHERE stock_code IN
        (SELECT stock_code FROM live_kept WHERE index_code IN ('885503.TI', '885507.TI', '885511.TI', '885514.TI'))""",
    "top_concepts": """SELECT index_code, count(*) AS n_stocks FROM stocks JOIN live_kept USING (stock_code) GROUP BY 1
        ORDER BY n_stocks DESC, index_code LIMIT 12""",
    "concepts_per_stock": """SELECT stock_code, coalesce(string_agg(index_code, ',' ORDER BY index_code), '') AS concepts
        FROM stocks LEFT JOIN live_kept USING (stock_code) GROUP BY 1""",
    "membership_spans": """SELECT index_code, stock_code, tradedate AS valid_from, valid_to FROM (
            SELECT *, lead(tradedate) OVER (PARTITION BY index_code, stock_code ORDER BY tradedate) AS valid_to FROM (
                SELECT index_code, stock_code, tradedate, arg_max(op, seq) AS op FROM log GROUP BY 1, 2, 3)) WHERE op = 1""",
    "calendar_list": """SELECT day, status FROM calendar
        WHERE status = 1 AND day >= TIMESTAMP '1996-02-10 12:00:00' AND day <= TIMESTAMP '2001-03-05'""",
    "calendar_prev_next": """SELECT max(day) FILTER (day <= TIMESTAMP '1998-08-18 23:00:00') AS last_day,
        min(day) FILTER (day > TIMESTAMP '1998-08-18 23:00:00') AS next_day FROM calendar WHERE status = 1""",
    "align_to_calendar": """SELECT s.report_id, s.end_date AS dt, p.day AS prev_day, n.day AS next_day FROM statements s
        ASOF LEFT JOIN (SELECT day FROM calendar WHERE status = 1) p ON s.end_date >= p.day
        ASOF LEFT JOIN (SELECT day FROM calendar WHERE status = 1) n ON s.end_date < n.day""",
    "calendar_dimension": """SELECT CAST(day AS DATE) AS day, CAST(isoyear(day) AS INTEGER) AS iso_year, CAST(week(day) AS INTEGER) AS iso_week,
        CAST(isodow(day) AS INTEGER) AS iso_weekday, CAST(CAST(day AS DATE) - DATE '0001-01-01' + 1 AS INTEGER) AS ordinal,
        (year(day) % 4 = 0 AND year(day) % 100 <> 0) OR year(day) % 400 = 0 AS leap_year,
        CAST(day(last_day(day)) AS INTEGER) AS days_in_month,
        CAST(dayofyear(date_trunc('month', day)) - 1 AS INTEGER) AS days_before_month,
        CAST(CAST(date_trunc('year', day) AS DATE) - DATE '0001-01-01' AS INTEGER) AS days_before_year,
        CAST(date_trunc('week', day) AS DATE) AS week_start, CAST(date_trunc('month', day) AS DATE) AS month_start FROM calendar""",
    "normalise_timestamps": """SELECT event_id, dt, epoch_us(dt) AS epoch_us, strftime(dt, '%Y-%m-%d %H:%M:%S.%g') AS text_ms,
        strftime(dt, '%Y-%m-%d %H:%M:%S.%f') || '007' AS text_ns, date_trunc('milliseconds', dt) AS dt_ms, dt AS dt_ns,
        date_trunc('second', dt) AS dt_s, epoch_us(dt) - epoch_us(TIMESTAMP '2000-01-01') AS micros_since_2000
        FROM time_parsed WHERE dt IS NOT NULL""",
    "rejected_timestamps": """SELECT event_id, text FROM time_parsed WHERE dt IS NULL
        UNION ALL SELECT event_id, CAST((event_id - 100) * 10000000000000 AS VARCHAR) FROM events
        WHERE (event_id - 100)::HUGEINT * 10000000000000 NOT BETWEEN -62135596800 AND 253402300799""",
    "members_from_snapshots": " UNION ALL ".join(
        f"""SELECT index_code, stock_code, '{at}' AS at FROM log WHERE tradedate <= TIMESTAMP '{at}'
        GROUP BY 1, 2 HAVING arg_max(op, {{'t': tradedate, 's': seq}}) = 1"""
        for at in ("1992-02-01 00:00:00", "1995-07-01 00:00:00", "1998-12-31 00:00:00")
    ),
    "limit_up_streaks": _streaks("bars"),
    "limit_up_streaks_chunked": _streaks("(SELECT symbol, dt, CAST(abs(maxupordown) AS TINYINT) AS maxupordown FROM bars)"),
    "statements_clean": f"SELECT ts_code, f_ann_date, end_date, amount, report_id FROM ({_clean('statements')})",
    "statements_merge": f"""SELECT ts_code, f_ann_date, end_date, a.amount, a.report_id AS income_id, b.amount AS amount_2,
            b.report_id AS balance_id, c.status
        FROM ({_clean('statements')}) a
        FULL JOIN ({_clean("(SELECT * FROM statements WHERE priority IN ('1-URGENT', '2-HIGH'))")}) b
            USING (ts_code, f_ann_date, end_date)
        FULL JOIN ({_clean("(SELECT * FROM statements WHERE status <> 'F')")}) c USING (ts_code, f_ann_date, end_date)""",
    "csv_ingest": f"""SELECT {_BAR}, name, CAST(round(amount) AS BIGINT) AS amount, maxupordown, CAST(NULL AS DOUBLE) AS pe_ttm,
        'bars_daily_' || symbol || '_SZ' AS table_name FROM bars""",
    "ticks_csv_ingest": """SELECT symbol, dt, last_price, CAST(1 AS BIGINT) AS volume, CAST(NULL AS BIGINT) AS amount,
        event_id AS open_interest, last_price - 0.5::DOUBLE AS bid_price1, last_price + 0.5::DOUBLE AS ask_price1,
        CAST(NULL AS BIGINT) AS bid_volume1, CAST(1 AS BIGINT) AS ask_volume1 FROM ticks""",
    "create_and_reload": "SELECT symbol, dt, close, trade_date FROM bars",
    "factor_spans": """SELECT symbol, round(adjust_factor, 8) AS adjust_factor, tradedate AS valid_from,
        lead(tradedate) OVER (PARTITION BY symbol ORDER BY tradedate) AS valid_to FROM factors""",
    "packed_dates_ingest": "SELECT CAST(day AS DATE) AS day, status FROM calendar",
    "append": f"""SELECT {_BAR}, maxupordown, trade_date FROM bars WHERE dt < TIMESTAMP '2024-01-16' OR maxupordown <> 0""",
    "delete": f"""SELECT {_BAR}, round(preclose, 8) AS preclose, trade_date FROM bars
        WHERE NOT coalesce(close > preclose OR dt = TIMESTAMP '2024-01-09', false)""",
    "day_merge": """SELECT symbol, dt, open, high, low, close, CASE WHEN trade_date = DATE '2024-01-15' THEN volume + 100 ELSE volume END
        AS volume, trade_date, CASE WHEN trade_date = DATE '2024-01-15' THEN round(high - low, 8) END AS spread FROM bars""",
    "upsert": """SELECT symbol, dt, open, high, low, round(CASE WHEN volume >= 4 THEN close + 2 WHEN volume = 3 THEN close + 1
            ELSE close END, 8) AS close, volume, trade_date,
            CAST(CASE WHEN volume >= 4 THEN 3 WHEN volume = 3 THEN 2 ELSE 1 END AS BIGINT) AS batch_id FROM bars
        UNION ALL SELECT 'N' || symbol, dt, NULL, NULL, NULL, round(close, 8), NULL, trade_date, 4 FROM bars WHERE volume = 1""",
    "compact": f"SELECT {_BAR}, trade_date FROM bars UNION ALL SELECT 'B' || symbol, {_BAR[8:]}, trade_date FROM bars",
    "undo_batch": f"SELECT {_BAR}, trade_date, volume + 100 AS batch_id FROM bars WHERE volume NOT IN (2, 3)",
    "sparse_docs": """SELECT *, CAST(1 + (amount IS NOT NULL)::INTEGER + (priority IS NOT NULL)::INTEGER AS INTEGER) AS n_fields FROM documents_""",
    "drop_fields": "SELECT report_id, amount FROM documents_",
    "schema_evolution": """SELECT symbol, dt, open, high, low, close, CASE WHEN trade_date < DATE '2024-01-11' THEN volume END AS volume,
        round(preclose, 8) AS preclose, trade_date FROM bars WHERE trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-18'""",
    "day_store_long_adjusted": f"""SELECT dt, symbol, open, close, {_round('preclose', 'adjust_factor')},
            round(open * adjust_factor, 8) AS adj_open, round(close * adjust_factor, 8) AS adj_close
        FROM adjusted WHERE CAST(dt AS DATE) IN (SELECT DISTINCT trade_date FROM bars
            WHERE trade_date <= DATE '2024-01-14' ORDER BY 1 DESC LIMIT 10)""",
    "day_store_adjusted": f"""SELECT dt, symbol, open, close, {_round('preclose', 'adjust_factor')},
            round(open * adjust_factor, 8) AS adj_open, round(close * adjust_factor, 8) AS adj_close, part
        FROM (SELECT *, CASE WHEN lead(dt) OVER w IS NULL THEN 1.0::DOUBLE WHEN lead(ratio) OVER w IS NULL THEN NULL
                ELSE product(ratio) OVER (PARTITION BY part, symbol ORDER BY dt ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
                END AS adjust_factor
            FROM (SELECT *, preclose / nullif(lag(close) OVER (PARTITION BY part, symbol ORDER BY dt), 0) AS ratio
                FROM (SELECT *, 'before' AS part FROM bars WHERE trade_date IN (SELECT DISTINCT trade_date FROM bars
                        WHERE trade_date <= DATE '2024-01-20' ORDER BY 1 DESC LIMIT 12)
                    UNION ALL SELECT *, 'after' FROM bars WHERE trade_date IN (SELECT DISTINCT trade_date FROM bars
                        WHERE trade_date >= DATE '2024-01-20' ORDER BY 1 LIMIT 6)
                    UNION ALL SELECT *, 'at' FROM bars WHERE trade_date = DATE '2024-01-07'))
            WINDOW w AS (PARTITION BY part, symbol ORDER BY dt))""",
    "named_sources": """SELECT c_name AS name, count(*) AS n_ticks, max(ts) AS last_dt FROM events
        JOIN customer ON user_id = c_custkey GROUP BY 1""",
    "field_presence": """SELECT 'symbol' AS field, true AS present, count(symbol) AS n_values FROM bars
        UNION ALL SELECT 'preclose', true, count(preclose) FROM bars UNION ALL SELECT 'maxupordown', true, count(maxupordown) FROM bars
        UNION ALL SELECT 'pe_ttm', false, NULL UNION ALL SELECT 'non', false, NULL""",
    "symbol_names": "SELECT symbol, name FROM info",
}


BODIES["statements_merge_salted"] = BODIES["statements_merge"]
BODIES["limitup_concepts_days"] = f"SELECT * FROM ({BODIES['limitup_concepts']}) WHERE dt::DATE IN ('2024-01-10', '2024-01-16', '2024-01-17')"


def _with_derived(body: str) -> str:
    """Prepend the derived tables the text uses, directly or through each other."""
    needed: list[str] = []
    text = body
    for name in reversed(DERIVED):
        if re.search(rf"\b{name}\b", text):
            needed.append(name)
            text += " " + DERIVED[name]
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({DERIVED[name]})" for name in reversed(needed))
    return f"WITH {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_derived(body) for name, body in BODIES.items()}
