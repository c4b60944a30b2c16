"""Chunked operators with one symbol holding most rows, against plain one-key-at-a-time results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barspan.operators import adjust, breadth, chunks, statements
from barspan.sources import reads

HOT, START = "HOT", dt.datetime(2023, 12, 28, 22, 0)
WIDTHS = [chunks.HOUR, chunks.DAY, 400 * chunks.DAY, chunks.WHOLE, None]


def _rows():
    rng = random.Random(5)
    rows = []
    for symbol, n in [(HOT, 900), ("B", 40), ("C", 1), (None, 25)]:
        at = START
        for _ in range(n):
            # Irregular steps: some chunks stay empty, others hold many rows.
            at += dt.timedelta(seconds=rng.choice([1, 50, 700, 9_000, 200_000]))
            close = round(rng.uniform(5, 50), 2)
            preclose = rng.choice([None, 0.0, round(close * 0.9, 2), close, close + 1])
            flag = rng.choice([None, -1, 0, 0, 1])
            sparse = rng.choice([None, None, None, round(rng.random(), 3)])
            rows.append((symbol, at, close, rng.choice([0.0, close, close]), preclose, flag, sparse))
    return rows


@pytest.fixture(scope="module")
def bars(spark):
    schema = "symbol string, dt timestamp_ntz, open double, close double, preclose double, flag int, sparse double"
    return spark.createDataFrame(_rows(), schema).repartition(5).persist()


def _series():
    """Rows per symbol in time order."""
    out = {}
    for r in sorted(_rows(), key=lambda r: (str(r[0]), r[1])):
        out.setdefault(r[0], []).append(r)
    return out


def _got(df, *columns):
    return {(r["symbol"], r["dt"]): tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("seconds", WIDTHS)
def test_previous(bars, seconds):
    want = {}
    for symbol, rows in _series().items():
        for before, row in zip([None, *rows], rows):
            want[(symbol, row[1])] = (before[3] if before else None,)
    assert _got(chunks.with_previous(bars, ["symbol"], ["dt"], {"p": "close"}, seconds), "p") == want


@pytest.mark.parametrize("seconds", WIDTHS)
@pytest.mark.parametrize("n", [1, 2, 10])
def test_rolling_max(bars, seconds, n):
    want = {}
    for symbol, rows in _series().items():
        for i, row in enumerate(rows):
            last = [r[5] for r in rows[max(0, i + 1 - n) : i + 1] if r[5] is not None]
            want[(symbol, row[1])] = (max(last) if len(last) == n else None,)
    assert _got(chunks.rolling_max(bars, ["symbol"], "dt", "flag", n, "m", seconds), "m") == want


@pytest.mark.parametrize("seconds", WIDTHS)
@pytest.mark.parametrize("newest_first", [False, True])
def test_position(bars, seconds, newest_first):
    want = {}
    for symbol, rows in _series().items():
        for i, row in enumerate(reversed(rows) if newest_first else rows, start=1):
            want[(symbol, row[1])] = (i,)
    assert _got(chunks.with_position(bars, ["symbol"], ["dt"], "p", seconds, newest_first), "p") == want


@pytest.mark.parametrize("seconds", WIDTHS)
def test_next_time(bars, seconds):
    want = {}
    for symbol, rows in _series().items():
        for row, after in zip(rows, [*rows[1:], None]):
            want[(symbol, row[1])] = (after[1] if after else None,)
    assert _got(chunks.with_next_time(bars, ["symbol"], "dt", "n", seconds), "n") == want


@pytest.mark.parametrize("seconds", WIDTHS)
def test_forward_fill(bars, seconds):
    want = {}
    for symbol, rows in _series().items():
        known = None
        for row in rows:
            known = row[6] if row[6] is not None else known
            want[(symbol, row[1])] = (known,)
    assert _got(chunks.forward_fill(bars, ["symbol"], "dt", "sparse", "f", seconds), "f") == want


@pytest.mark.parametrize("seconds", WIDTHS)
def test_forward_adjust(bars, seconds):
    want = {}
    for symbol, rows in _series().items():
        ratios = [None] + [
            None if r[4] is None or not before[3] else r[4] / before[3] for before, r in zip(rows, rows[1:])
        ]
        factor = 1.0
        for i in range(len(rows) - 1, -1, -1):
            if i == len(rows) - 1:
                want[(symbol, rows[i][1])] = 1.0
                continue
            if ratios[i + 1] is None:
                want[(symbol, rows[i][1])] = None
            else:
                factor *= ratios[i + 1]
                want[(symbol, rows[i][1])] = factor
    out = adjust.forward_adjust(bars, chunk_seconds=seconds)
    got = _got(out, "adjust_factor", "open", "adj_open")
    assert set(got) == set(want)
    for key, (factor, price, adjusted) in got.items():
        assert factor == (pytest.approx(want[key], rel=1e-9) if want[key] is not None else None)
        assert adjusted == (None if factor is None else pytest.approx(price * factor))


def _factors():
    rng = random.Random(9)
    out = []
    for symbol, n in [(HOT, 300), ("B", 3)]:
        at = START + dt.timedelta(days=3)
        for i in range(n):
            # Several entries at one time: the one with the highest seq counts.
            at += dt.timedelta(seconds=rng.choice([0, 0, 3_600, 90_000]))
            out.append((symbol, at, rng.choice([None, 1 + i / 100]), i))
    return out


@pytest.mark.parametrize("method", ["multiply", "minus"])
@pytest.mark.parametrize("way", [True, None, chunks.HOUR, chunks.DAY, chunks.WHOLE])
def test_asof_adjust(spark, bars, method, way):
    known = {}
    for symbol, at, factor, seq in _factors():
        if factor is not None:
            known.setdefault(symbol, {})[at] = (seq, factor)
    want = {}
    for symbol, rows in _series().items():
        for row in rows:
            at = max((t for t in known.get(symbol, {}) if t <= row[1]), default=None)
            default = 1.0 if method == "multiply" else 0.0
            f = known[symbol][at][1] if at else default
            price = row[3] * f if method == "multiply" else row[3] - f
            want[(symbol, row[1])] = (pytest.approx(price),)
    factors = spark.createDataFrame(_factors(), "symbol string, tradedate timestamp_ntz, adjust_factor double, seq int")
    merged = isinstance(way, int) and not isinstance(way, bool)
    out = adjust.asof_adjust(
        bars, factors, method, "seq", broadcast=False if merged else way, chunk_seconds=way if merged else chunks.DAY
    )
    assert _got(out, "close") == want


def test_bad_method(bars):
    with pytest.raises(ValueError):
        adjust.asof_adjust(bars, bars, "divide")


def test_broadcast_limit_per_key(spark, monkeypatch):
    factors = spark.range(20).select(F.lit("A").alias("symbol"))
    assert adjust.fits_broadcast(factors, ["symbol"])
    monkeypatch.setattr(adjust, "BROADCAST_ROWS_PER_KEY", 10)
    assert not adjust.fits_broadcast(factors, ["symbol"])


@pytest.mark.parametrize("n", [1, 5, 1500])
@pytest.mark.parametrize("newest", [True, False])
def test_edge_rows(bars, n, newest, monkeypatch):
    monkeypatch.setattr(reads, "map_side_limit", lambda spark: 4)
    want = set()
    for symbol, rows in _series().items():
        want |= {(symbol, r[1]) for r in (rows[-n:] if newest else rows[:n])}
    pick = reads.last_rows if newest else reads.first_rows
    assert set(_got(pick(bars, n), "close")) == want


@pytest.mark.parametrize("n", [1, 3])
def test_top_n_with_ties(spark, n):
    rng = random.Random(3)
    rows = [(0 if i % 3 else i % 7, float(rng.randint(0, 5)), i) for i in range(400)]
    rows += [(1, None, 900), (1, float("nan"), 901)]
    want = set()
    for group in {r[0] for r in rows}:
        values = sorted((r[1] for r in rows if r[0] == group and r[1] is not None and r[1] == r[1]), reverse=True)
        least = values[min(n, len(values)) - 1]
        want |= {r[2] for r in rows if r[0] == group and r[1] is not None and r[1] == r[1] and r[1] >= least}
    df = spark.createDataFrame(rows, "g int, v double, id int")
    assert {r["id"] for r in breadth.top_n_with_ties(df, n, "g", "v").collect()} == want


@pytest.mark.parametrize("seconds", [30 * chunks.DAY, 4000 * chunks.DAY, None])
def test_clean_statements(spark, seconds):
    rng = random.Random(1)
    day = lambda lo, hi: dt.datetime(2019, 1, 1) + dt.timedelta(days=rng.randint(lo, hi))
    rows = [(rng.choice(["A"] * 8 + ["B", "C"]), rng.choice([None] + [day(0, 900)] * 12), rng.choice([None] + [day(-300, 900)] * 12), i)
            for i in range(500)]
    low = dt.datetime.min
    key = lambda r: (r[0], r[1] or low, r[2] or low)
    want, before = set(), None
    for r in sorted(rows, key=key):
        first = before is None or before[0] != r[0]
        if first or (r[2] is not None and before[2] is not None and r[2] >= before[2]):
            want.add(r[3])
        before = r
    df = spark.createDataFrame(rows, "ts_code string, f_ann_date timestamp_ntz, end_date timestamp_ntz, id int").repartition(4)
    # Rows with equal keys are interchangeable, so compare the keys that stay.
    by_id = {r[3]: r[:3] for r in rows}
    got = sorted(str(by_id[r["id"]]) for r in statements.clean_statements(df, chunk_seconds=seconds).collect())
    assert got == sorted(str(by_id[i]) for i in want)


@pytest.mark.parametrize("hot_rows", [3, 10_000])
def test_merge_statements_with_hot_keys(spark, hot_rows, monkeypatch):
    monkeypatch.setattr(statements, "COPIES", 4)
    rng = random.Random(2)

    def table(column, n, hot):
        rows = [(hot if i % 3 == 0 else rng.choice("PQRS"), dt.datetime(2024, 1, rng.randint(1, 4)), None, i) for i in range(n)]
        rows = [(c, d, dt.datetime(2023, 1, 1) if i % 5 else None, i) for c, d, _, i in rows]
        # A group of identical copies.
        rows += [(hot, dt.datetime(2024, 1, 2), dt.datetime(2023, 1, 1), -1)] * 15
        return spark.createDataFrame(rows, f"ts_code string, f_ann_date timestamp_ntz, end_date timestamp_ntz, {column} int")

    tables = [table("a", 60, "P"), table("b", 40, "Q"), table("c", 30, "NEW")]
    plain = tables[0].join(tables[1], statements.KEYS, "full").join(tables[2], statements.KEYS, "full")
    got = statements.merge_statements(*tables, hot_rows=hot_rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_merge_statements_edges(spark):
    one = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1), 1)],
                                "ts_code string, f_ann_date timestamp_ntz, end_date timestamp_ntz, v int")
    assert statements.merge_statements() is None
    assert statements.merge_statements(one) is one
    assert statements.merge_statements(one, one.limit(0)) is None
    both = statements.merge_statements(one, one)
    assert both.columns == [*statements.KEYS, "v", "v_2"] and both.count() == 1


def test_chunk_numbers_are_monotonic(spark):
    times = [dt.datetime(1969, 12, 31, 23, 59), dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 0, 59), dt.datetime(1970, 1, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r[0] for r in df.orderBy("t").select(chunks.time_chunk(F.col("t"), chunks.HOUR)).collect()]
    assert got == [-1, 0, 0, 1]


def test_fitting_width(spark, bars):
    hour = dt.datetime(2024, 1, 1, 10)
    busy = spark.createDataFrame([("A", hour + dt.timedelta(seconds=i)) for i in range(600)], "symbol string, dt timestamp_ntz")
    two_days = busy.unionByName(busy.withColumn("dt", F.col("dt") + F.expr("interval 1 day")))
    width = lambda target: chunks.fitting_width(two_days, ["symbol"], "dt", target)
    assert [width(n) for n in (1200, 1199, 600, 599, 100, 1)] == [chunks.WHOLE, chunks.DAY, chunks.DAY, 21_564, 3_600, 36]
    assert chunks.fitting_width(bars.limit(0), ["symbol"], "dt") == chunks.WHOLE


def _tied(spark):
    """Two symbols, many rows of one time, rows without a time, copies."""
    rng = random.Random(8)
    rows = []
    for s in ("A", "B", None):
        for i in range(60):
            day = rng.choice([None, *range(1, 9)])
            at = None if day is None else dt.datetime(2024, 1, day, rng.choice([0, 9]))
            rows.append((s, at, i % 23, float(rng.randint(1, 9)), rng.choice([None, 2.0, 4.0]), rng.choice([None, -2, -1, 0, 1, 1, 2])))
    return spark.createDataFrame(rows + rows[:20], "symbol string, dt timestamp_ntz, seq int, close double, preclose double, maxupordown int").repartition(6)


@pytest.mark.parametrize("sequence", [None, "seq"])
def test_equal_times_in_all_widths(spark, sequence):
    """Whatever the chunk width, rows of equal time come in one order."""
    df = _tied(spark)
    ways = {
        "streaks": lambda w: breadth.limit_streaks(df, w, sequence),
        "max": lambda w: chunks.rolling_max(df, ["symbol"], "dt", "maxupordown", 3, "top", w, sequence),
        "fill": lambda w: chunks.forward_fill(df, ["symbol"], "dt", "preclose", "filled", w, sequence),
        "adjust": lambda w: adjust.forward_adjust(df, chunk_seconds=w, sequence=sequence).withColumn("adjust_factor", F.round("adjust_factor", 9)).drop("adj_close"),
    }
    for name, way in ways.items():
        found = [sorted(map(tuple, way(w).collect()), key=repr) for w in (chunks.WHOLE, 3 * chunks.DAY, chunks.DAY, chunks.HOUR)]
        assert all(f == found[0] for f in found), name


def test_streaks(spark):
    """Against a plain loop; a streak goes on over chunks without a break, and an unknown state ends it."""
    rng = random.Random(3)
    rows = []
    for s in "ABC":
        state = 1
        for d in range(200):
            state = rng.choice([-1, 0, 1, 2, None]) if rng.random() < 0.1 else state
            rows.append((s, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), state))
    want, run = {}, {}
    for s, at, state in rows:
        up, down = run.get(s, (0, 0))
        run[s] = want[s, at] = (up + 1 if state in (1, 2) else 0, down + 1 if state in (-1, -2) else 0)
    df = spark.createDataFrame(rows, "symbol string, dt timestamp_ntz, maxupordown int")
    for width in (chunks.WHOLE, 90 * chunks.DAY, 7 * chunks.DAY, chunks.DAY):
        got = {(r.symbol, r.dt): (r.lb_up_count, r.lb_down_count) for r in breadth.limit_streaks(df, width).collect()}
        assert got == want
    assert breadth.limit_streaks(df.limit(0)).collect() == []
