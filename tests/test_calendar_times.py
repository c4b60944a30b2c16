"""Golden dates and times, and trading-calendar answers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barspan.functions import timestamps as ts
from barspan.operators import trading_calendar as cal
from barspan.plans.queries import QUERIES

NANOS = 1734412701444555666

# ISO calendar of chosen days.
ISO = {
    "2024-12-31": (2025, 1, 2), "2025-01-01": (2025, 1, 3), "2025-01-03": (2025, 1, 5), "2025-01-06": (2025, 2, 1),
    "2025-01-10": (2025, 2, 5), "2025-01-15": (2025, 3, 3), "2025-01-21": (2025, 4, 2), "2025-01-28": (2025, 5, 2),
    "2025-02-05": (2025, 6, 3), "2025-02-14": (2025, 7, 5), "2025-02-24": (2025, 9, 1), "2025-03-07": (2025, 10, 5),
    "2025-03-19": (2025, 12, 3), "2025-04-01": (2025, 14, 2), "2025-04-15": (2025, 16, 2), "2025-04-30": (2025, 18, 3),
    "2025-05-16": (2025, 20, 5), "2025-06-02": (2025, 23, 1), "2025-06-20": (2025, 25, 5), "2025-07-09": (2025, 28, 3),
    "2022-01-01": (2021, 52, 6),
}


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_format(spark):
    at = ts.from_epoch(F.lit(NANOS), "ns")
    assert _one(spark, ts.format_time(at, "s")) == "2024-12-17 05:18:21"
    assert _one(spark, ts.format_time(at, "ms")) == "2024-12-17 05:18:21.444"
    assert _one(spark, ts.format_time(at, "us")) == "2024-12-17 05:18:21.444555"
    assert _one(spark, ts.format_nanos(F.lit(NANOS))) == "2024-12-17 05:18:21.444555666"


def test_before_1970(spark):
    at = ts.from_epoch(F.lit(-1), "ns")
    assert _one(spark, at) == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
    assert _one(spark, ts.format_nanos(F.lit(-1))) == "1969-12-31 23:59:59.999999999"


@pytest.mark.parametrize("unit, by", [("s", 10**9), ("ms", 10**6), ("us", 10**3), ("ns", 1)])
def test_epoch_round_trip(spark, unit, by):
    number = NANOS // by
    back = _one(spark, ts.to_epoch(ts.from_epoch(F.lit(number), unit), unit))
    assert back == (number // 1000 * 1000 if unit == "ns" else number)


@pytest.mark.parametrize("text, want", [
    ("2024-07-29 00:00:00.999666777", dt.datetime(2024, 7, 29, 0, 0, 0, 999666)),
    ("2024-07-29 00:00:00", dt.datetime(2024, 7, 29)),
    ("2024-07-29 00:00:00.000001", dt.datetime(2024, 7, 29, 0, 0, 0, 1)),
    ("2024-07-29 00:00:00.999", dt.datetime(2024, 7, 29, 0, 0, 0, 999000)),
    ("2024-07-29 00:00:00.01g999", None),
    ("2024-07-29 00:00:00.01", None),
    ("2024-07-29 00:00:00.", None),
    ("2024-07-29 00:00:00Z", None),
    ("2024-07-29", None),
    ("2024-02-30 00:00:00", None),
])
def test_parse(spark, text, want):
    assert _one(spark, ts.parse_strict(F.lit(text))) == want


def test_iso_calendar(spark):
    days = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in ISO], "day date")
    got = {r.day.isoformat(): (r.iso_year, r.iso_week, r.iso_weekday) for r in cal.calendar_dimension(days).collect()}
    assert got == ISO


def test_dimension_equals_datetime(spark):
    span = spark.sql("SELECT DATE'1999-12-20' AS lo, DATE'2005-01-10' AS hi")
    for r in cal.calendar_dimension(cal.date_range(F.col("lo"), F.col("hi"), span)).collect():
        assert r.ordinal == r.day.toordinal()
        assert (r.iso_year, r.iso_week, r.iso_weekday) == tuple(r.day.isocalendar())
        assert r.leap_year == (r.day.year % 4 == 0 and (r.day.year % 100 != 0 or r.day.year % 400 == 0))
        assert r.days_before_year == dt.date(r.day.year, 1, 1).toordinal() - 1
        assert r.days_before_month == (r.day.replace(day=1) - dt.date(r.day.year, 1, 1)).days
        assert r.week_start == r.day - dt.timedelta(days=r.day.weekday())


@pytest.fixture(scope="module")
def calendar(spark):
    """Weekdays of 2023 and 2024 are open, except the mid-autumn days of 2024."""
    closed = {dt.date(2024, 9, 16), dt.date(2024, 9, 17)}
    first = dt.date(2023, 1, 1)
    days = [first + dt.timedelta(days=i) for i in range(731)]
    rows = [(dt.datetime.combine(d, dt.time()), int(d.weekday() < 5 and d not in closed)) for d in days]
    return spark.createDataFrame(rows, "day timestamp_ntz, status int")


def test_open_days(calendar):
    days = [r.day for r in cal.open_days(calendar, "2024-08-19 23:00:00", "2024-09-19 00:00:00").collect()]
    assert days == sorted(days)
    assert (days[0], days[-1]) == (dt.datetime(2024, 8, 20), dt.datetime(2024, 9, 19))
    assert cal.open_days(calendar, start="2024-08-18").first().day == dt.datetime(2024, 8, 19)
    assert [r.day for r in cal.open_days(calendar, end="2024-09-17").collect()][-1] == dt.datetime(2024, 9, 13)
    assert cal.open_days(calendar).count() == calendar.where("status = 1").count()


def test_last_and_next(calendar):
    last = cal.last_and_next_open(calendar, "2023-04-10 23:00:00").first().last_day
    assert last == cal.last_and_next_open(calendar, "2023-04-08 00:00:00").first().next_day == dt.datetime(2023, 4, 10)
    assert cal.last_and_next_open(calendar, "2020-01-01").first().last_day is None
    assert cal.last_and_next_open(calendar, "2030-01-01").first().next_day is None


def test_align(spark, calendar):
    times = [dt.datetime(2022, 5, 1), dt.datetime(2023, 1, 1, 5), dt.datetime(2023, 12, 31, 9), dt.datetime(2024, 9, 15, 1),
             dt.datetime(2024, 9, 18), dt.datetime(2024, 12, 31, 23), dt.datetime(2025, 3, 1)]
    opened = [r.day for r in calendar.where("status = 1").collect()]
    # Closed dates may be missing from a calendar altogether.
    for table in (calendar, calendar.where("status = 1")):
        rows = cal.align_to_calendar(spark.createDataFrame([(t,) for t in times], "dt timestamp_ntz"), table).collect()
        assert len(rows) == len(times)
        for r in rows:
            assert r.prev_day == max((d for d in opened if d <= r.dt), default=None)
            assert r.next_day == min((d for d in opened if d > r.dt), default=None)


def test_from_parts(spark):
    parts = [F.lit(v) for v in (2024, 12, 17, 5, 18)]
    assert _one(spark, ts.from_parts(*parts, F.lit("21.444").cast("decimal(16,6)"))) == dt.datetime(2024, 12, 17, 5, 18, 21, 444000)
    assert _one(spark, ts.from_parts(*[F.lit(v) for v in (2023, 2, 29, 0, 0, 0)])) is None


@pytest.mark.parametrize("unit", ["s", "ms", "us", "ns"])
def test_epochs_out_of_range(spark, unit):
    """Huge epochs are rejected and end no job; the edges of the range are times."""
    per = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}[unit]
    edges = [x for x in (-62_135_596_800 * per, 253_402_300_800 * per - 1) if abs(x) < 1 << 63]
    beyond = [x for x in (-62_135_596_800 * per - 1, 253_402_300_800 * per, 9 * 10**18, -(1 << 63)) if abs(x) <= 1 << 63 and unit != "ns"]
    df = spark.createDataFrame([(x,) for x in [0, -1, *edges, *beyond, None]], "epoch long")
    good, bad = ts.split_epochs(df, "epoch", unit)
    assert sorted(r.epoch for r in bad.collect() if r.epoch is not None) == sorted(beyond)
    assert good.count() == 2 + len(edges) and good.where("dt IS NULL").count() == 0 and bad.count() == len(beyond) + 1


@pytest.mark.parametrize("unit", ["s", "ms", "us", "ns"])
def test_epochs_beyond_64_bits(spark, unit):
    """Decimals that 64 bits don't hold are rejected as they came; the others are taken as ever."""
    beyond = [1 << 63, -(1 << 63) - 1, 1 << 64, 10**33, -(10**35)]
    df = spark.createDataFrame([(Decimal(x),) for x in [0, -1, *beyond]] + [(None,)], "epoch decimal(36,0)")
    good, bad = ts.split_epochs(df, "epoch", unit)
    assert sorted(int(r.epoch) for r in bad.collect() if r.epoch is not None) == sorted(beyond) and bad.count() == len(beyond) + 1
    step = {"s": dt.timedelta(seconds=1), "ms": dt.timedelta(milliseconds=1)}.get(unit, dt.timedelta(microseconds=1))
    assert {int(r.epoch): r.dt for r in good.collect()} == {0: dt.datetime(1970, 1, 1), -1: dt.datetime(1970, 1, 1) - step}
    given = df.select("epoch", ts.from_epoch(F.col("epoch"), unit).alias("dt")).where("dt IS NOT NULL")
    assert sorted(int(r.epoch) for r in given.collect()) == [-1, 0]


def test_rejected_timestamps_of_large_event_numbers(spark, tmp_path):
    """Event numbers whose scaled epochs pass 64 bits give exact texts, up to the ends of the 64-bit range."""
    ids = [0, 99, 100, 101, 922_437, 922_438, 922_536, 922_537, 922_538, 5_999_999, (1 << 63) - 1, -(1 << 63)]
    at = dt.datetime(2024, 1, 3, 4, 5, 6, 123456)
    spark.createDataFrame([(i, at) for i in ids], "event_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    got = [(r.event_id, r.text) for r in QUERIES["rejected_timestamps"](spark, str(tmp_path)).collect()]
    texts = {4: "2024-01-03 04:05:06.12", 5: "2024-01-03 04:05:06.1g99", 6: "2024-02-30 04:05:06"}

    def layout(i):  # The remainder keeps the sign of the number, and negative ones take the last layout.
        return i % 7 if i >= 0 else 6

    want = [(i, texts[layout(i)]) for i in ids if layout(i) in texts]
    want += [(i, str((i - 100) * 10**13)) for i in ids if not -62_135_596_800 <= (i - 100) * 10**13 < 253_402_300_800]
    assert sorted(got) == sorted(want)
