"""Membership replay against a literal replay of the log."""

import datetime as dt
import random

import pytest

from barspan.operators import breadth, membership

EXCLUDED = "885338.TI"
CODES = ["I1", "I2", "I3", EXCLUDED]


def _log():
    rng = random.Random(4)
    rows = []
    for seq in range(600):
        # One stock has most of the entries.
        stock = "HOT" if rng.random() < 0.6 else rng.choice(["S1", "S2", "S3"])
        rows.append((rng.choice(CODES), stock, dt.datetime(2024, 1, rng.randint(1, 25)), rng.choice([1, 0, -1]), seq))
    return rows


def _replay(at, excluded=()):
    state = set()
    for index, stock, _, op, _ in sorted((r for r in _log() if r[2] <= at and r[0] not in excluded), key=lambda r: (r[2], r[4])):
        if op == 1:
            state.add((index, stock))
        else:
            state.discard((index, stock))
    return state


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(_log(), "index_code string, stock_code string, tradedate timestamp_ntz, op int, seq bigint").repartition(4)


@pytest.fixture(scope="module")
def stocks(spark):
    return spark.createDataFrame([(s,) for s in ["HOT", "S1", "S3", "NONE"]], "stock_code string")


DAYS = [dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 9), dt.datetime(2024, 2, 1)]


@pytest.mark.parametrize("at", DAYS)
def test_members(log, at):
    assert {tuple(r) for r in membership.members(log, at).collect()} == _replay(at)
    of_one = {r.stock_code for r in membership.members(log, at, index_codes=["I2"]).collect()}
    assert of_one == {s for i, s in _replay(at) if i == "I2"}
    of_stock = {r.index_code for r in membership.indexes_of_stocks(log, at, ["HOT"]).collect()}
    assert of_stock == {i for i, s in _replay(at, [EXCLUDED]) if s == "HOT"}


def test_in_concepts(log, stocks):
    at, codes = DAYS[1], ["I1", "I3", EXCLUDED]
    want = {s for i, s in _replay(at, [EXCLUDED]) if i in codes} & {"HOT", "S1", "S3", "NONE"}
    assert {r.stock_code for r in membership.in_concepts(stocks, log, at, codes).collect()} == want
    assert membership.in_concepts(stocks, log, at, []) is stocks


def test_concept_lists_and_counts(log, stocks):
    at = DAYS[1]
    state = _replay(at, [EXCLUDED])
    got = {r.stock_code: r.concepts for r in membership.concepts_per_stock(stocks, log, at).collect()}
    assert got == {s: sorted(i for i, x in state if x == s) for s in ["HOT", "S1", "S3", "NONE"]}
    counts = {c: sum(1 for i, s in state if i == c and s in got) for c in CODES}
    order = sorted((c for c in CODES if counts[c]), key=lambda c: (-counts[c], c))
    rows = membership.top_concepts(stocks, log, at).collect()
    assert [(r.index_code, r.n_stocks) for r in rows] == [(c, counts[c]) for c in order]
    assert [r.index_code for r in membership.top_concepts(stocks, log, at, 2).collect()] == order[:2]


@pytest.mark.parametrize("seconds", [86_400, 7 * 86_400, membership.QUARTER])
def test_members_at_rows(spark, log, seconds):
    rows = [(s, dt.datetime(2024, 1, d, h)) for s in ["HOT", "S2", "NONE"] for d in range(1, 29) for h in (0, 15)]
    df = spark.createDataFrame(rows, "stock_code string, dt timestamp_ntz")
    out = membership.members_at_rows(df, membership.membership_spans(log), df.selectExpr("max(dt)"), chunk_seconds=seconds)
    want = {(s, at, i) for s, at in rows for i, x in _replay(at) if x == s}
    got = [(r.stock_code, r.dt, r.index_code) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_limit_up_concepts_of_days(spark, log):
    bars = spark.createDataFrame(
        [(s, dt.datetime(2024, 1, d), 1 if (d + i) % 5 == 0 else 0) for i, s in enumerate(["HOT", "S1", "S2"]) for d in range(1, 25)],
        "symbol string, dt timestamp_ntz, maxupordown int",
    )
    days = [dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 20)]
    got = {(r.dt, r.index_code): (r.n_stocks, r["rank"]) for r in breadth.limit_up_concepts(bars, log, m=2, n=2, days=days).collect()}
    want = {}
    for day in days:
        hit = [s for i, s in enumerate(["HOT", "S1", "S2"]) if any((day.day - k + i) % 5 == 0 for k in (0, 1))]
        counts = {}
        for i, s in _replay(day, [EXCLUDED]):
            if s in hit:
                counts[i] = counts.get(i, 0) + 1
        for place, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c))[:2], start=1):
            want[(day, c)] = (counts[c], place)
    assert got == want


def test_market_stats_ladder(spark):
    day = dt.datetime(2024, 1, 2)
    rows = [("a", day, 1, 1), ("b", day, 2, 3), ("c", day, 1, 3), ("ST d", day, 1, 5), ("e", day, -2, 0), ("f", day, None, None)]
    df = spark.createDataFrame(rows, "name string, dt timestamp_ntz, maxupordown int, lb_up_count int")
    r = breadth.market_stats(df).first()
    assert (r.count_of_uplimit, r.count_of_downlimit, r.count_of_yiziup, r.count_of_yizidown) == (3, 1, 1, 1)
    assert r.lb == [1, 0, 2] and r.ratio_of_uplimit == pytest.approx(0.6)


def test_breadth(spark):
    day = dt.datetime(2024, 1, 2)
    rows = [("x", "a", day, 11.0, 10.0), ("y", "b", day, 10.0, None), ("z", "ST c", day, 20.0, 10.0), ("w", "d退", day, 20.0, 10.0),
            ("v", None, day, 20.0, 10.0), ("u", "e", day, 5.0, 0.0), ("t", "f", day, 9.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, name string, dt timestamp_ntz, close double, preclose double")
    assert breadth.market_breadth(df, 0.05).first().ratio_of_perctg_gt == 0.5
    info = spark.createDataFrame([("x",), ("y",), ("x",)], "symbol string")
    assert breadth.market_breadth(df, 0.05, info).first().ratio_of_perctg_gt == 0.5
    assert breadth.market_breadth(df.where("symbol <> 't'"), 0.05).first().ratio_of_perctg_gt == pytest.approx(1 / 3)


def test_hot_list(spark):
    d = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
    df = spark.createDataFrame([(x, s, o) for x in d for s, o in [("b", 2), ("a", 2), ("c", 1), ("d", 9)]], 'date timestamp_ntz, symbol string, `order` int')
    assert [r.symbol for r in breadth.hot_list(df, 2, d[0]).collect()] == ["c", "a"]
    assert sorted((r.date, r.symbol) for r in breadth.hot_list(df, 2).collect()) == [(x, s) for x in d for s in ("a", "c")]


def test_snapshots_equal_the_replay(spark, tmp_path):
    """At any time the same members as the whole log; only one period of either table is read."""
    rng = random.Random(2)
    rows = [(f"i{rng.randint(0, 4)}", f"s{rng.randint(0, 30)}", dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 900), hours=rng.choice([0, 9])), rng.choice([0, 1, 1]), i) for i in range(3000)]
    rows += [("i9", "early", dt.datetime(2020, 1, 5), 1, 4000), ("i9", "none", None, 1, 4001)]
    log = spark.createDataFrame(rows, "index_code string, stock_code string, tradedate timestamp_ntz, op int, seq long")
    path = str(tmp_path / "members")
    membership.write_snapshots(log, path)
    pairs = lambda df: sorted(map(tuple, df.collect()))
    for at in ("2019-12-31 00:00:00", "2020-01-05 00:00:00", "2020-03-31 10:00:00", "2020-04-01 00:00:00", "2021-07-11 09:00:00", "2030-01-01 00:00:00"):
        found = membership.members_from_snapshots(spark, path, at)
        assert pairs(found) == pairs(membership.members(log, at))
    assert ("i9", "early") in pairs(found)
    some = membership.members_from_snapshots(spark, path, "2021-07-11 09:00:00", index_codes=["i1", "i2"], excluded=["i2"])
    assert pairs(some) == pairs(membership.members(log, "2021-07-11 09:00:00", index_codes=["i1"]))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == plan.count("PartitionFilters: [isnotnull(snapshot") >= 2
