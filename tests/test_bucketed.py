"""Ordered operators on bucketed tables: no exchange in the plan, rows as from any other frame."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barspan.operators import adjust, breadth, chunks
from barspan.sources.bucketed import read_bucketed, write_bucketed


def _bars(spark):
    rng = random.Random(1)
    rows = [(s, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), rng.uniform(1, 9), rng.choice([None, rng.uniform(1, 9)]), rng.choice([-1, 0, 1, 2]))
            for s in [*(f"S{i}" for i in range(40)), None] for d in range(rng.randint(1, 60))]
    return spark.createDataFrame(rows, "symbol string, dt timestamp_ntz, close double, preclose double, maxupordown int").repartition(7)


OPERATORS = {
    "previous": lambda df, w: chunks.with_previous(df, ["symbol"], ["dt"], {"before": "close"}, w),
    "adjust": lambda df, w: adjust.forward_adjust(df, chunk_seconds=w).withColumns({c: F.round(c, 9) for c in ("adjust_factor", "adj_close")}),
    "fill": lambda df, w: chunks.forward_fill(df, ["symbol"], "dt", "preclose", "filled", w),
    "streaks": breadth.limit_streaks,
    "max": lambda df, w: chunks.rolling_max(df, ["symbol"], "dt", "maxupordown", 5, "top", w),
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    write_bucketed(_bars(spark), "bucketed_bars", 5, path=str(tmp_path_factory.mktemp("buckets") / "bars"))
    yield read_bucketed(spark, "bucketed_bars")
    spark.sql("DROP TABLE bucketed_bars")


@pytest.mark.parametrize("name", list(OPERATORS))
def test_no_exchange(spark, stored, name):
    found = OPERATORS[name](stored, chunks.WHOLE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(found) == rows(OPERATORS[name](_bars(spark), chunks.WHOLE)) == rows(OPERATORS[name](_bars(spark), 7 * chunks.DAY))


def test_width_is_measured_without_exchange(stored):
    assert chunks.fitting_width(stored, ["symbol"], "dt") == chunks.WHOLE


def test_busy_key_is_refused(spark):
    with pytest.raises(ValueError, match="more than one bucket"):
        write_bucketed(_bars(spark), "no_such_bars", 5, most_rows=20)
    assert not spark.catalog.tableExists("no_such_bars")
