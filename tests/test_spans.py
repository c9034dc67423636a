import datetime as dt
import random

import pytest

from wattmill.operators.spans import in_spans

START = dt.date(2020, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def drawn(seed):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.05 else v
    points = [(i, maybe(rng.choice("ab")), maybe(day(rng.randrange(-40, 900)))) for i in range(120)]
    spans = []
    for i in range(60):
        first = rng.randrange(-50, 900)
        length = rng.choice([-3, 0, 1, 5, 31, 32, 33, 700])
        spans.append((i, maybe(rng.choice("ab")), maybe(day(first)), maybe(day(first + length))))
    return points, spans


@pytest.mark.parametrize("days", [1, 7, 32])
def test_equals_brute_force(spark, rows, days):
    points, spans = drawn(days)
    p = spark.createDataFrame(points, "p int, k string, at date")
    s = spark.createDataFrame(spans, "s int, k string, first date, last date")
    got = rows(in_spans(p, s, "at", "first", "last", on=["k"], days=days), "p", "s")
    want = {(i, j) for i, k, d in points for j, l, a, b in spans if None not in (k, d, l, a, b) and k == l and a <= d <= b}
    assert set(got) == want and len(got) == len(want)
    every = rows(in_spans(p, s.drop("k"), "at", "first", "last", days=days), "p", "s")
    assert len(every) == sum(1 for _, _, d in points for _, _, a, b in spans if None not in (d, a, b) and a <= d <= b)


def test_no_nested_loop_and_no_hot_bin(spark):
    p = spark.range(10_000).selectExpr("id AS p", "date_add(DATE'2000-01-01', CAST(id AS INT)) AS at", "'x' AS bin")
    s = spark.sql("SELECT 1 AS s, DATE'2000-01-01' AS first, DATE'2030-01-01' AS last")
    joined = in_spans(p, s, "at", "first", "last")
    assert joined.columns == ["p", "at", "bin", "s", "first", "last"] and joined.count() == 10_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # an equi-join on the bin, beside a column of that name
    assert "bin_" in plan


def test_clashing_columns_are_refused(spark):
    p = spark.sql("SELECT DATE'2020-01-01' AS at, 1 AS v")
    s = spark.sql("SELECT DATE'2020-01-01' AS first, DATE'2020-01-02' AS last, 2 AS v")
    with pytest.raises(ValueError, match="v"):
        in_spans(p, s, "at", "first", "last")
