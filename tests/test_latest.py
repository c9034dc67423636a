import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattmill.operators.facility_marts import facility_generation
from wattmill.operators.latest import latest_abreast, latest_by

SCHEMA = "k string, part int, seq int, tie string, v double"


def expected(data):
    best = {}
    for k, part, seq, tie, v in data:
        order = (seq is not None, seq or 0, tie is not None, tie or "", v is not None, v or 0.0)
        if (k, part) not in best or order > best[k, part][0]:
            best[k, part] = (order, (k, part, seq, tie, v))
    return sorted((b[1] for b in best.values()), key=str)


row = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.integers(0, 2),
    st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from(["p", "q", None]),
    st.one_of(st.none(), st.sampled_from([-1.5, 0.5, 2.5])),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_equals_brute_force(spark, data):
    got = latest_by(spark.createDataFrame(data, SCHEMA), ["k", "part"], ["seq", "tie"])
    assert got.columns == ["k", "part", "seq", "tie", "v"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(data)


def test_order_and_copies_do_not_matter(spark, rows):
    data = [("a", i % 3, i % 7, "t", float(i)) for i in range(200)]
    once = rows(latest_by(spark.createDataFrame(data, SCHEMA), ["k", "part"], ["seq", "tie"]))
    shuffled = data * 3
    random.Random(1).shuffle(shuffled)
    assert rows(latest_by(spark.createDataFrame(shuffled, SCHEMA).repartition(7), ["k", "part"], ["seq", "tie"])) == once


def test_a_hot_key_shrinks_before_the_shuffle(spark):
    """Two thirds of the rows share one key; each map task must send a single row for it."""
    df = spark.range(0, 90_000, numPartitions=4).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('k', id) END AS k", "id AS seq", "CAST(id AS DOUBLE) AS v"
    )
    plan = latest_by(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")
    assert latest_by(df, ["k"], ["seq"]).where("k = 'hot'").first().v == 89_998.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_abreast_equals_brute_force(spark, data):
    """Named values of a key side by side, other values and NULL on their own: the rows of the plain form, ties and NULL keys included."""
    df = spark.createDataFrame(data, SCHEMA)
    for across, names in (("part", [0, 1]), ("k", ["b", "c"])):
        got = latest_abreast(df, ["k", "part"], ["seq", "tie"], across, names)
        assert got.columns == ["k", "part", "seq", "tie", "v"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected(data)


def test_metrics_of_a_fetch_cross_the_shuffle_in_one_row(spark):
    points = spark.range(0, 300, numPartitions=2).selectExpr(
        "concat('U', id div 3) AS unit_code", "timestamp_seconds(86400) AS interval_ts_utc", "'1d' AS interval", "timestamp_seconds(id) AS ingested_at",
        "element_at(array('energy', 'emissions', 'market_value'), CAST(id % 3 + 1 AS INT)) AS metric", "CAST(id AS DOUBLE) AS value", "'MWh' AS uom",
    )
    found = facility_generation(points)
    (keys,) = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
    assert "unit_code#" in keys and not re.search(r"(?<!other_)metric#", keys)
    assert sorted(r.value for r in found.collect()) == [float(i) for i in range(300)]
