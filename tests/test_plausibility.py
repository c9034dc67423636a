import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from wattmill.operators import plausibility


def days_of(n, seed, odd=()):
    rng = random.Random(seed)
    start = dt.date(2022, 1, 1)
    return [(g, start + dt.timedelta(days=i), 1e6 if (g, i) in odd else rng.gauss(100, 10)) for g in ("a", "b") for i in range(n)]


def brute_force(lines, least):
    out = []
    for g, d, v in lines:
        earlier = sorted(x for h, e, x in lines if h == g and e < d.replace(day=1))
        if len(earlier) >= least:
            q25, q75 = (earlier[int(np.ceil(len(earlier) * q)) - 1] for q in (0.25, 0.75))
            low, high = q25 - 3 * (q75 - q25), q75 + 3 * (q75 - q25)
            if not low <= v <= high:
                out.append((g, d, v, low, high, len(earlier)))
    return sorted(out, key=str)


def test_days_outside_the_bands_of_earlier_months(spark, rows):
    lines = days_of(200, 1, {("a", 3), ("a", 130), ("b", 199)})
    df = spark.createDataFrame([*lines, ("a", dt.date(2022, 2, 1), None)], "g string, nem_date date, v double").repartition(5)
    got = rows(plausibility.implausible_days(df, ["g"], "v"))
    want = brute_force(lines, 60)
    assert sorted(got, key=str) == want and [(g, d) for g, d, *_ in want] == [("a", dt.date(2022, 5, 11)), ("b", dt.date(2022, 7, 19))]


def test_merged_sketches_stay_within_the_stated_error(spark):
    k = 256
    df = spark.range(300_000, numPartitions=7).selectExpr(
        "'a' AS g", "date_add(DATE'2000-01-01', CAST(id % 3000 AS INT)) AS nem_date", "(xxhash64(id) % 100003) / 1000D AS v"
    )
    sketches = plausibility.monthly_sketches(df, ["g"], "v", k=k)
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 64 * k
    bands = plausibility.earlier_bands(sketches, ["g"], k=k).collect()
    values = np.sort(np.array([r.v for r in df.select("v").collect()]))
    last = max(bands, key=lambda r: r.month)
    spread = (last.high - last.low) / 7
    for found, share in ((last.low + 3 * spread, 0.25), (last.high - 3 * spread, 0.75)):
        rank = np.searchsorted(values, found) / len(values)
        assert abs(rank - share) < 3 * 1.7 / k
