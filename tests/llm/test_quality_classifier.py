import math
import zlib

import numpy as np
import pytest
from conftest import SF_DIR

from wattmill.llm import quality_classifier as qc

SF_LARGE = "/root/testdata/sf0.1"


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, qc.quality_scores(docs, labels).collect()


def test_held_out_labels_are_predicted(scored):
    docs, labels, found = scored
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert all(r.held_out == (remainder(r.doc_id) == 0) for r in found)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, y in held if y == label] for label in (1, 0))
    assert len(bad) > 50
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert above / len(good) / len(bad) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.99 and np.mean([s >= 0.3 for s in bad]) < 0.2
    # calibrated: the mean score is the share of label 1
    assert abs(np.mean([s for s, _ in held]) - np.mean([y for _, y in held])) < 0.03


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet").coalesce(1) for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality")
    one, other = ({r.doc_id: r.score for r in qc.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-9 for k in one)


def test_normal_equations_and_weights_equal_numpy(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, len(qc.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(1, float(t), [float(v) for v in own]) for t, own in zip(y, x, strict=True)], "fold int, y double, x array<double>").repartition(7)
    model = qc.drawn(rows, 40, 3)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))
    z = model.features(x)
    sums = qc.normal_equations(rows, model)
    assert np.allclose(sums[:, :-1], z.T @ z) and np.allclose(sums[:, -1], z.T @ y)
    penalty = np.diag([0.01 * 400] * 40 + [0])
    assert np.allclose(qc.solve(sums, 0.01), np.linalg.solve(z.T @ z + penalty, z.T @ y))


def test_random_features_approximate_the_kernel():
    draw = np.random.default_rng(2)
    size = len(qc.STATISTICS)
    x = draw.normal(size=(30, size))
    model = qc.Model(np.zeros(size), np.ones(size), draw.normal(size=(size, 20_000)) / math.sqrt(size), draw.uniform(0, 2 * math.pi, 20_000))
    z = model.features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * size))).max() < 0.05


def test_pooling_is_the_best_rising_fit():
    draw = np.random.default_rng(4)
    for _ in range(20):
        y, w = draw.integers(0, 2, size=12).astype(float), draw.integers(1, 5, size=12).astype(float)
        places, values = qc.pooled(np.arange(12.0), y, w)
        assert (np.diff(values) > 0).all() and (np.diff(places) > 0).all()
        # the max-min formula of isotonic regression, point by point
        mean = lambda a, b: np.average(y[a : b + 1], weights=w[a : b + 1])  # noqa: B023, E731
        best = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert sorted(set(np.round(best, 9))) == pytest.approx(sorted(set(np.round(values, 9))))


def test_statistics():
    x = dict(zip(qc.STATISTICS, qc.statistics_of("AB ab\nab ab | é9!\nAB ab".encode()), strict=True))
    assert x["distinct"] == pytest.approx(4 / 8) and x["top_word"] == 4 / 8 and x["word_again"] == 2 / 8
    assert x["lines_again"] == pytest.approx(1 / 3) and x["words_without_letters"] == 1 / 8
    assert x["upper"] == pytest.approx(4 / 24) and x["not_ascii"] == pytest.approx(2 / 24)
    assert qc.statistics_of(b"") == qc.statistics_of(b" \n\t") == [0.0] * len(qc.STATISTICS)


def test_odd_rows(spark, frame, odd):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (6, 1), (7, 0), (2, 0)], "doc_id bigint, quality int")
    found = qc.quality_scores(frame(odd, "x", "y", "fold", "score"), labels).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in odd)
    assert all(0 <= r.score <= 1 for r in found) and all(r.held_out for r in found if r.doc_id is None)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1


def test_without_labels_or_rows(spark, frame):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in qc.quality_scores(frame([(1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert qc.quality_scores(frame([]), none).collect() == []
    fitted = next(d for d in range(100) if remainder(d) == 1)
    only = spark.createDataFrame([(fitted, 1)], "doc_id bigint, quality int")
    assert all(r.score == pytest.approx(1) for r in qc.quality_scores(frame([(fitted, "a b c")]), only).collect())
