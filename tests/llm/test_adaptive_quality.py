import re
from collections import Counter

from pyspark.sql import functions as F

from wattmill.llm import adaptive_quality as aq

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(found) < 50 or 100 * len(hit) > 50 * len(found)


def test_counts_of_the_sample(sample, texts):
    found = {r.doc_id: tuple(r)[1:7] for r in aq.adaptive_quality(sample).collect()}
    assert found == {d: counts(t) for d, t in texts.items()}


def test_buckets_are_whole_number_ranges(spark):
    values = [*range(5000), *(2**k + d for k in range(13, 50) for d in (-1, 0, 1))]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").withColumn("b", aq.bucket(F.col("v"))).withColumn("low", aq.lower_end(F.col("b")))
    rows = sorted(tuple(r) for r in df.collect())
    assert all(b == v for v, b, _ in rows if v < 64)
    assert all(low <= v <= low + max(low // 32, 0) for v, _, low in rows)
    assert [b for _, b, _ in rows] == sorted(b for _, b, _ in rows)


def test_limits_follow_language_and_source(frame):
    plain = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    marked = lambda i: " ".join(f"w{i}x{j}" + ("#" if j % 2 else "") for j in range(60))
    rows = [(i, plain(i), "en", "prose") for i in range(150)] + [(1000, marked(1000), "en", "prose")]
    rows += [(2000 + i, marked(2000 + i), "en", "code") for i in range(150)]
    kept = {r.doc_id: r.kept for r in aq.adaptive_quality(frame(rows)).collect()}
    # the same share of symbols is an outlier in one source and usual in the other
    assert not kept[1000] and all(kept[i] for i in kept if i != 1000)


def test_small_groups_merge_into_their_language(frame):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en", f"s{i}") for i in range(120)]
    rows.append((500, " ".join(f"w{j}#####" for j in range(60)), "en", "s500"))
    kept = {r.doc_id: r.kept for r in aq.adaptive_quality(frame(rows)).collect()}
    assert not kept[500] and sum(kept.values()) == 120


def test_odd_rows(frame, odd):
    rows = [(*r, None, None) for r in odd]
    found = aq.adaptive_quality(frame(rows, "kept", "n", "measure", "base_failed")).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:7]) for r in found) == sorted((str(d), *counts(t)) for d, t in odd)
    assert not any(r.kept for r in found)


def test_empty_table(frame):
    assert aq.adaptive_quality(frame([])).collect() == []
