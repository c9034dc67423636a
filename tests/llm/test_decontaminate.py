import hashlib
import random
import re
import tracemalloc

import pytest

from wattmill.llm import decontaminate as de

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(text, items, width=13):
    own = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        item_words = words(item)
        size = min(width, len(item_words))
        windows = {tuple(item_words[i : i + size]) for i in range(len(item_words) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if size and tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item_id is not None:
                    found.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(own)


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]


def table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_sample_equals_brute_force(spark, sample, texts, items):
    found = {r.doc_id: tuple(r)[1:6] for r in de.contamination(sample, table(spark, items)).collect()}
    assert any(f[1] for f in found.values())
    assert found == {d: brute_force(t, items) for d, t in texts.items()}


def test_random_short_alphabet(spark, frame):
    draw = random.Random(3)
    text = lambda n: draw.choice((" ", ", ", "\n")).join(draw.choice(("a", "B", "ab", "é", "7")) for _ in range(n))
    some = [(i, text(draw.choice((1, 2, 3, 5, 13, 14, 30)))) for i in range(40)]
    some += [(None, "a B ab"), (3, text(20)), (41, None), (42, "!!")]
    rows = [(i, text(draw.choice((0, 1, 2, 12, 13, 60, 400)))) for i in range(60)]
    found = {r.doc_id: r for r in de.contamination(frame(rows), table(spark, some)).collect()}
    for d, t in rows:
        assert tuple(found[d])[1:6] == brute_force(t, some), t
        assert sum(s.last - s.first + 1 for s in found[d].spans) == found[d].n_hit


def test_a_scan_needs_a_few_times_its_text():
    texts = [b"the house and the garden were quiet that morning " * 40] * 1000
    size = sum(map(len, texts))
    tracemalloc.start()
    de.Scan(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 13 * size


def test_patterns_in_several_blocks(spark, sample, items, monkeypatch):
    whole = de.contamination(sample, table(spark, items)).collect()
    monkeypatch.setattr(de.pattern_blocks, "__defaults__", (1000,))
    assert len(de.pattern_blocks(table(spark, items), 13)) > 3
    assert sorted(map(str, de.contamination(sample, table(spark, items)).collect())) == sorted(map(str, whole))


def test_odd_rows(spark, frame, odd, items):
    docs = frame([*odd, (8, items[0][1])], "n_hit", "items")
    found = de.contamination(docs, table(spark, items)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit) for r in found) == sorted((str(d), *brute_force(t, items)[:2]) for d, t in [*odd, (8, items[0][1])])
    clean = de.clean_documents(docs, table(spark, items))
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in odd)


def test_empty_tables(spark, frame, items):
    assert de.contamination(frame([]), table(spark, items)).collect() == []
    [row] = de.contamination(frame([(1, "a b")]), table(spark, [])).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
