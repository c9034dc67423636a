import zlib
from collections import Counter

from wattmill.llm.interleave import interleave


def test_shards_of_the_sample(sample, texts):
    found = interleave(sample, shards=16).collect()
    sizes = Counter(r.shard for r in found)
    assert len(found) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_every_shard_has_the_mixture(frame):
    rows = [(i, f"t{i}", "en", "big" if i % 3 else "small") for i in range(1200)]
    found = interleave(frame(rows), shards=8).collect()
    for shard in range(8):
        own = Counter(r.source for r in found if r.shard == shard)
        assert abs(own["big"] - 100) <= 1 and abs(own["small"] - 50) <= 1
    assert [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot)) if r.source == "small"] != list(range(0, 1200, 3))


def test_ranks_by_brute_force(frame):
    from wattmill.llm.interleave import seeded

    rows = [(i, "x" * (i % 7), "en", ("a", "b", "b", None)[i % 4]) for i in range(101)]
    df = frame(rows)
    drawn = {r.doc_id: r.h for r in df.select("doc_id", seeded(42, "doc_id").alias("h")).collect()}
    by_source = {}
    for d, _, _, s in sorted(rows, key=lambda r: drawn[r[0]]):
        by_source.setdefault(s, []).append(d)
    place = {d: ((2 * i + 1) / (2 * len(ids)), drawn[d]) for ids in by_source.values() for i, d in enumerate(ids)}
    want = sorted(place, key=place.get)
    found = sorted(interleave(df, shards=5).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in found] == want


def test_odd_rows(frame, odd):
    found = interleave(frame(odd, "shard", "slot", "part", "size"), shards=4).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in odd)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(r.size == 1 for r in found if r.doc_id in (None, 1, 2))


def test_empty_table(frame):
    assert interleave(frame([])).collect() == []
