import hashlib
import zlib

import duckdb

from wattmill.llm import oracle
from wattmill.llm.merkle import manifest, proofs

LOWER = {i: i + 32 for i in range(65, 91)}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """The root, and for each node its siblings level by level."""
    steps, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 8, len(nodes))) for a in range(0, len(nodes), 8)]
        for run in runs:
            for k in run:
                for i in below[k]:
                    steps[i].append(([nodes[j] for j in run if j < k], [nodes[j] for j in run if j > k]))
        nodes, below = [h(*(nodes[j] for j in run)) for run in runs], [[i for j in run for i in below[j]] for run in runs]
    return nodes[0], steps


def brute_force(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by_lang = [sorted(((r[0] is not None, r[0] or 0, h(*map(field, r)), r) for r in rows if r[2] == lang), key=lambda x: x[:3]) for lang in langs]
    trees = [tree([x[2] for x in own]) for own in by_lang]
    root, over = tree([sub for sub, _ in trees])
    out = []
    for own, (sub, ways), way in zip(by_lang, trees, over, strict=True):
        for (known, doc_id, leaf, r), steps in zip(own, ways, strict=True):
            changed = known and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r[4] is not None
            x = h(*map(field, r[:4]), field(r[4].translate(LOWER))) if changed else leaf
            for left, right in steps + way:
                x = h(*left, x, *right)
            siblings = [d for left, right in steps + way for d in (*left, *right)]
            out.append((r[0], leaf, sub, root, h(*siblings), x, x == root))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def order(rows):
    return sorted(rows, key=str)


def test_sample_equals_brute_force_and_sql(sample):
    found = order(map(tuple, proofs(sample).collect()))
    assert found == order(brute_force(rows_of(sample)))
    verified = [r[-1] for r in found]
    assert any(verified) and not all(verified)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert order(con.execute(oracle.OP12).fetchall()) == found


def test_many_languages_and_heights(frame):
    rows = [(i, f"Text {i}", f"l{min(i % 97, 40):02d}", "s") for i in range(700)] + [(9000 + i, "A b", "zz", "s") for i in range(513)]
    df = frame(rows)
    assert order(map(tuple, proofs(df).collect())) == order(brute_force(rows_of(df)))


def test_steps_lead_to_the_root(sample):
    found = manifest(sample).collect()
    heights = {r.lang: len(r.steps) for r in found}
    assert all(len(r.steps) == heights[r.lang] for r in found)
    for r in found:
        x = r.leaf.hex()
        for left, right in r.steps:
            x = h(left.hex(), x, right.hex())
        assert x == r.root.hex()


def test_odd_rows(frame, odd):
    rows = [(d, t, lang, "s") for (d, t), lang in zip(odd, ["en", None, "en", "", "en", "en", "fr", "fr", None], strict=True)]
    df = frame(rows, "rank", "tree", "n", "part", "digest", "run", "pos")
    assert order(map(tuple, proofs(df).collect())) == order(brute_force(rows_of(df)))


def test_one_row_and_one_language(frame):
    one = frame([(3, "A")])
    [r] = proofs(one).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == h()
    nine = frame([(i, f"T{i}") for i in range(9)])
    assert order(map(tuple, proofs(nine).collect())) == order(brute_force(rows_of(nine)))


def test_empty_table(frame):
    assert proofs(frame([])).collect() == []
