import random

import numpy as np

from wattmill.llm import chosen_path as cp


def brute_force(rows, threshold=0.8):
    """Classes by comparing every pair of texts."""
    sets = cp.gram_sets([(t or "").encode() for _, t in rows])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if len(a) and len(b):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if shared >= threshold * (len(a) + len(b) - shared):
                    parent[find(i)] = find(j)
                    if not np.array_equal(a, b):
                        links[i].add(b.tobytes())
                        links[j].add(a.tobytes())
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    names = [min((x for x in members[find(i)] if x is not None), default=None) for i in range(len(rows))]
    return names, [len(x) for x in links]


def test_sample_equals_brute_force(sample, texts):
    rows = sorted(texts.items())
    names, links = brute_force(rows)
    found = {r.doc_id: r for r in cp.near_duplicates(sample).collect()}
    assert [found[d].class_id for d, _ in rows] == names
    assert [found[d].n_links for d, _ in rows] == links


def test_large_group_of_near_copies_and_common_passage(frame):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):  # more than a small child holds, each within 0.8 of the base
        copy = list(base)
        for at in draw.sample(range(300), 4):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    passage = " ".join(word() for _ in range(40))
    rows += [(200 + i, passage + " " + " ".join(word() for _ in range(200))) for i in range(30)]
    found = {r.doc_id: r for r in cp.near_duplicates(frame(rows)).collect()}
    assert {found[i].class_id for i in range(40)} == {0}
    assert all(found[200 + i].class_id == 200 + i and found[200 + i].n_links == 0 for i in range(30))


def family_rows(draw, n, own, pairs):
    """Texts that share all but ``own`` of 240 words with a template, the first ``pairs`` of them each with a text that shares four words more."""
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(240)]
    rows = []
    for i in range(n):
        text = base[: 240 - own] + [word() for _ in range(own)]
        rows.append((i, " ".join(text)))
        if i < pairs:
            rows.append((10_000 + i, " ".join(text[: 244 - own] + [word() for _ in range(own - 4)])))
    return rows


def test_pairs_within_a_large_family_are_found(frame):
    rows = family_rows(random.Random(7), 900, 28, 40)  # 0.788 alike, but 0.815 in pairs
    found = {r.doc_id: r for r in cp.near_duplicates(frame(rows)).collect()}
    missed = [i for i in range(40) if found[10_000 + i].class_id != i]
    assert missed == []
    assert [found[i].class_id for i in range(900)] == list(range(900))


def test_links_of_a_large_group_are_exact(frame):
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    rows = []
    for i in range(400):  # some pairs are within 0.8 of each other, some are not; more than one block
        copy = list(base)
        for at in draw.sample(range(300), draw.choice([2, 5, 8])):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    names, links = brute_force(rows)
    found = {r.doc_id: r for r in cp.near_duplicates(frame(rows)).collect()}
    assert [found[d].n_links for d, _ in rows] == links
    assert [found[d].class_id for d, _ in rows] == names


def test_odd_rows(frame, odd):
    found = cp.near_duplicates(frame(odd, "rep", "root", "path")).collect()
    assert len(found) == len(odd)
    by_id = {r.doc_id: r for r in found}
    assert by_id[None].class_id is None
    assert [(by_id[i].class_id, by_id[i].n_links, by_id[i].n_copies) for i in (1, 2, 3)] == [(1, 0, 1), (2, 0, 1), (3, 0, 1)]
    assert (by_id[4].class_id, by_id[4].n_copies) == (4, 2)
    kept = cp.one_of_each(frame(odd, "_key", "_wordless"))
    assert kept.columns == [*frame([]).columns, "_key", "_wordless"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in (None, 1, 2, 3, 4, 5, 6, 7))


def test_empty_table(frame):
    assert cp.near_duplicates(frame([])).collect() == []
    assert cp.one_of_each(frame([])).collect() == []
