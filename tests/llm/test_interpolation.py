import math
from collections import Counter

import numpy as np
import pytest

from wattmill.llm import interpolation as lm


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.decode() for w in lowered.encode().split()] + [None]


def brute_force(rows):
    """Scores of all rows from plain dictionaries, with weights learned by a plain loop."""
    docs = [(d, tokens(t), lm.remainder(d)) for d, t in rows]

    def count(keep):
        words, pairs = Counter(), Counter()
        for _, ts, r in docs:
            if keep(r):
                words.update(ts)
                pairs.update(zip([None, *ts], ts))
        return words, pairs

    words, pairs = count(lambda r: r > 0)
    kept_words, kept_pairs = count(lambda r: r > 1)
    _, held = count(lambda r: r == 1)
    n, v, n_kept = sum(words.values()), len(words), max(sum(kept_words.values()), 1)
    bucket = lambda c: c.bit_length()
    weights = {b: [0.4, 0.4, 0.2] if b else [0.0, 0.7, 0.3] for b in range(64)}
    last = -math.inf
    for _ in range(50):
        sums, log = {}, 0.0
        for (a, w), times in held.items():
            c = kept_words[a]
            parts = [x * y for x, y in zip(weights[bucket(c)], (kept_pairs[a, w] / max(c, 1), kept_words[w] / n_kept, 1 / (v + 1)))]
            own = sums.setdefault(bucket(c), [0.0, 0.0, 0.0])
            for k in range(3):
                own[k] += times * parts[k] / sum(parts)
            log += times * math.log(sum(parts))
        mass = sum(map(sum, sums.values()))
        if not mass:
            break
        for b, own in sums.items():
            own = [x + (0.5 if b or k else 0.0) for k, x in enumerate(own)]
            weights[b] = [x / sum(own) for x in own]
        gain, last = log / mass - last, log / mass
        if gain < 1e-4:
            break
    out = {}
    for d, ts, r in docs:
        base = sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        score = 0.0
        for a, w in zip([None, *ts], ts):
            x = weights[bucket(words[a])]
            score += math.log10(x[0] * pairs[a, w] / max(words[a], 1) + x[1] * words[w] / n + x[2] / (v + 1))
        out[d] = (r == 0, len(ts), sum(words[t] > 0 for t in ts), n, base, score)
    return out


def test_sample_equals_brute_force(sample, texts):
    want = brute_force(list(texts.items()))
    found = {r.doc_id: tuple(r)[1:] for r in lm.scores(sample).collect()}
    assert found.keys() == want.keys()
    for d in want:
        assert found[d][:4] == want[d][:4]
        assert found[d][4:] == pytest.approx(want[d][4:], rel=1e-6)
    # held-out texts are likelier under the mixture than under the base
    held = [f for f in found.values() if f[0]]
    assert sum(f[5] for f in held) > sum(f[4] for f in held)


def test_odd_rows_and_empty_table(frame, odd):
    found = lm.scores(frame(odd, "block", "part")).collect()
    want = brute_force([(d, t) for d, t in odd if d != 4] + [(4, odd[4][1]), (4, odd[4][1])])
    assert len(found) == len(odd)
    for r in found:
        assert (r.n_tokens, r.train_tokens) == (want[r.doc_id][1], want[r.doc_id][3])
        assert (r.base_score, r.score) == pytest.approx(want[r.doc_id][4:], rel=1e-6)
    assert lm.scores(frame([])).collect() == []


def test_nothing_to_learn_from(frame):
    [row] = lm.scores(frame([(None, "some words")])).collect()
    assert (row.held_out, row.n_tokens, row.train_tokens, row.base_score, row.score) == (True, 3, 0, None, None)


def test_packed_numbers_return():
    from wattmill.llm.word_blocks import pack, unpack

    for kind in (np.uint16, np.uint32, np.uint64):
        numbers = np.array([0, 1, 255, 256, 65535, 7], dtype=kind)
        assert (unpack(pack(numbers)) == numbers).all()
    assert len(unpack(pack(np.zeros(0, dtype=np.uint32)))) == 0
