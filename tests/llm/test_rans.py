import struct
import zlib

import numpy as np
import pytest

from wattmill.llm import rans


def expected(rows):
    """(doc_id, start, n_tokens, crc) by the library alone, in ascending order."""
    tokenizer = rans.CachedTokenizer(rans.TOKENIZER).tokenizer
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, rans.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_sample_equals_library(sample, texts):
    assert sorted(map(tuple, rans.token_files(sample).collect())) == expected(sorted(texts.items()))


def test_odd_texts(frame, odd):
    rows = [r for r in odd if r[0] is not None]
    more = ["x ", " x", "a  b", "a\n\nb", "a \nb", "a\tb", "a b c", "it's. (a) a,b ,", "x,", "x.,", "\n"]
    rows += [(100 + i, t) for i, t in enumerate(more)]
    want = expected([(None, None), *rows])
    found = [tuple(r) for r in rans.token_files(frame([(None, None), *rows], "part", "key", "ids")).collect()]
    assert sorted(found, key=lambda r: r[1]) == want


def test_words_are_kept_without_their_marks():
    words = rans.CachedTokenizer(rans.TOKENIZER).words
    words.of_all(["house", "house,", "house###", "\nhouse", "\nhouse."])
    assert set(words) == {"house", "\nhouse", "\n,", "\n###", "\n."}


def test_words_with_marks_equal_library(monkeypatch):
    monkeypatch.setattr(rans, "CACHED_WORDS", 12)
    tokenizer = rans.CachedTokenizer(rans.TOKENIZER)
    rng = np.random.default_rng(4)
    parts = ["the", "Haus", "\u00e9t\u00e9", "\u6f22\u5b57", "12", "'s", "'", ",", "###", "_", "-", "!!", "<|", '"', "e\u0301"]
    texts = [" ".join("".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(30)).replace("# ", "#\n") for _ in range(200)]
    found = tokenizer.encode_all(texts, rans.END_ID)
    assert [f.tolist() for f in found] == [[*tokenizer.tokenizer.encode(t, add_special_tokens=False).ids, rans.END_ID] for t in texts]
    assert len(tokenizer.words) + len(tokenizer.words.older) <= 12


def test_empty_table(frame):
    assert rans.token_files(frame([])).collect() == []


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 300_000])
def test_blocks_decode_from_any_place(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    model = rans.Model(dict(zip(values.tolist(), counts.tolist(), strict=True)))
    assert int(model.freq.sum()) == 1 << rans.SCALE
    marks, stream = rans.encode_block(ids, model)
    assert (rans.decode_block(n, marks.tobytes(), stream, model) == ids).all()
    first = n * 2 // 3
    assert (rans.decode_block(n, marks.tobytes(), stream, model, first, 1000) == ids[first : first + 1000]).all()


def test_damage_is_found(frame, spark):
    blocks, model = rans.write_rans(frame([(1, "some text"), (2, "more text")]))
    damaged = blocks.withColumn("stream_crc32", blocks.stream_crc32 + 1)
    with pytest.raises(Exception, match="damaged"):
        rans.read_rans(damaged, model).collect()
