import hashlib
import struct

import pytest

from wattmill.llm import word_bpe


def expected(text):
    tokenizer = word_bpe.load(word_bpe.TOKENIZER)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_sample_equals_library(sample, texts):
    found = {r.doc_id: r for r in word_bpe.encode(sample).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids, decoded = expected(text)
        assert bytes(found[doc_id].ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert (found[doc_id].n_tokens, bytes(found[doc_id].decoded).decode()) == (len(ids), decoded)


def test_odd_texts(frame, odd):
    found = word_bpe.encode(frame(odd, "ids", "block", "part"), digests=True).collect()
    assert len(found) == len(odd)
    want = []
    for doc_id, text in odd:
        ids, decoded = expected(text)
        want.append((str(doc_id), len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == sorted(want)


def test_empty_table(frame):
    assert word_bpe.encode(frame([])).collect() == []


def test_other_kinds_of_tokenizer_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        word_bpe.check_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
