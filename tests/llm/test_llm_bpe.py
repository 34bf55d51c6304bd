import hashlib
import random

import pytest

from llm_rows import ODD_ROWS
from tarmac.llm import bpe


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def test_round_trip_equals_the_library(docs_of, vocabulary, library):
    found = sorted(map(str, (tuple(r) for r in bpe.round_trip(docs_of(ODD_ROWS), vocabulary).collect())))
    want = []
    for doc_id, text in ODD_ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append(str((doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded), decoded == (text or ""))))
    assert found == sorted(want)


def test_random_texts_equal_the_library(vocabulary, library):
    own = bpe.bpe_of(open(vocabulary, encoding="utf-8").read())
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(0x3000), 0xFEFF, 0x1F600, 0x20000, 0x10FFFF]]
    for _ in range(500):
        text = "".join(rng.choice(letters) if rng.random() < 0.4 else rng.choice("   \n\tab'sd1") for _ in range(30))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_encode_then_decode(docs_of, vocabulary):
    docs = docs_of(ODD_ROWS)
    texts = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    assert sorted(map(str, map(tuple, texts.collect()))) == sorted(str((i, t or "")) for i, t in ODD_ROWS)


def test_broken_and_null_ids(spark, vocabulary):
    ids = spark.createDataFrame([(1, None), (2, []), (3, [160])], "doc_id int, ids array<int>")
    found = dict(map(tuple, bpe.decode(ids, vocabulary).collect()))
    assert found[1] == found[2] == "" and "�" in found[3]


def test_empty_table(docs_of, vocabulary):
    assert bpe.round_trip(docs_of([]), vocabulary).count() == 0


def test_forgetting_changes_nothing(monkeypatch, vocabulary, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    own = bpe.Bpe(bpe.Vocabulary(open(vocabulary, encoding="utf-8").read()))
    text = " ".join(f"word{i % 7} other{i % 5}" for i in range(60))
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_unsupported_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary('{"model": {"type": "BPE", "vocab": {}, "merges": []}, "pre_tokenizer": {"type": "Whitespace"}}')
