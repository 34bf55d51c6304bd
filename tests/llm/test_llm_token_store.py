import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import ODD_ROWS
from tarmac.llm import token_store as store


@pytest.mark.parametrize("seed", range(40))
def test_grammar_restores_every_range(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, rng.integers(1, 6), rng.integers(0, 600)).astype(np.int32)
    if seed % 3 == 0:
        ids = np.repeat(ids, rng.integers(1, 9, len(ids)))
    block = store.Block(store.pack(ids, 7))
    assert np.array_equal(block.ids(), ids)
    for _ in range(5):
        start, stop = sorted(rng.integers(0, len(ids) + 2, 2))
        assert np.array_equal(block.ids(start, stop), ids[start:stop])
    lengths = store.rule_lengths(block.rules, 7)
    assert all(len(store.expand(np.array([7 + i]), block.rules, 7)) == n for i, n in enumerate(lengths.tolist()))


def test_repetition_is_compressed():
    ids = np.tile(np.arange(50, dtype=np.int32), 400)
    assert len(store.pack(ids, 50)) < ids.nbytes / 4
    assert len(store.Block(store.pack(np.zeros(4096, np.int32), 5)).seq) <= 4096 / 2**store.ROUNDS


def test_foreign_payload_is_refused():
    with pytest.raises(ValueError):
        store.Block(b"\0" * 64)


def test_encoder_equals_the_library(vocabulary, library):
    encoder = store.encoder_of(open(vocabulary, encoding="utf-8").read())
    texts = [t or "" for _, t in ODD_ROWS] + ["a  b", " a", "a ", "a\n b", "a \nb", "\x1c a b", "a b  c"]
    assert [x.tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_store_in_order_of_ids(spark, docs_of, vocabulary, library, tmp_path):
    rows = [(i, t) for i, t in ODD_ROWS if i is not None] + [(i, f"document {i} of a shard") for i in range(100, 140)]
    path = str(tmp_path / "store")
    store.write_store(docs_of(rows), path, vocabulary, end_id=2, shards=4, block_tokens=64)
    assert spark.read.parquet(path).count() > 4
    found = sorted(map(tuple, store.read_store(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted(i for i, _ in rows)
    want = sorted((i, n, c) for i, n, c in ((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in (
        (i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows)))
    assert sorted((i, n, c) for i, _, n, c in found) == want
    place = 0
    for _, start, n, _ in found:
        assert start == place
        place += n


def test_null_ids_come_first(spark, docs_of, vocabulary, tmp_path):
    path = str(tmp_path / "store")
    store.write_store(docs_of(ODD_ROWS), path, vocabulary, end_id=2, shards=3)
    found = sorted(map(tuple, store.read_store(spark, path).collect()), key=lambda r: r[1])
    assert len(found) == len(ODD_ROWS) and [r[0] for r in found][:2] == [None, None]


def test_empty_table(spark, docs_of, vocabulary, tmp_path):
    path = str(tmp_path / "store")
    store.write_store(docs_of([]), path, vocabulary, end_id=2, shards=2)
    assert store.read_store(spark, path).count() == 0


def test_forgetting_changes_no_ids(vocabulary, library, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"word{i}" for i in rng.geometric(0.02, 60)) + f" only{n}" for n in range(60)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    spec = open(vocabulary, encoding="utf-8").read()
    for room in (1, 40, 150):
        monkeypatch.setattr(store, "CACHE_PIECES", room)
        encoder, sizes = store.Encoder(spec), []
        for at in range(0, 60, 4):
            assert [x.tolist() for x in encoder.encode(texts[at : at + 4])] == want[at : at + 4]
            sizes.append(len(encoder.known))
        assert max(sizes) <= room + 4 * 61 and any(b < a for a, b in zip(sizes, sizes[1:]))


def test_portions_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(store, "PORTION", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["", "abc", "x" * 50, "", "é" * 5, "a", "b"])], ["id", "text"])
    parts = [p.column(0).to_pylist() for p in store.portions(batch)]
    assert sum(parts, []) == list(range(7))
    assert all(len(p) == 1 or sum(len(x.encode()) for x in batch.take(pa.array(p)).column(1).to_pylist()) <= 10 for p in parts)
    assert list(store.portions(batch.slice(0, 0))) == []


def test_rules_do_not_depend_on_the_width_of_keys():
    rng = np.random.default_rng(3)
    few = rng.integers(0, 9, 4000)
    many = np.concatenate([few + 70000, np.arange(70000)])
    for seq, top in ((few, 9), (many, 70009)):
        pairs, counts = np.unique(seq[:-1].astype(np.int64) << 32 | seq[1:], return_counts=True)
        found, n = store._often(seq.astype(np.int32), top, 8)
        assert np.array_equal(found, pairs[counts >= 8]) and np.array_equal(n, counts[counts >= 8])


def test_encoder_takes_columns(vocabulary, library):
    rng = np.random.default_rng(7)
    odd = ["", " ", "  ", "a", "\n", "　", "é", "a\n", "\tb", "東京", "<|endoftext|>", "don't", "12,5", "\0", "🙂"]
    texts = ["".join(rng.choice([*odd, *[" "] * 12], rng.integers(0, 12))) for _ in range(400)] + ["x" * 2000, "word " * 500, "", " "]
    encoder = store.Encoder(open(vocabulary, encoding="utf-8").read())
    column = pa.array(texts)
    for at in range(0, len(texts), 37):
        got = encoder.encode(column.slice(at, 37))
        assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 37]]
    assert encoder.encode(column.slice(0, 0)) == []


def test_words_are_known_whatever_follows_them(vocabulary, library):
    words = [f"{a}{b}ing" for a in "bdfklm" for b in ("é", "oo", "ü", "ara")]
    texts = [f"so {w}{mark}{next_}" for w in words for mark in (".", ",", "!?", "%%%", ")", "\n", ".\n", "") for next_ in ("", " end", "\nend")]
    encoder = store.Encoder(open(vocabulary, encoding="utf-8").read())
    assert [x.tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoder.known) < 2 * len(words)


@pytest.mark.parametrize("seed", range(3))
def test_pieces_begin_at_pre_tokens(vocabulary, library, seed):
    rng = np.random.default_rng(seed)
    odd = ["'s", "'", "\t", "\r", "\x1c", "\x7f", "\0", "\x85", "\xa0", "ß", "×", "÷", "²", "ª", "Ⅷ", "é", "…", "–", "🙂", "東", "ы", "ế", " ", "​", "᠎", "　", "<|end"]
    letters = [*"abcST '  \n\n..,!?%_-012()", *odd]
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3000)] + ["x.<|endoftext|>.y"]
    encoder = store.Encoder(open(vocabulary, encoding="utf-8").read())
    for at in range(0, len(texts), 500):
        got = encoder.encode(pa.array(texts).slice(at, 500))
        assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 500]]
    starts = {at for _, (at, _) in library.pre_tokenizer.pre_tokenize_str("a.\nb 's c12")}
    found = store._pieces(np.frombuffer(b"a.\nb 's c12", np.uint8), np.array([0])).tolist()
    assert found == [0, 1, 2, 3, 4, 7] and starts.issuperset(found)
