import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_rows import ODD_ROWS

from tarmac.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute_force(docs, items, top=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in {i for i in items if i[1] is not None}:
        found = []
        for doc_id, c in counts:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t]
            )
            if score:
                found.append((-score, doc_id is None, doc_id or 0))
        found = [(item_id, rank, None if none else doc_id, -score) for rank, (score, none, doc_id) in enumerate(sorted(found)[:top], 1)]
        out += found
    return sorted(out, key=repr)


def searched(spark, docs, items, **options):
    rows = R.search(docs, spark.createDataFrame(items, "item_id bigint, text string"), **options).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=repr)


def random_rows(n, seed=0, words=60):
    rng = np.random.default_rng(seed)
    made = [(i, " ".join(f"w{w}" for w in rng.zipf(1.4, rng.integers(1, 80)) if w < words)) for i in range(n)]
    return [*made, *[(n + i, made[3][1]) for i in range(n // 3)]]  # a third more are copies of one text


def test_like_brute_force_and_most_blocks_are_left_out(spark):
    docs = random_rows(600)
    items = [(i, text) for i, text in random_rows(25, seed=1, words=90)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert searched(spark, table, items) == brute_force(docs, items)


@pytest.mark.parametrize("top", [1, 4, 1000])
def test_odd_rows(spark, docs_of, top):
    items = [(1, "Hello WORLD 2024"), (1, "Hello WORLD 2024"), (1, "another id"), (2, None), (3, " .. "), (None, "naïve 東京 word"), (4, "nowhere")]
    assert searched(spark, docs_of(ODD_ROWS), items, top=top) == brute_force([r[:2] for r in ODD_ROWS], items, top)


def test_empty_tables(spark, docs_of):
    assert searched(spark, docs_of([]), [(1, "a b")]) == []
    assert searched(spark, docs_of(ODD_ROWS), []) == []
    assert searched(spark, docs_of([(1, None), (2, "..")]), [(1, "a b")]) == []


def test_small_shards_portions_and_pieces_change_nothing(spark, monkeypatch):
    docs, items = random_rows(200), [(i, text) for i, text in random_rows(12, seed=2)]
    portions = list(R._portions(spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text"))
    weights, whole = np.arange(1, len(portions[0][1].vocabulary) + 1), None
    for name, value in [("SHARD_DOCS", 8192), ("SHARD_DOCS", 7), ("SHARD_ENTRIES", 40), ("BLOCK", 1)]:
        monkeypatch.setattr(R, name, value)
        best = R.Best(portions[0][1], weights, 10)
        for shard in R.shards(batches(spark, docs, portions[0][1]), weights, 260, 9000, np.random.default_rng(0).choice(np.float32([-1, 1]), (len(weights), 16))):
            best.search(shard)
        whole = whole or (best.scores.tolist(), best.keys.tolist())
        assert (best.scores.tolist(), best.keys.tolist()) == whole
    monkeypatch.setattr(R, "PIECE", 5)
    assert [w for piece in R._pieces(b"ab cdefghij k lm,n") for w in piece] == [b"ab", b"cdefghij", b"k", b"lm", b"n"]
    monkeypatch.setattr(R, "PORTION_ITEMS", 8)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert searched(spark, table, items) == brute_force(docs, items)


def batches(spark, docs, portion):
    table = R._counted(spark.createDataFrame(docs, "id bigint, text string"), portion).toArrow()
    return iter(table.combine_chunks().to_batches())


def test_blocks_are_skipped(spark):
    """Where few documents hold the rare terms, the list of a term that all have is mostly left out."""
    docs = [(i, "common " + ("rare " * 3 if i < 12 else f"x{i % 50} " * 5)) for i in range(2000)]
    (_, portion), = R._portions(spark.createDataFrame([(1, "rare common")], "item_id bigint, text string"), "item_id", "text")
    weights = np.array([{b"rare": 5000, b"common": 1}[t] for t in sorted(portion.vocabulary)])
    best = R.Best(portion, weights, 10)
    for shard in R.shards(batches(spark, docs, portion), weights, 2000, 12000, np.random.default_rng(0).choice(np.float32([-1, 1]), (2, 16))):
        best.search(shard)
    assert best.keys[0].tolist() == list(range(10)) and best.scored < 100


def test_long_texts_and_large_numbers(spark):
    docs = [(1, "a b " * 700_000), (2, "a " * 10), (3, "b")]
    assert searched(spark, spark.createDataFrame(docs, "doc_id bigint, text string"), [(1, "a b")]) == brute_force(docs, [(1, "a b")])
    wide = R.term_scores(np.array([5]), np.array([10**9]), np.array([3]), 10**10, 10**15)
    assert wide.tolist() == [3 * (10**9 * 5 // (5000 + 8 * (10 + 90 * 10**9 * 10**10 // 10**15)))]
