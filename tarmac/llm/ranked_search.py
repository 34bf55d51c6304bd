"""Ranked lexical search: exact best documents per item, by geometric blocks of posting lists.

Documents are dealt into shards as they lie in the files. In a shard, the posting list of every term that an
item has is cut into blocks of similar documents: a sketch of each document (its term scores under random signs)
is compared with the sketches of evenly spaced members of the list, and joins the nearest one's block. A block stores
the largest score of each term over its documents. Summed over an item's terms, these maxima bound the score of every
document of the block. For each item and term, blocks are taken by falling bound; a block is left out only if its bound shows that no
document of it can be among the item's best, ties included. Documents of the other blocks are scored in full.

Score of a document for an item: sum over the item's different terms of ``w * ((10**9 * tf) div (1000 * tf + 8 * m))``, with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 10 + (90 * n * N) div L``; N documents with a term, L terms in
all, n terms of the document, df documents with the term. All but the logarithm is integer, so results do not depend on order.

Scale: the items are a stated set and are taken in portions of about ``PORTION_CHARS`` characters and ``PORTION_ITEMS`` items, each of
which is broadcast and costs one pass over the texts. The pass stores the portion's terms of each document in the shared folder; df, N and L are
counted from that table. Searching reads it without a shuffle, one shard of at most ``SHARD_DOCS`` documents (or the one batch that exceeds
``SHARD_ENTRIES`` entries) in memory and one posting list's blocks at a time; only the best of each task are shuffled. A hot term has a posting list in every shard.

Rows: a null text has no terms and is not counted in N. Every row is a document, repeated rows and ids too; null ids rank last among equal
scores. Items of equal id and text are one item; those of equal id and different texts are answered separately. An item without terms, or whose terms
occur nowhere, has no rows; nor has any if a table is empty. Ids of documents are integers. Long texts are split in pieces, at gaps. Other
columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.llm.rows import text_of
from tarmac.session import stored

TOP = 10
#: expected size of a portion of items, a quarter of which is aimed at
PORTION_CHARS, PORTION_ITEMS = 1 << 22, 4096
#: size of a shard; longest list that is one block; numbers of a sketch
SHARD_DOCS, SHARD_ENTRIES, BLOCK, SKETCH = 8192, 1 << 20, 32, 16
#: bytes of text looked at in one piece
PIECE = 1 << 22

#: ASCII letters in lower case and digits stay, as do all bytes of other characters; the rest are gaps
_KEPT = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_NO_ID = (1 << 63) - 1
_LOWEST = -(1 << 63)


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_KEPT).split()


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time."""
    at = 0
    while len(raw) - at > PIECE:
        end = at + PIECE
        while end < len(raw) and _KEPT[raw[end]] != 32:
            end += 1
        yield terms_of(raw[at:end])
        at = end
    yield terms_of(raw[at:] if at else raw)


class Portion:
    """Some items: their numbers in the portion, terms as numbers, and what terms share items."""

    def __init__(self, texts: list[str]):
        words = [sorted(set(terms_of(text.encode()))) for text in texts]
        self.vocabulary = {term: i for i, term in enumerate(sorted({t for found in words for t in found}))}
        self.items = [np.array([self.vocabulary[t] for t in found], np.int64) for found in words]
        self.having: list[list[int]] = [[] for _ in self.vocabulary]
        for i, terms in enumerate(self.items):
            for t in terms:
                self.having[t].append(i)

    def beside(self, term: int) -> np.ndarray:
        """All terms of the items that have a term."""
        return np.unique(np.concatenate([self.items[i] for i in self.having[term]]))


def _portions(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, Portion]]:
    """Items dealt by hash into portions of bounded expected size, one at a time on the driver, with their ids."""
    kept = items.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).where("text is not null").distinct()
    n_items, chars = kept.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n = max(1, -(-4 * chars // PORTION_CHARS), -(-4 * n_items // PORTION_ITEMS))
    for part in range(n):
        rows = kept.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == part).orderBy("id", "text").collect()
        if rows:
            yield [r["id"] for r in rows], Portion([r["text"] for r in rows])


def _counted(docs: DataFrame, portion: Portion) -> DataFrame:
    """``id``, ``n`` (terms with repeats), and the portion's ``terms`` with their counts ``tf``, of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(portion.vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pickle.loads(shared.value)
        for batch in batches:
            sizes, lengths, terms, counts = [], [0], [], []
            for cell in batch.column(1).cast(pa.binary()):
                n, found = 0, []
                for words in _pieces(cell.as_py() or b""):
                    n += len(words)
                    found += [t for w in words if (t := vocabulary.get(w)) is not None]
                own, tf = np.unique(np.array(found, np.int32), return_counts=True)
                sizes.append(n)
                terms.append(own)
                counts.append(tf)
                lengths.append(lengths[-1] + len(own))
            flat = [np.concatenate(x) if x else np.zeros(0, int) for x in (terms, counts)]
            ends = pa.array(lengths, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(t))) for v, t in zip(flat, (np.int32, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "tf"])

    return docs.mapInArrow(run, "id bigint, n bigint, terms array<int>, tf array<bigint>")


class Shard:
    """Some documents: ids, and for each the portion's terms it has with their scores, ascending."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, terms: np.ndarray, scores: np.ndarray, signs: np.ndarray):
        self.keys, self.sizes, self.terms, self.scores = keys, sizes, terms, scores
        self.starts = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(scores.astype(np.float32)[:, None] * signs[terms], self.starts, axis=0)
        self.sketches = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-30)
        order = np.argsort(terms, kind="stable")
        self.posted = np.repeat(np.arange(len(keys)), sizes)[order]
        self.listed, self.list_starts = np.unique(terms[order], return_index=True)
        self.list_ends = np.append(self.list_starts[1:], len(terms))

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries of some documents are, and where each document's begin among them."""
        sizes = self.sizes[docs]
        starts = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.starts[docs] - starts, sizes), starts

    def blocks(self, docs: np.ndarray) -> np.ndarray:
        """The block of each document of a list: that of the most similar of evenly spaced members."""
        if len(docs) <= BLOCK:
            return np.zeros(len(docs), np.int64)
        heads = docs[np.linspace(0, len(docs) - 1, math.isqrt(len(docs))).astype(int)]
        return np.unique(np.argmax(self.sketches[docs] @ self.sketches[heads].T, axis=1), return_inverse=True)[1]


class Best:
    """The best documents of every item of a portion so far: by falling score, then rising id."""

    def __init__(self, portion: Portion, weights: np.ndarray, top: int):
        self.portion, self.weights = portion, weights
        self.scores = np.zeros((len(portion.items), top), np.int64)
        self.keys = np.full((len(portion.items), top), _LOWEST, np.int64)
        self.scored = self.skipped = 0

    def may_enter(self, item: int, scores: np.ndarray, keys: np.ndarray) -> np.ndarray:
        least, last = self.scores[item, -1], self.keys[item, -1]
        return (scores > least) | ((scores == least) & (keys < last))

    def enter(self, item: int, scores: np.ndarray, keys: np.ndarray) -> None:
        inside = self.may_enter(item, scores, keys)
        if not inside.any():
            return
        scores, keys = np.append(self.scores[item], scores[inside]), np.append(self.keys[item], keys[inside])
        order = np.lexsort((keys, -scores))[: self.scores.shape[1]]
        self.scores[item], self.keys[item] = scores[order], keys[order]

    def search(self, shard: Shard) -> None:
        """Takes the documents of a shard in, one posting list at a time, rarest terms first."""
        seen = np.zeros((len(self.portion.items), len(shard.keys)), bool)
        column = np.full(len(self.weights), -1)
        own = np.zeros(len(self.weights), bool)
        for at in np.argsort(-self.weights[shard.listed], kind="stable"):
            term = int(shard.listed[at])
            docs = shard.posted[shard.list_starts[at] : shard.list_ends[at]]
            block = shard.blocks(docs)
            order = np.argsort(block, kind="stable")
            docs, block = docs[order], block[order]
            block_starts = np.flatnonzero(np.diff(block, prepend=-1))
            least_keys = np.minimum.reduceat(shard.keys[docs], block_starts)
            ends = np.append(block_starts[1:], len(docs))
            # the summaries: the largest score of each term that matters here, by block
            beside = self.portion.beside(term)
            column[beside] = np.arange(len(beside))
            where, _ = shard.entries(docs)
            columns = column[shard.terms[where]]
            rows = np.repeat(block, shard.sizes[docs])
            matters = columns >= 0
            summary = np.zeros(len(block_starts) * len(beside), np.int64)
            np.maximum.at(summary, rows[matters] * len(beside) + columns[matters], shard.scores[where[matters]])
            summary = summary.reshape(len(block_starts), len(beside))
            for item in self.portion.having[term]:
                terms = self.portion.items[item]
                bounds = summary[:, column[terms]].sum(1)
                left = np.argsort(-bounds, kind="stable")
                own[terms] = True
                step = 1
                while len(left := left[self.may_enter(item, bounds[left], least_keys[left])]):
                    now, left, step = left[:step], left[step:], 2 * step
                    some = np.concatenate([docs[block_starts[b] : ends[b]] for b in now])
                    some = some[~seen[item, some]]
                    if not len(some):
                        continue
                    seen[item, some] = True
                    where, starts = shard.entries(some)
                    found = np.add.reduceat(np.where(own[shard.terms[where]], shard.scores[where], 0), starts)
                    self.enter(item, found, shard.keys[some])
                    self.scored += len(some)
                own[terms] = False
            column[beside] = -1

    def rows(self) -> pa.RecordBatch:
        item, place = np.nonzero(self.scores > 0)
        keys = self.keys[item, place]
        columns = [pa.array(item.astype(np.int32)), pa.array(keys, mask=keys == _NO_ID), pa.array(self.scores[item, place])]
        return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])


def term_scores(tf: np.ndarray, n: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The score of every entry; ``n`` and ``weights`` are those of its document and term."""
    wide = n.astype(object) if 90 * n_docs * int(n.max(initial=0)) >= 1 << 63 else n
    m = 10 + (90 * wide * n_docs // n_terms).astype(np.int64)
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int, signs: np.ndarray) -> Iterator[Shard]:
    """Documents with a term of the portion, in shards."""
    for batch in batches:
        keys = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        n = batch.column(1).to_numpy(zero_copy_only=False)
        sizes = batch.column(2).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        terms, tf = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
        values = term_scores(tf, np.repeat(n, sizes), weights[terms], n_docs, n_terms)
        has = sizes > 0
        keys, sizes = keys[has], sizes[has]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(keys):
            before = ends[at] - sizes[at]
            stop = min(at + SHARD_DOCS, max(at + 1, int(np.searchsorted(ends, before + SHARD_ENTRIES, "right"))))
            part = slice(int(before), int(ends[stop - 1]))
            yield Shard(keys[at:stop], sizes[at:stop], terms[part], values[part], signs)
            at = stop


def _best(counted: DataFrame, portion: Portion, top: int) -> DataFrame | None:
    """``item`` (its number), ``doc_id`` and ``score`` of the best documents of every task."""
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(portion.vocabulary))
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # bounded by the portion's terms
        df[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(k) + 1))) for k in df], np.int64)
    shared = counted.sparkSession.sparkContext.broadcast(pickle.dumps((portion, weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion, weights = pickle.loads(shared.value)
        signs = np.random.default_rng(0).choice(np.array([-1, 1], np.float32), (len(weights), SKETCH))
        best = Best(portion, weights, top)
        for shard in shards(batches, weights, n_docs, n_terms, signs):
            best.search(shard)
        yield best.rows()

    return counted.mapInArrow(run, "item int, doc_id bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``top`` documents of every item."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    id_type = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    for ids, portion in _portions(items, item_id, item_text):
        found = _best(stored(_counted(texts, portion), "posted-terms"), portion, top)
        if found is None:
            continue
        place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        ranked = found.withColumn("rank", place).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {id_type}")
        out = out.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out.withColumnsRenamed({"item_id": item_id, "doc_id": id_col})
