"""Quality of texts by votes of their nearest labelled neighbours in a latent-semantic space.

Terms of a text, hashed into buckets: its words; its shape (the classes of its characters, runs of letters as one) in n-grams of up to ``MAX_SHAPE``;
and marks for repetition (words equal to the one before, words and lines seen before) and for its length. Each of the three kinds of term is weighted by the square root of its share
and by inverse document frequency and scaled to length one, so that none drowns the others. The latent space is that of the ``LATENT`` strongest singular vectors of the labelled texts' term
vectors. Labelled vectors, at length one, are broadcast; every text is projected, its cosines to all of them are computed exactly,
block by block, and the ``NEIGHBOURS`` nearest vote with their label, weighted by a power of their cosine and by the number of labelled texts that
each stands for, so that a smaller share of the commoner label in the sample does not shift the score. The score is the weighted mean.

Training uses at most ``TRAIN_DOCS`` different texts of each label (chosen by the smallest hashes of the text; copies of a text count once, with the mean of their labels), so the
fit, which runs in one task, and the broadcast (``2 * TRAIN_DOCS * LATENT`` floats) do not grow with the corpus. Document frequencies are counted over all
documents. Labels meet documents by id and hash of the text only; of the texts, those chosen move. Two passes over the texts, and none of them is shuffled.

Rows: a null or empty text has the score of a text that resembles nothing, the share of label 1 among the labelled texts; so has every text if
there are no usable labels of two kinds (1/2 without any). Labels other than 0 and 1, null ids and texts without a label are not learned from. Several labels of one
id are averaged. Repeated rows are scored alike. Texts of any length are read whole, in pieces. Other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.rows import text_of
from tarmac.session import stored

#: different texts of each label in the training sample, at most
TRAIN_DOCS = 2000
#: buckets of words and of shapes, longest shape
WORDS, SHAPES, MAX_SHAPE = 1 << 12, 1 << 12, 4
#: dimensions of the latent space; neighbours that vote; power of the cosine that weights a vote
LATENT, NEIGHBOURS, POWER = 48, 15, 8
#: texts whose cosines are computed at once; bytes of a text looked at in one piece
BLOCK, PIECE = 512, 1 << 20

#: marks: repetition in steps of a tenth (neighbouring words, words, lines), and length in powers of two
_STEPS = 11
MARKS = 3 * _STEPS + 32
DIM = WORDS + SHAPES + MARKS

#: letters of either case, digits, white space, line ends; other bytes stand for themselves
_CLASS = bytes(97 if b >= 128 or 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 10 if b == 10 else 32 if b <= 32 else b for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _shapes(raw: bytes) -> np.ndarray:
    """Counts of shape n-grams by bucket."""
    counts = np.zeros(SHAPES)
    tail = np.zeros(0, np.uint8)
    for at in range(0, max(1, len(raw)), PIECE):
        data = np.frombuffer(raw[at : at + PIECE].translate(_CLASS), np.uint8)
        run = np.diff(np.append(tail[-1:] if len(tail) else np.uint8([255]), data).astype(int)) == 0
        data = data[~(run & ((data == 97) | (data == 65) | (data == 48)))]
        part = np.append(tail, data).astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(MAX_SHAPE):
            # grams that end in this piece
            code = code[:-1] * np.uint32(257) + part[n:] if n else part + np.uint32(1)
            new = code[max(0, len(tail) - n) :]
            counts += np.bincount((new * np.uint32(2654435761) + np.uint32(n * 97)) >> np.uint32(32 - SHAPES.bit_length() + 1), minlength=SHAPES)
            if len(code) < 2:
                break
        tail = np.append(tail, data)[-(MAX_SHAPE - 1) :].astype(np.uint8)
    return counts


def terms(raw: bytes) -> np.ndarray:
    """Weights of all terms of a text before document frequencies, square roots of shares; all zero for a text without words."""
    out = np.zeros(DIM, np.float32)
    words = raw.split()
    if not words:
        return out
    n = len(words)
    buckets = np.fromiter((zlib.crc32(w.translate(_LOWER)) for w in words), np.uint32, n)
    out[:WORDS] = np.sqrt(np.bincount(buckets & np.uint32(WORDS - 1), minlength=WORDS) / n)
    shapes = _shapes(raw)
    out[WORDS : WORDS + SHAPES] = np.sqrt(shapes / shapes.sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = [np.count_nonzero(buckets[1:] == buckets[:-1]) / n, 1 - len(set(words)) / n, 1 - len(set(lines)) / len(lines)]
    for i, share in enumerate(repeated):
        place = share * (_STEPS - 1)
        low = min(int(place), _STEPS - 2)
        at = WORDS + SHAPES + i * _STEPS + low
        out[at : at + 2] = low + 1 - place, place - low
    out[WORDS + SHAPES + 3 * _STEPS + min(n.bit_length(), 31)] = 0.5
    return out


def packed(x: np.ndarray) -> bytes:
    """A text's term weights without the zeros, which are most of them."""
    has = np.flatnonzero(x).astype(np.uint16)
    return has.tobytes() + x[has].tobytes()


def unpacked(cells: pd.Series) -> np.ndarray:
    """Rows of term weights."""
    out = np.zeros((len(cells), DIM), np.float32)
    for row, cell in zip(out, cells):
        n = len(cell) // 6
        row[np.frombuffer(cell, np.uint16, n)] = np.frombuffer(cell[2 * n :], np.float32)
    return out


def weighted(x: np.ndarray, idf: np.ndarray, into: np.ndarray | None = None) -> np.ndarray:
    """Rows of term weights times inverse document frequency, each kind of term at length one; in place of ``x`` if that is ``into``."""
    x = np.multiply(x, idf, out=into)
    for part in (slice(WORDS), slice(WORDS, WORDS + SHAPES), slice(WORDS + SHAPES, DIM)):
        x[:, part] /= np.maximum(np.linalg.norm(x[:, part], axis=1, keepdims=True), 1e-12)
    return x


class Model:
    """Document frequencies, latent space, and labelled vectors in it; ``x`` is overwritten, as it is the largest of what one task holds."""

    def __init__(self, idf: np.ndarray, x: np.ndarray, labels: np.ndarray, votes: np.ndarray | None = None):
        self.idf, self.labels = idf, labels.astype(np.float32)
        self.votes = np.ones(len(labels)) if votes is None else votes
        self.prior = float((labels * self.votes).sum() / self.votes.sum()) if len(labels) else 0.5
        x = weighted(x, idf, into=x)
        # right singular vectors by way of the smaller square matrix
        values, left = np.linalg.eigh((x @ x.T).astype(float))
        strong = np.argsort(-values)[:LATENT]
        strong = strong[values[strong] > 1e-9]
        self.basis = (x.T @ (left[:, strong] / np.sqrt(values[strong]))).astype(np.float32)
        self.vectors = self._latent(x)

    def _latent(self, x: np.ndarray) -> np.ndarray:
        y = x @ self.basis
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def scores(self, x: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The weighted vote for each row of term weights."""
        out = np.full(len(x), self.prior)
        has = x.any(axis=1)
        if not len(self.labels) or not has.any():
            return out
        cosines = self._latent(weighted(x[has], self.idf)) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, 1), 0, 1).astype(float) ** POWER * self.votes[near]
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-300)
        out[has] = np.where(total > 1e-12, vote, self.prior)
        return np.clip(out, 0, 1)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept out of training: crc32 of its id as text, modulo 3, is one; false for null ids."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents with a word, and those that have each term; ``text`` is the only column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIM, np.int64)
        for batch in batches:
            for cell in batch.column(0).cast(pa.binary()):
                x = terms(cell.as_py() or b"")
                df += x > 0
                n += bool(x.any())
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(has, -1).astype(np.int32)), pa.array(np.append(df[has], n))], names=["term", "n"])

    found = texts.mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row per bucket
    counts = {row["term"]: row["n"] for row in found}
    return counts.get(-1, 0), np.array([counts.get(i, 0) for i in range(DIM)], float)


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = TRAIN_DOCS
) -> Model:
    """Learns from rows of ``docs`` that are not held out and have a label of their id in ``labels``."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"), held_out(id_col).alias("out"))
    n, df = document_frequencies(texts.select("text"))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.1)
    label = F.col(f"`{label_col}`").cast("double")
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), label.alias("label")).where("id is not null and label in (0, 1)").groupBy("id").agg(F.avg("label").alias("label"))
    usable = texts.where("not out and id is not null and text is not null").withColumn("key", F.xxhash64("text"))
    known = usable.select("id", "key").distinct().join(marked, "id").groupBy("key").agg(F.avg("label").alias("label"))
    spark = docs.sparkSession
    known = stored(known.withColumn("good", F.col("label") >= 0.5), "labelled-texts")
    sizes = {row["good"]: row["count"] for row in known.groupBy("good").count().collect()}
    # of each label the smallest hashes; each stands for as many texts as it was chosen from
    chosen = {good: known.where(F.col("good") == good).orderBy(F.xxhash64("key", F.lit("sample")), "key").limit(sample).collect() for good in sizes}
    votes = {good: sizes[good] / len(rows) for good, rows in chosen.items()}
    chosen = {row["key"]: row["label"] for rows in chosen.values() for row in rows}
    if len(sizes) < 2:
        model = Model(idf, np.zeros((0, DIM), np.float32), np.zeros(0))
        model.prior = float(np.mean(list(chosen.values()))) if chosen else 0.5
        return model
    wanted = F.broadcast(spark.createDataFrame(list(chosen.items()), "key bigint, label double"))  # 2 * sample rows

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [packed(terms(cell.as_py())) for cell in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())], names=["key", "label", "x"])

    picked = usable.select("key", "text").join(wanted, "key").select("key", "text", "label").mapInArrow(vector, "key bigint, label double, x binary").dropDuplicates(["key"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        x = unpacked(rows["x"])
        return pd.DataFrame({"model": [pickle.dumps(Model(idf, x, y := rows["label"].to_numpy(), np.array([votes[v >= 0.5] for v in y])))]})

    fitted = picked.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "model binary").first()
    return pickle.loads(bytes(fitted["model"]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``id_col``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kept = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.zeros(batch.num_rows)
            for at in range(0, batch.num_rows, BLOCK):
                found[at : at + BLOCK] = model.scores(np.stack([terms(cell.as_py() or b"") for cell in texts.slice(at, BLOCK)]), neighbours)
            columns = [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "predicted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(run, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)
