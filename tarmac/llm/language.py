"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. One binary classifier per bit (logistic
regression over byte n-grams, in numpy) separates the languages with +1 there from those
with -1. A text's language is the one whose codeword has the least loss under the bits'
outputs, each bit weighted by its share of right answers in training. If the two
least losses are close, the text is ambiguous.

Features: the text in lower case, every run of bytes that spell no letter as one space, all n-grams of
one to ``MAX_GRAM`` bytes of the whole text, counted in ``DIM`` hash buckets; square roots of their
shares, so that a text's length does not matter.

Training uses a bounded sample (at most ``TRAIN_DOCS`` different labelled texts, spread evenly over languages, whole
texts, chosen by a hash of the text); it runs in one task, which the bound keeps small. Prediction is
one pass over all texts without a shuffle.

Rows: a null text, or one without a letter, is ``und`` with score 0 and not ambiguous. Rows whose label or text is
null, or without letters, are not learned from. Without any labelled row everything is ``und``; with one
language alone everything with a letter is that language. Repeated rows are predicted alike. Other columns are
ignored by ``predict``, and kept by ``keep_known``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.rows import text_of, wrapped

#: different texts of the training sample, at most
TRAIN_DOCS = 3000
#: longest n-gram in bytes, hash buckets
MAX_GRAM, DIM = 3, 1 << 13
#: passes of training, its step, its penalty on weights
EPOCHS, STEP, PENALTY = 60, 0.5, 1e-5
#: difference of the two least losses, per bit, below which a text is ambiguous
MARGIN = 0.05
UNKNOWN = "und"

_letter = regex.compile(r"\p{L}").search
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 or 65 <= b <= 90 else 32 for b in range(256))


def features(text: str | None) -> np.ndarray | None:
    """The feature vector of a text; None without a letter."""
    if not text or not _letter(text):
        return None
    raw = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    data = np.frombuffer(raw, np.uint8)
    counts = np.zeros(DIM)
    # n-gram codes as overflowing products, piecewise, so that a long text needs no more memory than its own size
    for at in range(0, len(data), 1 << 20):
        part = data[at : at + (1 << 20) + MAX_GRAM - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(MAX_GRAM):
            code = (code[: len(part) - n] * np.uint32(257) + part[n:]) if n else part + np.uint32(1)
            inside = code[: 1 << 20]
            counts += np.bincount((inside * np.uint32(2654435761)) >> np.uint32(32 - DIM.bit_length() + 1), minlength=DIM)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """One row of +1 and -1 per class: all different splits for up to 6 classes, else the best of some random codes."""
    if classes < 2:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = np.arange(1, 1 << (classes - 1))
        bits = (splits[None, :] >> np.arange(classes)[:, None]) & 1
        return 2.0 * bits - 1
    rng, width = np.random.default_rng(0), int(np.ceil(10 * np.log2(classes)))
    best, least = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (classes, width))
        code = code[:, np.abs(code.sum(0)) < classes]
        apart = (code.shape[1] - code @ code.T) / 2 + np.eye(classes) * code.shape[1]
        if apart.min() > least:
            best, least = code, apart.min()
    return best


class Model:
    """Languages, codewords, weights (bits by features), biases and bit weights. Fitting overwrites ``x``."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        #: texts learned from, by language
        self.seen = {k: int((y == i).sum()) for i, k in enumerate(languages)}
        bits = self.code.shape[1]
        self.weights, self.bias = np.zeros((bits, DIM), np.float32), np.zeros(bits, np.float32)
        target = self.code[y].astype(np.float32)
        share = np.bincount(y, minlength=len(languages)) / max(1, len(y))
        each = (1 / np.maximum(share[y], 1e-9) / len(languages) / max(1, len(y))).astype(np.float32)
        # full-batch AdaGrad: texts weigh the same in sum for every language; x is standardised in place, as it is the largest array here
        self.center = (each @ x).astype(np.float32) if len(x) else np.zeros(DIM, np.float32)
        x -= self.center
        spread = np.zeros(DIM, np.float32)
        for at in range(0, len(x), 256):
            spread += each[at : at + 256] @ np.square(x[at : at + 256])
        self.scale = np.sqrt(spread + 1e-6).astype(np.float32) if len(x) else np.ones(DIM, np.float32)
        x /= self.scale * np.sqrt(np.float32(DIM))
        z = x
        seen = np.full(self.weights.shape, 1e-8, np.float32)
        for _ in range(EPOCHS if len(languages) > 1 else 0):
            output = z @ self.weights.T + self.bias
            slope = -target / (1 + np.exp(np.clip(target * output, -30, 30))) * each[:, None]
            grad = slope.T @ z + PENALTY * self.weights
            seen += grad * grad
            self.weights -= STEP * grad / np.sqrt(seen)
            self.bias -= STEP * slope.sum(0)
        right = ((z @ self.weights.T + self.bias) * target > 0).astype(np.float32)
        self.trust = np.clip(each @ right, 0.5, 1).astype(np.float64) if len(x) else np.ones(bits)

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Mean weighted logistic loss per text and language."""
        output = ((x - self.center) / self.scale / np.sqrt(np.float32(DIM))) @ self.weights.T + self.bias
        each = np.logaddexp(0, -output[:, None, :].astype(float) * self.code[None])
        return (each * self.trust).sum(2) / self.trust.sum()

    def decide(self, x: np.ndarray, margin: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Nearest codeword's language, its score (share of exp(-loss of all bits)), and ambiguity."""
        loss = self.losses(x)
        order = np.argsort(loss, axis=1, kind="stable")
        weight = np.exp(-(loss - loss.min(1, keepdims=True)) * self.code.shape[1])
        score = weight.max(1) / weight.sum(1)
        rows = np.arange(len(x))
        second = loss[rows, order[:, min(1, loss.shape[1] - 1)]]
        ambiguous = (second - loss[rows, order[:, 0]] < margin) & (len(self.languages) > 1)
        return [self.languages[i] for i in order[:, 0]], score, ambiguous


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", docs: int = TRAIN_DOCS) -> Model:
    """Fits a model on at most ``docs`` different labelled texts."""
    usable = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label")).where("text is not null and label is not null")
    sizes = {r["label"]: r["count"] for r in usable.select("label", F.xxhash64("text").alias("key")).distinct().groupBy("label").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros(0, int))
    share = docs / len(languages)
    quota = F.element_at(F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, share / sizes[k]))]), F.col("label"))
    place = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    # copies meet on the map side; the quotas leave about as many as the limit takes
    sample = usable.where(place < quota).distinct().orderBy(place / quota, "label", "text").limit(docs)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "text"])
        x, y = np.zeros((len(rows), DIM), np.float32), []
        for text, label in zip(rows["text"], rows["label"]):
            if (found := features(text)) is not None:
                x[len(y)] = found
                y.append(languages.index(label))
        model = Model(languages, x[: len(y)], np.array(y, int))
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "model binary").first()
    return pickle.loads(bytes(fitted[0])) if fitted else Model(languages, np.zeros((0, DIM), np.float32), np.zeros(0, int))


def _predicted(docs: DataFrame, model: Model, margin: float) -> DataFrame:
    """``docs``, the last column of which is the text, with ``lang_pred``, ``score`` and ``ambiguous`` in its place."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    state: dict[str, Model] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "model" not in state:
            state["model"] = pickle.loads(shared.value)
        model = state["model"]
        for batch in batches:
            n = batch.num_rows
            label, score, unsure = [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
            texts = batch.columns[-1]
            for at in range(0, n if model.languages else 0, 512):
                found = [(at + i, f) for i, cell in enumerate(texts.slice(at, 512)) if (f := features(cell.as_py())) is not None]
                if not found:
                    continue
                rows = np.array([i for i, _ in found])
                said, score[rows], unsure[rows] = model.decide(np.stack([f for _, f in found]), margin)
                for i, language in zip(rows.tolist(), said):
                    label[i] = language
            new = [pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"])

    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields[:-1], *new]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``id_col``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` of every row."""
    kept = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    return _predicted(kept, model, margin).withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` without rows that have no language or an ambiguous one."""
    said = _predicted(wrapped(docs, text=text_of(text_col)), model, margin)
    return said.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select("doc.*")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept out of training: crc32 of its id as text, modulo ``folds``, is zero; false for null ids."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))
