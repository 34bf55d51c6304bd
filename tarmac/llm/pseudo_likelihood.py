"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides.

Tokens are words (as in ``decontaminate``). From the two tokens before and the two after a place, and not
its own, the network (in numpy) computes a hidden layer and the probabilities of ``CLASSES`` classes of tokens. A
token's probability is its class's times the word's own share of the class in the whole corpus. A document's score is the
sum of the log probabilities of all its tokens. Words are hashed into ``BUCKETS`` only to say which embedding and which class
they have; every word has its own count, so no word gets the probability of another.

1. Counts of all words over all documents, summed within tasks before they are shuffled. Buckets in order
   of frequency are cut into classes of equal mass. A word that the corpus lacks shares half a count with all such words of its bucket.
2. Training: all different texts (``SHARE`` = 1; a larger one trains on those whose hash falls in one of so many parts). They are dealt by
   hash to trainers of about ``TRAINER_BYTES`` each, and taken apart once, into the counts and the buckets that all rounds read. Every trainer starts a
   round from the common weights and goes through all its tokens, in shuffled runs of ``RUN`` places, and the results are averaged in
   groups of ``AVERAGED`` until one is left. Weights depend neither on the number of cores nor on the order of rows.
3. Scoring: one pass over all documents, in pieces of bounded size, so a long text needs no more memory. Counts of
   the most frequent words, ``FREQUENT`` at most, are broadcast. Where the corpus has more, the other words of each document, none of which
   is frequent, are joined with their counts, and sums by row joined with the rows; texts are not shuffled.

Rows: a null text, or one without words, has no tokens, score 0 and no mean. Repeated rows are scored alike and count once in
training, but as often as they occur in the counts. Without any training text the class shares alone score. Empty tables give empty tables. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from hashlib import md5
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.decontaminate import _KEPT, words_of
from tarmac.session import stored

#: hash buckets of words (a power of two), classes, width of the hidden layer, tokens to each side
BUCKETS, CLASSES, WIDTH, SIDE = 1 << 14, 256, 32, 2
#: places in a row that are trained on together; weights without rows of their own for each id
RUN, DENSE = 16, ("out", "bias", "hidden", "scale")
#: one of so many texts is trained on (1: every text); bytes of text per trainer; trainers averaged at once; rounds
SHARE, TRAINER_BYTES, AVERAGED, ROUNDS = 1, 4 << 20, 16, 2
BATCH, STEP = 1024, 0.15
#: places scored at once, pads between them included
PIECE = 2048
#: words whose counts are broadcast at most, bytes of a word that stands for itself, bytes of text taken apart at once (or one text), and scored at once
FREQUENT, KEY_BYTES, PORTION, SCORED = 1 << 17, 32, 1 << 23, 1 << 21


def token_ids(text: bytes | None) -> np.ndarray:
    return _buckets(words_of(text))


def _buckets(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.int64, len(words)) & (BUCKETS - 1)


def portions(texts: pa.Array, most: int) -> Iterator[slice]:
    """Slices of at most so many bytes of text, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = read = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, read + most, "right")))
        yield slice(start, stop)
        start, read = stop, int(ends[stop - 1])


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words (``words_of``) of texts, which of them each word is, one text after the other, and how many each text has.

    Arrow tells the words apart, so that none becomes Python's here.
    """
    cells = pa.concat_arrays([pc.fill_null(texts.cast(pa.binary()), b"")])
    places = np.frombuffer(cells.buffers()[1] or bytes(4), np.int32)[cells.offset : cells.offset + len(cells) + 1] if len(cells) else np.zeros(1, np.int32)
    data = np.frombuffer(memoryview(cells.buffers()[2] or b"")[places[0] : places[-1]].tobytes().translate(_KEPT), np.uint8)
    places = places - places[0]
    inside = data != ord(" ")
    # a word begins after a space or at the beginning of a text, and ends before a space or at the end of a text
    begins, goes_on = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    goes_on[:-1] &= inside[1:]
    goes_on[-1:] = False
    edges = places[1:-1][(places[1:-1] > 0) & (places[1:-1] < len(data))]
    begins[edges] = inside[edges]
    goes_on[edges - 1] = False
    first = np.flatnonzero(begins)
    length = np.flatnonzero(inside & ~goes_on) + 1 - first
    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.compress(inside, data))]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.diff(np.searchsorted(first, places))


def counted(words: pa.Array, number: np.ndarray, copies: np.ndarray | None = None) -> tuple[np.ndarray, list[pa.Array]]:
    """The buckets of different words, and their keys, buckets and counts, where the words in a place have so many copies."""
    buckets = _buckets(words.to_numpy(zero_copy_only=False).tolist())
    often = np.bincount(number, copies, len(words)).astype(np.int64)
    return buckets, [_keys(words), pa.array(buckets), pa.array(often)]


def _key(word: bytes) -> bytes:
    """The word itself, or its digest if it is long; 0xff occurs in no text."""
    return word if len(word) <= KEY_BYTES else b"\xff" + md5(word).digest()


def _keys(words: pa.Array) -> pa.Array:
    long = pc.greater(pc.binary_length(words), KEY_BYTES)
    digests = pa.array([_key(w.as_py()) for w in words.filter(long)], pa.binary())
    return pc.replace_with_mask(words, long, digests) if len(digests) else words


def joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids with ``SIDE`` pads (``BUCKETS``) before, between and after documents, and the places of real tokens."""
    pad = np.full(SIDE, BUCKETS, np.int64)
    ids = np.concatenate([pad, *(x for doc in docs for x in (doc, pad))])
    return ids, np.flatnonzero(ids != BUCKETS)


class Network:
    """Embeddings, a scale per place of the window, hidden bias, output weights and bias.

    ``words`` is the table of word counts (``word_counts``) behind the counts of buckets; it stays with the driver.
    """

    words: DataFrame | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "words"}

    def __init__(self, counts: np.ndarray):
        rng = np.random.default_rng(0)
        order = np.lexsort((np.arange(BUCKETS), -counts))
        smooth = counts[order] + 0.5
        self.class_of = np.zeros(BUCKETS, np.int64)
        ahead = (np.cumsum(smooth) - smooth) / smooth.sum()
        self.class_of[order] = np.minimum((ahead * CLASSES).astype(np.int64), CLASSES - 1)
        mass = np.bincount(self.class_of, counts + 0.5, CLASSES)
        self.inside = np.log((counts + 0.5) / mass[self.class_of])
        self.log_counts = np.log(counts + 0.5)
        self.weights = {
            "embed": np.concatenate([rng.normal(0, 0.3, (BUCKETS, WIDTH)), np.zeros((1, WIDTH))]).astype(np.float32),
            "scale": np.ones((2 * SIDE, WIDTH), np.float32), "hidden": np.zeros(WIDTH, np.float32),
            "out": np.zeros((WIDTH, CLASSES), np.float32),
            "bias": np.log(np.maximum(mass, 1e-3) / mass.sum()).astype(np.float32),
        }

    def _output(self) -> tuple[np.ndarray, bool]:
        """Output weights with the bias as the last row, and whether no logit can come near the limits of ``exp``, as |hidden| < 1."""
        joint = np.concatenate([self.weights["out"], self.weights["bias"][None]])
        return joint, _bounded(joint)

    def log_probabilities(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Of the tokens in ``places``, which ascend; a row of embeddings is read once for all windows of a piece that it is in."""
        w = self.weights
        joint, bounded = self._output()
        found = np.empty(len(places))
        near, sums, part = (np.empty((PIECE + more, WIDTH), np.float32) for more in (2 * SIDE, 0, 0))
        wide, hidden = np.empty((PIECE, CLASSES), np.float32), np.ones((PIECE, WIDTH + 1), np.float32)
        every, rows, scales = np.ones(CLASSES, np.float32), np.arange(PIECE), np.repeat(w["scale"][:, None], PIECE, 1)
        at = 0
        while at < len(places):
            low = places[at]
            end = int(np.searchsorted(places, low + PIECE))
            some = places[at:end] - low
            n, reach = len(some), some[-1] + 1
            seen = np.take(w["embed"], ids[low - SIDE : low + reach + SIDE], 0, out=near[: reach + 2 * SIDE], mode="clip")
            inner = np.multiply(seen[:reach], scales[0, :reach], out=sums[:reach])
            for k in range(1, 2 * SIDE):
                away = k + (k >= SIDE)
                inner += np.multiply(seen[away : away + reach], scales[k, :reach], out=part[:reach])
            inner = np.add(inner if n == reach else np.take(inner, some, 0), w["hidden"], out=hidden[:n, :WIDTH])
            np.tanh(inner, out=inner)
            logits = np.matmul(hidden[:n], joint, out=wide[:n])
            if not bounded:
                logits -= logits.max(1, keepdims=True)
            own = ids[places[at:end]]
            right = logits[rows[:n], self.class_of[own]]
            found[at:end] = right - np.log(np.exp(logits, out=logits) @ every) + self.inside[own]
            at = end
        return found

    def train(self, docs: list[np.ndarray], seed: int, batch: int = BATCH) -> int:
        """One pass of AdaGrad over all tokens in batches of shuffled runs of ``RUN`` places; returns their number.

        The windows of a run overlap, so its rows of embeddings are read, and their gradients summed, once for all its places.
        """
        ids, places = joined(docs)
        run = min(RUN, batch)
        runs = max(1, -(-(len(ids) - 2 * SIDE) // run))
        # 16 bits hold all ids, and numpy sorts those by radix
        padded = np.full(runs * run + 2 * SIDE, BUCKETS, np.uint16)
        padded[: len(ids)] = ids[: len(padded)]
        windows = np.lib.stride_tricks.sliding_window_view(padded, run + 2 * SIDE)[::run]
        windows = windows[np.random.default_rng(seed).permutation(runs)]
        class_of, taken = np.append(self.class_of, 0), np.unique(self.class_of)
        w = self.weights
        # all but the embeddings lie in one array and move at once
        dense = np.concatenate([w[k].ravel() for k in DENSE])
        w.update({k: part.reshape(w[k].shape) for k, part in zip(DENSE, np.split(dense, np.cumsum([w[k].size for k in DENSE])[:-1]))})
        memory, dense_memory = np.full(len(w["embed"]), 0.1, np.float32), np.full(len(dense), 0.1, np.float32)
        # memory that all batches share
        step = max(1, batch // run)
        most = step * run
        near, moved, room = (np.empty((most + 2 * SIDE * step, WIDTH), np.float32) for _ in range(3))
        inner, part, other = (np.empty((most, WIDTH), np.float32) for _ in range(3))
        wide, parts = np.empty((most, CLASSES), np.float32), np.empty((run, CLASSES, WIDTH), np.float32)
        every, ones, rows = np.ones(CLASSES, np.float32), np.ones(most, np.float32), np.arange(most)
        for at in range(0, runs, step):
            # the first place of all runs, then the second: what lies so many places away is then one slice for all of them
            window = windows[at : at + step].T.ravel()
            m = len(window) // (run + 2 * SIDE)
            n = m * run
            around = [slice(k * m, k * m + n) for k in range(2 * SIDE + 1) if k != SIDE]
            own = window[SIDE * m : SIDE * m + n]
            real = own != BUCKETS
            count = np.float32(max(1, np.count_nonzero(real)))
            scales = np.repeat(w["scale"][:, None], m, 1).reshape(2 * SIDE, m * WIDTH)
            seen = np.take(w["embed"], window, 0, out=near[: len(window)], mode="clip")
            hidden = _scaled(seen[around[0]], scales[0], inner[:n])
            for k in range(1, 2 * SIDE):
                hidden += _scaled(seen[around[k]], scales[k], part[:n])
            hidden += w["hidden"]
            np.tanh(hidden, out=hidden)
            slope = np.matmul(hidden, w["out"], out=wide[:n])
            # the bias is a factor of each class, unless a total over the factor of a token's class could exceed e^86, as |hidden| < 1
            if np.abs(w["out"]).sum(0).max() + max(w["bias"].max(), -w["bias"][taken].min()) < 40:
                lift = np.exp(w["bias"])
            else:
                lift = every
                slope += w["bias"]
                slope -= slope.max(1, keepdims=True)
            np.exp(slope, out=slope)
            # probabilities times their sum, without the factors; the small arrays beside them are divided and multiplied instead
            total, classes = slope @ lift, class_of[own]
            slope[rows[:n], classes] -= total / lift[classes]
            back = np.matmul(slope, (w["out"] * lift).T, out=part[:n])
            share = real / (total * count)
            shared = np.multiply(hidden, share[:, None], out=other[:n])
            # many small products and their sum: such a flat one is slower as a whole
            outer = np.matmul(slope.reshape(run, m, CLASSES).transpose(0, 2, 1), shared.reshape(run, m, WIDTH), out=parts).sum(0)
            grads = [(outer.T * lift).ravel(), (share @ slope) * lift]
            # (1 - hidden * hidden) * share
            shared *= hidden
            back *= np.subtract(share[:, None], shared, out=shared)
            grads += [ones[:n] @ back, *(ones[:n] @ np.multiply(seen[some], back, out=other[:n]) for some in around)]
            _scaled(back, scales[0], moved[:n])
            moved[n : len(window)] = 0
            for k in range(1, 2 * SIDE):
                moved[around[k]] += _scaled(back, scales[k], other[:n])
            grad = np.concatenate(grads)
            dense_memory += grad * grad
            dense -= STEP * grad / np.sqrt(dense_memory)
            to, sums = _summed(window, moved[: len(window)], room[: len(window)])
            # embeddings move by the sum over places, not the mean
            sums *= count
            kept = memory[to] + np.einsum("nw,nw->n", sums, sums) / np.float32(WIDTH)
            memory[to] = kept
            sums *= (np.float32(STEP) / np.sqrt(kept))[:, None]
            w["embed"][to] = np.subtract(np.take(w["embed"], to, 0), sums, out=sums)
        w.update({k: w[k].copy() for k in DENSE})
        return len(places)


def _scaled(rows: np.ndarray, scale: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Rows times a scale that is repeated for as many rows as it holds."""
    np.multiply(rows.reshape(-1, len(scale)), scale, out=out.reshape(-1, len(scale)))
    return out


def _bounded(joint: np.ndarray) -> bool:
    return bool(np.abs(joint).sum(0).max() < 60)


def _summed(ids: np.ndarray, rows: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids other than pads, each once, and the sums of their rows; ``room`` is as large as ``rows``."""
    order = np.argsort(ids, kind="stable")
    ordered = ids[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    # rows of ids that occur once are their own sums
    once = first & np.append(first[1:], True)
    again, alone = np.flatnonzero(~once & (ordered < BUCKETS)), np.flatnonzero(once & (ordered < BUCKETS))
    starts = np.flatnonzero(first[again])
    sorted_rows = np.take(rows, order[np.concatenate([again, alone])], 0, out=room[: len(again) + len(alone)], mode="clip")
    sums = sorted_rows[len(again) :]
    if len(again):
        # two floats make a complex number, which halves the number of columns
        sums = np.concatenate([np.add.reduceat(sorted_rows[: len(again)].view(np.complex64), starts).view(np.float32), sums])
    return np.concatenate([ordered[again[starts]], ordered[alone]]), sums


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (its key), ``bucket`` and ``n``: how often each word occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in portions(batch.column(0), PORTION):
                words, number, _ = words_in(batch.column(0)[rows])
                yield pa.RecordBatch.from_arrays(counted(words, number)[1], ["word", "bucket", "n"])

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word binary, bucket bigint, n bigint")
    return _added(parts)


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("word", "bucket").agg(F.sum("n").alias("n"))


def taken_apart(texts: DataFrame) -> DataFrame:
    """Of different texts with ``trainer``, ``learn`` and ``copies``: a row of ``ids`` (buckets, pads between texts) per trainer, and rows of ``word_counts``.

    The texts of a trainer lie together, in their order; ids are those of texts to ``learn`` from.
    """
    names = ["trainer", "ids", "word", "bucket", "n"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def row(columns: dict[int, pa.Array]) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[i] if i in columns else pa.nulls(n, kind) for i, kind in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.full(SIDE, BUCKETS, "<u2")
        now, ids = None, []
        for batch in batches:
            for rows in portions(batch.column(3), PORTION):
                trainers, learn, copies = (batch.column(i)[rows].to_pylist() for i in range(3))
                words, number, sizes = words_in(batch.column(3)[rows])
                often = None if set(copies) <= {1} else np.repeat(copies, sizes)
                buckets, columns = counted(words, number, often)
                yield row(dict(zip((2, 3, 4), columns)))
                found, end = np.take(buckets.astype("<u2"), number), 0
                for trainer, learned, size in zip(trainers, learn, sizes.tolist()):
                    if ids and trainer != now:
                        yield row({0: pa.array([now], pa.int64()), 1: pa.array([np.concatenate(ids).tobytes()], pa.binary())})
                        ids = []
                    now, end = trainer, end + size
                    if learned:
                        ids += [found[end - size : end], pad]
        if ids:
            yield row({0: pa.array([now], pa.int64()), 1: pa.array([np.concatenate(ids).tobytes()], pa.binary())})

    ordered = texts.repartition("trainer").sortWithinPartitions("trainer", "text").select("trainer", "learn", "copies", "text")
    return ordered.mapInArrow(run, "trainer bigint, ids binary, word binary, bucket bigint, n bigint")


def _by_bucket(words: DataFrame) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in words.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs in all documents; the driver gets one number per bucket."""
    return _by_bucket(word_counts(docs, text_col))


def frequent_words(words: DataFrame, most: int) -> tuple[dict[bytes, float], bool]:
    """Logs of the counts of the most frequent words, at most ``most``, and whether those are all words.

    Words are taken from a least count on, found from numbers of words by steps of their count's logarithm.
    """
    step = F.floor(F.log2("n") * 16).cast("long")
    steps = sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True)
    total, least = 0, None
    for at, n in steps:
        total += n
        if total > most:
            break
        least = at
    if least is None:
        return {}, not steps
    found = words.where(step >= least).select("word", "n").collect()
    return {bytes(word): float(np.log(n)) for word, n in found}, total <= most


def fit(docs: DataFrame, text_col: str = "text", share: int = SHARE, rounds: int = ROUNDS, trainer_bytes: int = TRAINER_BYTES, batch: int = BATCH) -> Network:
    """A network trained on one of ``share`` different texts, with the counts of all documents."""
    text = F.col(text_col).cast("string").alias("text")
    learn = F.pmod(F.xxhash64("text", F.lit("share")), F.lit(share)) == 0
    given = docs.select(text).where("text is not null")
    # texts are told apart by two hashes here: this is their size alone, and texts themselves needn't be stored for it
    marks = given.where(learn).select(F.xxhash64("text"), F.hash("text"), F.octet_length("text").alias("size")).distinct()
    size = marks.agg(F.sum("size")).first()[0] or 0
    trainers = max(1, -(-size // trainer_bytes))
    texts = given.groupBy("text").agg(F.count("*").alias("copies")).withColumn("learn", learn)
    dealt = texts.withColumn("trainer", F.pmod(F.xxhash64("text", F.lit("trainer")), F.lit(trainers)))
    apart = stored(taken_apart(dealt), "lm-apart")
    words = stored(_added(apart.where("word is not null").select("word", "bucket", "n")), "lm-words")
    network = Network(_by_bucket(words))
    network.words = words
    if not size:
        return network
    # a number of partitions of their own, as the work is far more than the bytes tell
    parts = min(trainers, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = apart.where("ids is not null").select("trainer", "ids").repartition(parts, "trainer")
    for round_ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(network))

        shape = "trainer bigint, tokens bigint, weights binary"
        found, left = dealt.groupBy("trainer").applyInPandas(trainer(shared, round_, batch), shape), trainers
        while left > 1:
            found = found.withColumn("trainer", F.floor(F.col("trainer") / AVERAGED)).groupBy("trainer").applyInPandas(averaged, shape)
            found, left = stored(found, "lm-weights"), -(-left // AVERAGED)
        network.weights = pickle.loads(bytes(found.first()["weights"]))
    return network


def trainer(shared, round_: int, batch: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What trains the broadcast network on the texts of one trainer."""

    def work(texts: pd.DataFrame) -> pd.DataFrame:
        own: Network = pickle.loads(shared.value)
        number = int(texts["trainer"].iloc[0])
        tokens = own.train([np.frombuffer(ids, "<u2") for ids in texts["ids"]], seed=1000 * number + round_, batch=batch)
        return pd.DataFrame({"trainer": [number], "tokens": [tokens], "weights": [pickle.dumps(own.weights)]})

    return work


def averaged(some: pd.DataFrame) -> pd.DataFrame:
    """The mean of up to ``AVERAGED`` weights by their tokens."""
    some = some.sort_values(["tokens", "weights"])
    total, n = None, 0
    for tokens, packed in zip(some["tokens"], some["weights"]):
        weights = pickle.loads(packed)
        scaled = {k: v.astype(np.float64) * tokens for k, v in weights.items()}
        total = scaled if total is None else {k: total[k] + v for k, v in scaled.items()}
        n += int(tokens)
    mean = {k: (v / max(1, n)).astype(np.float32) for k, v in total.items()} if n else pickle.loads(some["weights"].iloc[0])
    return pd.DataFrame({"trainer": [int(some["trainer"].iloc[0])], "tokens": [n], "weights": [pickle.dumps(mean)]})


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", most: int = FREQUENT) -> DataFrame:
    """``id_col``, ``n_tokens``, ``log_likelihood`` (sum over tokens) and ``mean_log`` of every row; counts of up to ``most`` words are broadcast."""
    table, whole = frequent_words(network.words, most)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps((network, table)))
    state: dict[str, tuple[Network, dict[bytes, float]]] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, table = state.get("network") or state.setdefault("network", pickle.loads(shared.value))
        # in places of its own, so that those that are not frequent have the last
        frequent, logs_of = pa.array(list(table), pa.binary()), np.append(np.fromiter(table.values(), np.float64, len(table)), np.nan)
        for batch in batches:
            for rows in portions(batch.column(2), SCORED):
                words, number, sizes = words_in(batch.column(2)[rows])
                keys, cuts = _keys(words), np.cumsum(sizes)
                ids, places = joined(np.split(np.take(_buckets(words.to_numpy(zero_copy_only=False).tolist()), number), cuts[:-1]))
                logs = network.log_probabilities(ids, places)
                # a word's share of its bucket, or the share of all words that the corpus lacks
                at = pc.fill_null(pc.index_in(keys, value_set=frequent), -1).to_numpy(zero_copy_only=False)
                own = np.take(np.take(logs_of, at, mode="wrap"), number)
                missing = np.flatnonzero(np.isnan(own))
                own[missing] = np.log(0.5) if whole else 0
                logs += own - network.log_counts[ids[places]]
                total = np.concatenate(([0.0], np.cumsum(logs)))
                columns = [batch.column(0)[rows], batch.column(1)[rows], pa.array(sizes, pa.int64()), pa.array(total[cuts] - total[cuts - sizes], pa.float64())]
                if not whole:
                    # each missing word of a text once, texts in their order
                    text = np.repeat(np.arange(len(sizes)), sizes)[missing]
                    pairs, times = np.unique(text * len(words) + number[missing], return_counts=True)
                    ends = pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(words)), pa.int32())
                    columns += [pa.ListArray.from_arrays(ends, keys.take(pa.array(pairs % max(1, len(words))))), pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    kept = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = f"row bigint, id {kept.schema['id'].dataType.simpleString()}, n_tokens bigint, log_likelihood double"
    shape += "" if whole else ", words array<binary>, times array<bigint>"
    names = [part.split()[0] for part in shape.split(", ")]
    scored = kept.mapInArrow(run, shape)
    if not whole:
        scored = stored(scored, "lm-scores")
        each = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times").withColumnRenamed("words", "word")
        # decimals add up to the same sum in any order
        log = F.log(F.coalesce(F.col("n").cast("double"), F.lit(0.5))) * F.col("times")
        sums = each.join(network.words.select("word", "n"), "word", "left").groupBy("row").agg(F.sum(log.cast("decimal(28,9)")).alias("more"))
        scored = scored.drop("words", "times").join(sums, "row", "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce(F.col("more").cast("double"), F.lit(0.0)))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.select(F.col("id").alias(id_col), "n_tokens", "log_likelihood", mean.alias("mean_log"))
