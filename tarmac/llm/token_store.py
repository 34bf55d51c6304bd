"""Token ids in files, compressed by Re-Pair grammars and decodable from any offset.

``write_store`` deals documents out by ranges of their ids, encodes them in ascending
order and packs each partition (a shard) into blocks of whole documents. A block
repeatedly replaces its most frequent pairs of neighbouring ids by new symbols
(nonterminals), whose rules and expansion lengths are stored beside the remaining
sequence. The lengths give the place of any token without expanding what lies before
it. Spark writes the blocks (a Parquet folder, one binary payload per block), so a
lost task is written again and half-written shards never count.

Several pairs are replaced per round: the most frequent ones of which no symbol is the
left part of one and the right part of another, so that no two replacements overlap.
A symbol paired with itself takes part in no other pair of its round, and runs of it
are paired from their start.

Rows: a null text is empty and holds the end id alone; documents with null ids come
first; rows of equal id are ordered by a hash of their text, then by it, and equal rows stay separate. An
empty table makes an empty store. A document longer than a block has a block of its
own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress as compress_list
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

#: ids a block holds before it is closed, unless one document has more
BLOCK_TOKENS = 1 << 20
#: rounds of replacement, pairs replaced in a round, and the least count of a replaced pair
ROUNDS, PAIRS, LEAST = 8, 4096, 8
#: pieces of text kept encoded per worker, pieces in one text for the library, texts in one call of it, bytes of text encoded at once (or one text)
CACHE_PIECES, JOINED, CALLED, PORTION = 3 << 18, 64, 256, 1 << 22

MAGIC, VERSION = 0x52505231, 1


# --- encoding -----------------------------------------------------------------------------------------------------


#: kinds of bytes: letters and digits, other visible ASCII, the apostrophe, a space, a line feed, the end of a character beyond Latin-1; 0 is anything else
WORD, MARK, APOSTROPHE, SPACE, LINE, TAIL = range(1, 7)
_KINDS = bytes(
    WORD if chr(b).isalnum() and b < 128 or b == 0xC3 else APOSTROPHE if b == 0x27 else SPACE if b == 0x20 else LINE if b == 0x0A
    else MARK if 0x20 < b < 0x7F else TAIL if 0x80 <= b < 0xC0 else 0
    for b in range(256)
)
#: by 8 times the kind of a byte plus that of the next: 1 if a pre-token begins there, 2 if so unless the last character is white space, 3 if so unless there is more white space
_BEGINS = bytearray(256)
for _kind in (WORD, MARK, APOSTROPHE):
    _BEGINS[8 * _kind + SPACE] = _BEGINS[8 * _kind + LINE] = 1
    _BEGINS[8 * LINE + _kind] = 3
_BEGINS[8 * WORD + MARK] = _BEGINS[8 * MARK + WORD] = 1
_BEGINS[8 * TAIL + SPACE] = _BEGINS[8 * TAIL + LINE] = 2
#: white space beyond ASCII, as the last three bytes of UTF-8 (two for 0x85 and 0xA0)
_WIDE = np.array([int.from_bytes(chr(c).encode(), "big") for c in range(0x80, 0x3001) if chr(c).isspace() or c == 0x180E])


def _pieces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts that begin at ``starts`` begin: at pre-tokens of byte-level BPE, though not at every one.

    Such a pre-token is a contraction, or letters, digits or other marks with a space before them, or white space that ends
    before the space of the next one. So one begins at white space after something else, after a single line feed, and
    between a mark and a letter or digit, unless the mark is an apostrophe. Where a character isn't known to be one or the other, nothing is cut.
    """
    kinds = np.frombuffer(bytearray(data.tobytes().translate(_KINDS)), np.uint8)
    # of the letters beyond ASCII those of Latin-1 are known: 0xC3 and another byte, but for the signs of multiplication and division
    latin = np.flatnonzero(data == 0xC3) + 1
    sign = (data[latin] == 0x97) | (data[latin] == 0xB7)
    kinds[latin] = np.where(sign, 0, WORD)
    kinds[latin[sign] - 1] = 0
    begins = np.zeros(len(data), np.uint8)
    begins[1:] = np.frombuffer((kinds[:-1] * np.uint8(8) + kinds[1:]).tobytes().translate(bytes(_BEGINS)), np.uint8)
    begins[starts] = 1
    found = np.flatnonzero(begins != 0)
    sort = begins[found]
    keep = sort == 1
    after = np.flatnonzero(sort == 2)
    last = data[np.maximum(found[after, None] - [3, 2, 1], 0)].astype(np.int64) @ [1 << 16, 1 << 8, 1]
    keep[after] = ~(np.isin(last, _WIDE) | np.isin(last & 0xFFFF, _WIDE[_WIDE < 1 << 16]))
    # a line feed alone: it was itself cut from a character that is no white space, or begins a text
    line = np.flatnonzero(sort == 3)
    keep[line] = begins[found[line] - 1] == 1
    return np.compress(keep, found)


class Encoder:
    """The ``tokenizers`` library over whole texts, asked once for each piece (see ``_pieces``).

    Pieces begin at pre-tokens, so each can be encoded apart, and many in one text, if white space
    keeps them apart there. The ids of one piece are told from the next by the bytes they stand for.
    Texts with special tokens are given to the library whole, as are all texts if its pre-tokens are others.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        parts = json.loads(spec)
        first = parts.get("pre_tokenizer") or {}
        usual = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space", True)
        self.by_pieces = usual and not parts.get("normalizer") and not any(c.isspace() for s in self.special for c in s)
        # in byte-level vocabularies every letter stands for a byte
        self.bytes = np.array([len(self.library.id_to_token(i) or "") for i in range(self.library.get_vocab_size())])
        #: numbers pieces as they come
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        #: piece k has ``ids[begin[k] :][: size[k]]``; did it come ``again`` in a later call
        self.begin, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)

    def _of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and how many each has."""
        size = self.size[number]
        return np.take(self.ids, np.repeat(self.begin[number] - np.cumsum(size) + size, size) + np.arange(size.sum())), size

    def _forget(self) -> None:
        """Keeps the pieces that came again since the last call, or none if they would fill half of the room."""
        kept = np.flatnonzero(self.again)
        kept = kept[: len(kept) * (2 * len(kept) < CACHE_PIECES)]
        pieces = list(compress_list(self.known, np.isin(np.arange(len(self.known)), kept).tolist()))
        self.known = defaultdict(None, zip(pieces, range(len(pieces))))
        self.known.default_factory = self.known.__len__
        self.ids, self.size = self._of(kept)
        self.begin, self.again = np.cumsum(self.size) - self.size, np.zeros(len(kept), bool)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        # a few at a time: the library's results take far more memory than the ids
        few = (self.library.encode_batch_fast(texts[at : at + CALLED], add_special_tokens=False) for at in range(0, len(texts), CALLED))
        return [np.array(e.ids, np.int32) for found in few for e in found]

    def _learn(self, pieces: list[str], length: np.ndarray) -> None:
        """Encodes new pieces, of which these are the bytes."""
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bare = np.fromiter(map(len, map(str.strip, pieces)), np.int64, len(pieces))
        spaced = np.fromiter(map(str.startswith, pieces, repeat(" ")), bool, len(pieces)) & (chars == bare + 1) & (bare > 0)
        closed = (chars == bare) & (bare > 0)
        begin, size, ids, ahead = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [self.ids], len(self.ids)
        # those that begin with their only space follow one another as they are, those without any follow a line feed each
        for some, mark in ((spaced, ""), (closed, "\n")):
            named = list(compress_list(pieces, some))
            joined = [mark + mark.join(named[at : at + JOINED]) for at in range(0, len(named), JOINED)]
            got = np.concatenate([self.ids[:0], *self.whole(joined)])
            read, ends = np.cumsum(self.bytes[got]), np.cumsum(length[some] + len(mark))
            stops = np.searchsorted(read, ends) + 1
            starts = stops - np.diff(stops, prepend=0)
            if len(ends) and (stops[-1] != len(got) or not np.array_equal(read[stops - 1], ends) or mark and (self.bytes[got[starts]] != 1).any()):
                raise ValueError("the library joined pieces of text")
            begin[some], size[some] = ahead + starts + len(mark), stops - starts - len(mark)
            ids, ahead = [*ids, got], ahead + len(got)
        others = ~(spaced | closed)
        alone = self.whole(list(compress_list(pieces, others)))
        size[others] = [len(x) for x in alone]
        begin[others] = ahead + np.cumsum(size[others]) - size[others]
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        self.ids, self.again = np.concatenate([*ids, *alone]), np.concatenate([self.again, np.zeros(len(pieces), bool)])

    def encode(self, given: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of every text."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        before = len(self.known)
        cells = given.cast(pa.string()) if isinstance(given, pa.Array) else pa.array(given, pa.string())
        whole = np.full(len(cells), not self.by_pieces)
        for special in self.special:
            whole |= pc.match_substring(cells, special).to_numpy(zero_copy_only=False)
        apart = cells.filter(pa.array(~whole)) if whole.any() else cells
        places = np.frombuffer(apart.buffers()[1] or bytes(4), np.int32)[apart.offset : apart.offset + len(apart) + 1] if len(apart) else np.zeros(1, np.int32)
        data = np.frombuffer(apart.buffers()[2] or b"", np.uint8)[places[0] : places[-1]] if len(apart) else np.zeros(0, np.uint8)
        places = places - places[0]
        # Arrow tells pieces apart, so that few of them become Python's
        found = _pieces(data, places[:-1][np.diff(places) > 0])
        cuts = pa.py_buffer(np.append(found, len(data)).astype(np.int32))
        coded = pa.StringArray.from_buffers(len(found), cuts, pa.py_buffer(data)).dictionary_encode()
        # by way of numpy, which makes strings faster
        named = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        each = np.fromiter(map(self.known.__getitem__, named), np.int64, len(named))
        new = each >= before
        self._learn(list(compress_list(named, new.tolist())), pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[new].astype(np.int64))
        self.again[each[~new]] = True
        ids, size = self._of(np.take(each, coded.indices.to_numpy()))
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(found, places)].tolist()
        parts = map(ids.__getitem__, map(slice, ends, ends[1:]))
        alone = iter(self.whole(cells.filter(pa.array(whole)).to_pylist()))
        return [next(alone) if w else next(parts) for w in whole.tolist()]


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most ``PORTION`` bytes of text (the second column, without nulls), or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = read = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, read + PORTION, "right")))
        yield batch.slice(start, stop - start)
        start, read = stop, int(ends[stop - 1])


_encoders: dict[str, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(spec)
    return _encoders[key]


# --- grammar ------------------------------------------------------------------------------------------------------


def _disjoint(lefts: np.ndarray, rights: np.ndarray, symbols: int) -> np.ndarray:
    """Which pairs, in order of preference, can be replaced together."""
    left, right, double = 1, 2, 3
    side = bytearray(symbols)
    taken = np.zeros(len(lefts), bool)
    for i, (a, b) in enumerate(zip(lefts.tolist(), rights.tolist())):
        if a == b and not side[a]:
            side[a], taken[i] = double, True
        elif a != b and side[a] in (0, left) and side[b] in (0, right):
            side[a], side[b], taken[i] = left, right, True
    return taken


def _from_run_start(at: np.ndarray, double: np.ndarray) -> np.ndarray:
    """Of the sorted places of pairs, those that are no self-pair or an even number of places after their run's start."""
    keep = np.ones(len(at), bool)
    self_at = at[double]
    starts = np.concatenate(([True], np.diff(self_at) != 1))
    keep[double] = (self_at - np.maximum.accumulate(np.where(starts, self_at, 0))) % 2 == 0
    return keep


def _often(seq: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of neighbours seen ``least`` times or more, ascending, as ``left << 32 | right``, and their counts."""
    used = np.flatnonzero(np.bincount(seq, minlength=top))
    bits, kind = (16, np.uint32) if len(used) <= 1 << 16 else (32, np.uint64)  # half the width sorts in half the time
    dense = np.zeros(top, kind)
    dense[used] = np.arange(len(used))
    symbols = np.take(dense, seq)
    ordered = np.sort(symbols[:-1] << kind(bits) | symbols[1:])
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    often = counts >= least
    found = ordered[np.compress(often, starts)].astype(np.int64)
    return used[found >> bits] << 32 | used[found & (1 << bits) - 1], np.compress(often, counts)


def compress(ids: np.ndarray, base: int, rounds: int = ROUNDS, pairs: int = PAIRS, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """The rules (rows of left, right; rule k makes symbol ``base + k``) and the remaining sequence."""
    seq, rules, top = ids.astype(np.int32), [], base
    for _ in range(rounds):
        if len(seq) < 2:
            break
        found, counts = _often(seq, top, least)
        best = np.lexsort((found, -counts))[:pairs]
        found = found[best]
        found = np.sort(found[_disjoint(found >> 32, found & 0xFFFFFFFF, top)])
        if not len(found):
            break
        # the rule of (left, right), plus one, in a table of the symbols that are a part of any rule
        lefts, rights = np.unique(found >> 32), np.unique(found & 0xFFFFFFFF)
        row, column = np.zeros(top, np.int32), np.zeros(top, np.int32)
        row[lefts], column[rights] = np.arange(1, len(lefts) + 1) * (len(rights) + 1), np.arange(1, len(rights) + 1)
        table = np.zeros((len(lefts) + 1) * (len(rights) + 1), np.int32)
        table[row[found >> 32] + column[found & 0xFFFFFFFF]] = np.arange(1, len(found) + 1)
        hit = np.take(table, np.take(row, seq[:-1]) + np.take(column, seq[1:]))
        # of truth values numpy makes places far faster than of numbers, and compress is faster than a mask
        at = np.flatnonzero(hit != 0)
        rule = hit[at] - 1
        double = seq[at] == seq[at + 1]
        if double.any():
            first = _from_run_start(at, double)
            at, rule = np.compress(first, at), np.compress(first, rule)
        seq[at] = top + rule
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = np.compress(keep, seq)
        rules.append(np.stack([found >> 32, found & 0xFFFFFFFF], 1))
        top += len(found)
    return np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), seq


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule's symbol stands for; rules refer to earlier rules only."""
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((1 if a < base else lengths[a - base]) + (1 if b < base else lengths[b - base]))
    return np.array(lengths, np.int64)


def expand(seq: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of a sequence: every pass replaces all its nonterminals by their two parts."""
    while len(seq) and (made := seq >= base).any():
        width = np.where(made, 2, 1)
        start = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.int64)
        out[start[~made]] = seq[~made]
        out[start[made]] = rules[seq[made] - base, 0]
        out[start[made] + 1] = rules[seq[made] - base, 1]
        seq = out
    return seq


def pack(ids: np.ndarray, base: int) -> bytes:
    """One block: header, rules, their expansion lengths, the remaining sequence; little-endian unsigned 32-bit."""
    rules, seq = compress(ids, base)
    head = np.array([MAGIC, VERSION, base, len(rules), len(seq), len(ids)], "<u4")
    return b"".join(x.astype("<u4").tobytes() for x in (head, rules.ravel(), rule_lengths(rules, base), seq))


class Block:
    """A packed block, read from any offset."""

    def __init__(self, payload: bytes):
        words = np.frombuffer(payload, "<u4").astype(np.int64)
        magic, version, self.base, n_rules, n_seq, self.n_ids = words[:6].tolist()
        if magic != MAGIC or version != VERSION or len(words) != 6 + 3 * n_rules + n_seq:
            raise ValueError("not a block of this format")
        self.rules = words[6 : 6 + 2 * n_rules].reshape(-1, 2)
        self.lengths = words[6 + 2 * n_rules : 6 + 3 * n_rules]
        self.seq = words[6 + 3 * n_rules :]
        #: how many ids each symbol stands for
        self.width = np.concatenate([np.ones(self.base, np.int64), self.lengths])
        self.ends = np.cumsum(np.take(self.width, self.seq))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the symbols that overlap them are expanded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.int64)
        first, last = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, stop, "left")
        before = int(self.ends[first - 1]) if first else 0
        seq = self.seq[first : last + 1]
        # symbol s stands for flat[begin[s] :][: width[s]]: ids for themselves, then all rules' expansions
        flat = np.concatenate([np.arange(self.base), expand(np.arange(self.base, self.base + len(self.rules)), self.rules, self.base)])
        begin = np.cumsum(self.width) - self.width
        sizes = np.take(self.width, seq)
        shift = np.repeat(np.take(begin, seq) - np.cumsum(sizes) + sizes, sizes)
        shift += np.arange(len(shift))
        return np.take(flat, shift)[start - before : stop - before]


# --- store --------------------------------------------------------------------------------------------------------


def write_store(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shards: int | None = None, block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encodes all documents and writes their blocks below ``path``.

    ``shards`` defaults to the session's shuffle partitions. The vocabulary file is read by
    the driver and broadcast; its size doesn't depend on the corpus.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    base = max(Tokenizer.from_str(spec.value).get_vocab_size(), end_id + 1)
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    kind = kept.schema["id"].dataType.simpleString()
    names = ["shard", "block", "n_tokens", "ids", "sizes", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = encoder_of(spec.value), TaskContext.get().partitionId()
        block, names_in, parts, filled = 0, [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            cells = [[shard], [block], [len(ids)], [names_in], [[len(p) for p in parts]], [pack(ids, base)]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names)

        for batch in batches:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(batch.schema[0].type), pa.list_(pa.int64()), pa.binary()]
            for rows in portions(batch):
                encoded = encoder.encode(rows.column(1))
                for doc_id, ids in zip(rows.column(0).to_pylist(), encoded):
                    if parts and filled + len(ids) + 1 > block_tokens:
                        yield closed()
                        block, names_in, parts, filled = block + 1, [], [], 0
                    names_in.append(doc_id)
                    parts.append(np.append(ids, np.int32(end_id)))
                    filled += len(ids) + 1
        if parts:
            yield closed()

    (
        kept.repartitionByRange(shards, "id", "mark").sortWithinPartitions("id", "mark", "text")
        .mapInArrow(run, f"shard int, block int, n_tokens bigint, ids array<{kind}>, sizes array<bigint>, payload binary")
        .write.parquet(path)
    )


def read_store(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per stored document: ``id_col``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    All ids come from the expanded blocks. Only sizes of blocks, without their
    payloads, take part in the running sums that place a block in the whole store.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, names, sizes, payload in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = Block(payload).ids().astype("<u4")
                ends = np.cumsum(sizes)
                if ends[-1] != len(ids):
                    raise ValueError(f"block {block} of shard {shard} holds {len(ids)} ids, not {ends[-1]}")
                sums = [zlib.crc32(ids[end - size : end]) for size, end in zip(sizes, ends.tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(names, batch.schema[2].type.value_type),
                     pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    ["shard", "block", "id", "place", "n_tokens", "ids_crc32"],
                )

    docs = blocks.select("shard", "block", "ids", "sizes", "payload").mapInArrow(
        run, f"shard int, block int, id {kind}, place bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return docs.join(block_starts(blocks), ["shard", "block"]).select(
        F.col("id").alias(id_col), (F.col("block_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def block_starts(blocks: DataFrame) -> DataFrame:
    """``block_start`` of every (shard, block): running sums within shards, and over one total per shard."""
    sizes = blocks.select("shard", "block", "n_tokens")
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    ahead = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("shard_start"))
    inside = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_tokens")
    return sizes.withColumn("inside", inside).join(ahead, "shard").select("shard", "block", (F.col("shard_start") + F.col("inside")).alias("block_start"))
