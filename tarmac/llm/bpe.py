"""Byte-level BPE: encoding by a priority queue of merge ranks, decoding by concatenation.

A pre-token's bytes form a doubly linked list of symbols. A heap holds every
adjacent pair that the vocabulary can merge, lowest rank first, leftmost first.
A merge unlinks the right symbol, puts the new symbol in place of the left one and
pushes its two new neighbour pairs. Entries are never removed from the heap: one
whose place no longer merges into the same symbol, by the rank that is kept for every place, is stale and skipped.

Rows: a null text counts as the empty text (no ids, empty decoding). Repeated rows,
null ids and clashing extra columns are passed on or ignored, never merged. An empty
table gives an empty table. A text of any length is encoded whole; the table of
already encoded pieces forgets the oldest beyond ``CACHE_WORDS``, which
changes the speed and no result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: pieces between spaces (and a quarter as many pre-tokens) of either age kept encoded per worker
CACHE_WORDS = 1 << 18

#: fixed value: the published pre-token pattern of byte-level BPE
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that vocabulary files use for each of the 256 bytes.

    Printable Latin-1 characters stand for themselves; the other bytes, in order,
    take the letters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What a byte-level BPE file of the ``tokenizers`` library says."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model = parsed["model"]
        pre = parsed.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or parsed.get("normalizer"):
            raise ValueError("only plain byte-level BPE files are supported")
        if model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("dropout, ignore_merges and byte_fallback are not supported")
        ids = model["vocab"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in parsed.get("added_tokens", [])):
            raise ValueError("added tokens that strip or need whole words are not supported")
        size = max([*ids.values(), *self.special.values()]) + 1
        self.strings: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.first = [ids[letter] for letter in byte_letters()]
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        self.made_by = [ids[left + right] for left, right in pairs]
        self.rank_of = {(ids[left], ids[right]): rank for rank, (left, right) in enumerate(pairs)}.get


class Words(dict):
    """Ids of the pieces seen lately; a missing one is made. At ``room`` pieces all become the former ones, of which those that are seen again come back."""

    def __init__(self, make, room: int):
        super().__init__()
        self.make, self.room, self.former = make, room, {}

    def __missing__(self, piece: str) -> tuple[int, ...] | None:
        if len(self) >= self.room:
            self.former = self.copy()
            super().clear()
        ids = self.former.get(piece, False)
        self[piece] = ids = self.make(piece) if ids is False else ids
        return ids

    def clear(self) -> None:
        super().clear()
        self.former = {}


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        longest_first = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.words = Words(lambda word: tuple(self.merged(word.encode())), CACHE_WORDS // 4)
        self.spaced = Words(self._after_space, CACHE_WORDS)

    def _after_space(self, piece: str) -> tuple[int, ...] | None:
        """The ids of a piece and the one space before it; None if their pre-tokens may reach beyond them."""
        if piece.isascii() and piece.isalpha():
            # one pre-token
            return tuple(self.merged(b" " + piece.encode()))
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        return tuple(self._plain(" " + piece))

    def _plain(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.words.__getitem__, self.pre_tokens(text))))

    def _ids(self, text: str) -> list[int]:
        """A space between two other characters always begins a pre-token, so pieces between such spaces stand alone."""
        first, *pieces = text.split(" ")
        if pieces and (not first or not first[-1].isspace()):
            ids = list(map(self.spaced.__getitem__, pieces))
            if None not in ids:
                return self._plain(first) + list(chain.from_iterable(ids))
        return self._plain(text)

    def merged(self, word: bytes) -> list[int]:
        """The ids of one pre-token. Heap keys hold the rank above the place, so ties in rank go left to right."""
        rank_of, made_by = self.vocabulary.rank_of, self.vocabulary.made_by
        symbols = [self.vocabulary.first[b] for b in word]
        end = len(symbols)
        shift = end.bit_length()
        places = (1 << shift) - 1
        # the rank of every symbol with the one after it; -1 where they do not merge
        ranks = [rank_of(pair, -1) for pair in zip(symbols, symbols[1:])]
        queue = [rank << shift | at for at, rank in enumerate(ranks) if rank >= 0]
        if not queue:
            return symbols
        ranks.append(-1)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            rank, at = top >> shift, top & places
            made, now = made_by[rank], ranks[at]
            if now != rank and (now < 0 or made_by[now] != made):
                continue
            gone = after[at]
            symbols[at], symbols[gone], ranks[gone], after[at] = made, -1, -1, (right := after[gone])
            if right < end:
                before[right] = at
                ranks[at] = rank = rank_of((made, symbols[right]), -1)
                if rank >= 0:
                    heapq.heappush(queue, rank << shift | at)
            else:
                ranks[at] = -1
            if (left := before[at]) >= 0:
                ranks[left] = rank = rank_of((symbols[left], made), -1)
                if rank >= 0:
                    heapq.heappush(queue, rank << shift | left)
        return [s for s in symbols if s >= 0]

    def encode(self, text: str) -> list[int]:
        if self.special is None or not self.special.search(text):
            return self._ids(text)
        ids: list[int] = []
        for part in self.special.split(text):
            ids += [self.vocabulary.special[part]] if part in self.vocabulary.special else self._ids(part)
        return ids

    def forget(self) -> None:
        """Drops the pieces seen, which would stay in the memory of a worker that goes on with other work."""
        self.words.clear()
        self.spaced.clear()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.strings.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = {}


def bpe_of(spec: str) -> Bpe:
    """The encoder of a vocabulary file's content, built once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Bpe(Vocabulary(spec))
    return _loaded[key]


def _spec(docs: DataFrame, vocabulary: str):
    """The vocabulary file, read by the driver; its size is that of a vocabulary, whatever the corpus."""
    with open(vocabulary, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the ids of every whole text as an array of ints."""
    spec = _spec(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        for batch in batches:
            ids = [bpe.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    kept = docs.select(id_col, F.col(text_col).cast("string"))
    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, ids array<int>")


def decode(ids: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and the text that the ids spell; null ids spell the empty text, broken UTF-8 U+FFFD."""
    spec = _spec(ids, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        for batch in batches:
            texts = [bpe.decode(row or ()) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kept = ids.select(id_col, F.col(ids_col).cast("array<int>"))
    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", forget: bool = False) -> DataFrame:
    """Encodes every whole text and decodes its ids again, in one pass.

    Per row: ``id_col``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by
    commas), ``decoded_sha256`` (of the decoded text in UTF-8) and ``restored``
    (whether the decoding equals the text). ``forget`` gives the memory of pieces seen back after each task, for
    workers that go on with other work.
    """
    spec = _spec(docs, vocabulary)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "restored"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        decimal = [str(i).encode() for i in range(len(bpe.vocabulary.strings))]
        for batch in batches:
            rows = []
            for cell in batch.column(1):
                text = cell.as_py() or ""
                ids = bpe.encode(text)
                decoded = bpe.decode(ids)
                rows.append((
                    len(ids), hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(), decoded == text,
                ))
            counts, ids_sha, text_sha, same = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                names,
            )
        if forget:
            bpe.forget()

    kept = docs.select(id_col, F.col(text_col).cast("string"))
    schema = f"`{id_col}` {kept.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, restored boolean"
    return kept.mapInArrow(run, schema)
