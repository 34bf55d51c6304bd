"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised items accepts every run of their words. Streaming a
document through it gives, at each word, the length of the longest run ending there
that some item contains. Where that length reaches ``window``, or a whole shorter item
ends, the words of the occurrence are hit. ``report`` counts hits and names the items;
``decontaminate`` cuts hit spans out of documents, or whole documents whose hits exceed the coverage limit.

Words: A-Z as a-z, then runs of digits, letters a-z and characters beyond ASCII. A window is
``window`` consecutive words of an item; an item with fewer words, but not none, is one window.

Only stretches of a document whose neighbouring words also neighbour each other somewhere
in the items can match two words or more, so the automaton is run over those alone; numpy finds them.

Scale: documents never shuffle. The items are cut into portions of at most
``PORTION_WORDS`` words (an item is never cut), so an automaton's size is bounded by that and its longest item; with more than
one portion each one makes a pass over the documents and spans are merged by document.

Rows: null texts and texts without words have no hits; null items and items without words have no windows. Null ids are kept (an
item with a null id is matched but not named). Repeated documents are judged apart, also when ids repeat.
An empty item table finds nothing. Texts of any length count whole. Other columns are kept by ``decontaminate`` and ignored by ``report``.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.rows import text_of, wrapped
from tarmac.session import stored

#: words of a window, words of items in one automaton
WINDOW, PORTION_WORDS = 13, 1 << 20
#: a document is contaminated if hit words are at least this share (as a fraction) of its words
COVERAGE = (1, 20)
#: states whose items a task remembers, rows matched at once
CACHE_STATES, ROWS = 4096, 1024

_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Normalised words of a text in UTF-8; bytes beyond ASCII belong to characters beyond ASCII."""
    return (text or b"").translate(_KEPT).split()


class Automaton:
    """Generalised suffix automaton over the words of items, numbered in order of appearance."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[int]] = {}  # items that have a prefix ending in the state
        short: list[int] = []  # items shorter than a window
        self.names = [name for name, _ in items]
        sizes, pairs = [], set()
        for item, (_, words) in enumerate(items):
            if not words:
                continue
            ids = [self.number.setdefault(w, len(self.number)) for w in words]
            pairs.update(zip(ids, ids[1:]))
            state = 0
            for word in ids:
                state = self._extend(state, word)
                ends.setdefault(state, set()).add(item)
            sizes.append(min(window, len(ids)))
            if len(ids) < window:
                short.append(item)
        self.shortest = min(sizes, default=0)
        self._finish(ends, short, items)
        n = max(1, len(self.number))
        self.pairs = np.array(sorted(a * n + b for a, b in pairs), np.int64)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            old = nxt[last][word]
            return old if length[old] == length[last] + 1 else self._clone(last, word, old)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and word not in nxt[state]:
            nxt[state][word] = new
            state = link[state]
        if state >= 0:
            old = nxt[state][word]
            link[new] = old if length[old] == length[state] + 1 else self._clone(state, word, old)
        return new

    def _clone(self, state: int, word: int, old: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[old]))
        length.append(length[state] + 1)
        link.append(link[old])
        link[old] = copy
        while state >= 0 and nxt[state].get(word) == old:
            nxt[state][word] = copy
            state = link[state]
        return copy

    def _state_of(self, ids: list[int]) -> int:
        state = 0
        for word in ids:
            state = self.next[state][word]
        return state

    def _finish(self, ends: dict[int, set[int]], short: list[int], items: list) -> None:
        """Prepares lookups along the links of the finished automaton."""
        by_state: dict[int, list[int]] = {}
        for item in short:
            by_state.setdefault(self._state_of([self.number[w] for w in items[item][1]]), []).append(item)
        self.children: list[list[int]] = [[] for _ in self.next]
        for state, parent in enumerate(self.link):
            if parent >= 0:
                self.children[parent].append(state)
        self.ends = {state: sorted(found) for state, found in ends.items()}
        # the nearest state along the links, itself included, where whole short items end
        self.short, self.size = by_state, {i: len(w) for i, (_, w) in enumerate(items)}
        self.short_at = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            parent = self.link[state]
            self.short_at[state] = state if state in by_state else (self.short_at[parent] if parent >= 0 else -1)

    def holders(self, state: int) -> list[int]:
        """Items that contain the runs of a state: those with a prefix ending in it or below it in the tree of links."""
        found, below = set(), [state]
        while below:
            state = below.pop()
            found.update(self.ends.get(state, ()))
            below += self.children[state]
        return sorted(found)

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of words outside of which no window can lie."""
        if not self.shortest or len(ids) < self.shortest:
            return
        known = ids >= 0
        if self.shortest == 1:
            good, need, extra = known, 1, 0
        else:
            keys = ids[:-1] * max(1, len(self.number)) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
            good, need, extra = known[:-1] & known[1:] & (self.pairs[at] == keys), self.shortest - 1, 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
        starts, stops = edges[::2], edges[1::2]
        wide = stops - starts >= need
        yield from zip(starts[wide].tolist(), (stops[wide] + extra).tolist())

    def match(self, words: list[bytes], cache: dict[int, list[int]]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans of hit words, and the items with a window in the document."""
        get, number = self.next, self.number.get
        ids = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()

        def hit(start: int, stop: int) -> None:
            if spans and start <= spans[-1][1]:
                # a longer occurrence that ends here may begin before earlier spans
                while len(spans) > 1 and start <= spans[-2][1]:
                    spans.pop()
                spans[-1] = (min(start, spans[-1][0]), stop)
            else:
                spans.append((start, stop))

        for start, stop in self.stretches(ids):
            state = length = 0
            for at in range(start, stop):
                word = int(ids[at])
                while state and word not in get[state]:
                    state = self.link[state]
                    length = self.length[state]
                if word in get[state]:
                    state, length = get[state][word], length + 1
                if length >= self.window:
                    top = state
                    while self.length[self.link[top]] >= self.window:
                        top = self.link[top]
                    if top not in cache:
                        if len(cache) >= CACHE_STATES:
                            cache.clear()
                        cache[top] = self.holders(top)
                    items.update(cache[top])
                    hit(at + 1 - self.window, at + 1)
                whole = self.short_at[state]
                while whole > 0:
                    here = [i for i in self.short.get(whole, ()) if self.size[i] <= length]
                    if here:
                        items.update(here)
                        hit(at + 1 - max(self.size[i] for i in here), at + 1)
                    whole = self.short_at[self.link[whole]]
        return spans, items


_automata: dict[bytes, tuple[Automaton, dict]] = {}


def _automaton(packed: bytes) -> tuple[Automaton, dict]:
    """The automaton of packed items, built once per Python worker, and its table of looked-up holders."""
    key = hashlib.sha256(packed).digest()
    if key not in _automata:
        _automata.clear()
        _automata[key] = (Automaton(*pickle.loads(packed)), {})
    return _automata[key]


def _portions(items: DataFrame, id_col: str, text_col: str, window: int, portion_words: int) -> Iterator[tuple[bytes, bool]]:
    """The items in portions of bounded size, one at a time on the driver, and whether it is the last one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = items.select(F.col(id_col).cast("string").alias("id"), text.alias("text")).distinct()
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (4 * portion_words)))
    if n > 1:
        kept = stored(kept, "items")
    for part in range(n):
        rows = kept.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == part).orderBy("id", "text").collect()
        yield pickle.dumps(([(r[0], words_of(r[1].encode())) for r in rows], window)), part == n - 1


def matched(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, portion_words: int = PORTION_WORDS,
    cut_below: tuple[int, int] | None = None,
) -> DataFrame:
    """``docs``, of which ``text`` is a string, with ``n_words``, ``spans`` (merged hit spans, as start, stop, start, ...) and ``items``.

    With a coverage ``cut_below`` the pass of the last portion also drops contaminated rows and cuts the spans out of the others' texts.
    """
    frame = docs.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<bigint>"), "items": F.array().cast("array<string>")})
    for packed, last in _portions(items, item_id, item_text, window, portion_words):
        frame = _pass(frame, docs.sparkSession.sparkContext.broadcast(packed), cut_below if last else None)
        if not last:
            frame = stored(frame, "decontamination")
    return frame


def _pass(frame: DataFrame, shared, cut_below: tuple[int, int] | None) -> DataFrame:
    """Adds the hits of one portion to those of earlier ones; with a coverage, drops and cuts by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, cache = _automaton(shared.value)
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            names = batch.schema.names
            sizes, spans, items = [], [], []
            text, *before = (batch.column(names.index(c)) for c in ("text", "spans", "items"))
            for cell, old_spans, old_items in zip(text.cast(pa.binary()), *(c.to_pylist() for c in before)):
                words = words_of(cell.as_py())
                found, hit = automaton.match(words, cache)
                sizes.append(len(words))
                spans.append(merged(old_spans, found))
                items.append(sorted({*old_items, *(automaton.names[i] for i in hit)} - {None}))
            new = [pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            done = pa.RecordBatch.from_arrays([*batch.columns[:-3], *new], names=names)
            if cut_below and any(spans):
                at = names.index("text")
                kept = [not _covered(n, s, cut_below) for n, s in zip(sizes, spans)]
                rest = [cell.as_py() if not (keep and s) else cut(cell.as_py(), s) for cell, s, keep in zip(text, spans, kept)]
                done = done.set_column(at, "text", pa.array(rest, text.type)).filter(pa.array(kept, pa.bool_()))
            yield done

    return frame.mapInArrow(run, frame.schema)


def _covered(n_words: int, spans: list[int], coverage: tuple[int, int]) -> bool:
    """Whether a document of hit spans is contaminated, as in ``_measured``."""
    n_hit = sum(spans[1::2]) - sum(spans[::2])
    return n_hit > 0 and n_hit * coverage[1] >= n_words * coverage[0]


def merged(old: list[int], found: list[tuple[int, int]]) -> list[int]:
    """Spans of two sorted lists, overlapping ones united, flat."""
    if not old or not found:
        return old or [x for span in found for x in span]
    out: list[int] = []
    for start, stop in sorted([*zip(old[::2], old[1::2]), *found]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], stop)
        else:
            out += [start, stop]
    return out


def _measured(frame: DataFrame, coverage: tuple[int, int]) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``."""
    ends = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    frame = frame.withColumn("n_hit", F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x))
    return frame.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage[1] >= F.col("n_words") * coverage[0]))


def report(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, coverage: tuple[int, int] = COVERAGE, portion_words: int = PORTION_WORDS,
) -> DataFrame:
    """Per document ``id_col``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings), ``spans`` (start, stop) and ``contaminated``."""
    kept = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    found = _measured(matched(kept, items, item_id, item_text, window, portion_words).drop("text"), coverage)
    pair = lambda x, i: F.when(i % 2 == 0, F.struct(x.alias("start"), F.get("spans", i + 1).alias("stop")))
    spans = F.filter(F.transform("spans", pair), lambda span: span.isNotNull())
    return found.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", spans.alias("spans"), "contaminated")


def cut(text: str, spans: list[int]) -> str:
    """The text without the words of the spans; what separates the remaining words stays as it is."""
    if not spans:
        return text
    raw = text.encode()
    gaps = np.frombuffer(b" " + raw.translate(_KEPT) + b" ", np.uint8) == 32
    edges = np.diff(gaps.astype(np.int8))
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    out, at = [], 0
    for start, stop in zip(spans[::2], spans[1::2]):
        out.append(raw[at : starts[start]])
        at = int(stops[stop - 1])
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, coverage: tuple[int, int] = COVERAGE, cut_spans: bool = True, portion_words: int = PORTION_WORDS,
) -> DataFrame:
    """``docs`` without contaminated rows; hits below the coverage limit are cut out of the others if ``cut_spans``."""
    if not cut_spans:
        frame = wrapped(docs, text=text_of(text_col))
        return _measured(matched(frame, items, item_id, item_text, window, portion_words), coverage).where("not contaminated").select("doc.*")
    # the text that comes back is the cut one, so a row carries no other
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]
    frame = docs.select(F.struct(*others).alias("doc"), text_of(text_col).alias("text"))
    done = matched(frame, items, item_id, item_text, window, portion_words, cut_below=coverage)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns])
