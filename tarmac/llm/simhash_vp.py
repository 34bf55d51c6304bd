"""SimHash near-duplicates through vantage-point trees.

``with_fingerprints`` gives every text 64 bits: a bit is set if it is set in over half of the
hashes of the text's word shingles. ``linked_fingerprints`` finds all fingerprints within
``max_bits`` of each other:

* A tree per block of bits. If two fingerprints differ in at most ``max_bits`` bits, one of
  ``blocks`` equal blocks has at most ``max_bits // blocks`` of them. The Hamming distance
  within a block is a (pseudo-)metric of its own, with that much smaller radius, so
  that tree prunes far better than one over all 64 bits at once, where most points
  lie near every boundary.
* Partition. The driver grows each tree from a bounded sample: a node keeps a vantage point
  and a bound ``mu``. Fingerprints not farther than ``mu + radius`` go inside, those
  farther than ``mu`` outside. By the triangle inequality two fingerprints within the
  radius meet on at least one side; those between ``mu`` and ``mu + radius`` overlap the
  boundary and visit both. Where a block cannot tell points apart (near copies), the tree
  goes on with the distance over all bits. Leaves are the shards.
* Exact pairs. A shard splits its points by the same bounds until few are left and
  compares those. Only links that join different parts leave the shard (a
  point and the first point of its part), so a group of copies costs as many rows as it
  has fingerprints, not their square.

``near_duplicates`` joins links into components. Equal fingerprints are one point from the start.

Rows: a null or empty text, or one without words, has fingerprint zero and is linked like any
other. Repeated rows and null ids are kept, each with its component (null ids never name
one, unless all ids of a component are null). Texts of any length count whole. An empty table gives an empty
table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.components import connected_components
from tarmac.llm.rows import text_of, wrapped
from tarmac.session import stored

BITS = 64
#: fingerprints a shard should hold, and the most that are sampled to grow the trees; neither changes a result
SHARD_ROWS, MOST_SAMPLED = 4096, 1 << 17
#: points that a shard compares directly
COMPARED = 512


# --- fingerprints -------------------------------------------------------------------------------------------------


def simhash(text: bytes | None, shingle_words: int, seed: int) -> int:
    """The fingerprint of a text in UTF-8: words between ASCII white space, A-Z as a-z."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(shingle_words))) if len(words) > shingle_words else [words]
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    hashes = np.array([digest(b" ".join(s)) for s in shingles], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, name: str, shingle_words: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with the fingerprint of its string column ``text_col`` as a signed long, ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col)).cast(pa.binary())
            found = np.array([simhash(cell.as_py(), shingle_words, seed) for cell in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


# --- trees --------------------------------------------------------------------------------------------------------


def _distance(points: np.ndarray, vantage, mask) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask).astype(np.int64)


def _bound(distances: np.ndarray, radius: int) -> tuple[int, int] | None:
    """The ``mu`` whose larger side is smallest, with the size of that side; None if no bound makes both sides smaller."""
    most = int(distances.max())
    upto = np.cumsum(np.bincount(distances, minlength=most + 1))
    mus = np.arange(most)
    inside, outside = upto[np.minimum(mus + radius, most)], len(distances) - upto[mus]
    worse = np.maximum(inside, outside)
    if not len(mus) or worse.min() >= len(distances):
        return None
    best = int(worse.argmin())
    return best, int(worse[best])


def _split(points: np.ndarray, metrics: list[tuple[int, int]], rng: np.random.Generator) -> tuple[int, int, int, int] | None:
    """Vantage point, mask, radius and ``mu`` that split the points best; later metrics count only where earlier ones fail."""
    for mask, radius in metrics:
        found = []
        for vantage in points[rng.integers(0, len(points), 6)]:
            distances = _distance(points, vantage, np.uint64(mask))
            if bound := _bound(distances, radius):
                found.append((bound[1], int(vantage), mask, radius, bound[0]))
        if found and min(found)[0] <= 0.9 * len(points):
            return min(found)[1:]
    return None


def grow(sample: np.ndarray, metrics: list[tuple[int, int]], leaf: int) -> np.ndarray:
    """The nodes of a tree: rows of vantage point, mask, radius, ``mu``, inner and outer child; a leaf has mask 0."""
    rng, nodes, open_nodes = np.random.default_rng(0), [[0, 0, 0, 0, 0, 0]], [(0, sample)]
    while open_nodes:
        node, points = open_nodes.pop()
        split = _split(points, metrics, rng) if len(points) > leaf else None
        if split is None:
            continue
        vantage, mask, radius, mu = split
        distances = _distance(points, np.uint64(vantage), np.uint64(mask))
        nodes[node] = [vantage, mask, radius, mu, len(nodes), len(nodes) + 1]
        open_nodes += [(len(nodes), points[distances <= mu + radius]), (len(nodes) + 1, points[distances > mu])]
        nodes += [[0, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0]]
    return np.array(nodes, np.uint64)


def visit(points: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (index of point, leaf) that the points reach, level by level."""
    rows, nodes, done = np.arange(len(points)), np.zeros(len(points), np.int64), []
    while len(rows):
        leaf = tree[nodes, 1] == 0
        done.append((rows[leaf], nodes[leaf]))
        rows, nodes = rows[~leaf], nodes[~leaf]
        vantage, mask, radius, mu, inner, outer = tree[nodes].T
        distances = _distance(points[rows], vantage, mask).astype(np.uint64)
        into, out = distances <= mu + radius, distances > mu
        rows, nodes = np.concatenate([rows[into], rows[out]]), np.concatenate([inner[into], outer[out]]).astype(np.int64)
    return np.concatenate([r for r, _ in done]), np.concatenate([n for _, n in done])


# --- exact links of a shard ---------------------------------------------------------------------------------------


def _parts(points: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Indices of the parts of two or more points that chains of steps within ``max_bits`` connect; compares all."""
    near = np.zeros(len(points), bool)
    for at in range(0, len(points), 256):
        close = np.bitwise_count(points[at : at + 256, None] ^ points[None, :]) <= max_bits
        near[at : at + 256] = close.sum(1) > 1
    rest, parts = np.flatnonzero(near), []
    while len(rest):
        part, front, rest = [rest[:1]], rest[:1], rest[1:]
        while len(front) and len(rest):
            step, front = front[:256], front[256:]
            reached = (np.bitwise_count(points[rest][:, None] ^ points[step][None, :]) <= max_bits).any(1)
            new, rest = rest[reached], rest[~reached]
            part.append(new)
            front = np.concatenate([front, new])
        parts.append(np.concatenate(part))
    return parts


def links(points: np.ndarray, metrics: list[tuple[int, int]], max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (point, first point of its part) that connect what the points' pairs within ``max_bits`` connect."""
    rng, open_sets = np.random.default_rng(0), [points]
    while open_sets:
        some = open_sets.pop()
        split = _split(some, metrics, rng) if len(some) > COMPARED else None
        if split:
            vantage, mask, radius, mu = split
            distances = _distance(some, np.uint64(vantage), np.uint64(mask))
            open_sets += [some[distances <= mu + radius], some[distances > mu]]
        elif len(some) > 1:
            for part in _parts(some, max_bits):
                yield some[part[1:]], np.repeat(some[part[:1]], len(part) - 1)


# --- all fingerprints ---------------------------------------------------------------------------------------------


def block_metrics(max_bits: int, blocks: int) -> list[list[tuple[int, int]]]:
    """Per tree the (mask, radius) of its block, then of all bits."""
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [[(mask, max_bits // blocks), ((1 << BITS) - 1, max_bits)] for mask in masks]


def linked_fingerprints(distinct: DataFrame, max_bits: int = 3, blocks: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``u``, ``v`` between the distinct fingerprints ``fp`` that connect the same parts as all pairs within ``max_bits``."""
    total = distinct.count()
    wanted = min(MOST_SAMPLED, max(8192, 4 * total // shard_rows))
    sample = np.array([r[0] for r in distinct.select("fp").sample(min(1.0, wanted / max(1, total)), seed=0).limit(2 * MOST_SAMPLED).collect()], np.int64).view(np.uint64)
    leaf = max(1, len(sample) * shard_rows // max(1, total))
    metrics = block_metrics(max_bits, blocks)
    trees = distinct.sparkSession.sparkContext.broadcast([grow(sample, m, leaf) for m in metrics])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, tree in enumerate(trees.value):
                rows, leaves = visit(points, tree)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), number, np.int32)), pa.array(leaves.astype(np.int32)), pa.array(points[rows].view(np.int64))],
                    ["tree", "leaf", "fp"],
                )

    def join(shard: pd.DataFrame) -> pd.DataFrame:
        points = shard["fp"].to_numpy().view(np.uint64)
        found = list(links(points, metrics[int(shard["tree"].iloc[0])], max_bits))
        u, v = (np.concatenate([f[i] for f in found] or [points[:0]]).view(np.int64) for i in (0, 1))
        return pd.DataFrame({"u": u, "v": v})

    return (
        distinct.select("fp").mapInArrow(deal, "tree int, leaf int, fp bigint")
        .groupBy("tree", "leaf").applyInPandas(join, "u bigint, v bigint")
    )


def classes(distinct: DataFrame, max_bits: int = 3, blocks: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``distinct`` (one row per fingerprint ``fp``) with ``root``, the fingerprint that stands for its component."""
    stars = connected_components(linked_fingerprints(distinct, max_bits, blocks, shard_rows))
    return distinct.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = 3, seed: int = 42, max_bits: int = 3, blocks: int = 4, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per row ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest id reachable over links)."""
    kept = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    prints = stored(with_fingerprints(kept, "text", "fp", shingle_words, seed).select("id", "fp"), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    rooted = classes(distinct, max_bits, blocks, shard_rows)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = stored(rooted.join(named, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = 3, seed: int = 42, max_bits: int = 3, blocks: int = 4, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last; of equal ids any one.

    Rows get numbers when they are first written, so repeated rows can be told apart and every
    component keeps exactly one.
    """
    given = wrapped(docs, id=F.col(f"`{id_col}`"), text=text_of(text_col))
    numbered = with_fingerprints(given, "text", "fp", shingle_words, seed).drop("text").withColumn("row", F.monotonically_increasing_id())
    kept = stored(numbered, "simhash-rows")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    distinct = stored(kept.groupBy("fp").agg(F.min(place).alias("first")), "simhash-distinct")
    firsts = classes(distinct, max_bits, blocks, shard_rows).groupBy("root").agg(F.min("first").alias("first"))
    chosen = stored(firsts.select("first.row"), "simhash-chosen")
    # always dealt by row, also where the chosen rows are few enough for a broadcast
    return kept.join(chosen.hint("merge"), "row", "left_semi").select("doc.*")
