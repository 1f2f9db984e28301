"""Benchmark decontamination (operator 7): q-gram lemma over diagonal bands, banded alignment.

Texts and items are lower-cased and their white space runs become one space. An item of m code
points is found where some stretch of a document is within ``budget(m)`` edits (8 % of m). Such a
stretch shares at least ``m - q + 1 - q * budget`` q-grams with the item, all on ``budget + 1``
neighbouring diagonals (place in the document minus place in the item). Diagonals are counted in
bands of twice that width that overlap by half, so one band holds them all. Bands that reach the
bound are verified by an alignment restricted to the band.

The benchmark goes to the tasks in blocks of at most about ``BLOCK_CHARS`` characters; a larger
benchmark is searched block by block, each time over all documents. Documents are read in place
and never shuffled.

Null and empty texts match nothing; items shorter than ``MIN_ITEM`` code points, null ones
included, are too short to tell and are not searched. Repeated rows are each reported; items of
equal text are all reported. Extra columns pass through ``clean``. Empty tables give no match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, slices

Q, EDIT_SHARE, MIN_ITEM, BLOCK_CHARS = 8, 0.08, 24, 4_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(cp: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place."""
    n = len(cp) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    x = cp.astype(np.uint64)
    for i in range(Q):
        out = out * _STEP + x[i:i + n]
    return mix64(out)


def budget(m: int) -> int:
    """Edits allowed in an item of m code points; the lemma's bound stays at 1 or more."""
    return min(int(EDIT_SHARE * m), (m - Q) // Q)


class Index:
    """q-grams of a block of items with their places."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        grams, owner, place = [], [], []
        for k, (_, t) in enumerate(self.items):
            g = qgrams(points(t))
            grams.append(g)
            owner.append(np.full(len(g), k))
            place.append(np.arange(len(g)))
        g = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(g, kind="stable")
        self.gram, self.first, self.count = np.unique(g[order], return_index=True, return_counts=True)
        self.owner = np.concatenate(owner)[order] if grams else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if grams else np.zeros(0, np.int64)
        self.length = np.array([len(t) for _, t in self.items], np.int64)
        self.edits = np.array([budget(n) for n in self.length], np.int64)
        self.bound = self.length - Q + 1 - Q * self.edits
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.gram >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document place, item, item place) of every shared q-gram."""
        g = qgrams(cp)
        at = np.flatnonzero(self.maybe[(g >> np.uint64(44)).astype(np.int64)])
        k = np.searchsorted(self.gram, g[at])
        k[k == len(self.gram)] = 0
        same = self.gram[k] == g[at] if len(self.gram) else np.zeros(len(at), bool)
        at, k = at[same], k[same]
        n = self.count[k]
        total = int(n.sum())
        post = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total) if total else np.zeros(0, np.int64)
        return np.repeat(at, n), self.owner[post], self.place[post]


def aligned(item: np.ndarray, cp: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int]:
    """Least edits of the item against a stretch whose diagonals stay in the band, and its end."""
    k = np.arange(low - edits, high + edits + 1)
    step = np.arange(len(k))
    d = np.zeros(len(k), np.int64)
    big = len(item) + len(k)
    for i, c in enumerate(item):
        at = k + i
        ok = (at >= 0) & (at < len(cp))
        same = np.zeros(len(k), bool)
        same[ok] = cp[at[ok]] == c
        new = np.where(ok, d + ~same, big)
        new[:-1] = np.minimum(new[:-1], d[1:] + 1)
        d = np.minimum.accumulate(new - step) + step
    best = int(d.argmin())
    return int(d[best]), int(k[best]) + len(item)


def search(index: Index, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """(text number, item number, edits, end) of the best place of each item found in a text."""
    cps = [points(t) for t in texts]
    at = np.concatenate([[0], np.cumsum([len(c) + Q for c in cps])])
    gap = np.full(Q, 0x110000, np.uint32)
    joined = np.concatenate([x for c in cps for x in (c, gap)]) if cps else np.zeros(0, np.uint32)
    place, item, inner = index.hits(joined)
    doc = np.searchsorted(at, place, side="right") - 1
    pair = doc * len(index.items) + item
    enough = np.bincount(pair, minlength=len(cps) * len(index.items) + 1)[pair] >= index.bound[item]
    place, item, inner, doc, pair = (x[enough] for x in (place, item, inner, doc, pair))
    width = index.edits[item] + 1
    # diagonals start at 1 so that each band and the one before it have numbers of 0 or more
    band = (place - at[doc] - inner + index.length[item]) // width + 1
    key = np.concatenate([pair, pair]) << 32 | np.concatenate([band, band - 1])
    key, n = np.unique(key, return_counts=True)
    pair, band = key >> 32, (key & 0xFFFFFFFF) - 1
    good = n >= index.bound[pair % max(1, len(index.items))] if len(key) else np.zeros(0, bool)
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for p, b in zip(pair[good].tolist(), band[good].tolist()):
        d, i = divmod(p, len(index.items))
        if found.get((d, i), (1, 0))[0] == 0:
            continue
        text, m, e = index.items[i][1], int(index.length[i]), int(index.edits[i])
        low = b * (e + 1) - m
        high = low + 2 * (e + 1) - 1
        exact = texts[d].find(text, max(0, low), max(0, high + 1 + m))
        hit = (0, exact + m) if exact >= 0 else aligned(points(text), cps[d], low, high, e)
        if hit[0] <= e and hit[0] < found.get((d, i), (e + 1, 0))[0]:
            found[d, i] = hit
    return [(d, i, *hit) for (d, i), hit in sorted(found.items())]


def _blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_CHARS))
    out = []
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        out.append(sorted((r.item_id, t) for r in rows if len(t := normal(r.text)) >= MIN_ITEM))
    return [x for x in out if x]


def _cuts(batch: pa.RecordBatch, index: Index):
    for part in slices(batch, "text", 1 << 19):
        yield part, search(index, [normal(t) for t in part.column("text").to_pylist()])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_edits, end_at (code points of the normal form), one row per item found in a row."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_edits long, end_at long"
    out = None
    for items in _blocks(benchmark):
        held = spark.sparkContext.broadcast(items)

        def run(batches, held=held):
            index = Index(held.value)
            for batch in batches:
                for part, found in _cuts(batch, index):
                    ids = part.column("doc_id").to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[d] for d, *_ in found], pa.int64()), pa.array([index.items[i][0] for _, i, *_ in found], pa.int64()),
                         pa.array([e for *_, e, _ in found], pa.int64()), pa.array([x for *_, x in found], pa.int64())],
                        ["doc_id", "item_id", "n_edits", "end_at"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no item is found; columns unchanged."""
    for items in _blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, held=held):
            index = Index(held.value)
            for batch in batches:
                for part, found in _cuts(batch, index):
                    keep = np.ones(part.num_rows, bool)
                    keep[[d for d, *_ in found]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
