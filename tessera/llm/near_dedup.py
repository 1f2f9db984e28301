"""MinHash near-dedup (operator 2): circulant MinHash, banding, exact Jaccard verification.

Shingle hashes are points of a circle of 2^32 places. One permutation scatters the points, a
second one ranks the places; coordinate k of a signature is the least rank after shifting all
points by k places, so two permutations give every coordinate. ``ROWS`` coordinates make a band;
documents sharing a band are candidates: a pair at similarity 0.75 is missed by all bands with a
chance of 2e-5. Candidates are confirmed on the full shingle sets.

Texts with equal shingle sets form one class (its least doc_id stands for it), so thousands of
copies cost one candidate. In a bucket each class meets the bucket's first and last class. Classes
of a bucket that are then still in another component than most of it are compared with the whole
bucket, in blocks of about ``BLOCK`` by ``BLOCK`` rows that hold signatures and texts: pairs that
agree in ``MIN_AGREE`` of 200 coordinates (a pair at similarity 0.75 fails this with a chance of
0.1 %, one at 0.8 with 1e-6) and whose sizes allow it are compared by their full shingle sets there,
so only links leave a block. Links become components by distributed union-find.

Null, empty and blank texts have no shingle and are linked with nothing; a text of fewer than
five words is one shingle. Repeated (doc_id, text) rows give one row each; of different texts with one
doc_id, each has its own row, and links are confirmed on the greatest one. Extra columns are kept
by ``dedup`` and ignored by ``components_of``. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix32, mix64, shingle_sets, slices
from .groups import components, star_pairs

SHINGLE, BANDS, ROWS = 5, 40, 5
MIN_PERCENT = 75
MIN_AGREE, BLOCK, LONG = 131, 1000, 500


def circulant_signature(points: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Signatures (sets x size) of consecutive point sets; every set has a point."""
    sigma = mix32(points.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15))
    out = np.empty((len(starts), size), np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(mix32(sigma + np.uint32(k)), starts)
    return out


def _sketch(batches):
    """(doc_id, text) -> doc_id, n_shingles, fingerprint (two longs), bands, signature (16 bits a coordinate)."""
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column("text"), SHINGLE)
            n = np.array([len(s) for s in sets], np.int64)
            f0 = np.array([int(mix64(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets], np.uint64)
            f1 = np.array([int(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets], np.uint64)
            bands = np.zeros((len(sets), BANDS), np.int64)
            short = np.zeros((len(sets), BANDS * ROWS), np.uint16)
            full = np.flatnonzero(n)
            if len(full):
                points = np.concatenate([sets[i] for i in full]) >> np.uint64(32)
                starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                sig = circulant_signature(points, starts, BANDS * ROWS).astype(np.uint64)
                key = np.zeros((len(full), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
                bands[full] = key.view(np.int64)
                short[full] = sig & np.uint64(0xFFFF)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(f0.view(np.int64)), pa.array(f1.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel())),
                 pa.Array.from_buffers(pa.binary(BANDS * ROWS * 2), len(sets), [None, pa.py_buffer(short)]).cast(pa.binary())],
                ["doc_id", "n_shingles", "f0", "f1", "bands", "sig"])


def _compare(batches):
    """Rows sorted by (a, salt, role): a's text first, then texts of its candidates -> confirmed links."""
    lead, lead_set = None, None
    for batch in (x for whole in batches for x in slices(whole, "text")):
        sets = shingle_sets(batch.column("text"), SHINGLE)
        a, salt = batch.column("a").to_pylist(), batch.column("salt").to_pylist()
        role, b = batch.column("role").to_pylist(), batch.column("b").to_pylist()
        links = []
        for i, s in enumerate(sets):
            if role[i] == 0:
                lead, lead_set = (a[i], salt[i]), s
                continue
            assert lead == (a[i], salt[i]), "a candidate without its leader's text"
            both = len(np.intersect1d(lead_set, s, assume_unique=True))
            if 100 * both >= MIN_PERCENT * (len(lead_set) + len(s) - both) and both:
                links.append((a[i], b[i]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets meet the threshold.

    Candidates of one node are counted and dealt over groups of about ``BLOCK``; in each, one copy of
    a's text comes first and the candidates' texts stream past it.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    p = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")).drop("salts")
    t = texts.select(F.col("doc_id").alias("node"), "text")
    heads = (p.select("a", "salt").distinct().join(t.withColumnRenamed("node", "a"), "a")
             .select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "text"))
    tails = (p.join(t.withColumnRenamed("node", "b"), "b")
             .select("a", "salt", F.lit(1).alias("role"), "b", "text"))
    rows = heads.unionByName(tails).repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "b")
    return rows.mapInArrow(_compare, "a long, b long")


def _blocks(batches):
    """Rows sorted by (bucket, rc, mc, role): a block's queries (role 0) against its members -> links (a, b).

    Signatures and sizes choose the pairs, full shingle sets decide. Of two queries only the lesser one
    asks, of all buckets that show a pair only the first band's; a pair that this block's links
    have joined already is not compared.
    """
    def block(t: pa.Table) -> tuple[list, list]:
        c = {x: t.column(x).to_numpy() for x in ("role", "node", "comp", "n", "rest")}
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(t.num_rows, BANDS * ROWS)
        band, texts = t.column("band")[0].as_py(), t.column("text")
        sets, joined, a, b = {}, {}, [], []

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_sets(texts.slice(i, 1), SHINGLE)[0]
            return sets[i]

        def root(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        m = np.flatnonzero(c["role"] == 1)
        for i in np.flatnonzero(c["role"] == 0):
            n, other = c["n"][i], m[c["comp"][m] != c["comp"][i]]
            ok = 100 * np.minimum(n, c["n"][other]) >= MIN_PERCENT * np.maximum(n, c["n"][other])
            other = other[ok & (~c["rest"][other] | (c["node"][other] > c["node"][i]))]
            same = sig[other] == sig[i]
            agree = same.sum(axis=1)
            near = np.flatnonzero((agree >= MIN_AGREE) & (same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band))
            for j in other[near[np.argsort(-agree[near], kind="stable")]]:
                x, y = root(int(c["comp"][i])), root(int(c["comp"][j]))
                if x == y:
                    continue
                both = len(np.intersect1d(of(i), of(j), assume_unique=True))
                if 100 * both >= MIN_PERCENT * (n + c["n"][j] - both):
                    joined[max(x, y)] = min(x, y)
                    a.append(min(c["node"][i], c["node"][j]))
                    b.append(max(c["node"][i], c["node"][j]))
        return a, b

    def links(t: pa.Table) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in block(t)], ["a", "b"])

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        key = [t.column(c).to_numpy() for c in ("bucket", "rc", "mc")]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        at = np.concatenate([[0], cuts]).astype(int)
        for x, y in zip(at[:-1], at[1:]):
            yield links(t.slice(x, y - x))
        held = t.slice(at[-1])
    if held is not None and held.num_rows:
        yield links(held)


def leftover_links(buckets: DataFrame, sigs: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) of a bucket whose ends are in different components: all that join components.

    ``buckets(bucket, band, node, n)``; ``sigs(node, sig)``; ``texts(doc_id, text)``; ``labels(node, comp)``
    of linked nodes. Classes outside a bucket's largest component meet the whole bucket in blocks
    of ``BLOCK`` rows or of ``BLOCK * LONG`` shingles, so rows travel once a block, not once a pair.
    """
    held = (buckets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    sizes = held.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    mixed = (sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.max("k").alias("top"), F.sum("k").alias("m"))
             .filter("m > top").select("bucket", "main"))
    held = cut(held.join(mixed, "bucket").withColumn("rest", F.col("comp") != F.col("main")).drop("main"))
    load = 1 + F.floor(F.col("n") / LONG)
    blocks = lambda x: F.ceil(F.sum(x) / BLOCK)
    dealt = held.groupBy("bucket").agg(blocks(load).alias("mb"), blocks(F.when(F.col("rest"), load)).alias("rb"))
    held = held.join(dealt, "bucket")
    part = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    queries = held.filter("rest").withColumn("rc", part(1, "rb")).withColumn("mc", every("mb")).withColumn("role", F.lit(0))
    members = held.withColumn("mc", part(2, "mb")).withColumn("rc", every("rb")).withColumn("role", F.lit(1))
    rows = (queries.unionByName(members).join(sigs.join(texts.withColumnRenamed("doc_id", "node"), "node"), "node")
            .repartition("bucket", "rc", "mc").sortWithinPartitions("bucket", "rc", "mc", "role", "node")
            .select("bucket", "rc", "mc", "role", "band", "node", "comp", "n", "rest", "sig", "text"))
    return rows.mapInArrow(_blocks, "a long, b long").distinct()


def components_of(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id, n_copies, kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = cut(rows.mapInArrow(_sketch, "doc_id long, n_shingles long, f0 long, f1 long, bands array<long>, sig binary"))
    classes = cut(sketch.filter("n_shingles > 0").groupBy("f0", "f1", "n_shingles")
                  .agg(F.min("doc_id").alias("node"), F.count("*").alias("n_copies")))
    first = sketch.join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").withColumnRenamed("doc_id", "node")
    every = first.select("node", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "bucket")).distinct()
    shared = (every.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
              .filter("lo < hi").select("bucket"))
    buckets = cut(every.join(shared, "bucket").select("bucket", "band", "node", "n"))
    near = cut(buckets.select("node").distinct())
    texts = cut(rows.join(near.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
                .groupBy("doc_id").agg(F.max("text").alias("text")))
    stars = cut(star_pairs(buckets))
    links = cut(confirm(stars, texts))
    sigs = first.join(near, "node", "left_semi").select("node", "sig").dropDuplicates(["node"])
    more = cut(leftover_links(buckets, sigs, texts, components(links)))
    comp = components(links.unionByName(more))
    named = (classes.join(comp, "node", "left")
             .select("f0", "f1", "n_shingles", "n_copies", F.coalesce("comp", "node").alias("component_id")))
    return (sketch.select("doc_id", "f0", "f1", "n_shingles").join(named, ["f0", "f1", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def dedup(docs: DataFrame) -> DataFrame:
    """Documents of which one per component stays; columns unchanged."""
    kept = components_of(docs).filter("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns)
