"""Language ID (operator 5): family first, then one-versus-one linear SVMs within the family.

Features are the counts of 1- to 3-byte grams of the lower-cased text (other ASCII characters than
letters count as spaces), hashed to ``DIM`` places, square-rooted and scaled to length 1. The
languages are the lang values of the learning rows. Families come from the data: languages are
merged by average linkage while the closest two are closer than the mean of all pairs. A linear
SVM for each family against the rest picks the family, one-versus-one SVMs within it vote.

Learning: rows whose crc32(doc_id as text) mod 5 is not 0, with lang, doc_id and text not null; of
these a sample of about ``SAMPLE_ROWS`` rows, evenly by language and chosen by a hash, each with
its whole text. Their feature vectors (16 KB each) go to the driver, which trains the weights.
Every document is predicted from its whole text alone.

``und`` with score 0: null texts, texts without letters, and all texts if nothing was learned. With
one learned language, that one with score 1. A null doc_id is not held out and not learned from.
Repeated rows get equal results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_bytes, slices

DIM, SAMPLE_ROWS, EPOCHS, COST = 4096, 1600, 12, 4.0
ROW_BYTES, PIECE = 8192, 1 << 20  # rows of a slice count so many bytes more; bytes of a text counted at once
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint32)


def features(texts: pa.Array) -> np.ndarray:
    """One row of DIM values per text, counted in pieces of ``PIECE`` bytes."""
    data, at = raw_bytes(pc.utf8_lower(texts))
    n = len(at) - 1
    out = np.zeros(n * DIM)
    for begin in range(0, len(data), PIECE):
        x = _FOLD[data[begin:begin + PIECE + 2]]  # grams that begin in the piece may end beyond it
        doc = np.searchsorted(at, np.arange(begin, begin + len(x)), side="right") - 1
        low = int(doc[0])
        code = np.zeros(len(x), np.uint32)
        for k in range(3):
            if len(x) <= k:
                break
            code = code[:len(x) - k] * np.uint32(256) + x[k:]
            place = (code * np.uint32(0x9E3779B1) + np.uint32(k * 0x45D9F3B)) >> np.uint32(20)
            own = min(PIECE, len(x) - k)
            same = doc[:own] == doc[k:k + own]
            more = np.bincount((doc[:own][same] - low) * DIM + place[:own][same].astype(np.int64))
            out[low * DIM:low * DIM + len(more)] += more
    out = np.sqrt(out.reshape(n, DIM))
    size = np.sqrt((out ** 2).sum(axis=1, keepdims=True))
    return (out / np.where(size > 0, size, 1)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a linear SVM with squared hinge loss, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x ** 2).sum(axis=1) + 0.5 / COST
    turn = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in turn.permutation(len(x)):
            step = max(a[i] - (y[i] * (x[i] @ w) - 1 + a[i] * 0.5 / COST) / norm[i], 0.0) - a[i]
            if step:
                a[i] += step
                w += step * y[i] * x[i]
    return w.astype(np.float32)


def families(x: np.ndarray, lang: np.ndarray) -> list[list[str]]:
    """Languages grouped by average linkage of their mean vectors."""
    names = sorted(set(lang))
    mean = np.array([x[lang == c].mean(axis=0) for c in names])
    mean /= np.linalg.norm(mean, axis=1, keepdims=True)
    near = mean @ mean.T
    level = near[np.triu_indices(len(names), 1)].mean() if len(names) > 1 else 1.0
    groups = [[i] for i in range(len(names))]
    while len(groups) > 1:
        best, i, j = max((near[np.ix_(a, b)].mean(), -i, -j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if best <= level:
            break
        groups[-i] = sorted(groups[-i] + groups.pop(-j))
    return [[names[i] for i in g] for g in groups]


def train(x: np.ndarray, lang: np.ndarray) -> dict:
    """Families, family weights and pair weights as plain data."""
    fams = families(x, lang)
    of = {c: k for k, f in enumerate(fams) for c in f}
    which = np.array([of[c] for c in lang])
    first = [svm(x, np.where(which == k, 1.0, -1.0)) for k in range(len(fams))] if len(fams) > 1 else []
    pairs = {}
    for f in fams:
        for i, a in enumerate(f):
            for b in f[i + 1:]:
                m = (lang == a) | (lang == b)
                pairs[a, b] = svm(x[m], np.where(lang[m] == a, 1.0, -1.0))
    return {"families": fams, "first": first, "pairs": pairs}


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row of features."""
    n, fams = len(x), model["families"]
    x = np.hstack([x, np.ones((n, 1), np.float32)])
    margin = np.full(n, 9.0)
    which = np.zeros(n, np.int64)
    if len(fams) > 1:
        s = x @ np.array(model["first"]).T
        which = s.argmax(axis=1)
        top = np.sort(s, axis=1)
        margin = (top[:, -1] - top[:, -2]) / 2
    lang = np.empty(n, object)
    for k, f in enumerate(fams):
        rows = np.flatnonzero(which == k)
        if not len(rows):
            continue
        least = np.full((len(rows), len(f)), 9.0)
        votes = np.zeros((len(rows), len(f)))
        for i, a in enumerate(f):
            for j in range(i + 1, len(f)):
                d = x[rows] @ model["pairs"][a, f[j]]
                votes[:, i] += d >= 0
                votes[:, j] += d < 0
                least[:, i] = np.minimum(least[:, i], d)
                least[:, j] = np.minimum(least[:, j], -d)
        win = (votes * 1e3 + least).argmax(axis=1)
        lang[rows] = np.array(f, object)[win]
        margin[rows] = np.minimum(margin[rows], least[np.arange(len(rows)), win])
    return lang, 1 / (1 + np.exp(-4.0 * margin))


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """The model from a bounded sample of the labelled rows that are not held out."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = max(1, sample_rows // len(counts))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    limit = F.create_map(*[x for c, n in sorted(counts.items()) for x in (F.lit(c), F.lit(min(1 << 30, (share << 30) // n + 1)))])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", row_bytes=ROW_BYTES):
                x = features(part.column("text"))
                flat = pa.Array.from_buffers(pa.binary(DIM * 4), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), flat.cast(pa.binary())], ["doc_id", "lang", "x"])

    got = (rows.filter(draw < limit[F.col("lang")])
           .select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text")
           .mapInArrow(run, "doc_id string, lang string, x binary").collect())
    if not got:
        return None
    got.sort(key=lambda r: (r.lang, r.doc_id, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float32) for r in got])
    return train(x, np.array([r.lang for r in got], object))


def identify(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang)`` -> doc_id, held_out, lang_pred, score."""
    model = learn(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            for part in slices(batch, "text", row_bytes=ROW_BYTES):
                letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                lang, score = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
                if m is not None and letters.any():
                    lang[letters], score[letters] = predict(m, features(part.column("text").filter(pa.array(letters))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                                                 ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
