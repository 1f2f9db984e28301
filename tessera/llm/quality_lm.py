"""Quality classifier (operator 6): interpolated modified Kneser-Ney n-gram model.

The model is trained on trusted text, the documents labelled quality = 1, over symbols: the 63
most frequent characters of trusted text are one symbol each; every other character is spelled, as
symbol 0 and its code point in base 64, so no two characters are taken for one. Counts
of all 4-grams of all trusted text are gathered by a partial aggregate, and from them the
alphabet; continuation counts,
context sums and the three discounts of each order follow by aggregates and joins of count tables
sharded by n-gram. Documents are scored by joins with these tables, which no task and no driver holds:
documents are dealt into slices of about ``SLICE`` bytes of text, every slice names its distinct
n-grams, these are joined once each with the four orders' tables, and every slice gets the log
probabilities of its own n-grams back. Joining every character of every document would shuffle
several times the input; so texts are moved once.

A document's score is its nats per character, shrunk towards its language's mean as if ``PRIOR``
characters of that mean were added, so that short texts are not judged by a few characters.
A fifth of the trusted documents, by a hash of doc_id, is held out of training; per language the
``QUANTILE`` quantile of their scores, plus ``MARGIN``, is the highest score that is kept. A
language with fewer than ``MIN_HELD`` held-out documents, or null, uses all languages' values; without trusted
text every document is kept. Languages' values stay in a table that is joined: broadcast up to
``MAX_LANGUAGES`` languages, by a plain join beyond.

Null texts and texts of white space only have no perplexity and are rejected. Repeated rows get
equal results; of repeated labels one with quality = 1 makes a document trusted. Extra columns
pass through. Empty tables give no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bitmap, maybe_in
from .common import cut, slices

ORDER, SYMBOLS = 4, 64
BITS, DIGITS = 6, 4  # a spelled character's digits have BITS bits; DIGITS of them hold any code point
QUANTILE, MARGIN, PRIOR, MIN_HELD = 0.999, 0.03, 60, 30
MAX_LANGUAGES = 1000
SLICE = 8 << 20


def _points(texts: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts.to_pylist()]


def _grams(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """The four code points of the 4-gram that ends at every character of all texts, and where each
    text begins. The first characters of a text follow ``ORDER - 1`` line breaks."""
    pad = np.full(ORDER - 1, 10, np.uint32)
    cps = _points(texts)
    s = np.concatenate([x for c in cps for x in (pad, c)]) if cps else pad
    size = np.array([len(c) for c in cps], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    end = np.arange(at[-1]) + np.repeat((np.arange(len(cps)) + 1) * (ORDER - 1), size)
    return [s[end - k] for k in range(ORDER - 1, -1, -1)], at


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled quality = 1, with ``held`` for the fifth kept out of training.

    The join shuffles at every size, as labels grow with the documents."""
    good = cut(labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return (maybe_in(rows, "doc_id", bitmap(good, "doc_id")).join(good.hint("merge"), "doc_id")
            .withColumn("held", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5)) == 0))


def _counts(text: DataFrame) -> DataFrame:
    """(c0, c1, c2, c3, n): how often each 4-gram of code points occurs in all texts."""
    def run(batches):
        code = np.zeros(0x110000, np.uint64)
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                gram, at = _grams(part.column("text"))
                own = np.unique(np.concatenate([gram[-1], [10]]))
                # a piece's own characters, numbered in 16 bits; pieces are short where there are more
                step = max(1, int(at[-1])) if len(own) < 1 << 16 else 16_000
                for i in range(0, int(at[-1]), step):
                    piece = [g[i:i + step] for g in gram]
                    if step == 16_000:
                        own = np.unique(np.concatenate(piece))
                    code[own] = np.arange(len(own), dtype=np.uint64)
                    packed = np.zeros(len(piece[0]), np.uint64)
                    for g in piece:
                        packed = packed << np.uint64(16) | code[g]
                    packed, n = np.unique(packed, return_counts=True)
                    c = [own[(packed >> np.uint64(16 * (ORDER - 1 - k)) & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int32) for k in range(ORDER)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, c), pa.array(n.astype(np.int64))], ["c0", "c1", "c2", "c3", "n"])

    return (text.select("text").mapInArrow(run, "c0 int, c1 int, c2 int, c3 int, n long")
            .groupBy("c0", "c1", "c2", "c3").agg(F.sum("n").alias("n")))


def _spelled(symbol: Column, c: str) -> Column:
    """A character's symbols: its own one, or 0 and the digits of its code point."""
    own = F.element_at(symbol, F.col(c))
    digits = [F.shiftright(F.col(c), BITS * k).bitwiseAND(F.lit(SYMBOLS - 1)) for k in range(DIGITS - 1, -1, -1)]
    return F.when(own.isNotNull(), F.array(own)).otherwise(F.array(F.lit(0), *digits))


def _symbol_grams(raw: DataFrame, symbols: list[int]) -> DataFrame:
    """(g, n): counts of 4-grams of symbols. Each ends in one of the last character's symbols; as every
    character has a symbol or more, the three before it lie within the character 4-gram."""
    symbol = F.create_map(*[F.lit(x) for i, c in enumerate(symbols) for x in (c, i + 1)])
    before = F.slice(F.concat(*[_spelled(symbol, f"c{k}") for k in range(ORDER - 1)]), 1 - ORDER, ORDER - 1)
    rows = raw.select("n", F.concat(before, _spelled(symbol, f"c{ORDER - 1}")).alias("s"))
    rows = rows.select("n", "s", F.explode(F.sequence(F.lit(0), F.size("s") - ORDER)).alias("i"))
    g = sum((F.get("s", F.col("i") + k).cast("long") * SYMBOLS ** (ORDER - 1 - k) for k in range(ORDER)), F.lit(0))
    return rows.groupBy(g.alias("g")).agg(F.sum("n").alias("n"))


class Model(dict):
    """The finished model: ``symbols``, and ``tables`` per order: shares (g, a) of n-grams and left-over
    weights (h, w) of contexts, as DataFrames. ``model[k]`` collects an order for those who want to look at it."""

    def __init__(self, symbols: list[int], tables: dict[int, tuple[DataFrame, DataFrame]]):
        super().__init__(symbols=symbols)
        self.tables = tables

    def __missing__(self, k: int) -> tuple[np.ndarray, ...]:
        a, w = (t.toPandas() for t in self.tables[k])
        self[k] = (a["g"].to_numpy(np.int64), a["a"].to_numpy(np.float32), w["h"].to_numpy(np.int64), w["w"].to_numpy(np.float32))
        return self[k]


def train(text: DataFrame) -> Model | None:
    """Tables of the model: per order the discounted shares and each context's left-over weight."""
    raw = cut(_counts(text))
    top = raw.groupBy("c3").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c3").limit(SYMBOLS - 1).collect()
    if not top:
        return None
    symbols = [r.c3 for r in top]
    counts = {ORDER: cut(_symbol_grams(raw, symbols))}
    for k in range(ORDER - 1, 0, -1):  # in how many different contexts to the left an n-gram is seen
        counts[k] = cut(counts[k + 1].groupBy((F.col("g") % SYMBOLS ** k).alias("g")).agg(F.count("*").alias("n")))
    tables = {}
    for k in range(1, ORDER + 1):
        seen = counts[k].agg(*[F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (x or 0 for x in seen)
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [min(max(i - (i + 1) * y * b / a, 0.05), i) if a else 0.5 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        c = counts[k].withColumn("h", F.floor(F.col("g") / SYMBOLS)).withColumn("off", off)
        sums = cut(c.groupBy("h").agg(F.sum("n").alias("all"), F.sum("off").alias("left")))
        share = c.join(sums, "h").select("g", ((F.col("n") - F.col("off")) / F.col("all")).cast("float").alias("a"))
        tables[k] = cut(share), sums.select("h", (F.col("left") / F.col("all")).cast("float").alias("w"))
    return Model(symbols, tables)


def log_prob(model: dict) -> np.ndarray:
    """Log probability of each 4-gram's last symbol after its first three, for all 64^4 of them.

    The plain form of ``_probs`` in one array, to look at a model as a whole; documents are scored by
    ``_probs``. It is worked out in place: no second table of its size."""
    p = np.full(1, 1.0 / SYMBOLS, np.float32)
    for k in range(1, ORDER + 1):
        g, a, h, w = model[k]
        left = np.ones(SYMBOLS ** (k - 1), np.float32)
        left[h] = w
        # lower order: drop the first symbol of the context
        low = p.reshape(1, -1, SYMBOLS) if k > 1 else np.full((1, 1, SYMBOLS), p[0], np.float32)
        p = np.multiply(left.reshape(-1, low.shape[1], 1), low).ravel()
        p[g] += a
    return np.log(p, out=p)


@lru_cache(1)
def _spelling(symbols: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Every code point's symbols in a row of 1 + DIGITS, and how many of them count."""
    c = np.arange(0x110000, dtype=np.int32)
    spell = np.zeros((len(c), 1 + DIGITS), np.uint8)
    for k in range(DIGITS):
        spell[:, 1 + k] = c >> BITS * (DIGITS - 1 - k) & (SYMBOLS - 1)
    length = np.full(len(c), 1 + DIGITS, np.uint8)
    spell[list(symbols), 0] = np.arange(1, len(symbols) + 1)
    length[list(symbols)] = 1
    return spell, length


def _codes(texts: pa.Array, spell: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbol 4-gram that ends at every symbol of all texts, where each text's begin, and the
    texts' characters. The first characters of a text follow ``ORDER - 1`` line breaks."""
    pad = np.full(ORDER - 1, 10, np.uint32)
    cps = _points(texts)
    s = np.concatenate([x for c in cps for x in (pad, c)]) if cps else pad
    size = np.array([len(c) for c in cps], np.int64)
    n = length[s]
    symbols = spell[s][np.arange(1 + DIGITS, dtype=np.uint8) < n[:, None]]
    code = np.zeros(len(symbols), np.int32)
    for k in range(ORDER):
        code[ORDER - 1:] = code[ORDER - 1:] * SYMBOLS + symbols[k:len(symbols) - (ORDER - 1) + k]
    own = np.ones(len(s), bool)  # characters that are no line break in front of a text
    begin = np.concatenate([[0], np.cumsum(size + ORDER - 1)[:-1]]).astype(np.int64) if len(size) else size
    for k in range(ORDER - 1):
        own[begin + k] = False
    upto = np.concatenate([[0], np.cumsum(n * own, dtype=np.int64)])
    return code[np.repeat(own, n)], upto[np.append(begin, len(s))], size


def _probs(grams: DataFrame, model: Model) -> DataFrame:
    """``grams(g, ...)``, a row for each 4-gram of symbols, plus ``p``, the probability of its last symbol
    after its first three: every order's share of the n-gram, and its context's left-over weight times
    the next lower order, by joins with the sharded tables."""
    p = F.lit(1.0 / SYMBOLS).cast("float")
    out = grams
    for k in range(1, ORDER + 1):
        share, left = model.tables[k]
        own, context = F.col("g") % SYMBOLS ** k, F.floor((F.col("g") % SYMBOLS ** k) / SYMBOLS)
        # the tables of orders 1 and 2 have 64^2 rows at most
        a, w = ((F.broadcast(t) if k <= 2 else t) for t in (share.select(F.col("g").alias("own"), F.col("a").alias(f"a{k}")),
                                                            left.select(F.col("h").alias("context"), F.col("w").alias(f"w{k}"))))
        out = out.withColumn("own", own).join(a, "own", "left").drop("own")
        out = out.withColumn("context", context).join(w, "context", "left").drop("context")
        p = F.coalesce(f"w{k}", F.lit(1.0).cast("float")) * p + F.coalesce(f"a{k}", F.lit(0.0).cast("float"))
    return out.select(*grams.columns, p.alias("p"))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` plus __nats and __chars of the whole text.

    Rows are dealt into slices by hash and moved once; both readers of a slice take them from there."""
    symbols = tuple(model["symbols"])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // SLICE) or 1
    deal = F.pmod(F.xxhash64(F.lit(6), "doc_id", "text"), F.lit(n)).cast("int")
    # as many tasks as slices, so that a task's share does not grow with the input
    rows = docs.withColumn("__slice", deal).repartition(max(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "__slice")

    def distinct(key, table):
        seen = np.zeros(SYMBOLS ** ORDER, bool)
        spell, length = _spelling(symbols)
        for batch in table.to_batches():
            for part in slices(batch, "text", 1 << 18):
                seen[_codes(part.column("text"), spell, length)[0]] = True
        g = np.flatnonzero(seen)
        return pa.table({"g": pa.array(g), "__slice": pa.array(np.full(len(g), key[0].as_py(), np.int32))})

    def summed(key, table, own):
        lp = np.zeros(SYMBOLS ** ORDER, np.float32)  # of the slice's n-grams only; other places are not read
        g, p = (own.column(c).combine_chunks().flatten().to_numpy() for c in ("g", "p"))
        lp[g] = np.log(p)
        spell, length = _spelling(symbols)
        out = []
        for batch in table.drop_columns("__slice").to_batches():
            for part in slices(batch, "text", 1 << 18):
                code, at, size = _codes(part.column("text"), spell, length)
                total = np.concatenate([[0.0], np.cumsum(-lp[code], dtype=np.float64)])
                out.append(pa.RecordBatch.from_arrays([*part.columns, pa.array(total[at[1:]] - total[at[:-1]]), pa.array(size)],
                                                      [*part.schema.names, "__nats", "__chars"]))
        return pa.Table.from_batches(out)

    grams = rows.groupBy("__slice").applyInArrow(distinct, "g long, __slice int")
    grams = _probs(grams.groupBy("g").agg(F.collect_list("__slice").alias("in")), model)
    own = (grams.select(F.explode("in").alias("__slice"), "g", "p").groupBy("__slice")
           .agg(F.collect_list(F.col("g").cast("int")).alias("g"), F.collect_list("p").alias("p")))
    schema = docs.limit(0).withColumn("__nats", F.lit(0.0)).withColumn("__chars", F.lit(0).cast("long")).schema
    return rows.groupBy("__slice").cogroup(own.groupBy("__slice")).applyInArrow(summed, schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus perplexity, score, limit and kept."""
    good = trusted(docs, labels)
    model = train(good.filter("NOT held"))
    blank = ~F.coalesce(F.col("text").rlike(r"[^\s\p{Z}]"), F.lit(False))
    if model is None:
        return docs.select("*", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("score"),
                           F.lit(None).cast("double").alias("limit"), (~blank).alias("kept"))
    held = cut(good.filter("held"))
    seen = cut(scores(held, model).filter("__chars > 0").select("lang", "__nats", "__chars"))
    every = seen.agg(F.sum("__nats") / F.sum("__chars")).first()[0]
    if every is None:  # no held-out text: judge by the training text itself
        seen = cut(scores(good, model).filter("__chars > 0").select("lang", "__nats", "__chars"))
        every = seen.agg(F.sum("__nats") / F.sum("__chars")).first()[0]
    del held  # its checkpoint goes with the next cut
    means = cut(seen.filter("lang IS NOT NULL").groupBy("lang").agg((F.sum("__nats") / F.sum("__chars")).alias("__mean"), F.count("*").alias("n"))
                .filter(F.col("n") >= MIN_HELD).drop("n"))
    few = means.count() <= MAX_LANGUAGES
    by_lang = lambda rows, values: rows.join(F.broadcast(values) if few else values, "lang", "left")
    mean = F.coalesce("__mean", F.lit(float(every)))
    score = (F.col("__nats") + PRIOR * mean) / (F.col("__chars") + PRIOR)
    seen = cut(by_lang(seen, means).withColumn("score", score))
    q = F.percentile_approx("score", F.lit(QUANTILE), F.lit(10_000))
    limits = cut(seen.filter("__mean IS NOT NULL").groupBy("lang").agg(F.first("__mean").alias("__mean"), (q * F.lit(1 + MARGIN)).alias("__limit")))
    limit = F.coalesce("__limit", F.lit(float(seen.agg(q).first()[0] * (1 + MARGIN))))
    out = by_lang(scores(docs, model), limits)
    has = F.col("__chars") > 0
    return (out.select(*docs.columns, F.when(has, F.exp(F.col("__nats") / F.col("__chars"))).alias("perplexity"),
                       F.when(has, score).alias("score"), limit.alias("limit"),
                       (~blank & has & (score <= limit)).alias("kept")))
