"""Suffix-array dedup (operator 4): sparse suffix arrays over words.

A passage of ``MIN_WORDS`` words or more that occurs at two places is found at each of them. In
every window of ``WINDOW`` consecutive ``GRAM``-word grams the place of the least gram hash is
retained, so two equal passages retain the same place within their first ``WINDOW`` words, and
the suffixes there agree for ``KEY`` words or more: that is the key. Suffixes with a key of their
own end there. A suffix's context is the ``MIN_WORDS`` words from its place on and the ``WINDOW - 1``
words before it. Equal contexts with equal keys are one class with a count.

The classes of keys that have several are sorted by key and words to the right, and again by key
and words to the left, in ranges over all tasks. Neighbours are compared, over task borders too,
and a match is extended to the left and to the right. Each class is compared with the most frequent one of its key
as well. A span of ``MIN_WORDS`` words or more that two classes share is a repeat. The longest match to
either side bounds what else may be shared; windows within these bounds that no comparison has
shown are hashed and counted, so partners that are neighbours on neither side are found as well.
Nothing depends on the size of a key's group. Overlapping spans of a document are joined.

Words are runs without ASCII white space, case kept. Null texts and texts of fewer than
``MIN_WORDS`` words have no span. A repeat inside one document counts as well. Repeated rows are
copies of each other; rows with one doc_id and different texts share that id's spans. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, grams, mix64, slices, word_hashes

MIN_WORDS, GRAM, WINDOW = 50, 8, 32
KEY, LEFT = MIN_WORDS - WINDOW + 1, WINDOW - 1
RIGHT = MIN_WORDS - KEY  # words of the context after the key, which need not be carried
PLACES_HELD = 20_000
# windows by how many words before the place they begin: those of one part share its least number of words
# to the left and RIGHT less its greatest to the right (0 and LEFT are always found by sorting)
PARTS = ((1, 7), (8, 15), (16, 23), (24, LEFT - 1))
_TIMES = mix64(np.arange(1, LEFT + MIN_WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def least_places(hashes: np.ndarray) -> np.ndarray:
    """For each run of ``WINDOW`` grams of all words, the place of its least gram."""
    g = grams(hashes, GRAM)
    if len(g) < WINDOW:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    parts = [view[a:a + (1 << 16)].argmin(axis=1) for a in range(0, len(view), 1 << 16)]
    return np.concatenate(parts) + np.arange(len(view))


def retained(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Retained places (in the run of all words) and the number of the text of each."""
    places = least_places(hashes)
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.arange(len(places))
    text = np.searchsorted(starts, first, side="right") - 1
    inside = first + WINDOW + GRAM - 1 <= starts[text + 1]
    at, where = np.unique(places[inside], return_index=True)
    text = text[inside][where]
    fits = at + KEY <= starts[text + 1]
    return at[fits], text[fits]


def _context(hashes: np.ndarray, starts: np.ndarray, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Words from each place on, then words before it, nearest first; 0 where the text has no more."""
    step = np.concatenate([np.arange(MIN_WORDS), -1 - np.arange(LEFT)])
    place = at[:, None] + step[None, :]
    inside = (place >= starts[text][:, None]) & (place < starts[text + 1][:, None])
    out = np.zeros(place.shape, np.uint64)
    out[inside] = hashes[place[inside]]
    return out


def _suffixes(batches):
    """(doc_id, text) -> key, context hash, doc_id, pos, words of context right and left, per retained place."""
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, starts = word_hashes(part.column("text"), lower=False)
            every, texts = retained(hashes, starts)
            keys = grams(hashes, KEY) if len(every) else np.zeros(0, np.uint64)
            for i in range(0, len(every), PLACES_HELD):
                at, text = every[i:i + PLACES_HELD], texts[i:i + PLACES_HELD]
                around = mix64((_context(hashes, starts, at, text) * _TIMES).sum(axis=1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at].view(np.int64)), pa.array(around.view(np.int64)), part.column("doc_id").take(pa.array(text)),
                     pa.array((at - starts[text]).astype(np.int32)), pa.array(np.minimum(starts[text + 1] - at, MIN_WORDS).astype(np.int32)),
                     pa.array(np.minimum(at - starts[text], LEFT).astype(np.int32))],
                    ["key", "ctx", "doc_id", "pos", "r", "l"])


def _fixed(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _contexts(batches):
    """(doc_id, text, places) -> key, ctx, words after the key and before the place as bytes, and a hash
    of the words that equal windows of each part share."""
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, starts = word_hashes(part.column("text"), lower=False)
            lists = part.column("places")
            place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            every = place + starts[texts]
            fits = every + KEY <= starts[texts + 1]  # rows of one doc_id may differ in their texts
            every, texts = every[fits], texts[fits]
            keys = grams(hashes, KEY) if len(every) else np.zeros(0, np.uint64)
            for i in range(0, len(every), PLACES_HELD):
                at = every[i:i + PLACES_HELD]
                words = _context(hashes, starts, at, texts[i:i + PLACES_HELD])
                around = mix64((words * _TIMES).sum(axis=1, dtype=np.uint64))
                shared = []
                for n, (low, high) in enumerate(PARTS):
                    columns = np.r_[KEY:KEY + RIGHT - high, MIN_WORDS:MIN_WORDS + low]
                    shared.append(mix64((words[:, columns] * _TIMES[columns]).sum(axis=1, dtype=np.uint64) + mix64(keys[at] + np.uint64(n))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at].view(np.int64)), pa.array(around.view(np.int64)), _fixed(words[:, KEY:MIN_WORDS]), _fixed(words[:, MIN_WORDS:]),
                     *(pa.array(x.view(np.int64)) for x in shared)],
                    ["key", "ctx", "right", "left", *(f"part{n}" for n in range(len(PARTS)))])


def _words(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each two rows of words."""
    other = np.concatenate([(a != b) | (a == 0), np.ones((len(a), 1), bool)], axis=1)
    return other.argmax(axis=1).astype(np.int32)


def _marks(key: np.ndarray, ctxs: list[np.ndarray], r: np.ndarray, l: np.ndarray) -> pa.RecordBatch:
    """Rows key, ctx, r, l, near, far; near and far (null where nothing is shown) are the least and the
    greatest distance of a shared window's begin before the place."""
    near, far = MIN_WORDS - r, l
    none = near > far
    two = lambda x, t=np.int32: np.concatenate([x.astype(t)] * len(ctxs))
    return pa.RecordBatch.from_arrays(
        [pa.array(two(key, np.int64)), pa.array(np.concatenate(ctxs)), pa.array(two(r)), pa.array(two(l)),
         pa.array(two(near), mask=two(none, bool)), pa.array(two(far), mask=two(none, bool))], ["key", "ctx", "r", "l", "near", "far"])


MARKS = "key long, ctx long, r int, l int, near int, far int"


def _with_hub(batches):
    """Each class against the most frequent class of its key (hub_right, hub_left)."""
    for batch in batches:
        if batch.num_rows:
            r = KEY + _agree(_words(batch.column("right"), RIGHT), _words(batch.column("hub_right"), RIGHT))
            l = _agree(_words(batch.column("left"), LEFT), _words(batch.column("hub_left"), LEFT))
            yield _marks(batch.column("key").to_numpy(), [batch.column("ctx").to_numpy()], r, l)


def _sorted_marks(wide: DataFrame, first: str, second: str) -> DataFrame:
    """Classes sorted by key and context, each compared with its neighbours.

    The last row of each range, one per task, goes through the driver to the next range."""
    n = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(wide.select("key", first, second, "ctx").repartitionByRange(n, "key", first, second)
               .sortWithinPartitions("key", first, second).withColumn("part", F.spark_partition_id()))
    ends = sorted((x.part, x.end) for x in rows.groupBy("part").agg(F.max(F.struct("key", first, second, "ctx")).alias("end")).collect())
    before = {part: (end.key, bytes(end["right"]), bytes(end["left"]), end.ctx) for (_, end), (part, _) in zip(ends, ends[1:])}
    held = wide.sparkSession.sparkContext.broadcast(before)

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                last = held.value.get(batch.column("part")[0].as_py())
            key, ctx = batch.column("key").to_numpy(), batch.column("ctx").to_numpy()
            right, left = _words(batch.column("right"), RIGHT), _words(batch.column("left"), LEFT)
            if last is not None:
                key, ctx = np.concatenate([[last[0]], key]), np.concatenate([[last[3]], ctx])
                right = np.concatenate([np.frombuffer(last[1], np.uint64)[None, :], right])
                left = np.concatenate([np.frombuffer(last[2], np.uint64)[None, :], left])
            at = np.flatnonzero(key[1:] == key[:-1])
            if len(at):
                yield _marks(key[at], [ctx[at], ctx[at + 1]], KEY + _agree(right[at], right[at + 1]), _agree(left[at], left[at + 1]))
            last = key[-1], right[-1].tobytes(), left[-1].tobytes(), ctx[-1]

    return rows.mapInArrow(run, MARKS)


def _windows(batches):
    """Windows that begin as many words before the place as ``asked`` has bits -> key, ctx, back, window
    hash, and whether the class's own bits in ``open`` lack it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = np.concatenate([_words(batch.column("left"), LEFT)[:, ::-1], _words(batch.column("right"), RIGHT)], axis=1)
        key, ctx = batch.column("key").to_numpy(), batch.column("ctx").to_numpy()
        asked, lacks = batch.column("asked").to_numpy(), batch.column("open").to_numpy()
        for back in range(WINDOW):
            at = np.flatnonzero(asked >> back & 1)
            if len(at):
                # the key's words lie between the two parts; its hash stands for them
                window = (words[at, LEFT - back:LEFT - back + RIGHT] * _TIMES[:RIGHT]).sum(axis=1, dtype=np.uint64)
                window = mix64(window + mix64(key[at].view(np.uint64) + np.uint64(back)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at]), pa.array(ctx[at]), pa.array(np.full(len(at), back, np.int32)), pa.array(window.view(np.int64)), pa.array(lacks[at] >> back & 1 == 1)],
                    ["key", "ctx", "back", "window", "open"])


def _bits(low, high):
    """A long with the bits from ``low`` to ``high``, none where low is the greater or null."""
    one = F.lit(1).cast("long")
    return F.coalesce(F.when(low <= high, F.call_function("shiftleft", one, (high + 1).cast("int")) - F.call_function("shiftleft", one, low.cast("int"))), F.lit(0).cast("long"))


def _merged(marks: DataFrame) -> DataFrame:
    return marks.groupBy("key", "ctx").agg(F.max("r").alias("r"), F.max("l").alias("l"), F.min("near").alias("near"), F.max("far").alias("far"))


def _mixed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Shared spans (MARKS, one row per class) between different classes of a key."""
    several = classes.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    classes = cut(classes.join(several, "key"))
    places = classes.groupBy(F.col("rep.doc_id").alias("doc_id")).agg(F.sort_array(F.collect_set("rep.pos")).alias("places"))
    wide = (rows.join(places, "doc_id").mapInArrow(_contexts, "key long, ctx long, right binary, left binary, part0 long, part1 long, part2 long, part3 long")
            .dropDuplicates(["key", "ctx"]).join(classes.select("key", "ctx", "n"), ["key", "ctx"]))
    wide = cut(wide)
    # the hub's place in the order of classes is fixed by its count and hash, so reruns agree
    top = wide.groupBy("key").agg(F.max(F.struct("n", "ctx")).alias("top")).select("key", F.col("top.ctx").alias("ctx"))
    hub = wide.join(top, ["key", "ctx"]).select("key", F.col("ctx").alias("hub"), F.col("right").alias("hub_right"), F.col("left").alias("hub_left"))
    by_hub = wide.join(hub, "key").filter("ctx != hub").select("key", "ctx", "right", "left", "hub", "hub_right", "hub_left")
    both = (by_hub.mapInArrow(_with_hub, MARKS)
            .unionByName(_sorted_marks(wide, "right", "left")).unionByName(_sorted_marks(wide, "left", "right")))
    # copies of a class share its whole context
    own = classes.filter("n > 1").select("key", "ctx", "r", "l", (F.lit(MIN_WORDS) - F.col("r")).alias("near"), F.col("l").alias("far"))
    marks = cut(_merged(both.unionByName(own.filter("near <= far"))))
    # bits of the windows that may be shared, and of those that no comparison has shown
    may = _bits(F.lit(MIN_WORDS) - F.col("r"), F.col("l"))
    bits = marks.select("key", "ctx", may.alias("may"), may.bitwiseAND(F.bitwise_not(_bits(F.col("near"), F.col("far")))).alias("open"))
    wanted = bits.filter("open != 0").groupBy("key").agg(F.bit_or("open").alias("wanted"))
    bits = bits.join(wanted, "key").filter("may & wanted != 0").drop("wanted")
    bits = cut(bits.join(wide.select("key", "ctx", *(f"part{n}" for n in range(len(PARTS)))), ["key", "ctx"]))
    tried = None
    for n, (low, high) in enumerate(PARTS):  # partners of a lacking window share its part's words
        part, mask = f"part{n}", F.lit((1 << high + 1) - (1 << low)).cast("long")
        lacks = F.col("open").bitwiseAND(mask)
        ask = bits.filter(lacks != 0).groupBy(part).agg(F.bit_or(lacks).alias("wanted"))
        one = bits.join(ask, part).select("key", "ctx", F.col("may").bitwiseAND(F.col("wanted")).alias("asked"), "open").filter("asked != 0")
        tried = one if tried is None else tried.unionByName(one)
    tried = tried.groupBy("key", "ctx").agg(F.bit_or("asked").alias("asked"), F.max("open").alias("open"))
    windows = cut(wide.join(tried, ["key", "ctx"]).select("key", "ctx", "right", "left", "asked", "open")
                  .mapInArrow(_windows, "key long, ctx long, back int, window long, open boolean"))
    # only classes that lack a window ask for it, so a window that many share is not joined back to all
    twice = windows.groupBy("window").agg(F.count("*").alias("n"), F.max("open").alias("open")).filter("n > 1 AND open").select("window")
    shown = (windows.filter("open").join(twice, "window")
             .select("key", "ctx", F.lit(0).alias("r"), F.lit(0).alias("l"), F.col("back").alias("near"), F.col("back").alias("far")))
    return _merged(marks.unionByName(shown))


def find(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, begin_word, end_word (exclusive), n_words: one row per joined span."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text IS NOT NULL AND doc_id IS NOT NULL")
    suffixes = rows.mapInArrow(_suffixes, "key long, ctx long, doc_id long, pos int, r int, l int")
    often = cut(suffixes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"))
    members = cut(suffixes.join(often, "key"))
    classes = cut(members.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.max("r").alias("r"), F.max("l").alias("l"),
                                                    F.min(F.struct("doc_id", "pos")).alias("rep")))
    whole = classes.filter((F.col("n") > 1) & (F.col("r") + F.col("l") >= MIN_WORDS)).select(
        "key", "ctx", (F.lit(MIN_WORDS) - F.col("r")).alias("near"), F.col("l").alias("far"))
    shared = _mixed(rows, classes).filter("near IS NOT NULL").select("key", "ctx", "near", "far")
    # cut, so that the join's sides are plain shuffles and a class of many members can be split
    spans = cut(whole.unionByName(shared).groupBy("key", "ctx").agg(F.min("near").alias("near"), F.max("far").alias("far")))
    spans = (members.join(spans, ["key", "ctx"])
             .select("doc_id", (F.col("pos") - F.col("far")).cast("long").alias("begin_word"),
                     (F.col("pos") - F.col("near") + MIN_WORDS).cast("long").alias("end_word")).distinct())
    w = Window.partitionBy("doc_id").orderBy("begin_word", "end_word")
    far = F.max("end_word").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (spans.withColumn("new", F.coalesce(F.col("begin_word") > far, F.lit(True)).cast("int"))
            .withColumn("no", F.sum("new").over(w))
            .groupBy("doc_id", "no").agg(F.min("begin_word").alias("begin_word"), F.max("end_word").alias("end_word"))
            .select("doc_id", "begin_word", "end_word", (F.col("end_word") - F.col("begin_word")).alias("n_words")))
