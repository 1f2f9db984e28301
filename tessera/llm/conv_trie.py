"""Conversation prefix trie (operator 11) by van Emde Boas recursion over turn sequences.

A node of depth d is a distinct sequence of the first d turns; its name is (d, least member), so
names need no dictionary. The trie is never walked turn by turn:

1. Turns get 120-bit digests; blocks of 2, 4, 8, ... turns are named from their halves.
2. ``name_prefixes``: a problem is a trie of sequences below a root, at most 2s turns deep. All
   problems of one depth are worked on at once: every sequence is cut after s turns, equal pairs
   (root, block of s turns) are one cut prefix, named by its least member. The distinct cut prefixes
   with the sequences that end before the cut are the upper trie, the rests below each cut prefix
   a lower forest; both are problems of half the depth. The log2 of the greatest length is the
   number of rounds, and a prefix that many sequences share goes on as one weighted sequence.
3. ``graft``: subtree totals of blocks of 2s levels are those of the upper s levels plus what the
   lower forests add at the cut, from s = 1 upward; then totals of the whole subtree go back down
   from the greatest s to all nodes. Each round is one join by name and one sum.

A root or a cut prefix may have a third of all sequences below it: equal pairs are counted by
partial aggregates and joined back by an equi-join that AQE can split; blocks are dealt by
(conversation, block), so one endless conversation is spread as well. Lists of member ids are built
from bounded pieces and digested as a stream.

``rebuild`` gives the sequences: turns in the order (turn, role, text), null turn first, null role
and text as empty texts, equal rows as turns of their own. Rows without conv_id belong to no
conversation and are left out. Extra columns are ignored. An empty table has no members, so no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import ensure_checkpoint_dir

GROUP, MOD = 5, 9  # conversations of a group share their leader's head; heads have fewer than MOD turns
PIECE_BITS = 12  # ids of one piece of a member list differ in these last bits only
_UNIT = ["d0", "d1"]


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared checkpoint folder: rounds are many and small, so nothing else is done here."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _digest(text: Column) -> list[Column]:
    """Two 60-bit halves of a text's MD5."""
    hexes = F.md5(text.cast("binary"))
    return [F.conv(F.substring(hexes, at, 15), 16, 10).cast("long").alias(n) for at, n in ((1, "d0"), (16, "d1"))]


def number_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, d0, d1, n_bytes: one row per turn, numbered from 0 within its conversation.

    Rows are range-partitioned by their whole order, so a conversation of any length is spread over
    tasks; only (conversation, partition) counts meet in a window.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    unit = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                 .select("conv_id", *_digest(unit), F.octet_length("text").cast("long").alias("n_bytes"),
                         F.monotonically_increasing_id().alias("id")))
    placed = placed.withColumn("part", F.shiftright("id", 33))
    parts = placed.groupBy("conv_id", "part").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("id") - F.col("first") + F.col("before")).alias("pos"), *_UNIT, "n_bytes")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of the rebuilt conversations: conv_id, pos, d0, d1, n_bytes and conv_id, n.

    The head of conversation c is the first h turns of its group's leader, c - c % GROUP; its own
    turns after its first h follow.
    """
    turns = cut(number_turns(conversations))
    c = F.col("conv_id")
    size = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    size = size.select("conv_id", "own", (c - c % GROUP).alias("leader"), (F.crc32(c.cast("string").cast("binary")) % MOD).alias("h"))
    leaders = size.select(F.col("conv_id").alias("leader"), F.col("own").alias("there"))
    size = cut(size.join(leaders, "leader", "left").withColumn("head", F.least("h", F.coalesce("there", F.lit(0)))))
    own = turns.join(size, "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), *_UNIT, "n_bytes")
    heads = (turns.filter((c % GROUP == 0) & (F.col("pos") < MOD - 1)).withColumnRenamed("conv_id", "leader")
             .withColumn("conv_id", F.explode(F.sequence(F.col("leader") - (GROUP - 1), F.col("leader") + (GROUP - 1))))
             .filter(c - c % GROUP == F.col("leader"))
             .join(size.select("conv_id", "h"), "conv_id").filter("pos < h").select("conv_id", "pos", *_UNIT, "n_bytes"))
    return own.unionByName(heads), size.select("conv_id", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))


def name_blocks(turns: DataFrame, top: int) -> dict[int, DataFrame]:
    """For each power of two s up to ``top``: (conv_id, k, d0, d1) of the whole blocks [k * s, (k + 1) * s)."""
    blocks, s = {1: turns.select("conv_id", F.col("pos").alias("k"), *_UNIT)}, 1
    while s < top:
        half = lambda odd, d: F.max(F.when(F.col("k") % 2 == odd, F.col(d)))
        pair = (blocks[s].groupBy("conv_id", F.shiftright("k", 1).alias("k2"))
                .agg(*[half(odd, d).alias(f"{d}{odd}") for odd in (0, 1) for d in _UNIT])
                .filter("d01 IS NOT NULL"))
        s *= 2
        blocks[s] = cut(pair.select("conv_id", F.col("k2").alias("k"), *_digest(F.concat_ws(",", "d00", "d10", "d01", "d11"))))
    return blocks


def name_prefixes(blocks: dict[int, DataFrame], lengths: DataFrame, root: int, top: int) -> tuple[dict[int, DataFrame], DataFrame]:
    """(steps, ends): for each s the nodes at multiples of s with their ancestor s levels above, and where members end.

    ``steps[s]``: (o, root, conv, w): node (o + s, conv) with w members, below node (o, root).
    ``ends``: (depth, node, conv_id).
    """
    steps, ends = {}, []
    whole = None  # (o, root, conv, w): full-length sequences, each a node of its own
    rest = lengths.filter("n > 0").select(F.lit(0).cast("long").alias("o"), F.lit(root).cast("long").alias("root"),
                                          F.col("conv_id").alias("conv"), F.col("n").alias("left"))
    s = top
    while s >= 1:
        items = rest.filter(F.col("left") >= s).select("o", "root", "conv", F.lit(1).cast("long").alias("w"), "left")
        if whole is not None:
            items = items.unionByName(whole.withColumn("left", F.lit(None).cast("long")))
        block = blocks[s].filter(F.col("k") % 2 == 0).select(F.col("conv_id").alias("conv"), (F.col("k") * s).alias("o"), *_UNIT)
        held = items.join(block, ["conv", "o"])
        # cut here, so that the join back has plain exchanges on both sides, which AQE can split at a hot prefix
        names = cut(held.groupBy("o", "root", *_UNIT).agg(F.min("conv").alias("name"), F.sum("w").alias("members")))
        named = cut(held.join(names, ["o", "root", *_UNIT]).drop(*_UNIT))
        upper = named.filter("conv = name").select("o", "root", "conv", F.col("members").alias("w"))
        lower = named.filter("left IS NULL").select((F.col("o") + s).alias("o"), F.col("name").alias("root"), "conv", "w")
        whole = steps[s] = upper.unionByName(lower)
        ends.append(named.filter(F.col("left") == s).select((F.col("o") + s).alias("depth"), F.col("name").alias("node"), F.col("conv").alias("conv_id")))
        rest = rest.filter(F.col("left") < s).unionByName(named.filter(F.col("left") > s).select(
            (F.col("o") + s).alias("o"), F.col("name").alias("root"), "conv", (F.col("left") - s).alias("left")))
        s //= 2
    out = lengths.filter("n = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "conv_id")
    for e in ends:
        out = out.unionByName(e)
    return steps, out


def graft(steps: dict[int, DataFrame], own: DataFrame, values: list[str]) -> DataFrame:
    """(depth, conv, values): each node's sums over its subtree, itself included.

    ``own(depth, conv, values)`` holds every node's own values.
    """
    total = [F.sum(v).alias(v) for v in values]
    block = {1: own}  # block[s]: nodes at multiples of s, sums over the s levels from each on
    sizes = sorted(steps)
    for s in sizes:
        link = steps[s].filter(F.col("o").bitwiseAND(F.lit(s)) == 0).select((F.col("o") + s).alias("depth"), "conv", "root")
        below = block[s].join(link, ["depth", "conv"]).select((F.col("depth") - s).alias("depth"), F.col("root").alias("conv"), *values)
        above = block[s].filter(F.col("depth") % (2 * s) == 0)
        block[2 * s] = cut(above.unionByName(below).groupBy("depth", "conv").agg(*total))
    done = block[2 * sizes[-1]] if sizes else own
    for s in reversed(sizes):
        link = steps[s].filter(F.col("o").bitwiseAND(F.lit(s)) != 0).select((F.col("o") + s).alias("depth"), "conv", "root")
        below = done.join(link, ["depth", "conv"]).select((F.col("depth") - s).alias("depth"), F.col("root").alias("conv"), *values)
        here = block[s].filter(F.col("depth") % (2 * s) == s)
        done = done.unionByName(cut(here.unionByName(below).groupBy("depth", "conv").agg(*total)))
    return done


def _digest_lists(batches):
    """Rows sorted by (depth, node, piece): SHA-256 of each node's pieces, joined by commas, as a stream."""
    key, sha = None, None
    for batch in batches:
        out = []
        for depth, node, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ids"))):
            if (depth, node) == key:
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, sha.hexdigest()))
            key, sha = (depth, node), hashlib.sha256(ids.encode())
        yield _digest_rows(out)
    if key is not None:
        yield _digest_rows([(*key, sha.hexdigest())])


def _digest_rows(rows):
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["depth", "conv", "ends_sha256"])


def digest_ends(ends: DataFrame) -> DataFrame:
    """(depth, conv, ends_sha256) of the nodes where members end."""
    piece = F.shiftright("conv_id", PIECE_BITS)
    pieces = (ends.groupBy("depth", "node", piece.alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    rows = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "piece")
    return rows.mapInArrow(_digest_lists, "depth long, conv long, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of sequences: ``turns(conv_id, pos, d0, d1, n_bytes)``, ``lengths(conv_id, n)``.

    Gives conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turns, lengths = cut(turns), cut(lengths)
    root, longest, members = lengths.agg(F.min("conv_id"), F.max("n"), F.count(F.lit(1))).first()
    if root is None:
        return turns.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                                      "n_leaves long, saved_tokens long, ends_sha256 string")
    top = 1 << (longest.bit_length() - 1) if longest else 0
    steps, ends = name_prefixes(name_blocks(turns, top), lengths, root, top) if top else ({}, lengths.select(
        F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "conv_id"))
    top_row = turns.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("conv"), F.lit(None).cast("long").alias("parent"),
        F.lit(members).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("n_bytes"))
    nodes = top_row
    if top:
        last = turns.select(F.col("conv_id").alias("conv"), F.col("pos").alias("o"), "n_bytes")
        nodes = nodes.unionByName(steps[1].join(last, ["conv", "o"]).select(
            (F.col("o") + 1).alias("depth"), "conv", F.col("root").alias("parent"), F.col("w").alias("n_convs"), "n_bytes"))
        children = steps[1].groupBy(F.col("o").alias("depth"), F.col("root").alias("conv")).agg(F.count(F.lit(1)).alias("n_children"))
        nodes = nodes.join(children, ["depth", "conv"], "left")
    else:
        nodes = nodes.withColumn("n_children", F.lit(None).cast("long"))
    nodes = cut(nodes.join(digest_ends(ends), ["depth", "conv"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    own = nodes.select("depth", "conv", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    totals = graft(steps, own, ["n_leaves", "saved_tokens"])
    return nodes.join(totals, ["depth", "conv"]).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``conversations(conv_id, turn, role, text)``."""
    return trie(*rebuild(conversations))
