"""Tree patterns over a graph (N: questions with several conditions).

A pattern is a tree of named nodes, each with a label and a condition, joined by relationships.
``match_pattern`` reduces before it joins: from the leaves up, each node keeps the ids that have a
partner below; from the root down, each node and relationship keeps what has a partner above. After
that every row that is left is part of an answer, so no join makes a row that a later one drops:
intermediate results are no larger than the input and the output together. Branches none of
whose nodes are asked for only filter. A negative relationship is an anti-join with its whole
branch: "no such partner".

All reductions are semi- or anti-joins on ids, which AQE splits at hubs. Results are sets: each
combination of ids once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import checkpointed
from .graph_match import directed


@dataclass(frozen=True)
class Node:
    """A named node: a label (None: any) and a condition over ``id``, ``labels`` and ``props``."""

    name: str
    label: str | None = None
    where: Column | None = None


@dataclass(frozen=True)
class Rel:
    """A relationship from the node ``above`` to the node ``below`` it in the tree.

    ``direction``: out (above -> below), in (below -> above) or both. ``absent``: there is none.
    """

    above: str
    below: str
    types: str | Sequence[str] | None = None
    direction: str = "out"
    absent: bool = False


def _ordered(nodes: Sequence[Node], rels: Sequence[Rel]) -> list[Rel]:
    """Relationships from the root down; fails unless they form a tree below the first node."""
    names, todo, out = {n.name for n in nodes}, list(rels), []
    if len(names) != len(nodes) or {x for r in rels for x in (r.above, r.below)} - names:
        raise ValueError("nodes need names of their own, relationships known nodes")
    seen = {nodes[0].name}
    while todo:
        r = next((r for r in todo if r.above in seen), None)
        if r is None or r.below in seen:
            raise ValueError("relationships must form a tree below the first node")
        todo.remove(r)
        seen.add(r.below)
        out.append(r)
    if seen != names:
        raise ValueError("every node must hang below the first one")
    return out


def match_pattern(nodes: DataFrame, edges: DataFrame, pattern: Sequence[Node], rels: Sequence[Rel],
                  returning: Sequence[str] | None = None) -> DataFrame:
    """All matches of a tree pattern: one column of ids per node of ``returning``.

    The first node is the root and always returned first; ``returning`` adds nodes outside negative
    branches (default: none). ``nodes(id, labels, props)``, ``edges(src, dst, type)``.
    """
    order = _ordered(pattern, rels)
    root = pattern[0].name
    above = {r.below: r for r in order}
    asked = [x for x in (returning or []) if x != root]
    needed = {root}  # nodes that lie between the root and a node asked for
    for x in asked:
        while x != root:
            if x not in above or above[x].absent:
                raise ValueError(f"{x} cannot be returned")
            needed.add(x)
            x = above[x].above
    ids = {}
    for n in pattern:
        held = nodes.filter(F.array_contains("labels", n.label)) if n.label is not None else nodes
        ids[n.name] = (held.filter(n.where) if n.where is not None else held).select(F.col("id").alias(n.name)).distinct()
    links = {}
    for r in reversed(order):  # leaves first: a branch is reduced before it reduces the node above
        pairs = directed(edges, r.types, r.direction).select(F.col("node").alias(r.above), F.col("other").alias(r.below)).distinct()
        # written once: it is read up and down, and semi-joins nested below unions of edge tables would multiply the plan
        links[r.below] = met = checkpointed(pairs.join(ids[r.below], r.below, "left_semi"))
        ids[r.above] = ids[r.above].join(met, r.above, "left_anti" if r.absent else "left_semi")
    out = checkpointed(ids[root])
    ids[root] = out
    for r in order:
        if r.below not in needed:
            continue
        links[r.below] = links[r.below].join(ids[r.above], r.above, "left_semi")
        ids[r.below] = links[r.below].select(r.below).distinct()
    for r in order:
        if r.below in needed:
            out = out.join(links[r.below], r.above)
    return out.select(root, *asked).distinct()
