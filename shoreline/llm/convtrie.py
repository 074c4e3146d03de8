"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; it is named by the smallest
conversation that begins with it and by its depth. A conversation's nodes are
found by running sums of position-bound turn digests over range partitions, so
a conversation of any length spreads over many tasks.

Subtree totals come from a centroid decomposition of the parent-edge forest.
Every component of more than ``MOST`` nodes is split at its centroid, the
deepest node with half of the component at or below it: the totals of what
lies there are added to the nodes on the path from the centroid to the
component's top, the centroid leaves, its children head components of their
own and the part above shrinks by as much. A round does this for all large
components at once, so the rounds grow with the logarithm of the nodes, also
for a trie that is one long path. Smaller components are decomposed the same
way inside tasks, many at a time, with arrays.

No pointers are chased: the ancestor of node (conversation, depth) at depth e
is the node in which that conversation passes depth e, which one equi-join
with the passages (conversation, depth, node) tells.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shoreline.llm.common import materialise
from shoreline.llm.ordered import join_hot, numbered

#: Nodes of a component that a task decomposes by itself, and nodes it holds at a time.
MOST, CHUNK = 20_000, 200_000
#: Path depths that one row stands for before it is unfolded.
STRIDE = 10_000


def _lane(digest: Column, k: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 15 * k + 1, 15), 16, 10).cast("long")


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(c, pos, digest, chars): turns by number (null first), equal numbers by
    role and then by digest; ``pos`` counts from 0. Null role and text are
    empty; rows without a conversation id belong to none and are left out."""
    role, text = (F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in (role_col, text_col))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
                        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
                        F.length(text).cast("long").alias("chars")).where("c IS NOT NULL")
    return materialise(numbered(materialise(rows), "c", ["turn", "role", "digest"]).select("c", "pos", "digest", "chars"))


def shared_openings(own: DataFrame, base: Column, shared: Column) -> tuple[DataFrame, DataFrame]:
    """(conversations, rebuilt turns): each conversation c of ``own`` (as from
    ``ordered_turns``) gets the first ``shared`` turns of conversation
    ``base`` (both expressions over c; all it has if fewer), then its own after
    its first ``shared``. (c, n, length) and (c, at, digest, chars, length)."""
    convs = materialise(own.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
                        .select("c", "n", base.alias("base"), shared.cast("long").alias("h")))
    widest = convs.agg(F.max("h")).first()[0] or 0
    heads = own.where(F.col("pos") < widest).select(F.col("c").alias("base"), "pos", "digest", "chars")
    held = heads.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    cut = F.least(F.col("h"), F.coalesce("held", F.lit(0).cast("long")))
    convs = materialise(convs.join(held, "base", "left").withColumn("cut", cut)
                        .withColumn("length", F.col("cut") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long")))
                        .select("c", "n", "base", "h", "cut", "length"))
    opening = (convs.join(heads, "base").where("pos < h")
               .select("c", F.col("pos").alias("at"), "digest", "chars", "length"))
    rest = (join_hot(own, convs, "c", "n").where("pos >= h")
            .select("c", (F.col("cut") + F.col("pos") - F.col("h")).alias("at"), "digest", "chars", "length"))
    return convs.select("c", "n", "length"), opening.unionByName(rest)


def passages(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(c, depth, m, up, n_convs, chars, length): the node, named m, in which
    conversation c passes each depth from 0 to its ``length``, and its parent's
    name ``up``; ``n_convs`` conversations pass that node."""
    placed = F.sha2(F.concat(F.col("at").cast("string"), F.lit(":"), F.col("digest")), 256)
    rows = materialise(turns.withColumn("placed", placed).select(
        "c", "at", _lane(F.col("placed"), 0).alias("x"), _lane(F.col("placed"), 1).alias("y"), "chars", "length"))
    run = numbered(rows, "c", ["at"], ("x", "y"))
    depth = F.col("pos") + 1
    run = materialise(run.select("c", F.struct(depth.alias("depth"), "sum_x", "sum_y").alias("key"), "chars", "length"))
    nodes = materialise(run.groupBy("key").agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs")))
    below = join_hot(run, nodes, "key", "n_convs").select("c", F.col("key.depth").alias("depth"), "m", "n_convs", "chars", "length")
    root = convs.agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs")).first()
    zero = F.lit(0).cast("long")
    top = convs.select("c", zero.alias("depth"), F.lit(root["m"]).cast("long").alias("m"),
                       F.lit(root["n_convs"]).cast("long").alias("n_convs"), zero.alias("chars"), "length")
    every = materialise(below.unionByName(top))
    above = every.select("c", (F.col("depth") + 1).alias("depth"), F.col("m").alias("up"))
    return materialise(every.join(above, ["c", "depth"], "left").select("c", "depth", "m", "up", "n_convs", "chars", "length"))


# ---------------------------------------------------------------- rollup
def decompose(parent: np.ndarray, depth: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Subtree totals of ``weights`` (a column per kind) in a forest given by
    parent positions (-1: top), by centroid decomposition of all its trees at once."""
    n = len(parent)
    parent, total = parent.copy(), np.zeros_like(weights)
    label, size = np.arange(n), np.ones(n, dtype=np.int64)
    order = np.argsort(depth, kind="stable")

    def levels(which: np.ndarray) -> list[np.ndarray]:
        return np.split(which, np.flatnonzero(np.diff(depth[which])) + 1) if len(which) else []
    first = levels(order)
    for rows in reversed(first):
        rows = rows[parent[rows] >= 0]
        np.add.at(size, parent[rows], size[rows])
    for rows in first:
        rows = rows[parent[rows] >= 0]
        label[rows] = label[parent[rows]]
    while len(order):
        half = order[2 * size[order] >= size[label[order]]]
        centroid = np.full(n, -1)
        centroid[label[half]] = half  # in ascending depth: the deepest stays
        tops = order[label[order] == order]
        cents = centroid[tops]
        inside = np.zeros(n, dtype=bool)
        inside[cents] = True
        moved = label.copy()
        for rows in levels(order):
            rows = rows[~inside[rows] & (parent[rows] >= 0)]
            rows = rows[inside[parent[rows]]]
            inside[rows] = True
            heads = parent[rows] == centroid[label[rows]]
            moved[rows] = np.where(heads, rows, moved[parent[rows]])
        held = np.zeros((n, weights.shape[1]), dtype=weights.dtype)
        rows = order[inside[order]]
        np.add.at(held, label[rows], weights[rows])
        lost, at, top = size[cents].copy(), cents.copy(), tops.copy()
        while len(at):  # the paths from the centroids to their tops, a step at a time
            total[at] += held[top]
            size[at] -= lost
            go = parent[at] >= 0
            at, top, lost = parent[at][go], top[go], lost[go]
        gone = np.zeros(n, dtype=bool)
        gone[cents] = True
        label = moved
        parent[(parent >= 0) & gone[parent]] = -1
        order = order[~gone[order]]
    return total


def _local(names: list[str]):
    def solve(f: pd.DataFrame) -> pd.DataFrame:
        depth = f["depth"].to_numpy()
        own = pd.MultiIndex.from_arrays([f["m"], depth])
        parent = own.get_indexer(pd.MultiIndex.from_arrays([f["up"].fillna(0).astype("int64"), depth - 1]))
        parent[(f["m"] == f["top_m"]).to_numpy() & (depth == f["top_depth"].to_numpy())] = -1
        found = decompose(parent, depth, f[names].to_numpy(dtype=np.int64))
        out = f[["m", "depth"]].copy()
        for k, name in enumerate(names):
            out[f"sum_{name}"] = f[f"sum_{name}"].to_numpy() + found[:, k]
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for f in frames:
            held.append(f)
            size += len(f)
            if size >= CHUNK:  # solve all but the last component, which may go on
                both = pd.concat(held, ignore_index=True)
                last = (both["top_m"] == both["top_m"].iloc[-1]) & (both["top_depth"] == both["top_depth"].iloc[-1])
                if (~last).any():
                    yield solve(both[~last].reset_index(drop=True))
                held = [both[last]]
                size = len(held[0])
        if size:
            yield solve(pd.concat(held, ignore_index=True))
    return run


def _subtree_sizes(nodes: DataFrame, passed: DataFrame, deepest: int) -> DataFrame:
    """``nodes`` with ``size``, the nodes at and below each: in every round a
    node takes over what the nodes twice as far below it hold."""
    sized, jump = nodes.withColumn("size", F.lit(1).cast("long")), 1
    while jump <= deepest:
        held = (sized.where(F.col("depth") >= jump)
                .select(F.col("m").alias("c"), (F.col("depth") - jump).alias("depth"), "size")
                .join(passed, ["c", "depth"]).groupBy("m", "depth").agg(F.sum("size").alias("more")))
        sized = materialise(sized.join(held, ["m", "depth"], "left")
                            .withColumn("size", F.col("size") + F.coalesce("more", F.lit(0).cast("long"))).drop("more"))
        jump *= 2
    return sized


def rollup(nodes: DataFrame, passed: DataFrame, values: list[str], most: int = MOST) -> DataFrame:
    """(m, depth, sum_<value>…): totals over each node's subtree, itself included.

    ``nodes`` has (m, depth, up) and the long columns ``values``; ``passed``
    (c, depth, m, up) tells in which node every conversation passes each depth.
    Any number of trees is allowed (tops have a null ``up``)."""
    sums = [f"sum_{v}" for v in values]
    zero = F.lit(0).cast("long")
    state = nodes.select("m", "depth", "up", *values, *[zero.alias(s) for s in sums])
    stats = state.agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest")).first()
    passed = passed.select("c", "depth", "m", "up")
    done: list[DataFrame] = []
    # a top is the passage at depth 0; trees that begin there are the first components
    tops = passed.where("depth = 0").select(F.col("c").alias("m"), F.struct(F.col("m").alias("m"), zero.alias("depth")).alias("comp"))
    state = state.join(tops, "m")
    keep = ["m", "depth", "up", "comp", *values, *sums]
    small: list[DataFrame] = []
    if stats["n"] <= most:
        small.append(state.select(*keep))
    else:
        state = _subtree_sizes(materialise(state), passed.select("c", "depth", "m"), stats["deepest"])
        while True:
            comps = materialise(state.groupBy("comp").agg(F.count(F.lit(1)).alias("n")))
            counted = materialise(join_hot(state, comps, "comp", "n"))
            small.append(counted.where(F.col("n") <= most).select(*keep))
            large = counted.where(F.col("n") > most)
            cents = (large.where(2 * F.col("size") >= F.col("n")).groupBy("comp", "n")
                     .agg(F.max_by(F.struct("m", "depth", "size"), "depth").alias("cent")))
            cents = materialise(cents)
            if cents.isEmpty():
                break
            # where a node below the centroid's depth passes the depth after it, and under which parent
            marked = join_hot(large.drop("n"), cents, "comp", "n").withColumn("next", F.col("cent.depth") + 1)
            after = passed.select(F.col("c").alias("m"), F.col("depth").alias("next"), F.col("m").alias("head"), F.col("up").alias("head_up"))
            is_cent = (F.col("m") == F.col("cent.m")) & (F.col("depth") == F.col("cent.depth"))
            below = F.coalesce((F.col("depth") >= F.col("next")) & (F.col("head_up") == F.col("cent.m")), F.lit(False))
            marked = materialise(marked.join(after, ["m", "next"], "left").withColumn("is_cent", is_cent).withColumn("below", below))
            part = marked.where("is_cent OR below").groupBy("comp").agg(*[F.sum(v).alias(f"add_{v}") for v in values])
            path = cents.join(part, "comp")
            spread = F.sequence(F.col("comp.depth"), F.col("cent.depth"), F.lit(STRIDE).cast("long"))
            path = path.withColumn("from", F.explode(spread))
            path = path.withColumn("depth", F.explode(F.sequence("from", F.least(F.col("from") + STRIDE - 1, F.col("cent.depth")))))
            path = (path.select(F.col("cent.m").alias("c"), "depth", F.col("cent.size").alias("lost"), *[f"add_{v}" for v in values])
                    .join(passed.select("c", "depth", "m"), ["c", "depth"]).drop("c"))
            moved = marked.join(path, ["m", "depth"], "left")
            for v, s in zip(values, sums):
                moved = moved.withColumn(s, F.col(s) + F.coalesce(f"add_{v}", zero))
            head = F.struct(F.col("head").alias("m"), F.col("next").alias("depth"))
            moved = materialise(moved.withColumn("size", F.col("size") - F.coalesce("lost", zero))
                                .withColumn("comp", F.when(F.col("below"), head).otherwise(F.col("comp")))
                                .select(*keep, "size", "is_cent"))
            done.append(moved.where("is_cent").select("m", "depth", *sums))
            state = moved.where("NOT is_cent").drop("is_cent")
    out = None
    for rows in small:
        rows = rows.select("m", "depth", "up", F.col("comp.m").alias("top_m"), F.col("comp.depth").alias("top_depth"), *values, *sums)
        out = rows if out is None else out.unionByName(rows)
    dealt = out.repartition("top_m", "top_depth").sortWithinPartitions("top_m", "top_depth")
    solved = dealt.mapInPandas(_local(values), ", ".join(["m long", "depth long", *(f"{s} long" for s in sums)]))
    for rows in done:
        solved = solved.unionByName(rows)
    return solved


# ---------------------------------------------------------------- members' ids
def _joined_ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        if not len(f):
            continue
        m, d = f["m"].to_numpy(), f["depth"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (d[1:] != d[:-1])]))
        ids = list(map(str, f["c"].tolist()))
        ends = [*starts[1:].tolist(), len(ids)]
        yield pd.DataFrame({"m": m[starts], "depth": d[starts], "first": f["c"].to_numpy()[starts],
                            "ids": [",".join(ids[a:b]) for a, b in zip(starts.tolist(), ends)]})


def _hashed_ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    node, digest = None, None
    for f in frames:
        out = []
        for m, d, ids in zip(f["m"].tolist(), f["depth"].tolist(), f["ids"]):
            if node == (m, d):
                digest.update(b"," + ids.encode())
            else:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (m, d), hashlib.sha256(ids.encode())
        if out:
            yield pd.DataFrame(out, columns=["m", "depth", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["m", "depth", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(m, depth, ends_sha256) of the ascending ids c of each (m, depth), joined
    by commas. Ids are sorted and joined in pieces by range partitions; a
    node's pieces, not its ids, are then hashed one after another."""
    pieces = (ends.repartitionByRange("m", "depth", "c").sortWithinPartitions("m", "depth", "c").select("m", "depth", "c")
              .mapInPandas(_joined_ids, "m long, depth long, first long, ids string"))
    return (pieces.repartition("m", "depth").sortWithinPartitions("m", "depth", "first")
            .mapInPandas(_hashed_ids, "m long, depth long, ends_sha256 string"))


def trie(convs: DataFrame, turns: DataFrame, most: int = MOST) -> DataFrame:
    """The nodes of the trie: (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256), the root at depth 0.

    ``convs`` (c, length) and ``turns`` (c, at, digest, chars, length) are as
    from ``shared_openings``. A conversation without turns is a member of the
    root. Equal conversations share all nodes. ``n_leaves`` and
    ``saved_tokens`` are totals over a node's subtree, itself included; the
    latter counts, for all members but one, the code points of the node's last
    text. No conversations give no rows."""
    passed = passages(convs, turns)
    own = passed.where("c = m")  # each node is passed once by the conversation that names it
    children = own.where("up IS NOT NULL").groupBy(F.col("up").alias("m"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(own.join(children, ["m", "depth"], "left")
                        .select("m", "depth", "up", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                                F.col("n_children").isNull().cast("long").alias("leaf"),
                                ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    totals = rollup(nodes, passed, ["leaf", "saved"], most)
    digests = ends_digest(passed.where("depth = length").select("m", "depth", "c"))
    out = nodes.join(totals, ["m", "depth"]).join(digests, ["m", "depth"], "left")
    return out.select(F.col("m").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children",
                      F.col("sum_leaf").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
