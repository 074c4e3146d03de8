"""The conversation trie against dictionaries in Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shoreline.llm import convtrie
from shoreline.llm.sampling import crc_mod


def plain(rows, rebuild=True):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            g = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by.setdefault(c, []).append((turn is not None, turn or 0, role, g, text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in by.items()}
    seqs = {}
    for c, mine in own.items():
        if rebuild:
            h = zlib.crc32(str(c).encode()) % 6
            seqs[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + mine[h:]
        else:
            seqs[c] = mine
    members, ends = {}, {}
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members.setdefault(tuple(seqs[c][:d]), []).append(c)
        ends.setdefault(tuple(seqs[c]), []).append(c)
    children, out = {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        mine = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += mine
    for p, m in members.items():
        out[(m[0], len(p))] = (members[p[:-1]][0] if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
                               hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest())
    return out


def run(spark, rows, most=convtrie.MOST, rebuild=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.withColumns({n: F.lit("x") for n in ("c", "pos", "digest", "chars", "m", "depth", "up", "part", "key", "a.b")})
    own = convtrie.ordered_turns(df)
    none = F.lit(0)
    convs, turns = convtrie.shared_openings(own, F.col("c") - F.col("c") % 100, crc_mod("c", 6) if rebuild else none)
    out = convtrie.trie(convs, turns, most)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = out.collect()
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    return got


def random_rows(seed, convs=150, words=2):
    rnd = random.Random(seed)
    return [(rnd.choice([c, c, c, c + 100, -c]), rnd.choice([t, t, None]), rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "é\U0001f600", None, ""][:words + 1]))
            for c in range(convs) for t in range(rnd.randrange(1, 8))]


@pytest.mark.parametrize("most", [1, 6, 20_000])
def test_equals_plain_trie(spark, most):
    rows = random_rows(most, 60 if most == 1 else 150)
    assert run(spark, rows, most) == plain(rows)


def test_long_path_takes_few_rounds(spark):
    """One conversation of a third of all rows, and a fork near its end."""
    rows = [(1, t, "user", f"t{t}") for t in range(600)] + [(2, t, "user", f"t{t}" if t < 590 else "fork") for t in range(600)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(3, 60) for t in range(10)]
    assert run(spark, rows, 200, rebuild=False) == plain(rows, rebuild=False)


def test_hot_first_turn_and_copies(spark):
    rows = [(c, t, "user", "the very same" if t == 0 or c % 2 else f"{c % 40} {t}") for c in range(400) for t in range(3)]
    assert run(spark, rows, 30) == plain(rows)


def test_nulls_ties_long_texts(spark):
    rows = [(None, 1, "user", "no conversation"), (5, None, None, None), (5, None, None, None), (5, 1, "user", "b"), (5, 1, "user", "a"),
            (5, 1, "assistant", "c"), (7, 1, "user", "x" * 1_500_000), (8, 1, "user", "x" * 1_500_000), (100, 1, "", ""), (-3, 2, "user", "n")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, rebuild=False) == plain(rows, rebuild=False)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for empty in (df.limit(0), df.where("conv_id IS NULL")):
        convs, turns = convtrie.shared_openings(convtrie.ordered_turns(empty), F.col("c") - F.col("c") % 100, crc_mod("c", 6))
        assert convtrie.trie(convs, turns).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(-5, 9)), max_size=60))
def test_decompose(nodes):
    """Any forest: parents among the nodes before (or none)."""
    parent = np.array([p % (i + 1) - 1 if p % 7 else -1 for i, (p, _) in enumerate(nodes)], dtype=np.int64)
    depth = np.zeros(len(nodes), dtype=np.int64)
    for i, p in enumerate(parent):
        depth[i] = depth[p] + 1 if p >= 0 else 0
    weights = np.array([[w, 1] for _, w in nodes], dtype=np.int64).reshape(len(nodes), 2)
    want = weights.copy()
    for i in range(len(nodes) - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (convtrie.decompose(parent, depth, weights) == want).all()


def test_decompose_long_path():
    n = 20_000
    got = convtrie.decompose(np.arange(-1, n - 1), np.arange(n), np.ones((n, 1), dtype=np.int64))
    assert got[:, 0].tolist() == list(range(n, 0, -1))


def test_chunks_keep_components_whole(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(convtrie, "CHUNK", 3)
    nodes = [(c, d, c, c, 0) for c in range(8) for d in range(c % 4 + 1)]
    frame = pd.DataFrame(nodes, columns=["m", "depth", "up", "top_m", "top_depth"]).assign(w=1, sum_w=10)
    out = pd.concat(convtrie._local(["w"])(iter([frame[:5], frame[5:6], frame[6:]])))
    assert {(r.m, r.depth): r.sum_w for r in out.itertuples()} == {(c, d): 10 + c % 4 + 1 - d for c, d, *_ in nodes}


def test_ends_digest(spark, monkeypatch):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit(1)).otherwise(F.col("id") % 7).cast("long").alias("m"),
                                  F.lit(2).cast("long").alias("depth"), F.col("id").alias("c"))
    want = {}
    for r in df.orderBy("c").collect():
        want.setdefault(r.m, []).append(str(r.c))
    got = {r.m: r.ends_sha256 for r in convtrie.ends_digest(df).collect()}
    assert got == {m: hashlib.sha256(",".join(ids).encode()).hexdigest() for m, ids in want.items()}
