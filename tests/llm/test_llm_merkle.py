"""The Merkle manifest against a plain tree built in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shoreline.llm import merkle, ordered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows, tampered):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)]"""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[1] for x in sorted(((r[0] is not None, r[0] or 0), leaf(r)) for r in by[s])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for s, (name, tree) in enumerate(zip(names, trees)):
        ranked = sorted(by[name], key=lambda r: ((r[0] is not None, r[0] or 0), leaf(r)))
        for i, r in enumerate(ranked):
            folded, proof = leaf(tampered(r)), ""
            for levs, at in ((tree, i), (top, s)):
                for lev in levs[:-1]:
                    run = range(at - at % 3, min(at - at % 3 + 3, len(lev)))
                    proof += "".join(lev[k] for k in run if k != at)
                    folded = h(*[folded if k == at else lev[k] for k in run])
                    at //= 3
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def tamper(r):
    if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
        return (*r[:4], r[4].replace("\n", ""))
    return r


def run(spark, rows, span, most):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    df = df.withColumns({c: F.lit(1) for c in ("key", "leaf", "tree", "idx", "g", "part", "all", "n", "a.b")})
    found = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.verify(df, found, span=span, most=most)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded", "verified"]
    return sorted(((r.doc_id, *(bytes(x).hex() for x in (r.leaf, r.subroot, r.root, r.proof, r.folded)), r.verified)
                   for r in out.collect()), key=str)


def many(sizes):
    return [(i * 7 % 1000, s, "en" if i % 3 else None, i, f"text {i}\nof {s}" if i % 4 else f"text {i}")
            for s, n in sizes.items() for i in range(n)]


@pytest.mark.parametrize("span,most", [(6, 200_000), (1, 7), (2, 30)])
def test_equals_plain_tree(spark, span, most):
    rows = many({"a": 1, "b": 3, "c": 4, "d": 200, None: 10, "é": 28, "Z": 9, "": 2})
    assert run(spark, rows, span, most) == sorted(plain(rows, tamper), key=str)


@pytest.mark.parametrize("sizes", [{"one": 1}, {"one": 3}, {None: 2}, {f"s{i}": 1 for i in range(30)}])
def test_small_shapes(spark, sizes):
    rows = many(sizes)
    assert run(spark, rows, 2, 5) == sorted(plain(rows, tamper), key=str)


def test_nulls_ties_long_texts(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "s", "en", 0, ""), (1, "s", "en", 0, ""), (1, "s", "en", 1, "x"),
            (2, "s", None, 5, "\n" * 5), (3, "s", "de", None, "word\n" * 400_000), (4, "s", "-", 1, "-"), (5, None, "", 0, "1:-"), (-6, "s", "en", 2, "é中\U0001f600\n")]
    assert run(spark, rows, 6, 4) == sorted(plain(rows, tamper), key=str)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.verify(df.limit(0), F.col("text")).count() == 0
    assert {r.verified for r in merkle.verify(df, F.col("text")).collect()} == {True}


def test_copies_bound_the_join(spark):
    """No stored row serves more than `most` leaves, however many pass through it."""
    rows = many({"hot": 900, "b": 5})
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaves = df.select(F.col("doc_id").alias("key"), "source", merkle.leaf_digest(*[F.col(c) for c in FIELDS]).alias("leaf"))
    placed, nodes = merkle.build(leaves, ["key", "leaf"], span=2, most=50)
    assert nodes.where("tree = -1").count() >= 905 // 50
    reached = placed.join(nodes.where("base = 0 AND tree >= 0").withColumn("t", F.col("tree")).drop("tree"),
                          (F.col("tree") == F.col("t")) & (F.floor(F.col("idx") / 9) == F.col("block")))
    assert reached.groupBy("tree", "block", "copy").count().agg(F.max("count")).first()[0] <= 9


def test_settings_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in merkle.LIMITS}
    run(spark, many({"a": 5}), 2, 5)
    assert {k: spark.conf.get(k, None) for k in merkle.LIMITS} == before


def test_numbered(spark):
    """A group spread over many tasks, small ones, sums that wrap."""
    big = (1 << 62)
    rows = [("hot", i, big + i) for i in range(500)] + [(f"g{i % 40}", i, -i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(7)
    got = {(r.g, r.k): (r.pos, r.sum_v) for r in ordered.numbered(df, "g", ["k"], ("v",)).collect()}
    want, held = {}, {}
    for g, k, v in sorted(rows):
        n, s = held.get(g, (0, 0))
        held[g] = (n + 1, (s + v) % (1 << 64))
        want[(g, k)] = (n, held[g][1] - (1 << 64 if held[g][1] >= 1 << 63 else 0))
    assert got == want
    assert ordered.numbered(df.limit(0), "g", ["k"]).count() == 0


def test_join_hot(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 500 THEN 0 ELSE id END AS k", "id AS v")
    info = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = ordered.join_hot(rows, info, "k", "n")
    assert sorted((r.k, r.v, r.n) for r in got.collect()) == sorted((0 if i < 500 else i, i, 500 if i < 500 else 1) for i in range(1000))
