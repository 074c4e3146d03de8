"""Vector search (fixture F7 edge rows) against brute force."""

import math

import numpy as np
import pytest

from shoreline.functions import embed as E
from shoreline.operators import vector as VS
from shoreline.operators import vector_blocks as VB


@pytest.fixture
def vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0], 0), (2, [0.0, 1.0, 0.0], 1), (3, [1.0, 1.0, 0.0], 0),
            (4, None, 1), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, 0.0], 1),  # null, zero, wrong length
            (7, [1.0, 1.0, 0.0], 1),  # exact tie with 3
            (8, [-1.0, 0.5, 2.0], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def brute(rows, q, metric):
    out = []
    for vid, v, label in rows:
        if v is None or len(v) != len(q):
            continue
        a, b = np.array(v), np.array(q)
        if metric == "COSINE":
            den = np.linalg.norm(a) * np.linalg.norm(b)
            if den == 0:
                continue
            d = 1 - a.dot(b) / den
        else:
            d = math.sqrt(((a - b) ** 2).sum())
        out.append((round(d, 6), vid))
    return [vid for _, vid in sorted(out)]


@pytest.mark.parametrize("metric", ["COSINE", "EUCLIDEAN"])
def test_single_query_matches_brute_force(spark, vectors, metric):
    q = [1.0, 0.9, 0.1]
    got = VS.search(vectors, q, k=4, columns=["vec_id"], metric=metric).collect()
    assert [r.vec_id for r in got] == brute(vectors.collect(), q, metric)[:4]
    assert all(abs(r.similarity - (1 - r.distance)) <= 5.1e-5 for r in got)


def test_top_k_rule():
    assert (VS.top_k(0), VS.top_k(None), VS.top_k(-3), VS.top_k(7)) == (5, 5, 1, 7)


def test_prefilter_and_null_query(spark, vectors):
    got = VS.search(vectors, [1.0, 1.0, 0.0], k=10, columns=["vec_id", "label"], where="label = 1")
    assert {r.label for r in got.collect()} == {1}
    with pytest.raises(ValueError):
        VS.search(vectors, None)


@pytest.mark.parametrize("metric", ["COSINE", "EUCLIDEAN"])
def test_batch_equals_single(spark, vectors, metric):
    queries = spark.createDataFrame([(10, [1.0, 0.0, 0.0]), (11, [0.2, 0.3, 0.9])],
                                    "query_id long, vector array<double>")
    batch = VS.search_batch(vectors.repartition(3), queries, k=3, key="vec_id", metric=metric).collect()
    for qid, q in ((10, [1.0, 0.0, 0.0]), (11, [0.2, 0.3, 0.9])):
        want = [r.vec_id for r in VS.search(vectors, q, k=3, columns=["vec_id"], metric=metric).collect()]
        got = [r.vec_id for r in sorted((r for r in batch if r.query_id == qid), key=lambda r: r["rank"])]
        assert got == want


def test_batch_refuses_mixed_query_lengths(spark, vectors):
    queries = spark.createDataFrame([(10, [1.0, 0.0, 0.0]), (11, [0.2, 0.3])],
                                    "query_id long, vector array<double>")
    with pytest.raises(ValueError, match="differ in length"):
        VS.search_batch(vectors, queries, k=3, key="vec_id")


def test_text_query_uses_same_model(spark):
    docs = spark.createDataFrame([(1, "red apple pie"), (2, "blue sky"), (3, "   ")], "doc_id long, text string")
    emb = docs.select("doc_id", E.embed_column(docs.text).alias("embedding"))
    assert emb.where("doc_id = 3").first().embedding is None
    top = VS.search(emb, "apple pie", k=1, columns=["doc_id"]).first()
    assert top.doc_id == 1
    v = E.embed_text("Héllo wörld hello")
    assert len(v) == E.DEFAULT_DIM and abs(sum(x * x for x in v) - 1) < 1e-12


@pytest.mark.parametrize("metric", ["COSINE", "EUCLIDEAN"])
def test_expression_path_agrees(spark, vectors, metric):
    q = [0.3, -0.2, 0.9]
    a = [(r.vec_id, r.distance) for r in VS.search(vectors, q, k=5, columns=["vec_id"], metric=metric).collect()]
    b = [(r.vec_id, r.distance) for r in VS.search_expr(vectors, q, k=5, columns=["vec_id"], metric=metric).collect()]
    assert a == b


@pytest.mark.parametrize("metric", ["COSINE", "EUCLIDEAN"])
def test_many_ties_across_partitions(spark, metric):
    # a third of the corpus is one repeated vector: ties are broken by key,
    # exactly as a full sort would, in both the single and the batch path
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(600):
        v = [0.5, 0.5, 0.5] if i % 3 == 0 else rnd.normal(size=3).round(3).tolist()
        rows.append((int((i * 7919) % 600), v, i % 4))
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    q = [0.4, 0.5, 0.6]
    want = brute(rows, q, metric)[:25]
    got = VS.search(corpus, q, k=25, columns=["vec_id"], metric=metric).collect()
    assert [r.vec_id for r in got] == want
    queries = spark.createDataFrame([(1, q)], "query_id long, vector array<double>")
    batch = VS.search_batch(corpus, queries, k=25, key="vec_id", metric=metric).collect()
    assert [r.vec_id for r in sorted(batch, key=lambda r: r["rank"])] == want


def test_vectors_with_null_or_nan_elements_get_no_distance(spark):
    rows = [(1, [1.0, None, 0.0]), (2, [float("nan"), 1.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0])]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for metric in ("COSINE", "EUCLIDEAN"):
        got = VS.search(corpus, [1.0, 0.1, 0.0], k=10, columns=["vec_id"], metric=metric).collect()
        assert [r.vec_id for r in got] == [3, 4]
        queries = spark.createDataFrame([(9, [1.0, 0.1, 0.0])], "query_id long, vector array<double>")
        batch = VS.search_batch(corpus, queries, k=10, key="vec_id", metric=metric).collect()
        assert sorted(r.vec_id for r in batch) == [3, 4]


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("metric", ["COSINE", "EUCLIDEAN"])
def test_every_vector_as_a_query(spark, monkeypatch, metric, broadcast):
    """Blocks of a few vectors, the query side broadcast or shuffled: equal to
    brute force over all pairs, with ties, zero, null and short vectors."""
    monkeypatch.setattr(VB, "BLOCK_BYTES", 3 * 8 * 7)
    monkeypatch.setattr(VB, "GROUP_BLOCKS", 4)
    if not broadcast:
        monkeypatch.setattr(VB, "BROADCAST_BYTES", 100)
    rnd = np.random.default_rng(5)
    rows = [(i, [0.5, 0.5, 0.5] if i % 3 == 0 else rnd.normal(size=3).round(2).tolist(), f"t{i}") for i in range(90)]
    rows += [(900, None, "n"), (901, [0.0, 0.0, 0.0], "z"), (902, [1.0, 2.0], "s"), (903, [None, 1.0, 0.0], "e")]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>, tag string").repartition(6)
    queries = corpus.where("size(embedding) = 3 AND vec_id <> 903").select(corpus.vec_id.alias("query_id"), corpus.embedding.alias("vector"))
    out = VS.search_batch(corpus, queries, k=4, key="vec_id", columns=["tag"], metric=metric)
    got = {}
    for r in sorted(out.collect(), key=lambda r: r["rank"]):
        assert r.tag == dict((a, c) for a, _, c in rows)[r.vec_id]
        got.setdefault(r.query_id, []).append(r.vec_id)
    plain = [r for r in rows if r[0] != 903]
    want = {i: brute(plain, v, metric)[:4] for i, v, _ in plain if v is not None and len(v) == 3}
    assert got == {i: w for i, w in want.items() if w}


def test_batch_plan_has_no_vector_pairs(spark, vectors, monkeypatch):
    queries = spark.createDataFrame([(10, [1.0, 0.0, 0.0]), (11, [0.2, 0.3, 0.9])], "query_id long, vector array<double>")
    plan = VS.search_batch(vectors, queries, k=3, key="vec_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_batch_refuses_repeated_ids_and_no_queries(spark, vectors):
    queries = spark.createDataFrame([(10, [1.0, 0.0, 0.0]), (10, [0.2, 0.3, 0.9])], "query_id long, vector array<double>")
    with pytest.raises(ValueError, match="unique"):
        VS.search_batch(vectors, queries, k=3, key="vec_id")
    with pytest.raises(ValueError, match="no query"):
        VS.search_batch(vectors, queries.limit(0), k=3, key="vec_id")
