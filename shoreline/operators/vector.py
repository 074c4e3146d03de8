"""Exact top-k vector search (``searchSimilar``) over a DataFrame.

Single query: each corpus partition computes its distances per Arrow batch
with NumPy and keeps a local top-k; ``orderBy(distance, key).limit(k)`` over
those rows plans as ``TakeOrderedAndProject``; no full sort, no shuffle of
the corpus. ``search_expr`` does the same with a JVM expression distance.

Many queries: ``vector_blocks`` joins blocks of queries with blocks of the
corpus; each task keeps only its top-k per query (plus ties within the
rounding margin) and a per-query ``row_number`` picks the global top-k. Pairs
of vectors are never rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import embed as E
from shoreline.functions import vectors as V
from shoreline.operators import read as R
from shoreline.operators import vector_blocks
from shoreline.operators.partitioning import spread

# Default projection of an asset search and the k rule.
DEFAULT_COLUMNS = ("id", "file_id", "name", "mime_type", "size", "updated_at")
DEFAULT_K = 5
DISTANCE_DIGITS = 6
SIMILARITY_DIGITS = 4
# Upper bound on one tile of a task's distance matrix.
TILE_BYTES = 16 * 1024 * 1024
# Rows of an Arrow batch whose vectors are copied into a matrix at once.
MATRIX_ROWS = 1024


def top_k(k) -> int:
    """``max(1, k or 5)``: 0 or missing → 5, negative → 1."""
    try:
        n = int(k) if k is not None else 0
    except (TypeError, ValueError):
        n = 0
    return max(1, n or DEFAULT_K)


def query_vector(query, dim: int | None = None) -> list[float]:
    """Numbers are used as given; text is embedded with the offline model."""
    if query is None:
        raise ValueError("a query is required for vector search")
    if isinstance(query, (list, tuple, np.ndarray)) and len(query) > 0 and \
            all(isinstance(x, (int, float, np.floating, np.integer)) and not isinstance(x, bool) for x in query):
        return [float(x) for x in query]
    if isinstance(query, (bytes, bytearray)):
        query = bytes(query).decode("utf-8", errors="replace")
    if isinstance(query, str):
        v = E.embed_text(query, dim or E.DEFAULT_DIM)
        if v is None:
            raise ValueError("query text is blank")
        return v
    raise ValueError(f"unsupported query {type(query).__name__}")


def _projection(df: DataFrame, columns, embedding_col: str) -> list[str]:
    if columns:
        return [str(c).strip().replace("`", "") for c in columns]
    present = [c for c in DEFAULT_COLUMNS if c in df.columns]
    return present or [c for c in df.columns if c != embedding_col]


def search(df: DataFrame, query, k=DEFAULT_K, embedding_col: str = "embedding", columns=None,
           where=None, metric: str = V.COSINE, key: str | None = None) -> DataFrame:
    """Top-k rows by distance to ``query``: projection + ``distance`` (rounded
    to 6 digits) + ``similarity`` (``round(1 - distance, 4)``). Rows with a
    NULL embedding, or no distance (zero vector, other length, NULL element),
    are left out; ties are broken by ``key``.

    Each partition computes distances for its Arrow batches with NumPy and
    keeps its local top-k (plus ties within the rounding margin); the global
    ``orderBy(distance, key).limit(k)`` over those few rows plans as
    ``TakeOrderedAndProject``. No shuffle of the corpus."""
    n = top_k(k)
    emb = embedding_col.replace("`", "")
    qvec = np.asarray(query_vector(query), dtype=np.float64)
    cols = _projection(df, columns, emb)
    key = key or cols[0]
    carried = cols + ([key] if key not in cols else [])
    base = df.where(F.col(R.quote(emb)).isNotNull())
    cond = R.predicate(where)
    if cond is not None:
        base = base.where(cond)
    base = spread(base.select(*[F.col(R.quote(c)) for c in carried],
                              F.col(R.quote(emb)).cast("array<double>").alias("_emb")))
    payload = [c for c in carried if c != key]
    schema = T.StructType([T.StructField("query_id", T.LongType()), df.schema[key]]
                          + [df.schema[c] for c in payload] + [T.StructField("_d", T.DoubleType())])
    bc = df.sparkSession.sparkContext.broadcast(qvec.reshape(1, -1))
    fn = _local_topk("_emb", key, payload, np.array([0], dtype=object), bc,
                     (metric or V.COSINE).upper(), n, 10.0 ** -DISTANCE_DIGITS)
    local = base.mapInPandas(fn, schema)
    return (local.select(*[F.col(R.quote(c)) for c in cols],
                         F.round("_d", DISTANCE_DIGITS).alias("distance"),
                         F.round(F.lit(1.0) - F.col("_d"), SIMILARITY_DIGITS).alias("similarity"),
                         F.col(R.quote(key)).alias("_key"))
            .orderBy(F.col("distance").asc(), F.col("_key").asc())
            .limit(n).drop("_key"))


def search_expr(df: DataFrame, query, k=DEFAULT_K, embedding_col: str = "embedding", columns=None,
                where=None, metric: str = V.COSINE, key: str | None = None) -> DataFrame:
    """The same search with the distance as a JVM column expression (no
    Python workers); fine for short vectors."""
    n = top_k(k)
    emb = embedding_col.replace("`", "")
    q = V.literal_vector(query_vector(query))
    cols = _projection(df, columns, emb)
    key = key or cols[0]
    base = df.where(F.col(R.quote(emb)).isNotNull())
    cond = R.predicate(where)
    if cond is not None:
        base = base.where(cond)
    d = V.distance(metric, F.col(R.quote(emb)), q)
    scored = base.select(*[F.col(R.quote(c)) for c in cols], F.col(R.quote(key)).alias("_key"),
                         d.alias("_d")).where(F.col("_d").isNotNull())
    return (scored.select(*[F.col(R.quote(c)) for c in cols], "_key",
                          F.round("_d", DISTANCE_DIGITS).alias("distance"),
                          F.round(F.lit(1.0) - F.col("_d"), SIMILARITY_DIGITS).alias("similarity"))
            .orderBy(F.col("distance").asc(), F.col("_key").asc())
            .limit(n).drop("_key"))


def _local_topk(emb_col: str, key: str, payload: list[str], qids: np.ndarray, qmat_bc,
                metric: str, k: int, margin: float):
    """mapInPandas body: running top-k per query over one partition.

    Distances are computed in tiles of at most ``TILE_BYTES`` (queries x rows),
    of ``MATRIX_ROWS`` rows of a batch at a time, so memory does not grow with
    the query matrix, and little with the batch; candidates are
    flat arrays of (query, row, distance), trimmed together."""

    def distances(Q, qn, X, xn):
        if metric == V.EUCLIDEAN:
            return np.stack([np.sqrt(((X - q) ** 2).sum(axis=1)) for q in Q])
        denom = np.outer(qn, xn)
        with np.errstate(divide="ignore", invalid="ignore"):
            D = 1.0 - (Q @ X.T) / denom
        D[denom == 0] = np.nan
        return D

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Q = qmat_bc.value
        qn = np.sqrt((Q * Q).sum(axis=1))
        n_q, dim = Q.shape
        width = max(1, TILE_BYTES // (8 * 2048))  # queries in a tile
        bound = np.full(n_q, np.inf)  # the k-th distance of each query so far
        best: pd.DataFrame | None = None
        for pdf in (b.iloc[at:at + MATRIX_ROWS] for b in batches for at in range(0, len(b), MATRIX_ROWS)):
            vecs = pdf[emb_col]
            # Rows without a usable vector (NULL, another length, a NULL or
            # NaN element) get no distance; the checks run on whole arrays.
            lens = np.fromiter((-1 if v is None else len(v) for v in vecs), dtype=np.int64,
                               count=len(vecs))
            ok = lens == dim
            if not ok.any():
                continue
            pdf = pdf[ok]
            X = np.stack(pdf[emb_col].to_numpy()).astype(np.float64, copy=False)
            finite = ~np.isnan(X).any(axis=1)
            pdf, X = pdf[finite], X[finite]
            if not len(X):
                continue
            xn = np.sqrt((X * X).sum(axis=1))
            rows = pdf[[key] + payload].reset_index(drop=True)
            for q0 in range(0, n_q, width):
                part = slice(q0, min(n_q, q0 + width))
                step = max(1, TILE_BYTES // (8 * (part.stop - part.start)))
                found = [] if best is None else [best]
                for r0 in range(0, len(X), step):
                    D = distances(Q[part], qn[part], X[r0:r0 + step], xn[r0:r0 + step])
                    near = D <= bound[part, None] + margin  # NaN is never near
                    if D.shape[1] > k:
                        kth = np.partition(np.where(near, D, np.inf), k - 1, axis=1)[:, k - 1]
                        near &= D <= kth[:, None] + margin
                    qi, ri = np.nonzero(near)
                    if len(qi):
                        found.append(rows.iloc[ri + r0].assign(_q=qi + q0, _d=D[qi, ri]))
                        best = _trim(pd.concat(found, ignore_index=True), k, margin, key)
                        found = [best]
                if best is not None:
                    last = best.groupby("_q")["_d"].nth(k - 1)
                    bound[best.loc[last.index, "_q"].to_numpy()] = last.to_numpy()
        if best is not None:
            yield best.assign(query_id=qids[best["_q"].to_numpy()])[["query_id", key] + payload + ["_d"]]

    return run


def _trim(cur: pd.DataFrame, k: int, margin: float, key: str) -> pd.DataFrame:
    """Per query: rows within the rounding margin of the k-th distance; of
    rows with exactly the same distance only the k smallest keys (the others
    are beaten by k rows under the (distance, key) order), so a corpus where a
    third of the vectors coincide still keeps at most k of them."""
    cur = cur.sort_values(["_q", "_d", key], na_position="first", kind="stable", ignore_index=True)
    kth = cur.groupby("_q")["_d"].nth(k - 1)
    limit = cur["_q"].map(dict(zip(cur.loc[kth.index, "_q"], kth))).fillna(np.inf) + margin
    cur = cur[cur["_d"] <= limit]
    return cur[cur.groupby(["_q", "_d"]).cumcount() < k].reset_index(drop=True)


def search_batch(corpus: DataFrame, queries: DataFrame, k=DEFAULT_K, embedding_col: str = "embedding",
                 key: str = "id", query_id: str = "query_id", query_vector_col: str = "vector",
                 columns=None, where=None, metric: str = V.COSINE) -> DataFrame:
    """Top-k per query for a batch of queries (``query_id``, vector): query_id,
    key, ``columns``, distance, similarity and rank.

    Any number of queries: they are a DataFrame, which meets the corpus by a
    join of blocks (``vector_blocks``). Query ids must be unique and the
    vectors of one length; NULL query vectors are left out, one that is zero
    or holds NULL or NaN has no rows (by cosine; zero has a euclidean distance)."""
    emb = embedding_col.replace("`", "")
    payload = [c for c in (columns or []) if c not in (key, emb)]
    cond = R.predicate(where)
    return vector_blocks.search_batch(corpus if cond is None else corpus.where(cond), queries, top_k(k), emb, key, query_id,
                                      query_vector_col, payload, metric, DISTANCE_DIGITS, SIMILARITY_DIGITS)
