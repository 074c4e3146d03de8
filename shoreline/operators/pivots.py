"""Exact euclidean search that skips: distances to a few pivots, kept with the vectors.

The index is a versioned table with, per vector, its nearest pivot, the
distance to it and to every pivot, clustered by (pivot, distance). For a query
any k rows give an upper bound on the k-th distance; those whose distance to
the query's own pivot is most like the query's make it a small one. By the
triangle inequality a row whose distance to some pivot differs from the
query's by more than the bound cannot be among the k nearest: these are
filters on stored numbers, which reach the Parquet scan, and only the rows that
pass are measured. The answer is that of the full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import vectors as V
from shoreline.operators import vector as VS
from shoreline.operators.partitioning import spread
from shoreline.operators.read import quote
from shoreline.operators.table import VersionedTable

#: Vectors among which pivots are chosen.
SAMPLE = 2_000
#: Relative slack on stored distances, above what rounding can add.
SLACK = 1e-9


class PivotIndex:
    def __init__(self, table: VersionedTable, pivots: np.ndarray, key: str, vector: str):
        self.table, self.pivots, self.key, self.vector = table, pivots, key, vector


def choose_pivots(df: DataFrame, vector: str, n: int, sample: int = SAMPLE) -> np.ndarray:
    """``n`` vectors far apart, from the ``sample`` usable vectors of smallest
    hash: the first at random, each next one farthest from those before."""
    v = F.col(quote(vector)).cast("array<double>")
    rows = (df.select(v.alias("v")).where(_usable("v")).withColumn("h", F.xxhash64("v")).orderBy("h").limit(sample).collect())
    if not rows:
        raise ValueError("no usable vector")
    lens = [len(r["v"]) for r in rows]
    dim = max(set(lens), key=lambda d: (lens.count(d), d))
    x = np.unique(np.array([r["v"] for r in rows if len(r["v"]) == dim]), axis=0)
    chosen = [0]
    far = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(chosen) < min(n, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(((x - x[chosen[-1]]) ** 2).sum(axis=1)))
    return x[chosen]


def _usable(name: str):
    c = F.col(name)
    return c.isNotNull() & (F.size(c) > 0) & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def build(df: DataFrame, path: str, key: str, vector: str = "embedding", columns: list[str] = (), n_pivots: int = 8, now=None) -> PivotIndex:
    """Index ``df`` (``key``, ``vector``, ``columns``) at ``path``. Vectors that
    are NULL, of another length than most, or hold NULL, NaN or infinite
    elements have no distance to anything and are left out."""
    pivots = choose_pivots(df, vector, n_pivots)
    names = [f"_d{i}" for i in range(len(pivots))]
    kept = [key, *[c for c in columns if c not in (key, vector)]]
    base = spread(df.select(*[F.col(quote(c)) for c in kept], F.col(quote(vector)).cast("array<double>").alias("_v"))
                  .where(_usable("_v") & (F.size("_v") == pivots.shape[1])))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x = np.stack(f["_v"].to_numpy())
            d = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
            out = f.assign(**{n: d[:, i] for i, n in enumerate(names)})
            out["_pivot"], out["_dist"] = d.argmin(axis=1).astype(np.int32), d.min(axis=1)
            yield out
    schema = T.StructType([*base.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names],
                           T.StructField("_pivot", T.IntegerType()), T.StructField("_dist", T.DoubleType())])
    table = VersionedTable.create(df.sparkSession, path, schema, data=base.mapInPandas(run, schema),
                                  cluster_by=["_pivot", "_dist"], now=now)
    return PivotIndex(table, pivots, key, vector)


def search(index: PivotIndex, query, k=VS.DEFAULT_K, columns=None) -> DataFrame:
    """``vector.search`` by euclidean distance over the indexed vectors: the
    same rows, distances and ties, from fewer rows read."""
    n = VS.top_k(k)
    cols = [c for c in (columns or [index.key])]
    return VS.search(candidates(index, query, n), query, k=n, embedding_col="_v", columns=cols, metric=V.EUCLIDEAN, key=index.key)


def candidates(index: PivotIndex, query, k: int) -> DataFrame:
    """The rows that the triangle inequality leaves for the ``k`` nearest."""
    q = np.asarray(VS.query_vector(query), dtype=np.float64)
    rows = index.table.read()
    if len(q) != index.pivots.shape[1]:
        return rows.limit(0)
    to = np.sqrt(((index.pivots - q) ** 2).sum(axis=1))
    own = int(to.argmin())
    like = rows.where(F.col("_pivot") == own).orderBy(F.abs(F.col("_dist") - float(to[own])), F.col(quote(index.key))).limit(k)
    seen = [np.asarray(r["_v"]) for r in like.select("_v").collect()]  # k vectors
    if len(seen) < k:
        bound = float("inf")  # too few around this pivot: any k rows will do
        seen = [np.asarray(r["_v"]) for r in rows.select("_v").limit(k).collect()]
    if len(seen) >= k:
        bound = max(float(np.sqrt(((v - q) ** 2).sum())) for v in seen)
    else:
        return rows
    # rows whose rounded distance ties with the k-th count too; stored distances may be off in their last digits
    reach = bound + 10.0 ** -VS.DISTANCE_DIGITS + SLACK * (1 + bound + float(to.max()))
    near = F.lit(False)
    for i, d in enumerate(to.tolist()):
        near = near | ((F.col("_pivot") == i) & F.col("_dist").between(d - reach, d + reach))
    out = rows.where(near)
    for i, d in enumerate(to.tolist()):
        out = out.where(F.col(f"_d{i}").between(d - reach, d + reach))
    return out


__all__ = ["PivotIndex", "choose_pivots", "build", "search", "candidates"]
