"""Near-duplicate vectors by random-hyperplane hashing.

Equal vectors form one class first (a third of all rows may be one vector).
Each class gets a sign key in several tables; vectors of one table's key are
compared in double precision, block by block, inside a task. A key held by
more than ``BLOCK`` classes is cut into blocks by a hash of the class, and each
pair of blocks is a group of its own, so no task ever holds more than two
blocks. A pair found in several tables counts in the first only. Pairs are no
rows: a group gives, per class, how many rows it links with there and the
smallest class it reaches there, so a dense group of any size gives as many
rows as it has classes. The latter go to the distributed connected components.

The number of tables follows from the bits per key, so that a pair exactly at
the threshold is missed in all of them with a probability of at most
``MISS``; nearer pairs are missed far less often. Bits grow with the number of
classes, which keeps a key's average holding constant.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shoreline.llm.common import groups, materialise
from shoreline.llm.components import connected_components

BLOCK, FILL, MISS, SEED = 1024, 16, 1e-4, 20240229
#: Keys above BLOCK are joined by broadcast up to so many, else by shuffle.
HOT_BROADCAST = 10_000


def table_shape(n_classes: int, threshold: float) -> tuple[int, int]:
    """(bits per key, tables) for ``n_classes`` distinct vectors."""
    bits = min(30, max(4, round(math.log2(max(1, n_classes) / FILL))))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree**bits))


def _canonical(stored: str):
    """Each vector's bytes (as stored: float or double) and their hash; null
    where the vector links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, digest = [], []
            for v in batch.column("_v").to_pylist():
                x = None if v is None or any(c is None for c in v) else np.asarray(v, dtype=stored)
                if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                    data.append(None)
                    digest.append(None)
                else:
                    data.append((x + x.dtype.type(0)).tobytes())
                    digest.append(xxhash.xxh3_128_digest(data[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(digest, pa.binary()), pa.array(data, pa.binary())], ["_id", "h", "v"])
    return run


def _planes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, count))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _signatures(bits: int, tables: int, stored: str):
    item = np.dtype(stored).itemsize
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            raw = batch.column("v").to_pylist()
            keys = np.empty((len(raw), tables), dtype=np.int64)
            sizes = np.array([len(r) // item for r in raw])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = _unit(np.frombuffer(b"".join(raw[i] for i in at), dtype=stored).astype(np.float64).reshape(-1, dim))
                p = planes.setdefault(dim, _planes(dim, bits * tables))
                keys[at] = ((x @ p) > 0).reshape(len(at), tables, bits) @ weights
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1, dtype=np.int32) * tables),
                                            pa.array(keys.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cid", "n", "v")), pa.array(sizes % 65_536), flat],
                                             ["cid", "n", "v", "dim", "keys"])
    return run


def _least_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` reaches by the links (i, j)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if (low == before).all():
            return low


def _verify(threshold: float, stored: str):
    def linked(g: pd.DataFrame) -> pd.DataFrame | None:
        t, bi, bj = int(g["t"].iloc[0]), int(g["bi"].iloc[0]), int(g["bj"].iloc[0])
        if len(g) < 2:
            return None
        cid, n = g["cid"].to_numpy(), g["n"].to_numpy()
        sizes = g["v"].map(len)
        if sizes.nunique() > 1:  # lengths that clash modulo 65,536
            found = [linked(part) for _, part in g.groupby(sizes)]
            found = [f for f in found if f is not None]
            return pd.concat(found) if found else None
        x = _unit(np.frombuffer(b"".join(g["v"]), dtype=stored).astype(np.float64).reshape(len(g), -1))
        keys = np.stack(g["keys"].to_numpy())
        side = g["b"].to_numpy()
        a, b = (np.arange(len(g)),) * 2 if bi == bj else (np.flatnonzero(side == bi), np.flatnonzero(side == bj))
        i, j = np.nonzero(np.clip(x[a] @ x[b].T, -1, 1) >= threshold)
        i, j = a[i], b[j]
        ok = i < j if bi == bj else np.ones(len(i), dtype=bool)
        ok[ok] = np.argmax(keys[i[ok]] == keys[j[ok]], axis=1) == t
        i, j = i[ok], j[ok]
        if not len(i):
            return None
        others = np.bincount(i, n[j], len(g)) + np.bincount(j, n[i], len(g))
        at = np.flatnonzero(others)
        return pd.DataFrame({"cid": cid[at], "others": others[at].astype(np.int64), "root": cid[_least_reachable(len(g), i, j)[at]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups(frames, ["t", "key", "bi", "bj"]):
            if (found := linked(g)) is not None:
                yield found
    return run


def _blocked(keyed: DataFrame) -> DataFrame:
    """Rows with their block ``b`` and the block pair (``bi``, ``bj``) of each
    group they belong to; (0, 0) for keys of up to BLOCK classes."""
    hot = materialise(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > BLOCK))
    n_hot = hot.count()
    side = F.broadcast(hot) if n_hot <= HOT_BROADCAST else hot
    blocks = F.ceil(F.coalesce(F.col("held"), F.lit(0)) / F.lit(BLOCK * 0.8)).cast("int")
    return (keyed.join(side, ["t", "key"], "left")
            .withColumn("nb", F.when(F.col("held").isNull(), 1).otherwise(blocks))
            .withColumn("b", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("t", "key", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"),
                    "b", "cid", "n", "v", "keys"))


def near_duplicate_vectors(vecs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           threshold: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """(per-vector result, links that keep the components together).

    The result has ``id_col``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, its own included) and ``kept``
    (the id is that smallest one). Links are (a, b): a class and the smallest
    one it reaches in one group of compared classes; neither copies nor the
    pairs within a group are expanded.
    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, nor do vectors of different lengths. Rows that repeat an
    id are rows of their own; a null id links as usual but never names a
    component. An empty table gives no rows, other columns are not read.
    """
    kind = dict(vecs.dtypes)[id_col]
    narrow = dict(vecs.dtypes)[vector_col] == "array<float>"  # kept as such: half the bytes to shuffle
    stored = "float32" if narrow else "float64"
    rows = materialise(vecs.select(F.col(f"`{id_col}`").alias("_id"),
                                   F.col(f"`{vector_col}`").cast("array<float>" if narrow else "array<double>").alias("_v"))
                       .mapInArrow(_canonical(stored), f"_id {kind}, h binary, v binary"))
    classes = materialise(rows.where("h IS NOT NULL").groupBy("h").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
        .withColumn("cid", F.monotonically_increasing_id()))
    bits, tables = table_shape(classes.count(), threshold)
    keyed = (classes.select("cid", "n", "v")
             .mapInArrow(_signatures(bits, tables, stored), "cid long, n long, v binary, dim long, keys array<int>")
             .select("cid", "n", "v", "dim", "keys", F.posexplode("keys").alias("t", "sign"))
             # vectors of another length never share a key
             .select("cid", "n", "v", "keys", "t", (F.col("sign").cast("long") * 65_536 + F.col("dim")).alias("key")))
    parts = ["t", "key", "bi", "bj"]
    found = materialise(_blocked(keyed).repartition(*parts).sortWithinPartitions(*parts)
                        .mapInPandas(_verify(threshold, stored), "cid long, others long, root long"))
    linked = found.groupBy("cid").agg(F.sum("others").alias("others"))
    links = found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct()
    found = connected_components(links).withColumnRenamed("node", "cid")
    named = (classes.select("h", "cid", "n", "first").join(found, "cid", "left").join(linked, "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    nodes = materialise(named.join(least, "component").select(
        "h", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    alone = rows.where("h IS NULL").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    result = rows.where("h IS NOT NULL").select("_id", "h").join(nodes, "h").select("_id", "n_links", "component_id")
    result = result.unionByName(alone).select(
        F.col("_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return result, links
