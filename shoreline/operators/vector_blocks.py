"""Block join of query vectors and corpus vectors, exact top-k per query.

Both sides are packed where they lie into block rows: a block holds a list of
keys (and carried columns) and one matrix, so a pair of blocks is one row of a
DataFrame join and never one row per vector pair. Queries are dealt by hash
into cells of about ``BROADCAST_BYTES``; every corpus block is joined with the query blocks
of every cell.

While all query blocks together stay under ``BROADCAST_BYTES`` (their counted
size), they are the broadcast side of that join and the corpus stays in its
scan tasks, without a shuffle. Beyond it both sides are shuffled on (group,
cell): the corpus blocks are dealt over groups, query blocks are repeated per
group, and a cell of a group holds a bounded number of pairs.

A pair's distances are computed in tiles. A task keeps the running top-k of
the query blocks it sees (with the rows inside the rounding margin) and gives
them out when it ends or holds too many; one ranking per query follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import vectors as V
from shoreline.operators import read as R
from shoreline.operators.partitioning import spread
from shoreline.operators.stage import materialize

#: Bytes of a block's matrix, and of all query blocks that may be broadcast.
BLOCK_BYTES, BROADCAST_BYTES = 4 * 1024 * 1024, 64 * 1024 * 1024
#: Upper bound on one tile of a distance matrix, and candidates a task holds.
TILE_BYTES, HELD = 16 * 1024 * 1024, 500_000
#: Corpus blocks that meet a cell's query blocks in one group of the shuffled form.
GROUP_BLOCKS = 64


def _usable(column: pa.ChunkedArray | pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, matrix) of the vectors of length ``dim`` without NULL or NaN."""
    lens = np.array([-1 if v is None else v for v in column.value_lengths().to_pylist()], dtype=np.int64)
    at = np.flatnonzero(lens == dim)
    if not len(at):
        return at, np.empty((0, dim))
    flat = column.take(pa.array(at)).flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    fine = ~np.isnan(x).any(axis=1)
    return at[fine], x[fine]


def _pack(vector: str, dim: int, most: int):
    """Batches of (columns…, vector) to rows (items: list of the columns, matrix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _usable(batch.column(vector), dim)
            names = [n for n in batch.schema.names if n != vector]
            kept = [batch.column(n).take(pa.array(at)) for n in names]
            for a in range(0, len(at), most):
                part = [c.slice(a, most) for c in kept]
                items = pa.StructArray.from_arrays(part, names=names)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items),
                     pa.array([x[a:a + most].tobytes()], pa.binary())], ["items", "matrix"])
    return run


def packed(df: DataFrame, vector: str, dim: int, block_bytes: int | None = None) -> DataFrame:
    """Block rows (items, matrix) of ``df``; rows whose vector is NULL, of
    another length, or holds NULL or NaN are left out."""
    kind = T.StructType([f for f in df.schema.fields if f.name != vector])
    schema = T.StructType([T.StructField("items", T.ArrayType(kind)), T.StructField("matrix", T.BinaryType())])
    return df.mapInArrow(_pack(vector, dim, max(1, (block_bytes or BLOCK_BYTES) // (8 * dim))), schema)


def _distances(metric: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if metric == V.EUCLIDEAN:
        return np.stack([np.sqrt(((x - v) ** 2).sum(axis=1)) for v in q])
    norms = np.outer(np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1)))
    with np.errstate(divide="ignore", invalid="ignore"):
        d = 1.0 - (q @ x.T) / norms
    d[norms == 0] = np.nan
    return d


def trim(found: pd.DataFrame, k: int, margin: float) -> pd.DataFrame:
    """Per query ``q``: the rows within the margin of the k-th distance; of rows
    at one distance only the k smallest keys, which beat the others anyway."""
    found = found.sort_values(["q", "d", "key"], na_position="first", kind="stable", ignore_index=True)
    kth = found.groupby("q")["d"].nth(k - 1)
    limit = found["q"].map(dict(zip(found.loc[kth.index, "q"], kth))).fillna(np.inf) + margin
    found = found[found["d"] <= limit]
    return found[found.groupby(["q", "d"]).cumcount() < k].reset_index(drop=True)


class _Running:
    """The running top-k of one query block."""

    def __init__(self, ids: list, matrix: np.ndarray, k: int, margin: float, metric: str):
        self.ids, self.matrix, self.k, self.margin, self.metric = ids, matrix, k, margin, metric
        self.bound = np.full(len(matrix), np.inf)
        self.best: pd.DataFrame | None = None

    def add(self, keys: list, items: list, x: np.ndarray) -> None:
        width = max(1, TILE_BYTES // (8 * 2048))
        for a in range(0, len(self.matrix), width):
            part = slice(a, min(len(self.matrix), a + width))
            step = max(1, TILE_BYTES // (8 * (part.stop - a)))
            for b in range(0, len(x), step):
                d = _distances(self.metric, self.matrix[part], x[b:b + step])
                near = d <= self.bound[part, None] + self.margin  # NaN is never near
                if d.shape[1] > self.k:
                    kth = np.partition(np.where(near, d, np.inf), self.k - 1, axis=1)[:, self.k - 1]
                    near &= d <= kth[:, None] + self.margin
                qi, ri = np.nonzero(near)
                if not len(qi):
                    continue
                new = pd.DataFrame({"q": qi + a, "d": d[qi, ri], "key": [keys[i + b] for i in ri.tolist()],
                                    "item": [items[i + b] for i in ri.tolist()]})
                both = new if self.best is None else pd.concat([self.best, new], ignore_index=True)
                self.best = trim(both, self.k, self.margin)
                last = self.best.groupby("q")["d"].nth(self.k - 1)
                self.bound[self.best.loc[last.index, "q"].to_numpy()] = last.to_numpy()


def _pairs(key: str, dim: int, metric: str, k: int, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: dict[int, _Running] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for r in running.values():
                if r.best is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r.ids[i] for i in r.best["q"]], id_kind), pa.array(r.best["item"].tolist(), item_kind),
                         pa.array(r.best["d"], pa.float64())], ["query_id", "item", "d"])
            running.clear()

        for batch in batches:
            id_kind = batch.schema.field("q_items").type.value_type.field("id").type
            item_kind = batch.schema.field("items").type.value_type
            for i in range(batch.num_rows):
                block = batch.column("q_block")[i].as_py()
                if block not in running:
                    if sum(len(r.best) for r in running.values() if r.best is not None) > HELD:
                        yield from given()
                    q = np.frombuffer(batch.column("q_matrix")[i].as_buffer(), dtype=np.float64).reshape(-1, dim)
                    running[block] = _Running([x["id"] for x in batch.column("q_items")[i].as_py()], q, k, margin, metric)
                items = batch.column("items")[i].as_py()
                x = np.frombuffer(batch.column("matrix")[i].as_buffer(), dtype=np.float64).reshape(-1, dim)
                running[block].add([it[key] for it in items], items, x)
        yield from given()
    return run


def top_k_pairs(corpus: DataFrame, queries: DataFrame, k: int, key: str, payload: list[str], vector: str,
                metric: str = V.COSINE, digits: int = 6) -> DataFrame:
    """(query_id, item, d): for every query of ``queries`` (id, v) a set of
    corpus rows that holds its k nearest by (distance rounded to ``digits``,
    key), at most a few more than k per task. ``item`` is a struct of the key
    and the ``payload`` columns. Query ids must be unique, queries of one length."""
    queries, _ = materialize(queries, "query_vectors")
    stats = queries.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.max(F.size("v")).alias("dim"),
                        F.min(F.size("v")).alias("least")).first()
    if not stats["n"]:
        raise ValueError("no query vectors")
    if stats["least"] != stats["dim"]:
        raise ValueError(f"query vectors differ in length ({stats['least']} to {stats['dim']}); "
                         "every query needs the corpus vector length")
    if stats["ids"] != stats["n"]:
        raise ValueError("query ids must be unique in a batch search")
    dim = stats["dim"]
    size = stats["n"] * dim * 8
    cells = max(1, -(-size // BROADCAST_BYTES))  # the corpus is repeated once per cell
    q = (queries.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int")).repartition(min(cells, 10_000), "cell")
         .sortWithinPartitions("cell"))
    q = _packed_by_cell(q, dim)
    blocks = packed(spread(corpus.where(F.col(R.quote(vector)).isNotNull())
                           .select(F.col(R.quote(key)), *[F.col(R.quote(c)) for c in payload],
                                   F.col(R.quote(vector)).cast("array<double>").alias("_emb"))), "_emb", dim)
    every = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    if size <= BROADCAST_BYTES:
        pairs = blocks.withColumn("cell", every).join(F.broadcast(q), "cell")
    else:
        # Both sides meet on (group, cell). A group holds about GROUP_BLOCKS corpus blocks.
        blocks, seen = materialize(blocks, "corpus_blocks", [F.count(F.lit(1)).alias("n")])
        groups = max(1, -(-seen["n"] // GROUP_BLOCKS))
        dealt = blocks.withColumn("group", F.pmod(F.xxhash64("matrix"), F.lit(groups)).cast("int")).withColumn("cell", every)
        pairs = q.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(dealt, ["group", "cell"])
    item = T.StructType([corpus.schema[c] for c in [key, *payload]])
    schema = T.StructType([T.StructField("query_id", queries.schema["id"].dataType), T.StructField("item", item),
                           T.StructField("d", T.DoubleType())])
    fn = _pairs(key, dim, (metric or V.COSINE).upper(), k, 10.0 ** -digits)
    return pairs.select("items", "matrix", "q_block", "q_items", "q_matrix").mapInArrow(fn, schema)


def _packed_by_cell(q: DataFrame, dim: int) -> DataFrame:
    """Query blocks (cell, q_block, q_items, q_matrix); a block is of one cell."""
    kind = T.StructType([q.schema["id"]])
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("q_items", T.ArrayType(kind)),
                           T.StructField("q_matrix", T.BinaryType())])
    pack = _pack("v", dim, max(1, BLOCK_BYTES // (8 * dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)] if len(cells) else [0, 0]
            for a, b in zip(cuts, cuts[1:]):
                for row in pack(iter([batch.slice(a, b - a).select(["id", "v"])])):
                    yield pa.RecordBatch.from_arrays([pa.array([cells[a]], pa.int32()), row.column(0), row.column(1)],
                                                     ["cell", "q_items", "q_matrix"])
    out, _ = materialize(q.select("cell", "id", "v").mapInArrow(run, schema), "query_blocks")
    return out.withColumn("q_block", F.monotonically_increasing_id())


def search_batch(corpus: DataFrame, queries: DataFrame, k: int, embedding_col: str, key: str, query_id: str,
                 query_vector_col: str, payload: list[str], metric: str, digits: int, similarity_digits: int) -> DataFrame:
    q = queries.select(F.col(query_id).alias("id"), F.col(query_vector_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull())
    local = top_k_pairs(corpus, q, k, key, payload, embedding_col, metric, digits)
    best = Window.partitionBy("query_id").orderBy(F.col("distance").asc(), F.col("item").getField(key).asc())
    ranked = (local.withColumn("distance", F.round("d", digits)).withColumn("similarity", F.round(F.lit(1.0) - F.col("d"), similarity_digits))
              .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    return ranked.select("query_id", *[F.col("item").getField(c).alias(c) for c in [key, *payload]], "distance", "similarity", "rank")
