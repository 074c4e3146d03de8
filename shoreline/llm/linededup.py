"""Exact line deduplication across documents.

Every line long enough gives a row (128-bit hash of its key, document,
position). The rows are range-partitioned by hash, document and position, so
that a line held by a third of all documents is spread over many tasks, and
sorted inside each task; a stream over the sorted rows keeps the lines of the
first document of each hash and drops the others. Only the run of equal hashes
that opens a task can have begun in an earlier one: the lines of its first
document stay undecided there and are settled by the smallest document among
the runs at task borders, one or two rows per task. The result is a
zlib-compressed keep bitmap per document; the text itself is not shuffled to
find the duplicates.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType

from shoreline.llm.common import ASCII_SPACE, materialise

#: A null document id ranks behind every other id.
LAST = 2**63 - 1
_SEEN = "kind int, h1 long, h2 long, doc long, rid long, pos int"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(F.col(f"`{text_col}`")).alias("rid"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def _lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, rid = batch.column("doc").to_numpy(), batch.column("rid").to_numpy()
            row, pos, keys = [], [], []
            for i, text in enumerate(batch.column("text")):
                for p, line in enumerate(text.as_py().split("\n")):
                    key = line.strip(ASCII_SPACE)
                    if len(key) >= min_chars:
                        row.append(i)
                        pos.append(p)
                        keys.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()))
            h = np.frombuffer(b"".join(keys), dtype=">i8").astype(np.int64).reshape(-1, 2)
            row = np.asarray(row, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({
                "h1": h[:, 0].copy(), "h2": h[:, 1].copy(), "doc": doc[row], "rid": rid[row],
                "pos": np.asarray(pos, dtype=np.int32)})
    return run


def _first_occurrences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over one task's sorted rows: kind 0, a line to drop; kind 1, a line of
    the opening run whose fate an earlier task may decide; kind 2, the last
    run's hash and first document."""
    key, first, opening = None, None, True
    for f in frames:
        if not len(f):
            continue
        h1, h2, doc = (f[c].to_numpy() for c in ("h1", "h2", "doc"))
        new = np.empty(len(f), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = key != (h1[0], h2[0])
        if new[0] and key is not None:
            opening = False
        start = np.maximum.accumulate(np.where(new, np.arange(len(f)), -1))
        lead = np.where(start >= 0, doc[np.maximum(start, 0)], first if first is not None else 0)
        drop = doc != lead
        head = np.zeros(len(f), dtype=bool)
        if opening:
            runs = np.cumsum(new) - (1 if key is None else 0)
            head = (runs == 0) & ~drop
            opening = bool(runs[-1] == 0)
        key, first = (h1[-1], h2[-1]), lead[-1]
        if (drop | head).any():
            out = f[drop | head]
            yield out.assign(kind=np.where(drop, 0, 1)[drop | head].astype(np.int32))[
                ["kind", "h1", "h2", "doc", "rid", "pos"]]
    if key is not None:
        yield pd.DataFrame({"kind": np.int32([2]), "h1": [key[0]], "h2": [key[1]], "doc": [first],
                            "rid": [0], "pos": np.int32([0])})


@F.pandas_udf(BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for n, gone in zip(n_lines, dropped):
        keep = np.ones(int(n), dtype=np.uint8)
        if gone is not None and len(gone):
            keep[np.asarray(gone, dtype=np.int64)] = 0
        out.append(zlib.compress(np.packbits(keep).tobytes(), 6))
    return pd.Series(out)


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The keep flags of a bitmap, one per line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def line_keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = 10) -> DataFrame:
    """(doc, rid, n_lines, n_dropped, keep) per distinct (document id, text):
    ``keep`` is a compressed bitmap over the ``\\n``-split lines.

    A line's key is the line without ASCII white space at its ends, A-Z in
    lower case. Keys of ``min_chars`` code points or more lose all lines
    outside the smallest document id that holds them. Null or empty text is
    one empty line. A null id ranks last; rows that share an id count as one
    document (a line in several of them stays in each); ``rid`` is the hash
    that tells their texts apart. An empty table gives no rows, other columns
    are not read.
    """
    base = _keyed(docs, id_col, text_col)
    lines = materialise(base.mapInArrow(_lines(min_chars), "h1 long, h2 long, doc long, rid long, pos int"))
    order = ["h1", "h2", "doc", "rid", "pos"]
    seen = materialise(lines.repartitionByRange(*order).sortWithinPartitions(*order)
                       .mapInPandas(_first_occurrences, _SEEN))
    border = seen.where("kind > 0").groupBy("h1", "h2").agg(F.min("doc").alias("least"))
    late = (seen.where("kind = 1").join(border, ["h1", "h2"]).where("doc > least")
            .select("doc", "rid", "pos"))
    gone = (seen.where("kind = 0").select("doc", "rid", "pos").unionByName(late)
            .groupBy("doc", "rid").agg(F.sort_array(F.collect_set("pos")).alias("gone")))
    sizes = base.groupBy("doc", "rid").agg(
        F.max(F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("long").alias("n_lines"))
    return (sizes.join(gone, ["doc", "rid"], "left")
            .select("doc", "rid", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                    _bitmap("n_lines", "gone").alias("keep")))


def _kept_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, keep, n, gone in zip(*(batch.column(c).to_pylist() for c in ("text", "keep", "n_lines", "n_dropped"))):
            if gone:
                text = "\n".join(line for line, k in zip(text.split("\n"), unpack_bitmap(keep, n)) if k)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), batch.column("n_lines"),
                                          batch.column("n_dropped")], ["row", "text", "n_lines", "n_dropped"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with each text reduced to its kept lines (joined by ``\\n``; null
    becomes empty), plus ``_n_lines`` and ``_n_dropped`` (in the place of
    columns of these names). All other columns and all rows stay."""
    others = [c for c in docs.columns if c not in (text_col, "_n_lines", "_n_dropped")]
    text = F.col(f"`{text_col}`")
    # the row's other columns travel as one struct, so that no name can clash
    packed = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("rid"),
                         F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    marks = bitmaps.select("doc", "rid", "n_lines", "n_dropped", F.when(F.col("n_dropped") > 0, F.col("keep")).alias("keep"))
    joined = packed.join(marks, ["doc", "rid"], "left").select("row", "text", "n_lines", "n_dropped", "keep")
    out = joined.mapInArrow(_kept_texts, joined.drop("keep").schema)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns
                        if c in others or c == text_col],
                      F.col("n_lines").alias("_n_lines"), F.col("n_dropped").alias("_n_dropped"))


def sha256_hex(col) -> Column:
    """Lowercase hex digest of a text column in UTF-8."""
    return F.sha2(F.encode(col, "UTF-8"), 256)


__all__ = ["line_keep_bitmaps", "apply_bitmaps", "unpack_bitmap", "sha256_hex"]
