"""SimHash near-duplicates with a pigeonring candidate filter.

Fingerprints are computed per document in the tasks that read the texts; from
there on only 64-bit numbers move. Equal fingerprints are one node. For a
distance of at most ``k`` the 64 bits form a ring of ``k + 1`` segments. The
pigeonring principle (Qin and Xiao, "Pigeonring: A Principle for Faster
Thresholded Similarity Search", 2018) says that two fingerprints within ``k``
bits have a segment from which every chain of ``l`` consecutive segments
differs in at most ``l * k / (k + 1)`` bits: none in the first segment, one
over the first two. The filter keeps a fingerprint only if another one shares
such a chain start: the first segment as it is and the second with one bit
position masked (two values that differ in at most one bit agree under the mask
of that bit). It counts fingerprints per chain key and never forms pairs.

The full Hamming check joins no pairs either: two survivors are within ``k``
bits exactly if they share a number at distance ``k // 2`` from both, up to one
masked bit position if ``k`` is odd. All members of such a group are linked
pairwise, so a link of each to the group's smallest is enough for the
components, and rows stay linear in the survivors also for a third of all
documents being near copies. Each of these links is checked by bit count again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shoreline.llm.common import materialise
from shoreline.llm.components import connected_components

SEED = 42
#: Hashes turned into bits at once, so that a long text needs little memory.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text as a signed number (see contract op4)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(h[at:at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in batch.column("_text")]
            at = batch.schema.get_field_index("_text")
            yield batch.remove_column(at).append_column("_fp", pa.array(fp, pa.int64()))
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(``id_col``, ``_fp``) per row of ``docs``."""
    narrow = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    kind = dict(narrow.dtypes)[id_col]
    return narrow.mapInArrow(_fingerprints(shingle), f"`{id_col}` {kind}, _fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def chain_keys(max_bits: int) -> list[tuple[int, int]]:
    """(number, mask) of every chain key: first segment whole, second less one bit."""
    m = max_bits + 1
    edges = [round(64 * i / m) for i in range(m + 1)]
    keys = []
    for i in range(m):
        def ones(s: int) -> int:
            return ((1 << (edges[s + 1] - edges[s])) - 1) << edges[s]
        if max_bits < 2:  # one bit over two segments is the whole check
            keys.append(ones(i))
            continue
        j = (i + 1) % m
        keys += [ones(i) | ones(j) & ~(1 << b) for b in range(edges[j], edges[j + 1])]
    return [(n, _signed(k)) for n, k in enumerate(keys)]


def chain_survivors(fps: DataFrame, max_bits: int) -> DataFrame:
    """The distinct fingerprints that share a chain key with another one."""
    table = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("mask")) for n, k in chain_keys(max_bits)])
    keyed = (fps.select("fp", F.explode(table).alias("k"))
             .select("fp", F.col("k.n").alias("n"), F.col("fp").bitwiseAND(F.col("k.mask")).alias("key")))
    shared = (keyed.groupBy("n", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
              .where("lo <> hi").select("n", "key"))
    return keyed.join(shared, ["n", "key"], "left_semi").select("fp").distinct()


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links whose components are those of all pairs of the distinct
    fingerprints ``fp`` within ``max_bits`` bits. Linear in the survivors."""
    kept = materialise(chain_survivors(fps, max_bits))
    near = [0]
    for r in range(1, max_bits // 2 + 1):
        near += [sum(1 << b for b in c) for c in combinations(range(64), r)]
    middle = F.explode(F.array(*[F.lit(_signed(x)) for x in near])).alias("flip")
    points = kept.select("fp", middle).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("p"))
    if max_bits % 2:
        masks = F.explode(F.array(*[F.struct(F.lit(b).alias("n"), F.lit(_signed(~(1 << b) & (2**64 - 1))).alias("mask"))
                                    for b in range(64)])).alias("k")
        points = points.select("fp", "p", masks).select(
            "fp", F.struct("k.n", F.col("p").bitwiseAND(F.col("k.mask")).alias("p")).alias("p"))
    # A group has at most 65 members per point for two bits: within one bit of it.
    grouped = points.groupBy("p").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    pairs = (grouped.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
             .where("a <> b").distinct())
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(``id_col``, ``fingerprint``, ``component_id``) per row of ``docs``:
    documents whose fingerprints differ in ``max_bits`` bits or fewer are
    linked, and ``component_id`` is the smallest id reachable.

    Null and empty texts and texts without words have fingerprint zero and are
    linked like any other. A row with a null id belongs to its component but
    never names it (a component of such rows alone has a null id). Rows that
    repeat an id or a text give one row each. An empty table gives no rows,
    other columns are not read. ``max_bits`` may be 0 to 3; cost grows with
    ``64 ** (max_bits // 2 + max_bits % 2)`` per survivor.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    marked = materialise(fingerprints(docs, id_col, text_col, shingle))
    distinct = materialise(marked.groupBy(F.col("_fp").alias("fp")).agg(F.min(F.col(f"`{id_col}`")).alias("first")))
    if max_bits:
        found = connected_components(links(distinct.select("fp"), max_bits))
        named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component"))
        least = named.groupBy("component").agg(F.min("first").alias("component_id"))
        nodes = named.join(least, "component").select("fp", "component_id")
    else:
        nodes = distinct.select("fp", F.col("first").alias("component_id"))
    nodes = materialise(nodes).select(F.col("fp").alias("_fp"), "component_id")
    return (marked.join(nodes, "_fp")
            .select(F.col(f"`{id_col}`"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"))
