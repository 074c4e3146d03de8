"""Mergeable summaries: distinct counts and quantiles of any union of groups
from one small row per group.

``summarize`` reduces rows to a row per group (a day, say) with the row count,
an HLL sketch and a KLL sketch. Such rows can be stored and added to as data
comes in. ``combine`` merges them over any coarser grouping or range without
going back to the rows: a distinct count over thirty days merges thirty
sketches of a few kilobytes, where an exact one would shuffle thirty days of
ids. Both merges are associative, so partial aggregation bounds what is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Registers of a distinct-count sketch (2 to this power) and size parameter of a quantile sketch.
HLL_BITS, KLL_SIZE = 12, 200


def distinct_error(bits: int = HLL_BITS, deviations: float = 3.0) -> float:
    """Relative error that an estimate stays within (``deviations`` standard errors)."""
    return deviations * 1.04 / (1 << bits) ** 0.5


def rank_error(size: int = KLL_SIZE) -> float:
    """Bound on how far a quantile's rank may be off, as a share of the rows (99 % confidence)."""
    return 2.296 / size ** 0.9021


def summarize(df: DataFrame, by: list[str | Column], distinct: str, quantile: str, bits: int = HLL_BITS,
              size: int = KLL_SIZE) -> DataFrame:
    """One row per group: ``by``, ``n``, ``distinct_sketch``, ``quantile_sketch``.

    NULLs are left out of both sketches, NaN of the quantiles; a group of
    NULLs only has a NULL sketch. Columns named by ``distinct`` may be of any
    type that casts to text."""
    kind = df.schema[distinct].dataType
    ids = F.col(f"`{distinct}`")
    ids = ids.cast("long") if isinstance(kind, T.IntegralType) else ids.cast("string")
    value = F.col(f"`{quantile}`").cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                               F.when(F.count(ids) > 0, F.hll_sketch_agg(ids, F.lit(bits))).alias("distinct_sketch"),
                               F.when(F.count(F.nanvl(value, F.lit(None).cast("double"))) > 0,
                                      F.kll_sketch_agg_double(F.nanvl(value, F.lit(None).cast("double")), F.lit(size))).alias("quantile_sketch"))


def combine(summaries: DataFrame, by: list[str | Column] = (), size: int = KLL_SIZE) -> DataFrame:
    """``summaries`` merged per ``by`` (all of them without it), in the same form."""
    return summaries.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(size)).alias("quantile_sketch"))


def estimate(summaries: DataFrame, quantiles: dict[str, float], keep: list[str]) -> DataFrame:
    """``keep``, ``n``, ``distinct_estimate`` (0 for groups of NULLs) and one column per quantile."""
    return summaries.select(
        *keep, "n", F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0).cast("long")).alias("distinct_estimate"),
        *[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))).alias(name) for name, q in quantiles.items()])


__all__ = ["summarize", "combine", "estimate", "distinct_error", "rank_error"]
