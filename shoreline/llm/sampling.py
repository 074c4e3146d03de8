"""Bounded training samples: the labelled ids of smallest hash, so many per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoreline.llm.common import materialise


#: A class is ranked among so many times the sample (in expectation), whatever its size.
SPARE = 4


def per_class(rows: DataFrame, id_col: str, label: Column, most: int) -> tuple[DataFrame, dict]:
    """((``id_col``, ``label``) of up to ``most`` different ids of each class,
    rows by class).

    Only ids and labels are read, and an id counts once per class however many
    rows hold it. The number of a class's ids (a sketch's estimate) gives a hash
    below which about ``SPARE * most`` of them lie; only these are ranked, so no
    task ranks more than that. (Should under ``most`` lie there, which has no
    practical probability, the sample is that much smaller.) Two counts per
    class come to the driver: classes are few."""
    hashed = (rows.select(F.col(f"`{id_col}`").alias("_i"), label.alias("label")).where("label IS NOT NULL")
              .withColumn("_h", F.shiftrightunsigned(F.xxhash64("_i"), 1)))
    counted = hashed.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_h").alias("d")).collect()
    sizes = {r["label"]: r["n"] for r in counted}
    large = [(r["label"], int((1 << 63) * (SPARE * most / r["d"]))) for r in counted if r["d"] > SPARE * most]
    if large:
        below = F.element_at(F.create_map(*[F.lit(x) for pair in large for x in pair]), F.col("label"))
        hashed = hashed.where(below.isNull() | (F.col("_h") < below))
    hashed = hashed.distinct()  # partial first: an id of very many rows is one row per task
    best = F.row_number().over(Window.partitionBy("label").orderBy("_h", "_i"))
    chosen = hashed.withColumn("_r", best).where(F.col("_r") <= most)
    return materialise(chosen.select(F.col("_i").alias(id_col), "label")), sizes


def one_each(rows: DataFrame, *keys: str) -> DataFrame:
    """Of the rows that share ``keys`` the one of smallest ``_h`` (the columns
    beside ``_h`` and the keys are kept). Merged in each task first."""
    others = [c for c in rows.columns if c not in (*keys, "_h")]
    return (rows.groupBy(*keys).agg(F.min_by(F.struct(*others), "_h").alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]))


def windows_per_class(rows: DataFrame, text_col: str, label: Column, most: int, size: int) -> DataFrame:
    """(label, piece): up to ``most`` different pieces of each class, of all
    the pieces of ``size`` bytes that the texts are cut into (the last of a text
    may be shorter), those of smallest hash. Pieces are cut in the tasks; equal
    ones of a class count once; ranking is bounded as in ``per_class``."""
    raw = rows.select(label.alias("label"), F.encode(F.col(f"`{text_col}`"), "UTF-8").alias("_raw")).where(
        "label IS NOT NULL AND octet_length(_raw) > 0")
    last = F.floor((F.octet_length("_raw") - 1) / size).cast("int")
    at = raw.withColumn("_at", F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(F.col("_raw"), k * size + 1, F.lit(size)))))
    pieces = at.select("label", F.col("_at").alias("piece")).withColumn("_h", F.shiftrightunsigned(F.xxhash64("piece"), 1))
    large = [(r["label"], int((1 << 63) * (SPARE * most / r["d"])))
             for r in pieces.groupBy("label").agg(F.approx_count_distinct("_h").alias("d")).collect() if r["d"] > SPARE * most]
    if large:
        below = F.element_at(F.create_map(*[F.lit(x) for pair in large for x in pair]), F.col("label"))
        pieces = pieces.where(below.isNull() | (F.col("_h") < below))
    best = F.row_number().over(Window.partitionBy("label").orderBy("_h", "piece"))
    return materialise(pieces.distinct().withColumn("_r", best).where(F.col("_r") <= most).select("label", "piece"))


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % n
