"""Inputs the registered queries derive from the test tables with Spark.

Every fixture is a DataFrame expression over a whole table, so its size
follows the table. The SQL oracles build the same inputs with the CTEs in
``shoreline.plans.oracle``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.sources.tables import load

# Fixed values shared with the SQL oracles.
COMMIT_TIME = datetime(2024, 2, 1, 12, 0, 0)
COMMIT_TIME_2 = datetime(2024, 2, 2, 8, 30, 0)
HOT_TIME = "2024-01-15 12:00:00"
PRODUCT_EPOCH = "2024-01-01 00:00:00"
EDIT_MOD = 50
NEW_KEY_OFFSET = 1_000_000_000
CHANGE_MOD = 20


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as the writeback product table: id, product, price, stock,
    updated_at (a distinct second per key)."""
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("product"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("stock"),
        F.timestamp_add("SECOND", F.col("p_partkey"),
                       F.lit(PRODUCT_EPOCH).cast("timestamp_ntz")).alias("updated_at"),
    )


def edited_products(base: DataFrame) -> DataFrame:
    """The edited copy, by ``id % 50``: 0 deleted; 1 price +1; 2 product
    padded with spaces (no change); 3 price +1e-7 (no change); 4 stock +5;
    5 product renamed; 6 also gives a new row with a new key."""
    m = F.col("id") % EDIT_MOD
    kept = base.where(m != 0).select(
        "id",
        F.when(m == 2, F.concat(F.lit("  "), F.col("product"), F.lit("  ")))
         .when(m == 5, F.concat(F.col("product"), F.lit(" v2")))
         .otherwise(F.col("product")).alias("product"),
        F.when(m == 1, F.col("price") + 1.0).when(m == 3, F.col("price") + 1e-7)
         .otherwise(F.col("price")).alias("price"),
        F.when(m == 4, F.col("stock") + 5).otherwise(F.col("stock")).alias("stock"),
        "updated_at",
    )
    added = base.where(m == 6).select(
        (F.col("id") + NEW_KEY_OFFSET).alias("id"),
        F.concat(F.lit("new "), F.col("product")).alias("product"),
        F.col("price"),
        F.lit(1).cast("bigint").alias("stock"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    return kept.unionByName(added)


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change set on ``events`` keyed by event_id with ``ts`` as version
    time, by ``event_id % 20``: 0 update, same time; 1 update, original
    0.4 s later (applies); 2 update, original 5 s earlier (stale); 3 update
    without original time (applies); 4 delete, same time; 5 delete, 5 s
    off (stale); 6 insert on an existing key (conflict); 7 insert, new key."""
    e = load(spark, sf_dir, "events")
    m = F.col("event_id") % CHANGE_MOD
    stamp = F.lit(COMMIT_TIME).cast("timestamp_ntz")
    ts = F.col("ts")
    upd = e.where(m.isin(0, 1, 2, 3)).select(
        "event_id", stamp.alias("ts"), "user_id", "event_type",
        (F.col("value") + 1.0).alias("value"), "props", F.lit("UPDATE").alias("_action"),
        F.when(m == 0, ts).when(m == 1, F.timestamp_add("MILLISECOND", F.lit(400), ts))
         .when(m == 2, F.timestamp_add("SECOND", F.lit(-5), ts)).alias("_orig_ts"))
    dele = e.where(m.isin(4, 5)).select(
        "event_id", ts, "user_id", "event_type", "value", "props", F.lit("DELETE").alias("_action"),
        F.when(m == 4, ts).otherwise(F.timestamp_add("SECOND", F.lit(5), ts)).alias("_orig_ts"))
    ins = e.where(m.isin(6, 7)).select(
        F.when(m == 6, F.col("event_id")).otherwise(F.col("event_id") + NEW_KEY_OFFSET).alias("event_id"),
        ts, "user_id", "event_type", "value", "props", F.lit("INSERT").alias("_action"),
        F.lit(None).cast("timestamp_ntz").alias("_orig_ts"))
    return upd.unionByName(dele).unionByName(ins)


def document_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a blob frame (UTF-8 bytes, text/plain) with the
    document fields as metadata."""
    d = load(spark, sf_dir, "documents")
    return d.select(
        F.encode(F.col("text"), "UTF-8").alias("data"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"),
        F.lit("text/plain").alias("content_type"),
        F.create_map(F.lit("id"), F.col("doc_id").cast("string"),
                     F.lit("lang"), F.col("lang"),
                     F.lit("source"), F.col("source")).alias("meta"),
        F.col("doc_id"),
    )
