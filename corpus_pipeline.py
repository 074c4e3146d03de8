"""The corpus pipeline: five stages over ``documents``, each calling one of the
operators in ``shoreline.llm``.

A stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoreline.llm import bpe, linededup, mixing, quality, queries, simhash
from shoreline.llm.common import table, whole_row
from shoreline.llm.sampling import crc_mod
from shoreline.session import checkpoint_root


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier scores under 0.7; without
    a usable label there is no classifier and all stay. Null and empty texts are
    scored like any other; an empty table stays empty; repeated rows and further
    columns, whatever their names, are kept."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable=crc_mod("doc_id", 4) != 2)
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; ``n_chars`` follows the text.
    A null text becomes empty; every document stays, also one that loses all
    lines; rows that share an id count as one document, null ids rank last; an
    empty table stays empty; further columns, whatever their names, are kept."""
    # the row travels as one struct, so that no name can clash
    packed = docs.select("doc_id", "text", whole_row(docs))
    out = linededup.apply_bitmaps(packed, linededup.line_keep_bitmaps(packed))
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near duplicates.
    Documents without id rank last; of rows alike in id and text one stays
    (ties within a group fall to the smallest id, then the smallest text hash).
    Null and empty texts are near duplicates of each other; an empty table stays
    empty; further columns, whatever their names, are kept."""
    big = 1 << 62
    text_hash = F.xxhash64("text")
    key = F.struct(F.coalesce("doc_id", F.lit(big) + F.pmod(text_hash, F.lit(big))).alias("k"), text_hash.alias("r"))
    # the row travels as one struct, so that no name can clash
    keyed = docs.select(key.alias("key"), "text", whole_row(docs))
    found = simhash.near_duplicates(keyed, "key", "text", shingle=3, max_bits=2)
    first = found.where("key = component_id").select("key").distinct()
    return keyed.select("key", "row").join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents until the languages' expected words match the targets;
    no rate is under one, so every document stays. Languages without a target
    keep their present share; targets without documents are warned of. Null and
    empty texts have no words and a rate like any other; equal rows have equal
    rates; an empty table stays empty; further columns, whatever their names,
    are kept."""
    labelled = queries.labelled_domains(docs, table(spark, sf_dir, "labels"))
    _, model, rates = mixing.mix(docs, labelled, queries.TARGETS, keep=True)
    return mixing.resample(docs, model, rates)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text; returns the digest of both, one row per
    row. Null and empty texts have no tokens; other columns are not read."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dup", near_duplicate_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: The classifiers, the SimHash and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's rows kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{root}/{k}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
