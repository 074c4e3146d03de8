"""Parallelism guard for CPU-heavy row work (embedding, vector distances).

A scan yields one task per file split; a small input in one Parquet row
group is a single task, which would run all per-row Python or
higher-order-function work on one core. ``spread`` re-balances such an
input across the cluster's cores. Large inputs already have at least that
many splits, so for them it is a no-op and adds no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` over at least ``min_partitions`` tasks (the cluster's cores by
    default) if the planner's estimate of its bytes fills fewer splits than
    that. Nothing is run to find out; only an input of under ``cores`` splits
    is ever shuffled."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    estimate, split = _sizes(df)
    return df if estimate >= want * split else df.repartition(want)


#: Tasks per core that ``gather`` leaves, so that uneven ones even out.
ROUNDS = 4


def gather(files: DataFrame) -> DataFrame:
    """``files`` (a scan of many small files) in as many tasks as its bytes and
    the cluster's cores ask for. The planner counts 4 MB for opening a file, so
    a task gets only some 30 small ones and writes an output file for them;
    here neighbouring tasks are joined, without a shuffle."""
    estimate, split = _sizes(files)
    return files.coalesce(_tasks(files, estimate, split))


def deal(files: DataFrame, size: int) -> DataFrame:
    """As ``gather`` for a list of files, of ``size`` bytes in all."""
    return files.repartition(_tasks(files, size, _sizes(files)[1]))


def _tasks(files: DataFrame, size: int, split: int) -> int:
    return max(ROUNDS * files.sparkSession.sparkContext.defaultParallelism, math.ceil(size / split))


def _sizes(df: DataFrame) -> tuple[int, int]:
    """The planner's estimate of the bytes of ``df``, and the bytes of a file split."""
    split = int(df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())), split
