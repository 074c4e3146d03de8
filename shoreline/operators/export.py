"""Grid form and guarded export.

``to_grid`` turns rows into the all-text form a sheet shows (ISO
millisecond times). ``export`` writes a key-ordered single file only after a
count proves the rows × columns stay under the cell limit, so the single
writer task is bounded; ``cell_guard`` reports the same check per table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions.times import iso_millis

# Fixed value: the most cells an export may write.
MAX_CELLS = 100_000


class ExportTooLarge(RuntimeError):
    pass


def to_grid(df: DataFrame) -> DataFrame:
    """Every column as text; timestamps as ISO-8601 with milliseconds."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(iso_millis(c).alias(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(c).alias(f.name))
        elif isinstance(f.dataType, T.BinaryType):
            out.append(F.base64(c).alias(f.name))
        else:
            out.append(c.cast("string").alias(f.name))
    return df.select(*out)


def cells(rows: int, columns: int) -> int:
    return rows * columns


def check_cells(df: DataFrame, max_cells: int = MAX_CELLS) -> dict:
    """Row count (Parquet footers when the plan allows) × column count."""
    n = df.count()
    c = cells(n, len(df.columns))
    return {"rows": n, "columns": len(df.columns), "cells": c, "allowed": c <= max_cells}


def export(df: DataFrame, path: str, order_by=None, max_cells: int = MAX_CELLS,
           fmt: str = "csv") -> int:
    """Write header + rows in key order as one file; returns rows written
    including the header, 0 when there are no rows. Refuses (before any
    write) when the cells would exceed ``max_cells``."""
    check = check_cells(df, max_cells)
    if not check["allowed"]:
        raise ExportTooLarge(f"export of {check['rows']} rows x {check['columns']} columns = "
                             f"{check['cells']} cells exceeds {max_cells}")
    if check["rows"] == 0:
        return 0
    # The guard bounds the rows (at most ``max_cells``), so one writer task
    # takes them all: a single exchange into one partition and a sort there
    # on the typed values (no range-boundary sampling job), then text.
    one = df.repartition(1)
    if order_by:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        one = one.sortWithinPartitions(*keys)
    grid = to_grid(one)
    (grid.write.mode("overwrite").option("header", "true").format(fmt).save(path))
    return check["rows"] + 1


def iter_rows(df: DataFrame):
    """All rows, paged to the driver one partition at a time
    (``toLocalIterator``), never as a whole."""
    return df.toLocalIterator()


def grids(df: DataFrame, max_cells: int = MAX_CELLS) -> Iterator[list[list]]:
    """All rows as grids of values, one after another: each a header row and as
    many rows as the cell guard allows. One grid is held at a time."""
    check = check_cells(df, max_cells)
    size = check["rows"] if check["allowed"] else max_cells // check["columns"]
    if check["rows"] and not size:
        raise ExportTooLarge(f"a row of {check['columns']} cells exceeds {max_cells}")
    rows = iter_rows(df)
    while part := [list(r) for r in islice(rows, size)]:
        yield [list(df.columns), *part]


def to_values(df: DataFrame, order_by=None) -> list[list]:
    """The grid as a header row + all rows of text, read page by page."""
    grid = to_grid(df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)) if order_by else df)
    return [list(grid.columns)] + [list(r) for r in iter_rows(grid)]


def read_export(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return spark.read.format(fmt).option("header", "true").load(path)


def cell_guard(named: dict[str, DataFrame], max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per table: rows, columns, cells and whether an export is
    allowed. Counts are per-table aggregates combined with ``unionByName``
    (one Spark job, no rows moved)."""
    parts = []
    for name, df in named.items():
        ncols = len(df.columns)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("table_name"), F.col("rows"),
                             F.lit(ncols).cast("bigint").alias("columns"),
                             (F.col("rows") * ncols).alias("cells"),
                             ((F.col("rows") * ncols) <= max_cells).alias("allowed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
