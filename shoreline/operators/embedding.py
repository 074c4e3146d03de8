"""Insert rows with an embedding computed from one of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.functions import embed as E
from shoreline.functions.text import blank_to_null, utf8
from shoreline.operators.partitioning import spread
from shoreline.operators.table import VersionedTable


def with_embedding(df: DataFrame, source_col: str, target_col: str = "embedding",
                   dim: int = E.DEFAULT_DIM, model=None) -> DataFrame:
    """Add (or fill) ``target_col`` with the embedding of ``source_col``;
    NULL or blank sources — and texts the model cannot embed — give NULL."""
    source_col = source_col.strip()
    if source_col not in df.columns:
        raise ValueError(f"embedding source column '{source_col}' is not in {df.columns}")
    src = F.col(f"`{source_col}`")
    text = blank_to_null(src.cast("string")) if dict(df.dtypes)[source_col] != "binary" \
        else blank_to_null(utf8(src))
    emb = E.embed_column(text, dim, model)
    return spread(df).withColumn(target_col.strip() or "embedding", emb)


def insert_values_with_embedding(table: VersionedTable, values, source_col: str, target_col: str = "embedding",
                                 **options) -> dict:
    """The grid form: header row and rows, short rows padded with NULL."""
    from shoreline.sources.grid import grid_to_frame
    width = len(values[0]) if values else 0
    padded = [list(row) + [None] * (width - len(row)) for row in values]
    frame = grid_to_frame(table.spark, padded, table.schema)
    return insert_with_embedding(table, frame, source_col, target_col, **options)


def insert_with_embedding(table: VersionedTable, df: DataFrame, source_col: str,
                          target_col: str = "embedding", dim: int = E.DEFAULT_DIM,
                          model=None, **insert_options) -> dict:
    """Embed, then insert; the result also reports how many rows got no
    embedding (``without_embedding``, counted in the same write pass)."""
    target = target_col.strip() or "embedding"
    rows = with_embedding(df, source_col, target, dim, model)
    res = table.insert(rows, count_nulls=(target,), **insert_options)
    res["without_embedding"] = res.pop(f"null_{target}")
    return res
