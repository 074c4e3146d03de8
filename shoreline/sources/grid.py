"""2D value grid source: first row headers, then data rows (``insertValues``).

For small hand-made input only; large input is any DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class GridError(ValueError):
    pass


def grid_to_frame(spark: SparkSession, values, schema: T.StructType | None = None) -> DataFrame:
    """Checks: a header row and at least one data row; every row an array of
    header width (the error names the row). With a table schema the columns
    are typed by name (missing ones NULL), otherwise all text."""
    if not isinstance(values, (list, tuple)) or len(values) < 2:
        raise GridError("values must contain a header row and at least one data row")
    headers = values[0]
    if not isinstance(headers, (list, tuple)) or not headers:
        raise GridError("header row must be a non-empty list of column names")
    names = [str(h).strip().replace("`", "") for h in headers]
    rows = []
    for i, row in enumerate(values[1:], start=1):
        if not isinstance(row, (list, tuple)):
            raise GridError(f"data row {i} must be a list")
        if len(row) != len(names):
            raise GridError(f"row {i}: expected {len(names)} columns, got {len(row)}")
        rows.append(tuple(row))
    if schema is not None:
        types = {f.name.lower(): f for f in schema.fields}
        fields = []
        for n in names:
            f = types.get(n.lower())
            if f is None:
                raise GridError(f"column '{n}' is not in the table")
            fields.append(T.StructField(f.name, f.dataType, True))
        return spark.createDataFrame(rows, T.StructType(fields))
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 T.StructType([T.StructField(n, T.StringType()) for n in names]))
