"""Declared schemas and layout rules (create-table semantics).

A column list ``[{name, type, mode}]`` becomes a ``StructType``; ``mode ==
"REQUIRED"`` is the only way to get a NOT NULL column. Parquet tables do not
keep NOT NULL, so nullability is enforced when rows are written.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names used by the reference and their Spark types.
TYPE_NAMES = {
    "INT64": "bigint", "INTEGER": "bigint", "INT": "bigint", "BIGINT": "bigint",
    "FLOAT64": "double", "FLOAT": "double", "DOUBLE": "double", "NUMERIC": "decimal(38,9)",
    "STRING": "string", "BOOL": "boolean", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp", "DATETIME": "timestamp_ntz", "DATE": "date",
    "BYTES": "binary", "JSON": "string",
}
MAX_CLUSTER_COLUMNS = 4


class SchemaError(ValueError):
    pass


def _spark_type(type_name: str) -> T.DataType:
    text = type_name.strip()
    upper = text.upper()
    if upper in TYPE_NAMES:
        return T.DataType.fromDDL(TYPE_NAMES[upper])
    m = re.fullmatch(r"ARRAY\s*<\s*(.+)\s*>", upper)
    if m:
        return T.ArrayType(_spark_type(m.group(1)))
    return T.DataType.fromDDL(text.lower())


def to_struct(columns) -> T.StructType:
    """Validate a column list and build the table schema.

    Accepts a ``StructType`` unchanged, or a list of ``{"name", "type",
    "mode"}`` dicts; the error names the offending index."""
    if isinstance(columns, T.StructType):
        return columns
    if isinstance(columns, str):
        parsed = T.DataType.fromDDL(columns)
        if not isinstance(parsed, T.StructType):
            raise SchemaError(f"not a column list: {columns!r}")
        return parsed
    if not columns:
        raise SchemaError("schema must be a non-empty list of columns")
    fields, seen = [], set()
    for i, col in enumerate(columns):
        if not isinstance(col, dict):
            raise SchemaError(f"column at index {i} must be a dict with 'name' and 'type'")
        name, typ = col.get("name"), col.get("type")
        if not isinstance(name, str) or not name.strip():
            raise SchemaError(f"column at index {i} needs a string 'name'")
        if not isinstance(typ, str) or not typ.strip():
            raise SchemaError(f"column at index {i} needs a string 'type'")
        name = name.strip()
        if name.lower() in seen:
            raise SchemaError(f"duplicate column '{name}' at index {i}")
        seen.add(name.lower())
        nullable = str(col.get("mode", "NULLABLE")).upper() != "REQUIRED"
        fields.append(T.StructField(name, _spark_type(typ), nullable))
    return T.StructType(fields)


@dataclass
class Layout:
    """Physical layout: partition expressions (each becomes a hidden column
    ``_p<i>`` used as a directory level) and up to four clustering columns
    (range-partitioned and sorted inside files for min/max skipping; with
    ``local_sort`` rows are only sorted in the task that read them, so wide
    rows such as blobs are never shuffled). Columns in ``bloom_by`` get
    Parquet's own Bloom filters, so a look-up by keys skips row groups also
    where the keys lie scattered. With ``curve`` rows lie along a
    space-filling curve through the quantiles of all clustering columns, so
    that a filter on any one of them skips row groups, not only on the first."""

    partition_by: list[str] = field(default_factory=list)
    cluster_by: list[str] = field(default_factory=list)
    vector_dims: dict[str, int] = field(default_factory=dict)
    local_sort: bool = False
    bloom_by: list[str] = field(default_factory=list)
    curve: bool = False

    def partition_columns(self) -> list[str]:
        return [f"_p{i}" for i in range(len(self.partition_by))]

    def with_partition_columns(self, df: DataFrame) -> DataFrame:
        if not self.partition_by:
            return df
        return df.withColumns({f"_p{i}": F.expr(e) for i, e in enumerate(self.partition_by)})

    def to_json(self) -> dict:
        return {"partition_by": self.partition_by, "cluster_by": self.cluster_by,
                "vector_dims": self.vector_dims, "local_sort": self.local_sort, "bloom_by": self.bloom_by,
                "curve": self.curve}

    def write_options(self) -> dict[str, str]:
        """Parquet options of a data write: filters sized to what a row group holds; blobs (``local_sort``), which
        are most of what their table takes on disk, in the denser codec."""
        out = {"compression": "zstd"} if self.local_sort else {}
        for c in self.bloom_by:
            out |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.adaptive.enabled#{c}": "true"}
        return out


_DATE_FN = re.compile(r"^\s*DATE\s*\((.+)\)\s*$", re.IGNORECASE)


def normalize_layout(schema: T.StructType, partition_by=None, cluster_by=None) -> Layout:
    """Apply the create-table layout rules.

    * ``DATE(col)`` is accepted and written as ``to_date(col)``; other
      expressions are kept as given.
    * A bare integer column as partition is dropped; it becomes the clustering
      column when no clustering was given.
    * Clustering keeps existing columns only, without duplicates, first four."""
    types = {f.name: f.dataType for f in schema.fields}
    parts: list[str] = []
    demoted: list[str] = []
    raw_parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    for expr in raw_parts:
        expr = expr.strip()
        if not expr:
            continue
        m = _DATE_FN.match(expr)
        if m:
            expr = f"to_date({m.group(1).strip()})"
        bare = expr.strip("`")
        if bare in types and isinstance(types[bare], (T.IntegerType, T.LongType, T.ShortType)):
            demoted.append(bare)
            continue
        parts.append(expr)
    raw_cluster = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by or [])
    if not raw_cluster:
        raw_cluster = demoted
    clusters: list[str] = []
    for c in raw_cluster:
        c = str(c).strip().strip("`")
        if c in types and c not in clusters:
            clusters.append(c)
    return Layout(parts, clusters[:MAX_CLUSTER_COLUMNS])


def vector_violation(dims: dict[str, int]) -> Column:
    """True for rows whose vector column has another length than the table's
    fixed one (NULL vectors are fine)."""
    cond = F.lit(False)
    for c, n in dims.items():
        v = F.col(f"`{c}`")
        cond = cond | (v.isNotNull() & (F.size(v) != F.lit(int(n))))
    return cond


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def null_violation(schema: T.StructType) -> Column:
    """True for rows breaking a NOT NULL column (False when none declared)."""
    cols = required_columns(schema)
    if not cols:
        return F.lit(False)
    cond = F.col(f"`{cols[0]}`").isNull()
    for c in cols[1:]:
        cond = cond | F.col(f"`{c}`").isNull()
    return cond


def conform(df: DataFrame, schema: T.StructType, carry=()) -> DataFrame:
    """Align ``df`` to the table schema by name: missing columns become NULL,
    values are cast (``try_cast`` semantics via ``cast`` under the caller's
    ANSI setting), unknown columns are an error. ``carry`` names helper
    columns kept after the table's columns."""
    lower = {c.lower(): c for c in df.columns}
    names = {f.name.lower() for f in schema.fields}
    unknown = [c for c in df.columns if c.lower() not in names and c not in carry]
    if unknown:
        raise SchemaError(f"columns not in the table schema: {unknown}")
    out = []
    for f in schema.fields:
        src = lower.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return df.select(*out, *[F.col(f"`{c}`") for c in carry])
