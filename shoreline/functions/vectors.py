"""Vector distances as Column expressions (JVM-side higher-order functions).

Vectors are cast to ``array<double>`` first (test embeddings are stored as
``array<float>``). A vector of another length than the query, a NULL element
or a zero vector gives a NULL distance, and NULL distances are never ranked.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COSINE, EUCLIDEAN = "COSINE", "EUCLIDEAN"


def as_doubles(c: Column) -> Column:
    return c.cast("array<double>")


def literal_vector(values) -> Column:
    if values is None or len(values) == 0:
        raise ValueError("query vector must be a non-empty list of numbers")
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def _same_length(a: Column, b: Column) -> Column:
    return F.size(a) == F.size(b)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - a·b / (|a| |b|)``; NULL for zero vectors or length mismatch."""
    a, b = as_doubles(a), as_doubles(b)
    denom = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(_same_length(a, b) & (denom > 0), F.lit(1.0) - dot(a, b) / denom)


def euclidean_distance(a: Column, b: Column) -> Column:
    a, b = as_doubles(a), as_doubles(b)
    sq = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                     lambda acc, x: acc + x)
    return F.when(_same_length(a, b), F.sqrt(sq))


def distance(metric: str, a: Column, b: Column) -> Column:
    m = (metric or COSINE).upper()
    return euclidean_distance(a, b) if m == EUCLIDEAN else cosine_distance(a, b)
