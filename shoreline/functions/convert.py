"""Value conversions used when rows come from text cells or literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for special doubles.
NAN_TEXT, POS_INF_TEXT, NEG_INF_TEXT = "NaN", "Infinity", "-Infinity"


def parse_number(c: Column) -> Column:
    """Whole trimmed text as a double; anything else (including text with
    a numeric prefix) → NULL."""
    return F.trim(c.cast("string")).try_cast("double")


def finite_or_null(c: Column) -> Column:
    """NaN and ±infinity → NULL."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def int_floor(c: Column) -> Column:
    return F.floor(finite_or_null(c)).cast("bigint")


def special_double(c: Column) -> Column:
    """'NaN' / 'Infinity' / '-Infinity' text → the double; others parsed."""
    t = F.trim(c.cast("string"))
    return (F.when(t == NAN_TEXT, F.lit(float("nan")))
            .when(t == POS_INF_TEXT, F.lit(float("inf")))
            .when(t == NEG_INF_TEXT, F.lit(float("-inf")))
            .otherwise(t.try_cast("double")))


def from_base64(c: Column) -> Column:
    return F.unbase64(c)


def json_text(**fields: Column) -> Column:
    """A flat object as JSON text."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def clean_text(c: Column) -> Column:
    return F.trim(c)


def clean_header(c: Column) -> Column:
    return F.lower(F.trim(c))
