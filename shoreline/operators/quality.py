"""Row rules: split rows into valid and rejected with the names of the
rules each rejected row broke. Rules apply only to columns the rows have;
a NULL value passes (blank cells are allowed), text that is not a number
fails a numeric rule."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    check: Callable[[Column], Column]  # True when the (non-null) value is valid


def _num(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


# The writeback console's column rules.
DEFAULT_RULES = (
    Rule("price_positive", "price", lambda c: _num(c) > 0),
    Rule("stock_non_negative", "stock", lambda c: _num(c) >= 0),
    Rule("id_positive", "id", lambda c: _num(c) > 0),
)


def failed_rules(df: DataFrame, rules=DEFAULT_RULES) -> Column:
    """``array<string>`` of the rules a row breaks (empty when none)."""
    present = {c.lower(): c for c in df.columns}
    checks = []
    for r in rules:
        col = present.get(r.column.lower())
        if col is None:
            continue
        v = F.col(f"`{col}`")
        broke = v.isNotNull() & ~F.coalesce(r.check(v), F.lit(False))
        checks.append(F.when(broke, F.lit(r.name)))
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def annotate(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    failed = failed_rules(df, rules)
    return df.withColumn("_failed", failed).withColumn("_valid", F.size("_failed") == 0)


def split(df: DataFrame, rules=DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``_failed``). Both come from one
    annotated plan; persist or checkpoint it when both are consumed."""
    a = annotate(df, rules)
    return a.where("_valid").drop("_failed", "_valid"), a.where("not _valid").drop("_valid")
