"""One-table reads: projection, predicate, order, limit (``getValues``).

Predicates and sort keys are SQL text parsed by Spark (``F.expr``) so they
become Catalyst expressions: filters reach the Parquet scan as
``PushedFilters`` and projections shrink its ``ReadSchema``."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GuardError(ValueError):
    pass


_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")


def guard(text: str | None, what: str = "expression") -> str | None:
    """Reject text that would end one statement and start another.

    A ``;`` outside quoted text is refused wherever it appears (the same rule
    for reads and for DML); semicolons inside literals are fine."""
    if text is None:
        return None
    bare = _QUOTED.sub("''", text)
    if ";" in bare:
        raise GuardError(f"{what} must be a single expression without ';': {text!r}")
    return text


def strip_keyword(text: str, keyword: str) -> str:
    return re.sub(rf"^\s*{keyword}\s+", "", text.strip(), flags=re.IGNORECASE)


def predicate(where: str | Column | None) -> Column | None:
    if where is None:
        return None
    if isinstance(where, Column):
        return where
    text = strip_keyword(guard(where, "where") or "", "WHERE")
    return F.expr(text) if text.strip() else None


def quote(name: str) -> str:
    return "`" + str(name).strip().replace("`", "") + "`"


def project(df: DataFrame, columns) -> DataFrame:
    if not columns:
        return df
    return df.select(*[c if isinstance(c, Column) else F.col(quote(c)) for c in columns])


def sort_keys(order_by) -> list[Column]:
    if order_by is None:
        return []
    if isinstance(order_by, Column):
        return [order_by]
    if isinstance(order_by, str):
        text = strip_keyword(guard(order_by, "orderBy"), "ORDER\\s+BY")
        return [_sort_key(part) for part in _split_top_level(text) if part.strip()]
    return [k if isinstance(k, Column) else _sort_key(k) for k in order_by]


def _sort_key(text: str) -> Column:
    m = re.match(r"^(.*?)(\s+(ASC|DESC))?(\s+NULLS\s+(FIRST|LAST))?\s*$", text.strip(), re.IGNORECASE)
    expr, direction, nulls = m.group(1), (m.group(3) or "ASC").upper(), (m.group(5) or "").upper()
    c = F.expr(expr)
    if direction == "DESC":
        return c.desc_nulls_first() if nulls == "FIRST" else c.desc_nulls_last() if nulls == "LAST" else c.desc()
    return c.asc_nulls_last() if nulls == "LAST" else c.asc_nulls_first() if nulls == "FIRST" else c.asc()


def _split_top_level(text: str) -> list[str]:
    parts, depth, cur, quote_ch = [], 0, [], None
    for ch in text:
        if quote_ch:
            cur.append(ch)
            if ch == quote_ch:
                quote_ch = None
            continue
        if ch in "'\"`":
            quote_ch = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append("".join(cur))
            cur = []
            continue
        cur.append(ch)
    parts.append("".join(cur))
    return parts


def check_limit(limit) -> int | None:
    if limit is None:
        return None
    if isinstance(limit, bool) or not isinstance(limit, int) or limit < 0:
        raise ValueError(f"limit must be a non-negative integer, got {limit!r}")
    return limit


def get_values(df: DataFrame, columns=None, where=None, order_by=None, limit=None) -> DataFrame:
    """Project, filter, sort, limit. ``order_by`` + ``limit`` plans as
    ``TakeOrderedAndProject`` (per-partition top-k, then a merge of k rows
    per partition), never a full sort."""
    cond = predicate(where)
    if cond is not None:
        df = df.where(cond)
    keys = sort_keys(order_by)
    n = check_limit(limit)
    df = project(df, columns) if not keys else df
    if keys:
        df = df.orderBy(*keys)
        if columns:
            df = project(df, columns)
    if n is not None:
        df = df.limit(n)
    return df


def _bound_literal(v):
    if isinstance(v, (datetime, date)):
        return F.lit(v)
    return F.lit(str(v))


def between(column: str, lo, hi, partition_column: str | None = None) -> Column:
    """``column BETWEEN lo AND hi``; when the table is partitioned by
    ``to_date(column)`` also bound the partition column so Spark prunes
    directories (Catalyst does not derive the date bound from a timestamp
    filter on its own)."""
    c = F.col(quote(column))
    cond = c.between(_bound_literal(lo), _bound_literal(hi))
    if partition_column:
        p = F.col(partition_column)
        cond = cond & p.between(F.to_date(_bound_literal(lo)), F.to_date(_bound_literal(hi)))
    return cond
