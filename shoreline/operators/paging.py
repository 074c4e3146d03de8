"""Paging by keyset: a page token holds the last sort key, not a position.

The next page is a filter (rows after that key) and a top-k, at the version at
which paging began: no page is skipped or shown twice while others write, no
page costs more than another, and nobody keeps a cursor open. The filter's
first comparison reaches the Parquet scan, so on a table clustered by the sort
key later pages do not read earlier ones.

A top-k brings each task's first rows into one task. That is right for small
pages; the border of a large one is found among the sorted keys alone, spread
by ranges, and the page is the rows between two borders.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators import read as R
from shoreline.operators.stage import materialize
from shoreline.operators.table import VersionedTable

#: Rows of a page up to which one task takes the first rows of all others.
TOP_K_ROWS = 1_000


@dataclass
class Page:
    rows: DataFrame
    token: str | None  # None: this was the last page


def _order(order_by) -> list[tuple[str, bool]]:
    """[(column, descending)] from names, each optionally with ASC or DESC."""
    out = []
    for text in [order_by] if isinstance(order_by, str) else order_by:
        name, _, way = text.strip().partition(" ")
        way = way.strip().upper()
        if way not in ("", "ASC", "DESC"):
            raise ValueError(f"sort key must be a column, optionally with ASC or DESC: {text!r}")
        out.append((name.strip("`"), way == "DESC"))
    if not out:
        raise ValueError("paging needs a sort key")
    return out


def _text(v):
    return v.isoformat() if isinstance(v, (datetime, date)) else str(v) if isinstance(v, Decimal) else v


def _value(v, kind: T.DataType) -> Column:
    if isinstance(v, str) and isinstance(kind, (T.DoubleType, T.FloatType)):
        v = float(v)
    return F.lit(v).cast(kind)


def encode_token(version: int, order: list[tuple[str, bool]], values: list) -> str:
    text = [str(v) if isinstance(v, float) and v != v or v in (float("inf"), float("-inf")) else _text(v) for v in values]
    return base64.urlsafe_b64encode(json.dumps({"v": version, "o": order, "k": text}).encode()).decode()


def decode_token(token: str) -> dict:
    try:
        out = json.loads(base64.urlsafe_b64decode(token.encode()))
        return {"v": int(out["v"]), "o": [(n, bool(d)) for n, d in out["o"]], "k": list(out["k"])}
    except Exception:
        raise ValueError("not a page token") from None


def after(order: list[tuple[str, bool]], values: list, schema: T.StructType) -> Column:
    """Rows that sort after the key ``values`` (NULL first, last if descending)."""
    cond, same = F.lit(False), F.lit(True)
    for (name, down), v in zip(order, values):
        c = F.col(R.quote(name))
        if v is None:
            beyond = F.lit(False) if down else c.isNotNull()
            equal = c.isNull()
        else:
            lit = _value(v, schema[name].dataType)
            beyond = (c < lit) | c.isNull() if down else c > lit
            equal = c == lit
        cond = cond | (same & F.coalesce(beyond, F.lit(False)))
        same = same & F.coalesce(equal, F.lit(False))
    first, down = order[0]
    if values[0] is None or down:
        return cond
    # said once more for the scan: everything beyond has at least the first key
    return (F.col(R.quote(first)) >= _value(values[0], schema[first].dataType)) & cond


def page_rows(table: VersionedTable, order_by, size: int, token: str | None = None, columns=None, where=None) -> Page:
    """One page of ``table``: at most ``size`` rows in the order of ``order_by``
    (whose columns together must be unique, or rows that share a key across a
    page border are lost; ``unique`` keys are the caller's choice, the last one
    usually the primary key). Pass the page's token to get the next one: all
    pages read the version the first one saw. ``where`` must be the same for all."""
    if int(size) < 1:
        raise ValueError("a page holds at least one row")
    order = _order(order_by)
    if token is None:
        at = table if table._pinned is not None else table.as_of(version=table._fresh().latest_version)
        values = None
    else:
        held = decode_token(token)
        if held["o"] != order:
            raise ValueError("the page token belongs to another order")
        table._fresh()
        at, values = table.as_of(version=held["v"]), held["k"]
    missing = [n for n, _ in order if n not in at.columns]
    if missing:
        raise ValueError(f"unknown sort columns: {missing}")
    df = at.read(where=where)
    if values is not None:
        df = df.where(after(order, values, at.schema))
    keys = [F.col(R.quote(n)).desc_nulls_last() if down else F.col(R.quote(n)).asc_nulls_first() for n, down in order]
    shown = [c for c in at.columns if not columns or c in columns]
    if int(size) > TOP_K_ROWS:
        rows, border = _large_page(df, order, keys, int(size), at.schema)
        following = None if border is None else encode_token(at.version, order, border)
        return Page(rows.select(*[F.col(R.quote(c)) for c in shown]), following)
    rows = df.orderBy(*keys).limit(int(size))
    # the page's last key and whether it is full: one row
    flip = [F.col(R.quote(n)).asc_nulls_first() if down else F.col(R.quote(n)).desc_nulls_last() for n, down in order]
    last = rows.select(*[F.col(R.quote(n)) for n, _ in order]).orderBy(*flip).limit(1).collect()
    n = rows.count() if last else 0
    following = encode_token(at.version, order, [last[0][name] for name, _ in order]) if n == int(size) else None
    return Page(rows.select(*[F.col(R.quote(c)) for c in shown]), following)


def _large_page(df: DataFrame, order: list[tuple[str, bool]], keys: list[Column], size: int,
                schema: T.StructType) -> tuple[DataFrame, list | None]:
    """The first ``size`` rows of ``df`` in order, and the key of the last one
    (None if there are fewer). Only keys are moved to find it, to tasks by ranges."""
    names = [n for n, _ in order]
    keyed = df.select(*[F.col(R.quote(n)) for n in names])
    placed, seen = materialize(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys), "page_keys", [F.count(F.lit(1)).alias("n")])
    if (seen["n"] or 0) < size:
        return df.orderBy(*keys), None
    part, ahead = F.spark_partition_id(), 0
    for number, n in sorted(placed.groupBy(part.alias("part")).count().collect()):  # a number per task
        if ahead + n >= size:
            break
        ahead += n
    # a row's place in its task is the lower part of its id
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    last = (placed.select("*", part.alias("_part"), place.alias("_place"))
            .where((F.col("_part") == number) & (F.col("_place") == size - ahead - 1)).first())
    border = [last[n] for n in names]
    # as a token's reader gets it
    values = decode_token(encode_token(0, order, border))["k"]
    beyond = after(order, values, schema)
    same = F.lit(True)
    for n, v in zip(names, values):
        same = same & F.col(R.quote(n)).eqNullSafe(_value(v, schema[n].dataType))
    few = placed.agg(F.count_if(~beyond & ~same).alias("less"), F.count_if(same).alias("same")).first()
    page = df.where(~beyond)
    if few["less"] + few["same"] > size:  # the border runs through rows of one key
        page = df.where(~beyond & ~same).unionByName(df.where(same).limit(size - few["less"]))
    return page.orderBy(*keys), border


def all_pages(table: VersionedTable, order_by, size: int, **options):
    """The pages one after another."""
    token = None
    while True:
        page = page_rows(table, order_by, size, token, **options)
        yield page
        token = page.token
        if token is None:
            return


__all__ = ["Page", "page_rows", "all_pages"]
