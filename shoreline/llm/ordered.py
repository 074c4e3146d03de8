"""Positions and running sums inside groups of any size, and joins that a hot
key does not slow: helpers of the operators that number rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shoreline.llm.common import materialise

#: A key is hot if it holds more rows than this and than this share of all; at most HOT_SHARE keys are.
HOT_ROWS, HOT_SHARE = 64, 10_000


def _wrapped(frame: pd.DataFrame, sums: list[str]) -> np.ndarray:
    """Columns: one per row counted, then the named ones, as unsigned numbers that wrap."""
    out = np.ones((len(frame), 1 + len(sums)), dtype=np.uint64)
    for k, name in enumerate(sums):
        out[:, k + 1] = frame[name].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _borders(group: str, sums: list[str]):
    """The totals of a part's first and last group: all that can go on elsewhere."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = last = part = None
        for f in frames:
            if not len(f):
                continue
            part, g, v = int(f["part"].iloc[0]), f[group].to_numpy(), _wrapped(f, sums)
            for key in dict.fromkeys((g[0], g[-1])):
                total = v[g == key].sum(axis=0)
                if first is None or first[0] == key:
                    first = (key, total + (first[1] if first else 0))
                elif last is not None and last[0] == key:
                    last = (key, total + last[1])
                else:
                    last = (key, total)
        if part is not None:
            rows = [(part, k, *t.view(np.int64).tolist()) for k, t in filter(None, (first, last))]
            yield pd.DataFrame(rows, columns=["part", group, "rows", *sums])
    return run


def _number(group: str, sums: list[str], carried: dict):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, np.zeros(1 + len(sums), dtype=np.uint64)
        begun = False
        for f in frames:
            if not len(f):
                continue
            g, v = f[group].to_numpy(), _wrapped(f, sums)
            starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            upto = np.cumsum(v, axis=0)
            before = np.concatenate([np.zeros((1, v.shape[1]), dtype=np.uint64), upto])[starts]
            offset = np.zeros_like(before)
            if begun and key == g[0]:
                offset[0] = held
            elif not begun:
                known = carried.get((int(f["part"].iloc[0]), g[0]))
                if known is not None:
                    offset[0] = known
            sizes = np.diff(np.append(starts, len(g)))
            upto = upto + np.repeat(offset - before, sizes, axis=0)
            key, held, begun = g[-1], upto[-1], True
            out = f.drop(columns=["part"])
            out["pos"] = (upto[:, 0] - np.uint64(1)).view(np.int64)
            for k, name in enumerate(sums):
                out[f"sum_{name}"] = upto[:, k + 1].view(np.int64)
            yield out
    return run


def numbered(rows: DataFrame, group: str, order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``pos``, a row's place (from 0) in its group by ``order``,
    and ``sum_<name>`` for the long columns in ``sums``: the sum up to and with
    the row, modulo 2**64.

    Groups (not null) are range-partitioned together with the order, so one of
    any size spreads over many tasks; what a group holds in earlier tasks comes
    from two rows of totals per task, the only rows that reach the driver.
    ``rows`` is read twice (materialise it first if it is costly)."""
    sums = list(sums)
    keys = [group, *order]
    placed = materialise(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))
    kinds = dict(rows.dtypes)
    totals = placed.select("part", group, *sums).mapInPandas(
        _borders(group, sums), ", ".join(["part int", f"{group} {kinds[group]}", "rows long", *(f"{s} long" for s in sums)]))
    carried, held = {}, {}
    for r in sorted(totals.collect(), key=lambda r: r["part"]):
        add = np.array(list(r)[2:], dtype=np.int64).view(np.uint64)
        if r[group] in held:
            carried[(r["part"], r[group])] = held[r[group]]
            held[r[group]] = held[r[group]] + add
        else:
            held = {**{k: v for k, v in held.items() if k == r[group]}, r[group]: add}
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "pos long", *(f"sum_{s} long" for s in sums)])
    return placed.mapInPandas(_number(group, sums, carried), schema)


def join_hot(rows: DataFrame, info: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``info``, which has one row per ``key`` and
    the number of its rows in ``count`` (kept). Keys of very many rows, at most
    HOT_SHARE of them by their counts, are joined by broadcast where the rows
    lie; the others are shuffled."""
    total = info.agg(F.sum(count)).first()[0] or 0
    hot: Column = F.col(count) > max(HOT_ROWS, total // HOT_SHARE)
    hot_info = F.broadcast(info.where(hot))
    return rows.join(hot_info, key).unionByName(
        rows.join(F.broadcast(info.where(hot).select(key)), key, "left_anti").join(info.where(~hot), key))
