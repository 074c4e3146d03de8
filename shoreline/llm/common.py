"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoreline.session import checkpoint_root

#: Characters stripped or split on wherever a contract says ``[\\x20\\x09-\\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that a
    lost executor costs no recomputation of what lies before it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns (others, also ones whose names clash with the
    operators' own, are left out)."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``: it travels where no name can clash."""
    return F.struct(*[column(c) for c in df.columns]).alias("row")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row. Catalyst would
    otherwise inline it into every lambda call that refers to it."""
    return F.transform(F.array(value), body)[0]


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of equal ``keys`` of a sorted stream of frames, each whole."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        if rest and not (rest[-1][keys].iloc[-1] == frame[keys].iloc[0]).all():
            yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
            rest = []
        changed = (frame[keys].shift() != frame[keys]).any(axis=1).to_numpy().copy()
        changed[0] = False
        cuts = [0, *changed.nonzero()[0].tolist(), len(frame)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            rest.append(frame.iloc[a:b])
            if b < len(frame):
                yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
                rest = []
    if rest:
        yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
