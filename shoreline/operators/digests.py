"""Diff of two copies by digests of key ranges.

Both copies are summed up first: per key range, split further by a hash of the
key, the number of rows and order-free sums of row hashes. That moves a few
thousand rows, whatever the size of the copies. Only groups whose sums differ
can hold a change; only their rows are compared in full, and on a table
clustered by the key only their row groups are read again. Sums can be kept
(they are a small table): then the baseline is read only where the edited copy
differs from it.

Sums are taken over exact values, the diff itself is as tolerant as ever: a
group may be compared and turn out unchanged, never the reverse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators import cdc
from shoreline.operators.stage import materialize

#: Equal parts of the key's span, parts of each by hash, and key intervals that a scan is filtered by.
RANGES, PARTS, INTERVALS = 256, 16, 64


@dataclass(frozen=True)
class Grid:
    """How keys fall into groups. Without a span (text keys) only the hash counts."""
    lo: float | None
    hi: float | None
    ranges: int = RANGES
    parts: int = PARTS

    @property
    def step(self) -> float:
        return (self.hi - self.lo) / self.ranges

    def range_of(self, number: Column) -> Column:
        if self.lo is None or not self.step > 0:
            return F.lit(0).cast("long")
        place = F.floor((number - F.lit(self.lo)) / F.lit(self.step))
        return F.least(F.greatest(place, F.lit(-1).cast("long")), F.lit(self.ranges).cast("long"))


def _number(key: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.NumericType):
        return key.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(key.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("double")
    return None


def make_grid(df: DataFrame, key: str = "id", ranges: int = RANGES, parts: int = PARTS) -> Grid:
    """Groups for the keys of ``df``: its key span in equal parts (one aggregate)."""
    number = _number(F.col(f"`{key}`"), df.schema[key].dataType)
    if number is None:
        return Grid(None, None, 1, ranges * parts)
    finite = F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)
    ends = df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    return Grid(ends["lo"], ends["hi"], ranges, parts) if ends["lo"] is not None else Grid(None, None, 1, ranges * parts)


def _grouped(df: DataFrame, key: str, kind: T.DataType, grid: Grid) -> DataFrame:
    """``df`` with its group; a key that does not read as ``kind`` is in a group of its own."""
    c = F.col(f"`{key}`")
    typed = c if df.schema[key].dataType == kind else F.trim(c.cast("string")).try_cast(kind)
    number = _number(typed, kind)
    unread = typed.isNull()
    return df.withColumns({
        "_range": F.when(unread, F.lit(-2).cast("long")).otherwise(F.lit(0).cast("long") if number is None else grid.range_of(number)),
        "_part": F.when(unread, F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64(F.trim(typed.cast("string"))), F.lit(grid.parts)))})


def _sums(grouped: DataFrame, key: str, columns: list[str]) -> DataFrame:
    cols = [F.col(f"`{c}`") for c in (key, *columns)]
    nulls = [c.isNull() for c in cols]  # a hash skips NULLs

    def lane(k: int) -> Column:
        return F.sum(F.xxhash64(F.lit(k), *cols, *nulls).cast("decimal(38,0)"))
    return grouped.groupBy("_range", "_part").agg(F.count(F.lit(1)).alias("n"), lane(1).alias("h1"), lane(2).alias("h2"))


def range_digests(df: DataFrame, key: str, columns: list[str], grid: Grid) -> DataFrame:
    """(_range, _part, n, h1, h2): row count and two sums of row hashes per group."""
    return _sums(_grouped(df, key, df.schema[key].dataType, grid), key, columns)


def _intervals(ranges: list[int], grid: Grid) -> list[tuple[float, float]]:
    """Key intervals around the given ranges, the nearest ones joined."""
    spans = [[r, r] for r in sorted(set(ranges))]
    while len(spans) > INTERVALS or any(b[0] - a[1] <= 1 for a, b in zip(spans, spans[1:])):
        i = min(range(len(spans) - 1), key=lambda k: spans[k + 1][0] - spans[k][1])
        spans[i:i + 2] = [[spans[i][0], spans[i + 1][1]]]
    inf = float("inf")  # one range more at each end: bounds are only a first sieve
    return [(grid.lo + (a - 1) * grid.step if a >= 1 else -inf, grid.lo + (b + 2) * grid.step if b < grid.ranges - 1 else inf) for a, b in spans]


def diff_ranges(baseline: DataFrame, active: DataFrame, key: str = "id", version_col: str | None = "updated_at",
                grid: Grid | None = None, baseline_digests: DataFrame | None = None, **options) -> tuple[DataFrame, dict]:
    """(changes, info): the rows of ``cdc.diff``, with only those rows compared
    whose group's sums differ. ``info`` has ``groups``, ``differing`` and
    ``compared`` (rows of both copies that were compared in full).

    ``baseline_digests`` are ``range_digests`` of the baseline by the same
    ``grid`` over its non-key columns that the active copy has, in the
    baseline's order; if given, the baseline is read in differing groups only."""
    baseline, active = cdc.normalize_headers(baseline), cdc.normalize_headers(active)
    key, version = key.lower(), version_col.lower() if version_col else None
    if key not in baseline.columns or key not in active.columns:
        raise cdc.DiffError(f"primary key column '{key}' is required in both inputs")
    grid = grid or make_grid(baseline, key)
    kinds = {f.name: f.dataType for f in baseline.schema.fields}
    columns = [c for c in baseline.columns if c in active.columns and c not in (key, version)]
    base = _grouped(baseline, key, kinds[key], grid)
    act = _grouped(active, key, kinds[key], grid)
    typed = cdc.coerce_to(act, kinds, skip=(key, version))
    if typed.schema[key].dataType != kinds[key]:
        typed = typed.withColumn(key, F.trim(F.col(f"`{key}`").cast("string")).try_cast(kinds[key]))
    old = baseline_digests if baseline_digests is not None else _sums(base, key, columns)
    old = old.select("_range", "_part", *[F.col(c).alias(f"o_{c}") for c in ("n", "h1", "h2")])
    both = _sums(typed, key, columns).join(old, ["_range", "_part"], "full_outer")
    same = F.lit(True)
    for c in ("n", "h1", "h2"):
        same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    # keys that do not read as the baseline's type sum up to nothing and are always compared
    both, _ = materialize(both.withColumn("same", same & (F.col("_range") > -2)), "digests")
    info = both.agg(F.count(F.lit(1)).alias("groups"), F.count_if(~F.col("same")).alias("differing"),
                    F.sum(F.when(~F.col("same"), F.coalesce("n", F.lit(0)) + F.coalesce("o_n", F.lit(0)))).alias("compared")).first().asDict()
    info["compared"] = int(info["compared"] or 0)
    wanted = both.where(~F.col("same")).select("_range", "_part")  # at most one row per group
    ranges = [r["_range"] for r in wanted.select("_range").distinct().collect()]

    def sieve(df: DataFrame, grouped: DataFrame) -> DataFrame:
        number = _number(F.col(f"`{key}`"), df.schema[key].dataType)
        if number is not None and df.schema[key].dataType == kinds[key] and isinstance(kinds[key], T.NumericType) \
                and grid.lo is not None and grid.step > 0 and ranges and min(ranges) > -2:
            c, near = F.col(f"`{key}`"), F.lit(False)
            for lo, hi in _intervals(ranges, grid):
                part = F.lit(True)
                if lo > float("-inf"):
                    part = part & (c >= _bound(lo, kinds[key], down=True))
                if hi < float("inf"):
                    part = part & (c <= _bound(hi, kinds[key], down=False))
                near = near | part
            grouped = grouped.where(near)
        return grouped.join(F.broadcast(wanted), ["_range", "_part"], "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return cdc.diff(sieve(baseline, base), sieve(active, act), key=key, version_col=version_col, **options), info


def _bound(value: float, kind: T.DataType, down: bool) -> Column:
    """A literal that the scan can compare its stored keys with."""
    if isinstance(kind, T.IntegralType):
        import math
        whole = math.floor(value) if down else math.ceil(value)
        bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(kind.simpleString(), 64)
        return F.lit(max(-(1 << bits - 1), min((1 << bits - 1) - 1, whole))).cast(kind)
    return F.lit(value)


__all__ = ["Grid", "make_grid", "range_digests", "diff_ranges"]
