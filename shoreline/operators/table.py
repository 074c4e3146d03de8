"""Versioned tables on plain Parquet: insert, update, delete, time travel,
snapshot diff and compaction, without a table-format runtime.

Layout under the table folder::

    data/_c=<commit>/[_p0=…/]part-*.parquet   rows + _rv (commit version), _rn (row number)
    tomb/_c=<commit>/part-*.parquet           (_rv, _rn) of rows that stopped being current
    _log/<version>.json                       one file per commit, created exclusively, last

The state at version *v* is the data of the commits from the last base
(create / compact) up to *v*, minus the tombstones of those commits
(``left_anti`` join on ``(_rv, _rn)``). Physical rows never change, so filters
on user columns still reach the Parquet scan below the anti join, old
snapshots need no copy, and a writer that fails before its log file exists
leaves only files no commit names. Each commit writes into its own
``_c=<version>-<uuid>`` folder, so a losing concurrent writer cannot mix
files into the winner's commit.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline import fs
from shoreline.operators import read as R
from shoreline.operators.curve import curve_position
from shoreline.operators.schema import (Layout, SchemaError, conform, normalize_layout,
                                        null_violation, to_struct, vector_violation)

RV, RN, PV, PRN = "_rv", "_rn", "_pv", "_prn"
META = (RV, RN)
# Broadcast the tombstone side of the anti join only while its exact size
# (known from the commit log, 12 bytes a row) stays under this bound; beyond
# it the join is left to AQE (sort-merge on (_rv, _rn)); compact() is the
# caller's decision and never runs by itself.
TOMBSTONE_BROADCAST_ROWS = 2_000_000
class CommitConflict(RuntimeError):
    """Another writer committed the same version first; re-run the operation."""


class NotNullViolation(ValueError):
    pass


class VectorLengthError(ValueError):
    pass


@dataclass(frozen=True)
class Commit:
    version: int
    commit_id: str
    committed_at: str
    operation: str
    base: int
    has_data: bool
    has_tomb: bool
    added: int
    removed: int
    schema: str
    layout: dict
    partition_types: dict
    txn: dict | None
    info: dict

    @property
    def time(self) -> datetime:
        return datetime.fromisoformat(self.committed_at.replace("Z", "+00:00"))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _iso(ts: datetime) -> str:
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=timezone.utc)
    return ts.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


class VersionedTable:
    """Handle on a versioned table. Handles are immutable: ``as_of`` returns a
    new handle pinned to a version instead of changing this one."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None,
                 version: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.name = name or self.path.rsplit("/", 1)[-1]
        self._pinned = version
        self._log_cache: list[Commit] | None = None

    # ------------------------------------------------------------ accessors
    @property
    def full_path(self) -> str:
        """Back-quoted ``catalog.table`` form used in messages and SQL views."""
        parent = self.path.rstrip("/").rsplit("/", 2)
        catalog = parent[-2] if len(parent) >= 2 else ""
        return f"`{catalog}.{self.name}`" if catalog else f"`{self.name}`"

    @property
    def storage_uri(self) -> str | None:
        return getattr(self, "_storage_uri", None)

    def set_storage_uri(self, uri: str | None) -> "VersionedTable":
        """Where large asset bytes of this table go (``assets.externalize``); chainable."""
        self._storage_uri = uri.strip() if isinstance(uri, str) and uri.strip() else None
        return self

    def latest(self) -> "VersionedTable":
        """A handle without a pinned snapshot (reads the newest version)."""
        handle = VersionedTable(self.spark, self.path, self.name)
        handle._storage_uri = self.storage_uri
        return handle

    # ------------------------------------------------------------------ log
    @property
    def data_dir(self) -> str:
        return f"{self.path}/data"

    @property
    def tomb_dir(self) -> str:
        return f"{self.path}/tomb"

    @property
    def log_dir(self) -> str:
        return f"{self.path}/_log"

    def exists(self) -> bool:
        return bool(fs.list_names(self.spark, self.log_dir))

    def log(self, refresh: bool = False) -> list[Commit]:
        """The commit list. A refresh lists the log folder and reads only the
        commit files this handle has not read yet (commits are immutable)."""
        if self._log_cache is None or refresh:
            known = {f"{c.version:020d}.json": c for c in (self._log_cache or [])}
            commits = []
            for n in fs.list_names(self.spark, self.log_dir):
                if not n.endswith(".json"):
                    continue
                c = known.get(n)
                if c is None:
                    c = Commit(**json.loads(fs.read_text(self.spark, f"{self.log_dir}/{n}")))
                commits.append(c)
            self._log_cache = sorted(commits, key=lambda c: c.version)
        return self._log_cache

    def history(self) -> DataFrame:
        """The commit list as a DataFrame (version, time, operation, counts)."""
        self._fresh()
        rows = [(c.version, c.committed_at, c.operation, c.added, c.removed, c.base)
                for c in self.log()]
        return self.spark.createDataFrame(
            rows, "version int, committed_at string, operation string, added long, removed long, base int")

    def _fresh(self) -> "VersionedTable":
        """Unpinned handles see commits made through other handles (another
        writer, a stream) whenever a read starts; pinned ones never move."""
        if self._pinned is None:
            self.log(refresh=True)
        return self

    @property
    def latest_version(self) -> int:
        log = self.log()
        if not log:
            raise FileNotFoundError(f"no table at {self.path}")
        return log[-1].version

    @property
    def version(self) -> int:
        return self._pinned if self._pinned is not None else self.latest_version

    def _commit_at(self, version: int) -> Commit:
        for c in self.log():
            if c.version == version:
                return c
        raise ValueError(f"table {self.name} has no version {version}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._commit_at(self.version).schema))

    @property
    def layout(self) -> Layout:
        d = self._commit_at(self.version).layout
        return Layout(list(d.get("partition_by", [])), list(d.get("cluster_by", [])),
                      dict(d.get("vector_dims", {})), bool(d.get("local_sort", False)), list(d.get("bloom_by", [])),
                      bool(d.get("curve", False)))

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def column_names(self) -> list[str] | None:
        """Column names, or None when the table cannot be resolved."""
        try:
            return self.columns
        except (FileNotFoundError, ValueError):
            return None

    def row_count(self) -> int:
        """Rows at this version, from the commit log alone (no scan)."""
        self._fresh()
        commits = self._snapshot_commits(self.version)
        return sum(c.added for c in commits) - sum(c.removed for c in commits)

    # --------------------------------------------------------------- create
    @classmethod
    def create(cls, spark: SparkSession, path: str, schema, *, partition_by=None,
               cluster_by=None, name: str | None = None, data: DataFrame | None = None,
               now: datetime | None = None, vector_dims: dict[str, int] | None = None,
               local_sort: bool = False, bloom_by=(), curve: bool = False) -> "VersionedTable":
        """Create-or-replace: an existing table at ``path`` gets a new base
        version with the new schema; its history stays readable by version.
        ``vector_dims`` fixes the length of array columns (checked at write);
        ``local_sort`` clusters without a shuffle, ``bloom_by`` names columns
        with Bloom filters, ``curve`` clusters by all columns alike (see ``Layout``)."""
        struct = to_struct(schema)
        layout = normalize_layout(struct, partition_by, cluster_by)
        for c in (vector_dims or {}):
            if c not in struct.fieldNames() or not isinstance(struct[c].dataType, T.ArrayType):
                raise SchemaError(f"vector column '{c}' must be an array column of the table")
        layout.vector_dims = {c: int(n) for c, n in (vector_dims or {}).items()}
        layout.local_sort, layout.curve = local_sort, curve
        layout.bloom_by = [bloom_by] if isinstance(bloom_by, str) else list(bloom_by)
        for c in layout.bloom_by:
            if c not in struct.fieldNames():
                raise SchemaError(f"Bloom filter column '{c}' must be a column of the table")
        probe = layout.with_partition_columns(spark.createDataFrame([], struct))
        ptypes = {c: probe.schema[c].dataType.simpleString() for c in layout.partition_columns()}
        table = cls(spark, path, name)
        fs.mkdirs(spark, table.log_dir)
        if data is not None:
            data = _null_guarded(conform(data, struct), struct, table.name)
        table._write_commit("CREATE", struct, layout, ptypes, data=data, replace=True, now=now)
        return table

    # ---------------------------------------------------------------- reads
    def _snapshot_commits(self, version: int) -> list[Commit]:
        upto = [c for c in self.log() if c.version <= version]
        if not upto:
            raise ValueError(f"table {self.name} has no version <= {version}")
        base = max(c.base for c in upto)
        return [c for c in upto if c.version >= base]

    def _full_schema(self, commit: Commit) -> T.StructType:
        schema = T.StructType.fromJson(json.loads(commit.schema))
        fields = list(schema.fields) + [T.StructField(RV, T.IntegerType()),
                                        T.StructField(RN, T.LongType()),
                                        T.StructField("_c", T.StringType())]
        for c, t in commit.partition_types.items():
            fields.append(T.StructField(c, T.DataType.fromDDL(t)))
        return T.StructType(fields)

    def _data(self, version: int, only: set[int] | None = None) -> DataFrame:
        """Data rows of the snapshot's commits (``only``: just the commits
        with those versions, and the compacted base, whose rows keep the
        identity of the commits it replaced)."""
        commits = self._snapshot_commits(version)
        full = self._full_schema(self._commit_at(version))
        paths = [f"{self.data_dir}/_c={c.commit_id}" for c in commits
                 if c.has_data and (only is None or c.version in only or c.operation == "COMPACT")]
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", self.data_dir).parquet(*paths)

    def _tombstone_rows(self, version: int) -> int:
        commits = self._snapshot_commits(version)
        base = commits[0].version
        return sum(c.removed for c in commits if c.has_tomb and c.version > base)

    def _tombstones(self, version: int) -> tuple[DataFrame | None, int]:
        commits = self._snapshot_commits(version)
        base = commits[0].version
        paths = [f"{self.tomb_dir}/_c={c.commit_id}" for c in commits
                 if c.has_tomb and c.version > base]
        if not paths:
            return None, 0
        return self.spark.read.schema(f"{RV} int, {RN} long").parquet(*paths), self._tombstone_rows(version)

    def _base_version(self) -> int:
        """The newest version, which a mutation reads and must directly follow:
        the commit is refused if another writer came between."""
        if self._pinned is not None:
            raise ValueError(f"{self.name}: a handle pinned to version {self._pinned} is read-only")
        return self._fresh().latest_version

    def live(self, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        """Current rows with the row identity and partition columns kept
        (``only``: rows written by the commits with those versions)."""
        self._fresh()
        v = self.version if version is None else version
        data = self._data(v, only)
        tomb, n = self._tombstones(v)
        if tomb is None:
            return data
        if n <= TOMBSTONE_BROADCAST_ROWS:
            tomb = F.broadcast(tomb)
        return data.join(tomb, [RV, RN], "left_anti")

    def _user_view(self, df: DataFrame, with_version: bool = False) -> DataFrame:
        cols = [F.col(R.quote(c)) for c in self.columns]
        if with_version:
            cols.append(F.col(RV).alias("_version"))
        return df.select(*cols)

    def read(self, where=None, between: tuple | None = None, with_version: bool = False) -> DataFrame:
        """Rows at this handle's version. ``between=(col, lo, hi)`` also bounds
        the date partition column when the table is partitioned by
        ``to_date(col)``, so directories are pruned."""
        df = self.live()
        cond = R.predicate(where)
        if cond is not None:
            df = df.where(cond)
        if between is not None:
            col, lo, hi = between
            df = df.where(R.between(col, lo, hi, self._date_partition_of(col)))
        return self._user_view(df, with_version)

    def _date_partition_of(self, column: str) -> str | None:
        for i, e in enumerate(self.layout.partition_by):
            if e.replace(" ", "").lower() in (f"to_date({column})".lower(), f"to_date(`{column}`)".lower()):
                return f"_p{i}"
        return None

    def get_values(self, columns=None, where=None, order_by=None, limit=None,
                   between: tuple | None = None) -> DataFrame:
        return R.get_values(self.read(where=where, between=between), columns, None, order_by, limit)

    def as_of(self, version: int | None = None, timestamp=None) -> "VersionedTable":
        """A new handle at ``version``, or at the last commit made at or before
        ``timestamp`` (datetime, ISO text, or epoch milliseconds)."""
        if version is None and timestamp is None:
            raise ValueError("as_of needs a version or a timestamp")
        if version is None:
            ts = _parse_time(timestamp)
            eligible = [c.version for c in self.log() if c.time <= ts]
            if not eligible:
                raise ValueError(f"table {self.name} has no commit at or before {timestamp!r}")
            version = max(eligible)
        self._commit_at(version)
        handle = VersionedTable(self.spark, self.path, self.name, version)
        handle._log_cache = self._log_cache
        return handle

    def changes(self, start: int, end: int | None = None) -> DataFrame:
        """Rows that stopped being current (``_change = 'removed'``) and rows
        that became current (``'added'``) between versions ``start`` and
        ``end``, by row identity: an update that leaves its values as they were
        is a change. ``compact`` keeps identities, so the answer is the same
        before and after it; a replaced table changes in all its rows."""
        self._fresh()
        end = self.version if end is None else end
        between_commits = [c for c in self.log() if start < c.version <= end]
        if any(c.operation == "CREATE" for c in between_commits):
            added, removed = self.live(end), self.live(start)
        else:
            # Only the commits after ``start`` can hold added rows, and only the
            # commits the new tombstones name can hold removed ones: neither
            # side reads the rest of the table (unless compacted since; the
            # version filter then reaches the Parquet scan).
            added = self.live(end, only={c.version for c in between_commits}).where(F.col(RV) > start)
            removed = None
            new_tombs = [c for c in between_commits if c.has_tomb]
            if new_tombs:
                t = (self.spark.read.schema(f"{RV} int, {RN} long")
                     .parquet(*[f"{self.tomb_dir}/_c={c.commit_id}" for c in new_tombs]))
                # distinct commit versions named: at most one row per commit
                named = {int(r[RV]) for r in t.select(RV).distinct().collect()}
                removed = self.live(start, only=named).join(t, [RV, RN], "left_semi")
        out = self._user_view(added).withColumn("_change", F.lit("added"))
        if removed is not None:
            out = out.unionByName(self._user_view(removed).withColumn("_change", F.lit("removed")))
        return out

    # --------------------------------------------------------------- writes
    @staticmethod
    def _prepare_rows(df: DataFrame, version: int, layout: Layout, columns: list[str],
                      keep_origin: bool = False, carry: tuple = (), keep_identity: bool = False) -> DataFrame:
        cols = [F.col(R.quote(c)) for c in columns]
        if keep_origin:
            cols += [F.col(PV), F.col(PRN)]
        if keep_identity:
            cols += [F.col(RV), F.col(RN)]
        cols += [F.col(R.quote(c)) for c in carry]
        out = layout.with_partition_columns(df.select(*cols))
        pcols = layout.partition_columns()
        keys = [R.quote(c) for c in layout.cluster_by]
        if layout.local_sort:
            out = out.sortWithinPartitions(*pcols, *keys) if pcols or keys else out
        elif keys:
            # Range partitioning on the cluster keys (sampled boundaries) plus a
            # sort inside each task: every file covers a narrow key range, so
            # Parquet min/max statistics skip row groups on range reads. Ties are
            # broken by a hash of the row, which a retried task computes alike,
            # so a single hot cluster value is split over several tasks; AQE
            # joins small ranges by their bytes. Partition columns come first:
            # a task writes few of them.
            if layout.curve and len(keys) > 1:
                out = out.withColumn("_curve", curve_position(out, layout.cluster_by))
                keys = ["_curve", *keys]
            hashable = [R.quote(f.name) for f in out.schema.fields if "map<" not in f.dataType.simpleString()]
            out = out.repartitionByRange(*pcols, *keys, F.xxhash64(*hashable))
            out = out.sortWithinPartitions(*pcols, *keys).drop("_curve")
        elif pcols:
            # Rows of a partition value meet in one task, AQE splits large ones
            # and joins small ones by their bytes: few files per value.
            out = out.hint("rebalance", *pcols).sortWithinPartitions(*pcols)
        if not keep_identity:
            # Numbered after the shuffle, in the task that writes the row.
            out = out.withColumns({RV: F.lit(version).cast("int"), RN: F.monotonically_increasing_id()})
        return out

    def _write_commit(self, operation: str, schema: T.StructType | None = None,
                      layout: Layout | None = None, ptypes: dict | None = None, *,
                      data: DataFrame | None = None, tombs: DataFrame | None = None,
                      replace: bool = False, keep_origin: bool = False,
                      txn: dict | None = None, info: dict | None = None,
                      now: datetime | None = None, expected_version: int | None = None,
                      carry: tuple = (), keep_identity: bool = False,
                      metrics: list[Column] | None = None, skip_col: str | None = None,
                      observed: dict | None = None) -> Commit:
        """Write one commit. ``carry`` columns ride along with ``data`` to the
        write's last stage, where ``metrics`` are observed (once per row, even
        with a clustering shuffle), rows flagged by ``skip_col`` are left out,
        and the carried columns are dropped; ``observed`` receives the
        metrics."""
        log = self.log(refresh=True)
        prev = log[-1] if log else None
        version = (prev.version + 1) if prev else 1
        if expected_version is not None and version != expected_version:
            raise CommitConflict(f"{self.name}: expected to write version {expected_version}, "
                                 f"found {version}")
        if schema is None:
            schema = self.schema
            layout = self.layout
            ptypes = dict(prev.partition_types)
        commit_id = f"{version:010d}-{uuid.uuid4().hex[:8]}"
        schema_json = schema.json()
        added = removed = 0
        has_data = has_tomb = False
        if prev is None and not replace:
            raise FileNotFoundError(f"no table at {self.path}")
        columns = [f.name for f in schema.fields]
        try:
            data_path = f"{self.data_dir}/_c={commit_id}"
            if data is not None:
                obs = Observation(f"add_{commit_id}")
                if layout.vector_dims:
                    msg = f"vector length differs from {layout.vector_dims} on {self.name}"
                    broken = vector_violation(layout.vector_dims)
                    if skip_col:  # rows left out anyway do not fail the write
                        broken = broken & ~F.col(skip_col)
                    data = (data.withColumn("_vl", F.when(broken, F.raise_error(F.lit(msg))))
                            .where(F.col("_vl").isNull()).drop("_vl"))
                rows = self._prepare_rows(data, version, layout, columns, keep_origin, carry, keep_identity)
                kept = ~F.col(skip_col) if skip_col else F.lit(True)
                rows = rows.observe(obs, F.count_if(kept).alias("n"), *(metrics or []))
                if skip_col:
                    rows = rows.where(kept)
                if carry:
                    rows = rows.drop(*carry)
                (rows.write.mode("errorifexists").options(**layout.write_options())
                 .partitionBy(*layout.partition_columns()).parquet(data_path))
                got = obs.get
                added = int(got["n"] or 0)
                has_data = added > 0
                if observed is not None:
                    observed.update(got)
            tomb_parts = []
            if tombs is not None:
                tomb_parts.append(tombs.select(F.col(RV).cast("int"), F.col(RN).cast("long")))
            if keep_origin and has_data:
                written = (self.spark.read.option("basePath", data_path).parquet(data_path)
                           .where(F.col(PV).isNotNull())
                           .select(F.col(PV).cast("int").alias(RV), F.col(PRN).alias(RN)))
                tomb_parts.append(written)
            if tomb_parts:
                t = tomb_parts[0]
                for extra in tomb_parts[1:]:
                    t = t.unionByName(extra)
                obs = Observation(f"tomb_{commit_id}")
                t = t.observe(obs, F.count(F.lit(1)).alias("n"))
                t.write.mode("errorifexists").parquet(f"{self.tomb_dir}/_c={commit_id}")
                removed = int(obs.get["n"])
                has_tomb = removed > 0
        except Exception as e:
            # Nothing names these files yet; remove them so the folder stays clean.
            fs.delete(self.spark, f"{self.data_dir}/_c={commit_id}")
            fs.delete(self.spark, f"{self.tomb_dir}/_c={commit_id}")
            text = str(e)
            if "NOT NULL violated" in text:
                raise NotNullViolation(text.split("NOT NULL violated", 1)[1][:200]) from None
            if "vector length differs" in text:
                raise VectorLengthError(text.split("vector length differs", 1)[1][:200]) from None
            raise
        commit = Commit(version, commit_id, _iso(now or _now()), operation,
                        version if replace else prev.base, has_data, has_tomb,
                        added, removed, schema_json, layout.to_json(), ptypes, txn, info or {})
        ok = fs.create_exclusive(self.spark, f"{self.log_dir}/{version:020d}.json",
                                 json.dumps(commit.__dict__))
        self.log(refresh=True)
        if not ok:
            fs.delete(self.spark, f"{self.data_dir}/_c={commit_id}")
            fs.delete(self.spark, f"{self.tomb_dir}/_c={commit_id}")
            raise CommitConflict(f"{self.name}: version {version} was committed by another writer")
        return commit

    def insert(self, df: DataFrame, *, on_null: str = "error", now: datetime | None = None,
               txn: dict | None = None, count_nulls: tuple[str, ...] = (),
               count_where: dict[str, Column] | None = None, helpers: tuple[str, ...] = ()) -> dict:
        """Append rows (aligned to the schema by name and cast).

        NOT NULL columns: ``on_null="error"`` writes nothing when any row
        breaks them (checked in the same pass as the write, files of the
        failed attempt are removed, no commit is made); ``"reject"`` writes the
        valid rows and reports how many were left out (``rejects(df)`` gives
        them back). ``helpers`` names columns of ``df`` that only ``count_where``
        reads; any other column the table does not have is an error."""
        schema = self.schema
        if on_null not in ("error", "reject"):
            raise ValueError("on_null must be 'error' or 'reject'")
        # Per-row flags travel with the rows as columns and are counted in the
        # write job's last stage (after any clustering shuffle): counts taken
        # before the shuffle would also see the range-partitioner's sampling
        # pass and come out doubled.
        where = {f"_cw_{i}": c for i, c in enumerate((count_where or {}).values())}
        rows = conform((df.withColumns(where) if where else df).drop(*helpers), schema, carry=list(where))
        bad = null_violation(schema) | vector_violation(self.layout.vector_dims)
        flags = {"_bad": bad, **{f"_nl_{i}": F.col(f"`{c}`").isNull() for i, c in enumerate(count_nulls)}}
        rows = rows.withColumns(flags)
        if on_null == "error":
            rows = _null_guarded(rows, schema, self.name)
        metrics = ([F.count(F.lit(1)).alias("seen"), F.count_if(F.col("_bad")).alias("bad")]
                   + [F.count_if(F.col(f"_nl_{i}")).alias(f"null_{c}") for i, c in enumerate(count_nulls)]
                   + [F.count_if(F.col(k)).alias(n) for k, n in zip(where, (count_where or {}))])
        observed: dict = {}
        commit = self._write_commit("INSERT", data=rows, txn=txn, now=now,
                                    carry=tuple(where) + tuple(flags), metrics=metrics,
                                    skip_col="_bad" if on_null == "reject" else None,
                                    observed=observed)
        out = {"version": commit.version, "inserted": commit.added,
               "rejected": int(observed.get("bad") or 0), "seen": int(observed.get("seen") or 0)}
        for c in count_nulls:
            out[f"null_{c}"] = int(observed.get(f"null_{c}") or 0)
        for n in (count_where or {}):
            out[n] = int(observed.get(n) or 0)
        return out

    def insert_values(self, values, **options) -> dict:
        """Insert a 2D grid (header row + rows), typed by the table schema."""
        from shoreline.sources.grid import grid_to_frame
        return self.insert(grid_to_frame(self.spark, values, self.schema), **options)

    @staticmethod
    def rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
        return conform(df, schema).where(null_violation(schema))

    def update(self, set_values: dict, where, now: datetime | None = None) -> dict:
        """``UPDATE … SET … WHERE``: expressions see the old row (one
        ``select``); matched rows are tombstoned and rewritten in one commit."""
        cond = R.predicate(where)
        if cond is None:
            raise ValueError("update needs a non-empty where predicate")
        if not set_values:
            raise ValueError("update needs at least one column to set")
        unknown = [c for c in set_values if c not in self.columns]
        if unknown:
            raise SchemaError(f"unknown columns in SET: {unknown}")
        schema = self.schema
        base = self._base_version()
        matched = self.live(base).where(F.coalesce(cond, F.lit(False)))
        new_cols = []
        for f in schema.fields:
            if f.name in set_values:
                v = set_values[f.name]
                expr = v if isinstance(v, Column) else F.expr(R.guard(str(v), "set"))
                new_cols.append(expr.cast(f.dataType).alias(f.name))
            else:
                new_cols.append(F.col(R.quote(f.name)))
        new_rows = matched.select(*new_cols, F.col(RV).alias(PV), F.col(RN).alias(PRN))
        commit = self._write_commit("UPDATE", data=new_rows, keep_origin=True, now=now,
                                    expected_version=base + 1)
        return {"version": commit.version, "updated": commit.added}

    def delete(self, where, now: datetime | None = None) -> dict:
        """``DELETE WHERE``; rows where the predicate is NULL stay."""
        cond = R.predicate(where)
        if cond is None:
            raise ValueError("delete needs a non-empty where predicate")
        base = self._base_version()
        gone = self.live(base).where(F.coalesce(cond, F.lit(False))).select(RV, RN)
        commit = self._write_commit("DELETE", tombs=gone, now=now, expected_version=base + 1)
        return {"version": commit.version, "deleted": commit.removed}

    def apply(self, operation: str, data: DataFrame | None = None, tombs: DataFrame | None = None,
              *, keep_origin: bool = False, txn: dict | None = None, info: dict | None = None,
              now: datetime | None = None, expected_version: int | None = None) -> Commit:
        """Low-level commit used by merge and streaming: ``data`` rows in the
        table schema (optionally with ``_pv``/``_prn`` naming the rows they
        replace) and ``tombs`` ``(_rv, _rn)`` rows to retire."""
        if data is not None:
            data = data.select(*[F.col(R.quote(c)) for c in self.columns],
                               *([F.col(PV), F.col(PRN)] if keep_origin else []))
        return self._write_commit(operation, data=data, tombs=tombs, keep_origin=keep_origin,
                                  txn=txn, info=info, now=now, expected_version=expected_version)

    def compact(self, now: datetime | None = None) -> dict:
        """Rewrite the current rows as a new base version; later reads skip
        all older data and tombstones (older versions stay readable). Rows keep
        their identity, so change sets across a compaction stay the same."""
        base = self._base_version()
        commit = self._write_commit("COMPACT", self.schema, self.layout,
                                    dict(self.log()[-1].partition_types),
                                    data=self.live(base).select(*[F.col(R.quote(c)) for c in self.columns], RV, RN),
                                    replace=True, now=now, expected_version=base + 1, keep_identity=True)
        return {"version": commit.version, "rows": commit.added}

    def committed_txn(self, app: str, batch: int) -> bool:
        """True when a commit already carries ``(app, batch)`` (replay check)."""
        return any(c.txn and c.txn.get("app") == app and c.txn.get("batch") == batch
                   for c in self.log(refresh=True))

    def drop(self) -> None:
        fs.delete(self.spark, self.path)
        self._log_cache = None


def _null_guarded(rows: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Fail inside the write job itself on the first row breaking a NOT NULL
    column, so a bad batch never costs a second scan. The check is tied to the
    task: else the filter would be pushed below the columns it reads and work
    out their expressions once more, written out in full."""
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return rows
    msg = f"NOT NULL violated on {name} for {required}"
    here = F.spark_partition_id() >= 0
    return (rows.withColumn("_nn", F.when(null_violation(schema) & here, F.raise_error(F.lit(msg))))
            .where(F.col("_nn").isNull()).drop("_nn"))


def _parse_time(value) -> datetime:
    if isinstance(value, datetime):
        return value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return datetime.fromtimestamp(value / 1000.0, tz=timezone.utc)
    if isinstance(value, str) and value.strip():
        t = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
        return t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    raise ValueError(f"invalid snapshot time {value!r}")


__all__ = ["VersionedTable", "Commit", "CommitConflict", "NotNullViolation",
           "TOMBSTONE_BROADCAST_ROWS"]
