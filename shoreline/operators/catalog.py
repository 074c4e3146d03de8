"""Catalog: a named folder of versioned tables.

Listing reads each table's commit log (metadata only); row counts come
from the logs, not from scans.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from shoreline import fs
from shoreline.operators.table import VersionedTable


class CatalogError(ValueError):
    pass


class Catalog:
    def __init__(self, spark: SparkSession, root: str, name: str):
        name = (name or "").strip()
        root = (root or "").strip()
        if not name:
            raise CatalogError("catalog name must be non-empty")
        if not root:
            raise CatalogError("warehouse root must be non-empty")
        self.spark = spark
        self.name = name
        self.root = root.rstrip("/")

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}"

    def ensure(self, description: str | None = None) -> "Catalog":
        """Idempotent create; chainable."""
        fs.mkdirs(self.spark, self.path)
        marker = f"{self.path}/_catalog.json"
        if not fs.exists(self.spark, marker):
            fs.create_exclusive(self.spark, marker, json.dumps(
                {"name": self.name, "description": description,
                 "created_at": datetime.now(timezone.utc).isoformat()}))
        return self

    def exists(self) -> bool:
        return fs.exists(self.spark, f"{self.path}/_catalog.json")

    def create(self, name: str, schema, *, partition_by=None, cluster_by=None,
               data: DataFrame | None = None, auto_create_catalog: bool = True,
               now=None) -> VersionedTable:
        if not name or not str(name).strip():
            raise CatalogError("table name must be non-empty")
        if not self.exists():
            if not auto_create_catalog:
                raise CatalogError(f"catalog {self.name} does not exist")
            self.ensure()
        return VersionedTable.create(self.spark, f"{self.path}/{name.strip()}", schema,
                                     partition_by=partition_by, cluster_by=cluster_by,
                                     name=name.strip(), data=data, now=now)

    def table(self, name: str) -> VersionedTable:
        """Handle without an existence check."""
        return VersionedTable(self.spark, f"{self.path}/{name}", name)

    def table_by_name(self, name: str) -> VersionedTable | None:
        t = self.table(name)
        return t if t.exists() else None

    def table_names(self) -> list[str]:
        names = []
        for n in fs.list_names(self.spark, self.path):
            if n != "_catalog.json" and fs.list_names(self.spark, f"{self.path}/{n}/_log"):
                names.append(n)
        return names

    def tables(self) -> DataFrame:
        rows = []
        for n in self.table_names():
            t = self.table(n)
            last = t.log()[-1]
            rows.append((n, t.latest_version, t.row_count(), len(t.columns), last.committed_at))
        return self.spark.createDataFrame(
            rows, "table_name string, version int, rows long, columns int, committed_at string")

    def drop(self, name: str, if_exists: bool = True) -> bool:
        t = self.table(name)
        if not t.exists():
            if if_exists:
                return False
            raise CatalogError(f"table {name} does not exist")
        t.drop()
        return True

    def drop_catalog(self) -> None:
        """Drop every table and the catalog folder."""
        fs.delete(self.spark, self.path)

    def register_views(self) -> list[str]:
        """Each table's current rows as a temp view of the same name, for raw SQL."""
        names = self.table_names()
        for n in names:
            self.table(n).read().createOrReplaceTempView(n)
        return names

