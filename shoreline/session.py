"""Session settings and the shared scratch location.

Every job that persists intermediate state writes under the folder the cluster
names in ``spark.checkpoint.dir``; a private temporary folder is only created
when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on: UTC times (test tables are
# timestamp_ntz, commit stamps must not shift), AQE for runtime re-planning and
# skew splitting, Arrow for the pandas paths.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # a cast that would lose a value fails the write
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "shoreline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, the bench and local runs. On a cluster the
    platform's session is used as is and only ``apply_session_defaults`` runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Checkpoint files of intermediates nobody references any more are removed.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    checkpoint_root(spark)
    return ship_package(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only when unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="shoreline-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per context: they then
    import it wherever the driver was started from."""
    sc = spark.sparkContext
    if not getattr(sc, "_shoreline_shipped", False):
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="shoreline-ship-")
        path = os.path.join(folder, "shoreline.zip")
        with zipfile.ZipFile(path, "w") as z:
            for top, _, names in os.walk(here):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(top, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(here)))
        sc.addPyFile(path)
        sc._shoreline_shipped = True
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one run of ``name``."""
    root = checkpoint_root(spark)
    return f"{root}/shoreline/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "apply_session_defaults", "checkpoint_root",
           "ship_package", "scratch_path", "local_path", "SESSION_DEFAULTS"]

