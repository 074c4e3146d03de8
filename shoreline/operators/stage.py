"""Materialise an intermediate result once, with its counts, in one job.

An intermediate that is read more than once (a change set, a classified
merge) is checkpointed into the shared checkpoint folder
(``spark.checkpoint.dir``, reliable storage): the lineage is cut, and a lost
executor re-reads the checkpoint instead of recomputing a join. The counts
the caller needs are ``Observation`` metrics of that same job, so no second
pass over the data is made for them. The metrics sit in the checkpoint job's
result stage, where Spark applies each partition's update once even when
tasks are retried.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation

from shoreline.session import checkpoint_root


def materialize(df: DataFrame, name: str, metrics: list[Column] | None = None) -> tuple[DataFrame, dict]:
    """Checkpoint ``df`` once; return the checkpointed frame and the
    observed ``metrics`` (already-aliased aggregate columns)."""
    checkpoint_root(df.sparkSession)  # the shared folder (a private one only in tests)
    if not metrics:
        return df.checkpoint(), {}
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    out = df.observe(obs, *metrics).checkpoint()
    return out, dict(obs.get)


__all__ = ["materialize"]
