"""shoreline: versioned analytical tables, change capture, asset ingestion and
vector search expressed as Spark DataFrame jobs over plain Parquet."""

from shoreline.session import build_session, apply_session_defaults, scratch_path

__all__ = ["build_session", "apply_session_defaults", "scratch_path"]
__version__ = "0.1.0"
