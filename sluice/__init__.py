"""Registry-driven event ingest and table provisioning on PySpark."""

from sluice.config import IngestConfig

__all__ = ["IngestConfig"]
