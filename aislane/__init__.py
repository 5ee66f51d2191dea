"""Spark jobs over AIS reception data: ingest, slot checks and signal reports."""

from aislane.session import configure

__all__ = ["configure"]
