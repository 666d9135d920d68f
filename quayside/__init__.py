"""Incremental landing-zone ingestion expressed as Spark DataFrame operators."""

from quayside.params import ChangeWindow, LoadParams

__all__ = ["ChangeWindow", "LoadParams"]
