"""Imports every module that registers queries."""

from . import crawl_queries, fixture_queries, incremental_queries, io_queries, record_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
