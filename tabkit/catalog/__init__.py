"""Every operator as a query over the test tables, with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tabkit.catalog.registry import QUERIES, SQL

SECTIONS = ("io", "rows", "scalars", "gaps", "joining", "statistics", "pages", "encoding", "learning", "stated", "flagships")


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for section in SECTIONS:
        import_module(f"tabkit.catalog.{section}")
    return QUERIES, SQL
