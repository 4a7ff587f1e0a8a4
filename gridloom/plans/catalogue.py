"""Every query of the engine and, where SQL expresses it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from .registry import ENTRIES

for _name in ("finance", "measures", "dates_text", "lookups", "graphs", "grading", "records", "audits", "workbooks", "models", "trials", "questions", "masks", "ways", "checks", "cuts", "leaks"):
    import_module(f".{_name}", __package__)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: entry[0] for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry[1] for name, entry in ENTRIES.items() if entry[1] is not None}
