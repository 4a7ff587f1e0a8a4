"""Where plans register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.shipping import ship

ENTRIES: dict[str, tuple[Callable, str | None]] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function of a table reader under its own name. sql: the same rows, for another engine."""

    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__ = f.__name__
        ENTRIES[f.__name__] = (run, sql)
        return f

    return register
