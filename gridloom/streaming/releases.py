"""Records that arrive over time: each key's latest release, and scores of attempts by time window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def current_releases(stream: DataFrame, key: str, published: str, record: str) -> DataFrame:
    """(key, record, published) each time that a later release than any before arrives; ties go to the larger record.

    State is one row a key. Late and repeated records change nothing.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = tuple(state.get) if state.exists else None
        before = best
        for pdf in batches:
            own = max(zip(pdf[published], pdf[record], strict=True))
            own = (own[0].isoformat(), int(own[1]))
            best = own if best is None or own > best else best
        if best != before:
            state.update(best)
            yield pd.DataFrame({key: [k[0]], record: [best[1]], published: [pd.Timestamp(best[0])]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {record} long, {published} timestamp", "published string, record long", "update", GroupStateTimeout.NoTimeout)


def attempt_scores(stream: DataFrame, at: str, ok: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window, attempts, passed): attempts by time window; rows later than late are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width)).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(ok).alias("passed"))
