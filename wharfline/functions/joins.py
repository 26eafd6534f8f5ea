"""Joining small tables of statistics back to the rows they came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions.durable import durable

SMALL_ROWS = 100_000


def join_statistics(df: DataFrame, statistics: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows next to the statistics of their group.

    The statistics are computed once and counted. Up to ``SMALL_ROWS`` groups are
    sent to every task, so the rows stay where they are, however uneven the
    groups; more are joined by shuffle.
    """
    stored = durable(statistics)
    side = F.broadcast(stored) if stored.count() <= SMALL_ROWS else stored
    return df.join(side, list(keys), how)
