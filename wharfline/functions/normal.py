"""Inverse of the normal distribution function."""

from __future__ import annotations

from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_quantile(level: float) -> float:
    """Standard-normal quantile of one level; evaluated when the plan is built."""
    if not 0 < level < 1:
        raise ValueError("service level must be between 0 and 1")
    return NormalDist().inv_cdf(level)


@F.pandas_udf(T.DoubleType())
def _quantiles(levels: pd.Series) -> pd.Series:
    usable = levels.where((levels > 0) & (levels < 1))
    table = {v: NormalDist().inv_cdf(v) for v in usable.dropna().unique()}
    return usable.map(table).astype("float64")


def service_factor(level: float | Column) -> Column:
    """Safety factor: a literal for a fixed level, per row for a column of levels.

    A level outside (0, 1) is an error for a literal and NULL in a column.
    """
    return _quantiles(level.cast("double")) if isinstance(level, Column) else F.lit(normal_quantile(level))
