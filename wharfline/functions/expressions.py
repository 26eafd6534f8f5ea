"""Column expressions that fix the missing-value and division rules once.

Missing values are NULL everywhere (NaN is turned into NULL on entry), a
comparison with a missing value is False, and a division by zero is NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MICROS = 86_400_000_000

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def flag(condition: Column) -> Column:
    """Boolean that is False where the comparison is unknown."""
    return F.coalesce(condition, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division with NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def elapsed_days(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole days from ``start`` to ``end``, rounded towards minus infinity.

    This counts elapsed 24-hour spans, not calendar days: 23:00 to 01:00 is 0.
    """
    micros = F.unix_micros(as_column(end).cast("timestamp")) - F.unix_micros(as_column(start).cast("timestamp"))
    return ((micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("bigint")


def round_half_even(value: ColumnLike, digits: int = 0) -> Column:
    """Round with ties going to the even neighbour."""
    return F.bround(as_column(value), digits)


def clamp(value: ColumnLike, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value from below and above; missing stays missing."""
    column = as_column(value)
    bounded = column
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(column.isNotNull(), bounded)


def map_values(key: ColumnLike, mapping: dict, default=None) -> Column:
    """Look a key up in a small fixed mapping held in the plan."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), as_column(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def prefixed_id(column: ColumnLike, prefix: str) -> Column:
    """True where a text is the prefix followed by digits only."""
    return as_column(column).rlike(f"^{prefix}[0-9]+$")


def label_id(column: ColumnLike) -> Column:
    """Number in front of an ``"id - name"`` label, NULL when there is none."""
    return F.split(as_column(column), " - ").getItem(0).try_cast("bigint")


def id_label(*columns: ColumnLike) -> Column:
    """``"id - name"`` label."""
    return F.concat_ws(" - ", *[as_column(c).cast("string") for c in columns])


def linspace(low: Column, high: Column, steps: int) -> Column:
    """Array of ``steps`` evenly spaced values from low to high; one step gives low alone."""
    if steps < 1:
        raise ValueError("steps must be at least 1")
    if steps == 1:
        return F.array(low)
    points = F.sequence(F.lit(0), F.lit(steps - 1))
    return F.transform(points, lambda i: low + (high - low) * i / F.lit(float(steps - 1)))


def has_all_tags(tags: ColumnLike, wanted: Sequence[str]) -> Column:
    """True where an array column holds every wanted tag."""
    if not wanted:
        return F.lit(True)
    missing = F.array_except(F.array(*[F.lit(t) for t in wanted]), as_column(tags))
    return flag(F.size(missing) == 0)


def outside(value: Column, mean: Column, std: Column, limit: float) -> Column:
    """True where a value lies more than ``limit`` deviations from the mean."""
    return flag(F.abs(ratio(value - mean, std)) > limit)


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    """Frame of the current row and the ``rows - 1`` rows before it."""
    return window.rowsBetween(-(rows - 1), 0)


def full_window_mean(value: ColumnLike, window: WindowSpec, rows: int) -> Column:
    """Moving average that is NULL until ``rows`` values are present."""
    frame = trailing(window, rows)
    column = as_column(value)
    return F.when(F.count(column).over(frame) == rows, F.avg(column).over(frame))


def key_window(keys: Iterable[str]) -> WindowSpec:
    """Window over one series; without keys the whole frame is one series."""
    return Window.partitionBy(*keys)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a missing key do not exist."""
    return df.dropna(subset=list(keys)) if keys else df
