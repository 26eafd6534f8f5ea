"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.expressions import ColumnLike, as_column


def as_date(value: ColumnLike) -> Column:
    """Date of a date, timestamp or date text; unreadable text is NULL."""
    return as_column(value).try_cast("date")


def fiscal_year(value: ColumnLike, start_month: int = 4) -> Column:
    """Year named after its end: months from ``start_month`` on belong to the next year.

    A start in January still adds one.
    """
    day = as_date(value)
    return F.when(F.month(day) >= start_month, F.year(day) + 1).otherwise(F.year(day))


def date_parts(value: ColumnLike, prefix: str) -> dict[str, Column]:
    """Year, month, day, Monday-based weekday and quarter."""
    day = as_date(value)
    return {
        f"{prefix}_year": F.year(day),
        f"{prefix}_month": F.month(day),
        f"{prefix}_day": F.dayofmonth(day),
        f"{prefix}_dayofweek": F.weekday(day),
        f"{prefix}_quarter": F.quarter(day),
    }


def boundary_flags(value: ColumnLike, prefix: str) -> dict[str, Column]:
    """First of month, last of month, last of quarter; False for a missing date."""
    day = as_date(value)
    last = F.coalesce(day == F.last_day(day), F.lit(False))
    return {
        f"{prefix}_is_month_start": F.coalesce(F.dayofmonth(day) == 1, F.lit(False)),
        f"{prefix}_is_month_end": last,
        f"{prefix}_is_quarter_end": last & (F.month(day) % 3 == 0),
    }


def cyclical(value: ColumnLike, prefix: str) -> dict[str, Column]:
    """Month and weekday as points on a circle."""
    day = as_date(value)
    month, weekday = F.month(day) * (2 * math.pi) / 12, F.weekday(day) * (2 * math.pi) / 7
    return {
        f"{prefix}_month_sin": F.sin(month),
        f"{prefix}_month_cos": F.cos(month),
        f"{prefix}_day_sin": F.sin(weekday),
        f"{prefix}_day_cos": F.cos(weekday),
    }


def grid_dates(first: Column, last: Column, freq: str) -> Column:
    """Array of grid dates in [first, last]: D daily, W Sundays, M month ends, Q quarter ends."""
    first, last = first.cast("date"), last.cast("date")
    if freq == "D":
        return F.when(first <= last, F.sequence(first, last))
    if freq == "W":
        sunday = F.next_day(F.date_sub(first, 1), "Sunday")
        return F.when(sunday <= last, F.sequence(sunday, last, F.expr("interval 7 days"))).when(
            last.isNotNull(), F.array().cast("array<date>")
        )
    if freq in ("M", "Q"):
        unit, step, tail = ("month", 1, 0) if freq == "M" else ("quarter", 3, 2)
        starts = F.sequence(
            F.trunc(first, unit), F.greatest(F.trunc(last, unit), F.trunc(first, unit)), F.expr(f"interval {step} months")
        )
        ends = F.transform(starts, lambda d: F.last_day(F.add_months(d, tail)))
        return F.filter(ends, lambda d: (d >= first) & (d <= last))
    raise ValueError(f"unsupported frequency: {freq}")


def period_start(value: Column, freq: str) -> Column:
    return F.trunc(value, {"M": "month", "Q": "quarter"}[freq])


def step_date(last: Column, steps: Column, freq: str | None) -> Column:
    """Date ``steps`` grid periods after ``last``."""
    if freq in (None, "D"):
        return F.date_add(last.cast("date"), steps.cast("int"))
    if freq == "W":
        return F.date_add(last.cast("date"), (steps * 7).cast("int"))
    if freq in ("M", "Q"):
        months = steps * (1 if freq == "M" else 3)
        return F.last_day(F.add_months(last.cast("date"), months.cast("int")))
    raise ValueError(f"unsupported frequency: {freq}")


def date_range(spark: SparkSession, start: str, end: str, freq: str = "D") -> DataFrame:
    """One row per grid date between two dates, both inclusive."""
    return spark.range(1).select(
        F.explode(grid_dates(F.lit(start).cast("date"), F.lit(end).cast("date"), freq)).alias("date")
    )
