"""Cleaning of raw order tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions.durable import stored
from wharfline.functions.expressions import nan_to_null, numeric_columns, text_columns
from wharfline.functions.quantiles import STATE_ROWS, exact_quantiles

UNKNOWN = "Unknown"


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of every row; copies are combined before the shuffle."""
    return df.dropDuplicates()


def probe(df: DataFrame, columns: Sequence[str]) -> dict[str, int | None]:
    """The columns that hold a missing value, numbers with about how many distinct values; one scan, one row back."""
    if not columns:
        return {}
    numbers = [c for c in columns if c in numeric_columns(df)]
    row = df.agg(
        *[F.max(F.col(c).isNull()).alias(f"{c}_null") for c in columns],
        *[F.approx_count_distinct(c).alias(f"{c}_distinct") for c in numbers],
    ).first()
    return {c: row[f"{c}_distinct"] if c in numbers else None for c in columns if row[f"{c}_null"]}


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the most frequent text of each column; ties go to the smallest.

    Texts are counted before they are compared, so no task holds a column's vocabulary.
    """
    counts = (
        df.select(*columns)
        .unpivot([], list(columns), "_column", "_text")
        .where(F.col("_text").isNotNull())
        .groupBy("_column", "_text")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.agg(
        *[
            F.min_by("_text", F.when(F.col("_column") == c, F.struct(-F.col("_n"), F.col("_text")))).alias(c)
            for c in columns
        ]
    )


def fill_missing(df: DataFrame, columns: Sequence[str] | None = None, like: DataFrame | None = None) -> DataFrame:
    """Numbers get their column's median, texts the most frequent one or ``Unknown``.

    A filled whole-number column becomes double, since its median may be fractional.
    ``like`` may name a cheaper frame with the same values, to look for gaps in.
    """
    fillable = [c for c in (columns or df.columns) if c in {*numeric_columns(df), *text_columns(df)}]
    holes = probe(like if like is not None else df, fillable)
    numbers = [c for c in holes if c in numeric_columns(df)]
    texts = [c for c in holes if c in text_columns(df)]
    filled: dict[str, Column] = {}
    for method in ("built_in", "banded"):
        # A column of few distinct values has a small median state, however many rows.
        mine = [c for c in numbers if (holes[c] <= STATE_ROWS) == (method == "built_in")]
        if mine:
            medians = exact_quantiles(df, [], {c: (c, 0.5) for c in mine}, method)
            one = medians.select(F.struct(*mine)).scalar()
            filled |= {c: F.coalesce(F.col(c).cast("double"), one.getField(c)) for c in mine}
    if texts:
        one = most_frequent(df, texts).select(F.struct(*texts)).scalar()
        filled |= {c: F.coalesce(F.col(c), one.getField(c), F.lit(UNKNOWN)) for c in texts}
    return df.withColumns(filled) if filled else df


def parse_date_columns(df: DataFrame) -> DataFrame:
    """Every column with ``date`` in its name becomes a timestamp.

    Texts that are no date become NULL; numbers count nanoseconds since 1970.
    """
    parsed: dict[str, Column] = {}
    for field in df.schema.fields:
        if "date" not in field.name.lower():
            continue
        if isinstance(field.dataType, T.NumericType):
            parsed[field.name] = F.timestamp_micros(F.floor(F.col(field.name) / 1000).cast("bigint"))
        elif isinstance(field.dataType, T.StringType):
            parsed[field.name] = F.col(field.name).try_cast("timestamp")
        elif not isinstance(field.dataType, T.TimestampType):
            parsed[field.name] = F.col(field.name).cast("timestamp")
    return df.withColumns(parsed) if parsed else df


def clean_data(df: DataFrame) -> DataFrame:
    """Drop duplicates, fill missing values, then parse dates.

    The distinct rows are written once; gaps, medians and modes are read from them by column.

    Date texts are still texts when gaps are filled, so they get the most
    frequent text; columns that are dates already stay NULL.
    """
    rows = stored(drop_exact_duplicates(nan_to_null(df)), "distinct")
    return parse_date_columns(fill_missing(rows))
