"""Dataset catalog entries, built by profiling DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions.expressions import has_all_tags
from wharfline.operators.quality import profile
from wharfline.sources.files import save_dictionary


def infer_schema(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: ``row_count`` and ``columns`` with name, type, nullable, unique_count, and min/max of numbers as text."""
    column = F.struct(
        "position",
        F.col("column_name").alias("name"),
        F.col("data_type").alias("type"),
        (F.col("null_count") > 0).alias("nullable"),
        "unique_count",
        F.col("min").cast("string").alias("min"),
        F.col("max").cast("string").alias("max"),
    )
    return profile(df, approximate).agg(
        F.max("row_count").alias("row_count"), F.array_sort(F.collect_list(column)).alias("columns")
    )


def register_from_dataframe(
    df: DataFrame,
    dataset_id: str,
    name: str,
    description: str,
    location: str,
    tags: Sequence[str] = (),
    metadata: dict[str, str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """One catalog row for a dataset."""
    pairs = [F.lit(x) for item in (metadata or {}).items() for x in item]
    return infer_schema(df, approximate).select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(name).alias("name"),
        F.lit(description).alias("description"),
        F.lit(location).alias("location"),
        F.array(*[F.lit(t) for t in tags]).cast("array<string>").alias("tags"),
        (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>").alias("metadata"),
        F.struct("row_count", "columns").alias("schema"),
    )


def list_datasets(entries: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """Entries that carry every wanted tag."""
    return entries.where(has_all_tags("tags", tags))


def data_dictionary(entries: DataFrame, path: str | None = None) -> DataFrame:
    """One row per column of every entry, written as csv where a path is given."""
    rows = entries.select(
        "dataset_id", F.col("name").alias("dataset_name"), "description", F.inline("schema.columns")
    ).select(
        "dataset_id",
        "dataset_name",
        F.col("name").alias("column_name"),
        F.col("type").alias("data_type"),
        "nullable",
        "unique_count",
        "min",
        "max",
        "description",
    )
    if path:
        save_dictionary(rows, path)
    return rows
