"""The batch job from raw order lines to curated, partitioned parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions.dates import boundary_flags, date_parts
from wharfline.operators.cleaning import clean_data
from wharfline.operators.leadtimes import calculate_lead_times
from wharfline.sources.tables import write_zone


def curated(raw: DataFrame) -> DataFrame:
    """Clean rows with lead times, regional scores, date features and an order month."""
    # Statistics and rows both read the stored distinct rows that cleaning leaves behind.
    clean = clean_data(raw)
    scored = calculate_lead_times(clean).withColumnsRenamed(
        {"mean": "region_lead_time_mean", "median": "region_lead_time_median", "std": "region_lead_time_std"}
    )
    features = date_parts("order_date", "order_date") | boundary_flags("order_date", "order_date")
    return scored.withColumns(features).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))


def run(raw: DataFrame, target: str) -> DataFrame:
    """Write the curated zone, partitioned by order month, and return it as read back."""
    write_zone(curated(raw), target, ["order_month"])
    return raw.sparkSession.read.parquet(target)
