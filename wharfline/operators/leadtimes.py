"""Lead times, their regional statistics, and daily metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions.durable import stored
from wharfline.functions.expressions import elapsed_days, flag, ratio, require_columns
from wharfline.functions.joins import join_statistics
from wharfline.functions.quantiles import banded_quantiles, built_in_quantile, fits_one_state

ANOMALY_LIMIT = 2.5


def lead_time_days(df: DataFrame, start: str = "order_date", end: str = "delivery_date") -> DataFrame:
    """Add ``lead_time`` in whole days and ``lead_time_error`` for negative ones."""
    out = df.withColumn("lead_time", elapsed_days(start, end))
    return out.withColumn("lead_time_error", flag(F.col("lead_time") < 0))


def group_statistics(df: DataFrame, keys: Sequence[str], value: str = "lead_time") -> DataFrame:
    """Mean, median and sample deviation per group; no row for a missing key.

    The built-in median keeps one counter per distinct value and merges
    map-side. That is bounded for day counts; use ``exact_quantiles`` otherwise.
    """
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.median(value).alias("median"), F.stddev_samp(value).alias("std")
    )


def calculate_lead_times(df: DataFrame) -> DataFrame:
    """Lead time, error flag and, given a region, the z-score within it.

    A region may hold a third of all rows, so its statistics are aggregated and
    joined back instead of sorted in one window task. Rows without a region
    drop out, as in any inner join on it. The rows are not shuffled for that.
    """
    if not {"order_date", "delivery_date"} <= set(df.columns):
        return df
    out = lead_time_days(df)
    if "region" not in df.columns:
        return out
    scored = join_statistics(out, group_statistics(out, ["region"]), ["region"])
    # A missing lead time has a missing score; a group without spread scores 0.
    score = F.when(F.col("std") > 0, (F.col("lead_time") - F.col("mean")) / F.col("std")).otherwise(F.lit(0.0))
    return scored.withColumn("lead_time_z_score", score).withColumn(
        "lead_time_anomaly", flag(F.abs("lead_time_z_score") > ANOMALY_LIMIT)
    )


def aggregate_metrics(df: DataFrame, extra_means: Sequence[str] = ()) -> DataFrame:
    """Metrics per order day: lead time, quantity, price, and means of any further columns."""
    if "order_date" not in df.columns:
        return df.sparkSession.createDataFrame([], "order_date date")
    require_columns(df, ["lead_time", "quantity", "price", *extra_means])
    aggregates = [
        F.avg("lead_time").alias("lead_time_mean"),
        F.median("lead_time").alias("lead_time_median"),
        F.stddev_samp("lead_time").alias("lead_time_std"),
        F.count("lead_time").alias("lead_time_count"),
        F.sum("quantity").alias("quantity_sum"),
        F.avg("quantity").alias("quantity_mean"),
        F.sum("price").alias("price_sum"),
        F.avg("price").alias("price_mean"),
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in extra_means],
    ]
    dated = df.withColumn("order_date", F.to_date("order_date")).dropna(subset=["order_date"])
    return dated.groupBy("order_date").agg(*aggregates)


def calculate_order_statistics(
    df: DataFrame, order_id: str = "order_id", keys: Sequence[str] | None = None, join_back: bool = True
) -> DataFrame:
    """Order count, and sum, mean, deviation and median of quantity and price per group.

    The default group is the product; without one the input is unchanged.
    Absent measures are left out. ``join_back=False`` returns one row per group.
    """
    if keys is None:
        if "product_id" not in df.columns:
            return df
        keys = ["product_id"]
    keys = list(keys)
    measures = [c for c in ("quantity", "price") if c in df.columns]
    # Group sizes, statistics and medians read one narrow copy, so the rows behind them are built once for all three.
    grouped = stored(df.dropna(subset=keys).select(*dict.fromkeys([*keys, order_id, *measures])), "grouped")
    aggregates = [F.count(order_id).alias("order_count")]
    for c in measures:
        aggregates += [
            F.sum(c).alias(f"{c}_sum"),
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
        ]
    medians = {f"{c}_median": (c, 0.5) for c in measures}
    if fits_one_state(grouped, keys):
        aggregates += [built_in_quantile(c, p).alias(name) for name, (c, p) in medians.items()]
        medians = {}
    stats = grouped.groupBy(*keys).agg(*aggregates)
    if medians:
        stats = stats.join(banded_quantiles(grouped, keys, medians), keys, "left")
    return join_statistics(df, stats, keys) if join_back else stats


def on_time_share(df: DataFrame, keys: Sequence[str], done: str, due: str, name: str = "on_time_percentage") -> DataFrame:
    """Percentage finished by the due date among the rows that are finished."""
    finished = df.where(F.col(done).isNotNull())
    on_time = flag(F.col(done) <= F.col(due)).cast("int")
    return finished.groupBy(*keys).agg((ratio(F.sum(on_time), F.count(F.lit(1))) * 100).alias(name))


def supplier_performance(orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """On-time percentage of the shipped orders per supplier name, next to the reliability score in percent.

    Orders are counted per supplier id before the supplier table comes in.
    """
    shipped = orders.where(F.col("ship_date").isNotNull())
    per_id = shipped.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("ship_date") <= F.col("due_date")).alias("_on_time")
    )
    named = per_id.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
    share = named.groupBy("supplier_name").agg(
        (ratio(F.sum("_on_time"), F.sum("_n")) * 100).alias("on_time_percentage")
    )
    scores = suppliers.select("supplier_name", (F.col("reliability_score") * 100).alias("reliability_score"))
    return share.join(scores, "supplier_name")
