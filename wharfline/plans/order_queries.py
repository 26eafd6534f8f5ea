"""Registered queries: cleaning, lead times, daily metrics, order features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.dates import boundary_flags, cyclical, date_parts, fiscal_year
from wharfline.operators.cleaning import clean_data, drop_exact_duplicates
from wharfline.operators.leadtimes import (
    aggregate_metrics,
    calculate_lead_times,
    calculate_order_statistics,
    lead_time_days,
    on_time_share,
)
from wharfline.plans.registry import query
from wharfline.plans.sql_views import FACTS, RAW, with_view
from wharfline.sources import views


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round double columns for comparison; ``special`` sets other digits by name."""
    return df.select(*[F.round(F.col(c), special.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def in_single(df: DataFrame) -> DataFrame:
    """Double columns to the about seven digits of single precision, for comparison of figures with decimal ties."""
    return df.select(*[F.col(c).cast("float").cast("double").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "monthly_region_lead_times",
    with_view(
        FACTS,
        """,
stats AS (SELECT region, avg(lead_time) AS m, stddev_samp(lead_time) AS s FROM facts GROUP BY 1),
scored AS (
  SELECT facts.*, CASE WHEN s > 0 THEN (lead_time - m) / s ELSE 0 END AS z FROM facts JOIN stats USING (region)
)
SELECT region, CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS line_count,
       round(avg(lead_time), 9) AS lead_time_mean, median(lead_time) AS lead_time_median,
       count(*) FILTER (lead_time < 0) AS error_count, count(*) FILTER (abs(z) > 2.5) AS anomaly_count,
       round(sum(quantity), 4) AS quantity_sum, round(sum(line_value), 2) AS value_sum
FROM scored GROUP BY 1, 2""",
    ),
)
def monthly_region_lead_times(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: lead times scored within their region, then summed up per region and month."""
    scored = calculate_lead_times(views.order_facts(spark, folder))
    return rounded(
        scored.groupBy("region", F.trunc("order_date", "month").alias("month")).agg(
            F.count(F.lit(1)).alias("line_count"),
            F.avg("lead_time").alias("lead_time_mean"),
            F.median("lead_time").alias("lead_time_median"),
            F.count_if("lead_time_error").alias("error_count"),
            F.count_if("lead_time_anomaly").alias("anomaly_count"),
            F.sum("quantity").alias("quantity_sum"),
            F.sum("line_value").alias("value_sum"),
        ),
        lead_time_mean=9,
        value_sum=2,
    )


@query(
    "distinct_order_lines",
    with_view(RAW, "\nSELECT DISTINCT * FROM raw"),
)
def distinct_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return drop_exact_duplicates(views.raw_orders(spark, folder))


@query(
    "clean_orders",
    with_view(
        RAW,
        """,
once AS (SELECT DISTINCT * FROM raw),
fills AS (
  SELECT (SELECT median(quantity) FROM once) AS q,
         (SELECT delivery_date FROM once WHERE delivery_date IS NOT NULL
          GROUP BY 1 ORDER BY count(*) DESC, delivery_date LIMIT 1) AS d,
         (SELECT region FROM once WHERE region IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, region LIMIT 1) AS r
)
SELECT order_id, line_number, product_id, CAST(order_date AS TIMESTAMP) AS order_date,
       CAST(coalesce(delivery_date, d, 'Unknown') AS TIMESTAMP) AS delivery_date,
       coalesce(quantity, q) AS quantity, line_value, coalesce(region, r, 'Unknown') AS region, return_flag
FROM once, fills""",
    ),
)
def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return clean_data(views.raw_orders(spark, folder))


@query(
    "lead_time_scores",
    with_view(
        FACTS,
        """,
stats AS (
  SELECT region, avg(lead_time) AS m, median(lead_time) AS med, stddev_samp(lead_time) AS s FROM facts GROUP BY 1
)
SELECT order_id, line_number, product_id, supplier_id, region, lead_time, lead_time < 0 AS lead_time_error,
       round(m, 4) AS mean, med AS median, round(s, 4) AS std,
       round(CASE WHEN s > 0 THEN (lead_time - m) / s ELSE 0 END, 6) + 0.0 AS lead_time_z_score,
       coalesce(abs(CASE WHEN s > 0 THEN (lead_time - m) / s ELSE 0 END) > 2.5, false) AS lead_time_anomaly
FROM facts JOIN stats USING (region)""",
    ),
)
def lead_time_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with its region's statistics, z-score and anomaly flag."""
    scored = calculate_lead_times(views.order_facts(spark, folder))
    return rounded(
        scored.select(
            "order_id", "line_number", "product_id", "supplier_id", "region", "lead_time", "lead_time_error",
            "mean", "median", "std", "lead_time_z_score", "lead_time_anomaly",
        ),
        lead_time_z_score=6,
    )


@query(
    "region_lead_time_statistics",
    with_view(
        FACTS,
        """
SELECT region, round(avg(lead_time), 6) AS mean, median(lead_time) AS median, round(stddev_samp(lead_time), 6) AS std
FROM facts GROUP BY 1""",
    ),
)
def region_lead_time_statistics(spark: SparkSession, folder: str) -> DataFrame:
    from wharfline.operators.leadtimes import group_statistics

    return rounded(group_statistics(lead_time_days(views.order_facts(spark, folder)), ["region"]), 6)


@query(
    "daily_metrics",
    with_view(
        FACTS,
        """
SELECT CAST(order_date AS DATE) AS order_date, round(avg(lead_time), 4) AS lead_time_mean,
       median(lead_time) AS lead_time_median, round(stddev_samp(lead_time), 4) AS lead_time_std,
       count(lead_time) AS lead_time_count, sum(quantity) AS quantity_sum, round(avg(quantity), 4) AS quantity_mean,
       round(sum(price), 4) AS price_sum, round(avg(price), 4) AS price_mean
FROM facts GROUP BY 1""",
    ),
)
def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(aggregate_metrics(lead_time_days(views.order_facts(spark, folder))))


@query(
    "daily_metrics_with_service",
    with_view(
        FACTS,
        """
SELECT CAST(order_date AS DATE) AS order_date, round(avg(lead_time), 4) AS lead_time_mean,
       median(lead_time) AS lead_time_median, round(stddev_samp(lead_time), 4) AS lead_time_std,
       count(lead_time) AS lead_time_count, sum(quantity) AS quantity_sum, round(avg(quantity), 4) AS quantity_mean,
       round(sum(price), 4) AS price_sum, round(avg(price), 4) AS price_mean,
       round(avg(CASE WHEN delivery_date <= due_date THEN 1 ELSE 0 END), 6) AS on_time_delivery_mean,
       round(avg(CASE WHEN status = 'Delivered' THEN 1 ELSE 0 END), 6) AS fulfillment_rate_mean,
       round(avg(CASE WHEN return_flag = 'R' THEN 1 ELSE 0 END), 6) AS stockout_probability_mean
FROM facts GROUP BY 1""",
    ),
)
def daily_metrics_with_service(spark: SparkSession, folder: str) -> DataFrame:
    facts = lead_time_days(views.order_facts(spark, folder)).withColumns(
        {
            "on_time_delivery": F.col("delivery_date") <= F.col("due_date"),
            "fulfillment_rate": F.col("status") == "Delivered",
            "stockout_probability": F.col("return_flag") == "R",
        }
    )
    extra = ["on_time_delivery", "fulfillment_rate", "stockout_probability"]
    as_numbers = facts.withColumns({c: F.col(c).cast("int") for c in extra})
    return rounded(aggregate_metrics(as_numbers, extra), **{f"{c}_mean": 6 for c in extra})


ORDER_STATISTICS = """
  SELECT {key}, count(order_id) AS order_count, sum(quantity) AS quantity_sum,
         round(avg(quantity), 4) AS quantity_mean, round(stddev_samp(quantity), 4) AS quantity_std,
         median(quantity) AS quantity_median, round(sum(price), 4) AS price_sum, round(avg(price), 4) AS price_mean,
         round(stddev_samp(price), 4) AS price_std, round(median(price), 8) AS price_median
  FROM facts GROUP BY ALL"""


@query("product_order_statistics", with_view(FACTS, ORDER_STATISTICS.format(key="product_id")))
def product_order_statistics(spark: SparkSession, folder: str) -> DataFrame:
    facts = views.order_facts(spark, folder).select("order_id", "product_id", "quantity", "price")
    return rounded(calculate_order_statistics(facts, join_back=False), price_median=8)


@query("region_priority_order_statistics", with_view(FACTS, ORDER_STATISTICS.format(key="region, priority")))
def region_priority_order_statistics(spark: SparkSession, folder: str) -> DataFrame:
    facts = views.order_facts(spark, folder).select("order_id", "region", "priority", "quantity", "price")
    return rounded(calculate_order_statistics(facts, keys=["region", "priority"], join_back=False), price_median=8)


@query(
    "order_lines_with_statistics",
    with_view(
        FACTS,
        f""",
stats AS ({ORDER_STATISTICS.format(key="product_id")})
SELECT order_id, facts.product_id, quantity, round(price, 8) AS price, stats.* EXCLUDE (product_id)
FROM facts JOIN stats ON facts.product_id = stats.product_id""",
    ),
)
def order_lines_with_statistics(spark: SparkSession, folder: str) -> DataFrame:
    facts = views.order_facts(spark, folder).select("order_id", "product_id", "quantity", "price")
    return rounded(calculate_order_statistics(facts), price=8, price_median=8)


@query(
    "order_date_features",
    """
SELECT o_orderkey AS order_id, year(o_orderdate)::INT AS order_date_year, month(o_orderdate)::INT AS order_date_month,
       day(o_orderdate)::INT AS order_date_day, (isodow(o_orderdate) - 1)::INT AS order_date_dayofweek,
       quarter(o_orderdate)::INT AS order_date_quarter, day(o_orderdate) = 1 AS order_date_is_month_start,
       CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS order_date_is_month_end,
       CAST(o_orderdate AS DATE) = last_day(o_orderdate) AND month(o_orderdate) % 3 = 0 AS order_date_is_quarter_end,
       round(sin(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS order_date_month_sin,
       round(cos(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS order_date_month_cos,
       round(sin(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) + 0.0 AS order_date_day_sin,
       round(cos(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) + 0.0 AS order_date_day_cos
FROM orders""",
)
def order_date_features(spark: SparkSession, folder: str) -> DataFrame:
    orders = views.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date")
    )
    features = (
        date_parts("order_date", "order_date")
        | boundary_flags("order_date", "order_date")
        | cyclical("order_date", "order_date")
    )
    return rounded(orders.withColumns(features).drop("order_date"), 6)


@query(
    "orders_by_fiscal_year",
    """
SELECT CASE WHEN month(o_orderdate) >= 4 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END::INT AS fiscal_year,
       CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END::INT AS us_fiscal_year,
       count(*) AS order_count, round(sum(o_totalprice), 2) AS value_sum
FROM orders GROUP BY 1, 2""",
)
def orders_by_fiscal_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = views.table(spark, folder, "orders")
    return orders.groupBy(
        fiscal_year("o_orderdate").alias("fiscal_year"),
        fiscal_year(F.date_format("o_orderdate", "yyyy-MM-dd"), 10).alias("us_fiscal_year"),
    ).agg(F.count(F.lit(1)).alias("order_count"), F.round(F.sum("o_totalprice"), 2).alias("value_sum"))


@query(
    "supplier_on_time_by_id",
    with_view(
        FACTS,
        """
SELECT supplier_id,
       round(100.0 * count(*) FILTER (delivery_date <= due_date) / count(*), 6) AS on_time_percentage
FROM facts WHERE status <> 'Pending' GROUP BY 1""",
    ),
)
def supplier_on_time_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(on_time_share(views.star_orders(spark, folder), ["supplier_id"], "ship_date", "due_date"), 6)
