"""Registered queries: inventory policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.normal import normal_quantile
from wharfline.operators import inventory
from wharfline.plans.order_queries import in_single, rounded
from wharfline.plans.registry import query
from wharfline.plans.sql_views import ITEMS, WIDE, with_view
from wharfline.sources import views

Z95 = f"{normal_quantile(0.95)!r}::DOUBLE"
DEVIATION = "sqrt(lead_time_mean * demand_std * demand_std + demand_mean * demand_mean * lead_time_std * lead_time_std)"
EOQ = "sqrt(2 * 365 * demand_mean * order_cost / holding_cost)"


@query(
    "item_parameters",
    with_view(
        ITEMS,
        """
SELECT item_id, round(demand_mean, 6) AS demand_mean, round(demand_std, 6) AS demand_std,
       round(lead_time_mean, 6) AS lead_time_mean, round(lead_time_std, 6) AS lead_time_std,
       round(holding_cost, 6) AS holding_cost, round(stockout_cost, 6) AS stockout_cost, order_cost
FROM items""",
    ),
)
def item_parameters(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(inventory.validate_items(views.item_parameters(spark, folder)), 6)


@query("economic_order_quantity", with_view(ITEMS, f"\nSELECT item_id, round({EOQ}, 6) AS eoq FROM items"))
def economic_order_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(inventory.calculate_eoq(views.item_parameters(spark, folder)), 6)


@query(
    "safety_stock",
    with_view(ITEMS, f"\nSELECT item_id, round({Z95} * {DEVIATION}, 4) AS safety_stock FROM items"),
)
def safety_stock(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(inventory.calculate_safety_stock(views.item_parameters(spark, folder)))


@query(
    "reorder_point",
    with_view(
        ITEMS,
        f"""
SELECT item_id, round(demand_mean * lead_time_mean + {Z95} * {DEVIATION}, 4) AS reorder_point FROM items""",
    ),
)
def reorder_point(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(inventory.calculate_reorder_point(views.item_parameters(spark, folder)))


@query(
    "reorder_point_by_item_level",
    with_view(
        ITEMS,
        f"""
SELECT item_id, round(demand_mean * lead_time_mean + CASE WHEN holding_cost >= 200
         THEN {normal_quantile(0.99)!r}::DOUBLE ELSE {normal_quantile(0.9)!r}::DOUBLE END * {DEVIATION}, 4) AS reorder_point
FROM items""",
    ),
)
def reorder_point_by_item_level(spark: SparkSession, folder: str) -> DataFrame:
    """A service level per row: dear items get 99 %, others 90 %."""
    level = F.when(F.col("holding_cost") >= 200, 0.99).otherwise(0.9)
    return rounded(inventory.calculate_reorder_point(views.item_parameters(spark, folder), level))


ABC = """,
valued AS (SELECT item_id, round(demand_mean, 6) AS demand_mean FROM items),
summed AS (
  SELECT item_id, demand_mean,
         sum(demand_mean) OVER (ORDER BY demand_mean DESC, item_id ROWS UNBOUNDED PRECEDING) AS cumulative_value,
         sum(demand_mean) OVER () AS total
  FROM valued
),
classed AS (
  SELECT item_id, demand_mean, round(cumulative_value, 6) AS cumulative_value,
         round(cumulative_value / total, 8) AS cumulative_percentage,
         CASE WHEN cumulative_value / total <= 0.8::DOUBLE THEN 'A'
              WHEN cumulative_value / total <= 0.95::DOUBLE THEN 'B' ELSE 'C' END AS abc_category
  FROM summed
)
"""


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    valued = views.item_parameters(spark, folder).select("item_id", F.round("demand_mean", 6).alias("demand_mean"))
    return inventory.abc_analysis(valued)


@query("abc_analysis", with_view(ITEMS, ABC + "SELECT * FROM classed"))
def abc_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_classified(spark, folder), 6, cumulative_percentage=8)


@query("abc_category_counts", with_view(ITEMS, ABC + "SELECT abc_category, count(*) AS items FROM classed GROUP BY 1"))
def abc_category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.category_counts(_classified(spark, folder))


COSTS = """
SELECT item_id, q::FLOAT::DOUBLE AS quantity, (365 * demand_mean / q * order_cost)::FLOAT::DOUBLE AS annual_ordering_cost,
       (q / 2 * holding_cost)::FLOAT::DOUBLE AS annual_holding_cost,
       (365 * demand_mean / q * order_cost + q / 2 * holding_cost)::FLOAT::DOUBLE AS total_cost
FROM priced"""


@query("total_costs", with_view(ITEMS, f",\npriced AS (SELECT *, {EOQ} AS q FROM items)" + COSTS))
def total_costs(spark: SparkSession, folder: str) -> DataFrame:
    return in_single(inventory.calculate_total_costs(views.item_parameters(spark, folder)))


@query(
    "total_costs_for_size",
    with_view(ITEMS, ",\npriced AS (SELECT items.*, p_size::DOUBLE AS q FROM items JOIN part ON item_id = 'P' || p_partkey)" + COSTS),
)
def total_costs_for_size(spark: SparkSession, folder: str) -> DataFrame:
    """Costs of ordering as many units at a time as the part's size."""
    sizes = views.table(spark, folder, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("item_id"), F.col("p_size").alias("quantity")
    )
    return in_single(inventory.calculate_total_costs(views.item_parameters(spark, folder), sizes))


@query(
    "demand_sensitivity",
    with_view(
        ITEMS,
        f""",
grid AS (
  SELECT item_id, step, demand_std, lead_time_mean, lead_time_std, holding_cost, order_cost,
         demand_mean * 0.7::DOUBLE + (demand_mean * 1.3::DOUBLE - demand_mean * 0.7::DOUBLE) * step / 9.0::DOUBLE AS demand_mean
  FROM items, generate_series(0, 9) AS g(step)
),
answered AS (SELECT *, {EOQ} AS q, {Z95} * {DEVIATION} AS safety FROM grid)
SELECT item_id, step::INT AS step, round(demand_mean, 6) AS parameter_value, round(q, 6) AS eoq,
       round(demand_mean * lead_time_mean + safety, 4) AS reorder_point, round(safety, 4) AS safety_stock,
       round(365 * demand_mean / q * order_cost + q / 2 * holding_cost, 4) AS total_cost
FROM answered""",
    ),
)
def demand_sensitivity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        inventory.sensitivity(views.item_parameters(spark, folder), "demand_mean"), 4, parameter_value=6, eoq=6
    )


@query(
    "policy_by_product",
    with_view(
        WIDE,
        f""",
stats AS (
  SELECT region, product, avg(demand) AS demand_mean, coalesce(stddev_samp(demand), 0::DOUBLE) AS demand_std,
         avg(lead_time) AS lead_time_mean, coalesce(stddev_samp(lead_time), 0::DOUBLE) AS lead_time_std
  FROM wide GROUP BY 1, 2
)
SELECT region, product, round(demand_mean, 6) AS demand_mean, round(demand_std, 6) AS demand_std,
       round(lead_time_mean, 6) AS lead_time_mean, round(lead_time_std, 6) AS lead_time_std,
       round({Z95} * {DEVIATION}, 4) AS safety_stock,
       round(demand_mean * lead_time_mean + {Z95} * {DEVIATION}, 4) AS reorder_point
FROM stats""",
    ),
)
def policy_by_product(spark: SparkSession, folder: str) -> DataFrame:
    policy = inventory.policy_from_rows(views.daily_wide(spark, folder), ["region", "product"])
    return rounded(policy, 6, safety_stock=4, reorder_point=4)
