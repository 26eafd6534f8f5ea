"""Cost, policy and status columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions.expressions import ColumnLike, as_column

# Rates of the cost and policy formulas.
SHIPPING_RATE = 0.1
SHIPPING_DAYS = 5
HOLDING_RATE = 0.02
STOCKOUT_RATE = 0.5
SAFETY_RATE = 0.2
PERIOD_DAYS = 30


def policy_columns(df: DataFrame, demand: str = "demand", lead_time: str = "lead_time") -> DataFrame:
    """Safety stock as a share of demand, reorder point as safety plus lead-time demand."""
    safety = F.col(demand) * SAFETY_RATE
    return df.withColumns(
        {"safety_stock": safety, "reorder_point": safety + F.col(demand) * F.col(lead_time) / PERIOD_DAYS}
    )


def quantity_share(quantity: ColumnLike = "quantity") -> Column:
    """The simple policy: a fifth of the quantity for both safety stock and reorder point."""
    return as_column(quantity) * SAFETY_RATE


def cost_components(df: DataFrame) -> DataFrame:
    """Shipping, holding, stockout and total cost per row."""
    shipping = F.col("unit_cost") * SHIPPING_RATE * F.col("lead_time") / SHIPPING_DAYS
    holding = F.col("inventory_level") * F.col("unit_cost") * HOLDING_RATE
    stockout = F.col("demand") * F.col("stockout_probability") * F.col("unit_cost") * STOCKOUT_RATE
    return df.withColumns(
        {
            "shipping_cost": shipping,
            "holding_cost": holding,
            "stockout_cost": stockout,
            "total_cost": shipping + holding + stockout,
        }
    )


def order_value(quantity: ColumnLike = "quantity", price: ColumnLike = "price_per_unit") -> Column:
    return as_column(quantity) * as_column(price)


def order_status(ship_date: ColumnLike, order_date: ColumnLike, as_of: ColumnLike) -> Column:
    """Delivered once a ship date is known, in transit if ordered by the given day, else pending."""
    ordered = as_column(order_date) <= as_column(as_of)
    return F.when(as_column(ship_date).isNotNull(), "Delivered").when(ordered, "In Transit").otherwise("Pending")


def shipment_status(delivery_date: ColumnLike, as_of: ColumnLike) -> Column:
    """Delivered by the given day, else still in transit."""
    return F.when(as_column(delivery_date) <= as_column(as_of), "Delivered").otherwise("In Transit")
