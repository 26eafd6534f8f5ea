"""Inventory policy: order quantity, safety stock, reorder point, ABC classes, cost, sensitivity.

Every function takes the item table and returns one row per item, for all items
at once; ``item_id`` narrows it to one and is an error when absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions.expressions import linspace, ratio, require_columns, round_half_even
from wharfline.functions.normal import service_factor
from wharfline.functions.ordering import running_totals

# Required columns, columns that may be negative, days per year.
PARAMETERS = [
    "demand_mean", "demand_std", "lead_time_mean", "lead_time_std", "holding_cost", "stockout_cost", "order_cost",
]
MAY_BE_NEGATIVE = {"demand_mean", "demand_std"}
DAYS_PER_YEAR = 365


def validate_items(df: DataFrame) -> DataFrame:
    """The item table unchanged, or an error naming what is wrong with it; one aggregation."""
    require_columns(df, ["item_id", *PARAMETERS])
    for name in PARAMETERS:
        if not isinstance(df.schema[name].dataType, T.NumericType):
            raise ValueError(f"column '{name}' must contain numeric values")
    checked = [c for c in PARAMETERS if c not in MAY_BE_NEGATIVE]
    found = df.agg(*[F.max(F.col(c) < 0).alias(c) for c in checked]).first()
    negative = [c for c in checked if found[c]]
    if negative:
        raise ValueError(f"columns with negative values: {negative}")
    return df


def _narrowed(df: DataFrame, item_id: str | None) -> DataFrame:
    if item_id is None:
        return df
    one = df.where(F.col("item_id") == F.lit(item_id))
    if one.isEmpty():
        raise ValueError(f"item '{item_id}' not found")
    return one


def annual_demand() -> Column:
    return F.col("demand_mean") * DAYS_PER_YEAR


def order_quantity() -> Column:
    """Economic order quantity; NULL without holding cost or for negative demand."""
    square = ratio(annual_demand() * 2 * F.col("order_cost"), F.col("holding_cost"))
    return F.when(square >= 0, F.sqrt(square))


def lead_time_deviation() -> Column:
    """Deviation of the demand during the lead time, from varying demand and varying lead time."""
    demand_part = F.col("lead_time_mean") * F.col("demand_std") * F.col("demand_std")
    lead_part = F.col("demand_mean") * F.col("demand_mean") * F.col("lead_time_std") * F.col("lead_time_std")
    return F.sqrt(demand_part + lead_part)


def safety_stock(service_level: float | Column = 0.95) -> Column:
    return service_factor(service_level) * lead_time_deviation()


def reorder_point(service_level: float | Column = 0.95) -> Column:
    return F.col("demand_mean") * F.col("lead_time_mean") + safety_stock(service_level)


def cost_columns(quantity: Column) -> dict[str, Column]:
    """Yearly ordering, holding and total cost of ordering a quantity at a time."""
    ordering = ratio(annual_demand(), quantity) * F.col("order_cost")
    holding = quantity / 2 * F.col("holding_cost")
    return {"annual_ordering_cost": ordering, "annual_holding_cost": holding, "total_cost": ordering + holding}


def calculate_eoq(df: DataFrame, item_id: str | None = None) -> DataFrame:
    return _narrowed(df, item_id).select("item_id", order_quantity().alias("eoq"))


def calculate_safety_stock(
    df: DataFrame, service_level: float | Column = 0.95, item_id: str | None = None
) -> DataFrame:
    return _narrowed(df, item_id).select("item_id", safety_stock(service_level).alias("safety_stock"))


def calculate_reorder_point(
    df: DataFrame, service_level: float | Column = 0.95, item_id: str | None = None
) -> DataFrame:
    return _narrowed(df, item_id).select("item_id", reorder_point(service_level).alias("reorder_point"))


def abc_analysis(
    df: DataFrame, value: str = "demand_mean", a_limit: float = 0.8, b_limit: float = 0.95
) -> DataFrame:
    """Class A up to ``a_limit`` of the running value share, B up to ``b_limit``, else C.

    A first item that alone exceeds ``a_limit`` is not A. The running sum is taken
    slice by slice, largest value first and by item for equal values.
    """
    require_columns(df, ["item_id", value])
    if not 0 < a_limit < b_limit < 1:
        raise ValueError("limits must satisfy 0 < a_limit < b_limit < 1")
    summed = running_totals(
        df, [F.desc(value), F.asc("item_id")], value, "cumulative_value", "cumulative_percentage"
    )
    share = F.col("cumulative_percentage")
    return summed.withColumn(
        "abc_category", F.when(share <= a_limit, "A").when(share <= b_limit, "B").otherwise("C")
    )


def category_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("abc_category").agg(F.count(F.lit(1)).alias("items"))


def calculate_total_costs(df: DataFrame, quantities: DataFrame | None = None) -> DataFrame:
    """Yearly costs for given quantities ``(item_id, quantity)``, by default the economic ones.

    Items without a quantity are left out.
    """
    if quantities is None:
        priced = df.withColumn("quantity", order_quantity())
    else:
        priced = df.join(quantities.select("item_id", F.col("quantity").cast("double")), "item_id")
    return priced.withColumns(cost_columns(F.col("quantity"))).select(
        "item_id", "quantity", "annual_ordering_cost", "annual_holding_cost", "total_cost"
    )


def sensitivity(
    df: DataFrame,
    parameter: str,
    item_id: str | None = None,
    range_percent: float = 0.3,
    steps: int = 10,
    service_level: float = 0.95,
) -> DataFrame:
    """Vary one parameter around its value and report the policy at every step, for all items in one pass."""
    require_columns(df, [parameter])
    base = F.col(parameter)
    tried = linspace(base * (1 - range_percent), base * (1 + range_percent), steps)
    grid = _narrowed(df, item_id).select(
        *[c for c in df.columns if c != parameter], F.posexplode(tried).alias("step", parameter)
    )
    return (
        grid.withColumn("eoq", order_quantity())
        .withColumns(
            {
                "reorder_point": reorder_point(service_level),
                "safety_stock": safety_stock(service_level),
                **cost_columns(F.col("eoq")),
            }
        )
        .select(
            "item_id", "step", F.col(parameter).alias("parameter_value"), "eoq", "reorder_point", "safety_stock",
            "total_cost",
        )
    )


def policy_from_rows(
    df: DataFrame,
    keys: Sequence[str],
    demand: str = "demand",
    lead_time: str = "lead_time",
    service_level: float = 0.95,
) -> DataFrame:
    """Safety stock and reorder point per group from raw demand and lead-time rows."""
    aggregates = [
        F.avg(demand).alias("demand_mean"),
        F.coalesce(F.stddev_samp(demand), F.lit(0.0)).alias("demand_std"),
        F.avg(lead_time).alias("lead_time_mean"),
        F.coalesce(F.stddev_samp(lead_time), F.lit(0.0)).alias("lead_time_std"),
    ]
    stats = df.dropna(subset=list(keys)).groupBy(*keys).agg(*aggregates) if keys else df.agg(*aggregates)
    return stats.withColumns(
        {"safety_stock": safety_stock(service_level), "reorder_point": reorder_point(service_level)}
    )


# What one order costs, and the yearly holding share of a unit's cost.
ORDER_COST, HOLDING_SHARE = 100.0, 0.2


def observed_policy(
    df: DataFrame, keys: Sequence[str], demand: str = "demand", unit_cost: str = "unit_cost",
    order_cost: float = ORDER_COST, holding_share: float = HOLDING_SHARE,
) -> DataFrame:
    """Per group the whole order quantity, reorder point and safety stock, and what holding and stockouts have cost.

    The quantity comes from the group's mean demand and unit cost; a group without either has none.
    """
    quantity = F.sqrt(ratio(F.avg(demand) * 2 * order_cost, F.avg(unit_cost) * holding_share))
    return df.groupBy(*keys).agg(
        round_half_even(quantity).alias("eoq"),
        round_half_even(F.avg("reorder_point")).alias("reorder_point"),
        round_half_even(F.avg("safety_stock")).alias("safety_stock"),
        F.sum("holding_cost").alias("annual_holding_cost"),
        F.sum("stockout_cost").alias("annual_stockout_cost"),
    )
