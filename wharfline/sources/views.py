"""The order, inventory, supplier and series tables, derived from the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.expressions import clamp, elapsed_days, map_values
from wharfline.session import tune
from wharfline.sources.schemas import WAREHOUSE

# Order status by the warehouse's status letter.
STATUS = {"F": "Delivered", "P": "In Transit", "O": "Pending"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A warehouse table; zone-less timestamps are read as UTC."""
    tune(spark)
    df = spark.read.schema(WAREHOUSE[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")
    zoneless = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def customer_regions(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("r_name").alias("region"))
    )


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line with its dates, product, supplier, customer and region."""
    orders = table(spark, folder, "orders").join(
        customer_regions(spark, folder), F.col("o_custkey") == F.col("c_custkey")
    )
    part = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("product"))
    return (
        table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("o_orderdate").alias("order_date"),
            F.col("l_shipdate").alias("delivery_date"),
            F.col("l_partkey").alias("product_id"),
            "product",
            F.col("l_suppkey").alias("supplier_id"),
            F.col("o_custkey").alias("retailer_id"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_extendedprice").alias("line_value"),
            "region",
            F.col("o_orderpriority").alias("priority"),
            map_values("o_orderstatus", STATUS).alias("status"),
            F.col("l_returnflag").alias("return_flag"),
            (F.col("o_orderdate") + F.expr("interval 30 days")).alias("due_date"),
        )
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as they arrive: date texts, gaps, and returned lines sent twice."""
    facts = order_facts(spark, folder).select(
        "order_id",
        "line_number",
        "product_id",
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        F.when(F.col("line_number") != 7, F.date_format("delivery_date", "yyyy-MM-dd")).alias("delivery_date"),
        F.nullif(F.col("quantity"), F.lit(13.0)).alias("quantity"),
        "line_value",
        F.nullif(F.col("region"), F.lit("ASIA")).alias("region"),
        "return_flag",
    )
    # Sent twice by a generated row: a union would join the tables twice.
    copies = F.when(F.col("return_flag") == "R", F.lit(2)).otherwise(F.lit(1))
    return facts.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def daily_demand(spark: SparkSession, folder: str, *keys: str) -> DataFrame:
    """Demand per order day and further keys (default region): the panel (keys, ds, y)."""
    keys = keys or ("region",)
    return (
        order_facts(spark, folder)
        .groupBy(*keys, F.to_date("order_date").alias("ds"))
        .agg(F.sum("quantity").alias("y"))
    )


def event_series(spark: SparkSession, folder: str) -> DataFrame:
    """Event value per day and event type: the panel (event_type, ds, y)."""
    return (
        table(spark, folder, "events")
        .groupBy("event_type", F.to_date("ts").alias("ds"))
        .agg(F.sum("value").alias("y"))
    )


def daily_wide(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order day, region and product with operating metrics and costs."""
    facts = order_facts(spark, folder).withColumn(
        "lead_days", clamp(elapsed_days("order_date", "delivery_date"), low=1)
    )
    base = facts.groupBy(F.to_date("order_date").alias("date"), "region", "product").agg(
        F.min("supplier_id").alias("supplier"),
        F.avg("lead_days").alias("lead_time"),
        F.sum("quantity").alias("demand"),
        F.avg((F.col("status") == "Delivered").cast("double")).alias("fulfillment_rate"),
        F.avg((F.col("return_flag") == "R").cast("double")).alias("stockout_probability"),
        F.avg("price").alias("unit_cost"),
    )
    from wharfline.operators.costs import cost_components, policy_columns

    return cost_components(
        policy_columns(base, demand="demand", lead_time="lead_time").withColumn(
            "inventory_level", F.col("reorder_point") * 1.2
        )
    )


def star_orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_facts(spark, folder).select(
        "order_id",
        "order_date",
        "product",
        "region",
        "supplier_id",
        "quantity",
        F.col("price").alias("price_per_unit"),
        "due_date",
        F.when(F.col("status") != "Pending", F.col("delivery_date")).alias("ship_date"),
        "status",
    )


def star_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return daily_wide(spark, folder).select(
        F.col("date").cast("timestamp").alias("date"),
        "product",
        "region",
        F.col("inventory_level").alias("quantity"),
        "reorder_point",
        (F.col("demand") * 2).alias("reorder_quantity"),
    )


def star_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments of all lines; delivery comes line-number days after shipping."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("ship_date"),
        F.timestamp_add("DAY", F.col("l_linenumber"), F.col("l_shipdate")).alias("delivery_date"),
        F.col("l_linestatus").alias("carrier"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("shipping_cost"),
    )


def star_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        ((F.col("s_acctbal") + 1000.0) / 11000.0).alias("reliability_score"),
        F.col("s_nationkey").cast("bigint").alias("lead_time_days"),
        (F.col("s_acctbal") / 100.0).alias("cost_per_unit"),
    )


def item_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """Demand, lead-time and cost parameters per product.

    Demand is summed per day first; lead times are the non-negative ones.
    """
    facts = order_facts(spark, folder).withColumn("lead_days", elapsed_days("order_date", "delivery_date"))
    daily = facts.groupBy("product_id", "order_date").agg(
        F.sum("quantity").alias("day_quantity"),
        F.count(F.when(F.col("lead_days") >= 0, 1)).alias("n"),
        F.sum(F.when(F.col("lead_days") >= 0, F.col("lead_days"))).alias("s1"),
        F.sum(F.when(F.col("lead_days") >= 0, F.col("lead_days") * F.col("lead_days"))).alias("s2"),
    )
    n, s1, s2 = F.sum("n"), F.sum("s1"), F.sum("s2")
    stats = daily.groupBy("product_id").agg(
        F.avg("day_quantity").alias("demand_mean"),
        F.coalesce(F.stddev_samp("day_quantity"), F.lit(0.0)).alias("demand_std"),
        F.coalesce(F.try_divide(s1, n), F.lit(0.0)).alias("lead_time_mean"),
        F.coalesce(
            F.when(n > 1, F.sqrt(F.greatest(s2 - F.try_divide(s1 * s1, n), F.lit(0.0)) / (n - 1))), F.lit(0.0)
        ).alias("lead_time_std"),
    )
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    return stats.join(part, F.col("product_id") == F.col("p_partkey")).select(
        F.concat(F.lit("P"), F.col("product_id").cast("string")).alias("item_id"),
        "demand_mean",
        "demand_std",
        "lead_time_mean",
        "lead_time_std",
        (F.col("p_retailprice") * 0.2).alias("holding_cost"),
        (F.col("p_retailprice") * 0.5).alias("stockout_cost"),
        F.lit(100.0).alias("order_cost"),
    )


def supply_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier -> supplier nation -> customer region, weighted by quantity; one row per pair and leg."""
    facts = order_facts(spark, folder).groupBy("supplier_id", "region").agg(F.sum("quantity").alias("weight"))
    supplier = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    flows = facts.join(supplier, F.col("supplier_id") == F.col("s_suppkey")).select(
        F.concat(F.lit("S"), F.col("supplier_id").cast("string")).alias("s"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("n"),
        F.concat(F.lit("R"), F.col("region")).alias("r"),
        "weight",
    )
    legs = F.array(
        F.struct(F.col("s").alias("src"), F.col("n").alias("dst")),
        F.struct(F.col("n").alias("src"), F.col("r").alias("dst")),
    )
    return flows.select(F.inline(legs), "weight").select("src", "dst", "weight")


def trade_lanes(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier nation -> customer nation with the quantity sold, all pairs of two nations."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    # Sum per supplier and customer nation before the supplier table comes in.
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    per_pair = (
        lines.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("l_suppkey", "c_nationkey")
        .agg(F.sum("l_quantity").alias("q"))
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    pairs = (
        per_pair.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .where(F.col("s_nationkey") != F.col("c_nationkey"))
        .groupBy(
            F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("src"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("dst"),
        )
        .agg(F.sum("q").alias("weight"))
    )
    return pairs


def busy_lanes(lanes: DataFrame) -> DataFrame:
    """The lanes heavier than the mean of all."""
    return lanes.where(F.col("weight") > lanes.agg(F.avg("weight")).scalar())
