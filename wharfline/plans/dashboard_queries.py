"""Registered queries: filters, joins, KPI cards, breakdowns, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.expressions import id_label, label_id
from wharfline.operators import aggregates as agg
from wharfline.operators import costs
from wharfline.operators import filters, inventory
from wharfline.operators.leadtimes import lead_time_days, supplier_performance
from wharfline.plans.order_queries import in_single, rounded
from wharfline.plans.registry import query
from wharfline.plans.sql_views import EDGES, FACTS, STAR, WIDE, with_view
from wharfline.sources import views

# The region names of the warehouse.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


COST_COLUMNS = ", ".join(
    f"{c}::FLOAT::DOUBLE AS {c}"
    for c in (
        "lead_time", "demand", "safety_stock", "reorder_point", "inventory_level", "shipping_cost", "holding_cost",
        "stockout_cost", "total_cost",
    )
)


@query(
    "cost_components",
    with_view(
        WIDE,
        f"""
SELECT date, region, product, supplier, {COST_COLUMNS}
FROM wide""",
    ),
)
def cost_components(spark: SparkSession, folder: str) -> DataFrame:
    wide = views.daily_wide(spark, folder).select(
        "date", "region", "product", "supplier", "lead_time", "demand", "safety_stock", "reorder_point",
        "inventory_level", "shipping_cost", "holding_cost", "stockout_cost", "total_cost",
    )
    return in_single(wide)


@query(
    "order_status_by_date",
    with_view(
        STAR,
        """
SELECT CASE WHEN ship_date IS NOT NULL THEN 'Delivered' WHEN order_date <= TIMESTAMP '1999-06-30' THEN 'In Transit'
            ELSE 'Pending' END AS status,
       count(*) AS count, round(sum(quantity * price_per_unit), 2) AS value
FROM star_orders GROUP BY 1""",
    ),
)
def order_status_by_date(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("1999-06-30").cast("timestamp")
    orders = views.star_orders(spark, folder).withColumn("status", costs.order_status("ship_date", "order_date", as_of))
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.sum(costs.order_value()), 2).alias("value")
    )


@query(
    "shipment_status",
    with_view(
        STAR,
        """
SELECT carrier, CASE WHEN delivery_date <= TIMESTAMP '1999-06-30' THEN 'Delivered' ELSE 'In Transit' END AS status,
       count(*) AS count
FROM star_shipments GROUP BY 1, 2""",
    ),
)
def shipment_status(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("1999-06-30").cast("timestamp")
    shipments = views.star_shipments(spark, folder)
    return agg.counts_by(
        shipments.withColumn("status", costs.shipment_status("delivery_date", as_of)), "carrier", "status"
    )


@query(
    "mapped_priority_delays",
    """
SELECT o_orderkey AS order_id, o_orderdate::DATE + CASE o_orderpriority
         WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4 WHEN '5-LOW' THEN 7 ELSE 5 END AS promised,
       greatest(CASE o_orderpriority
         WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4 WHEN '5-LOW' THEN 7 ELSE 5 END - 2, 1)
         AS working_days
FROM orders""",
)
def mapped_priority_delays(spark: SparkSession, folder: str) -> DataFrame:
    """A lookup by key, a date shifted by it, and a value bounded from below."""
    from wharfline.functions.expressions import clamp, map_values

    # Days promised by priority.
    days = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 4, "5-LOW": 7}
    delay = map_values("o_orderpriority", days, default=5)
    return views.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_add(F.to_date("o_orderdate"), delay).alias("promised"),
        clamp(delay - 2, low=1).alias("working_days"),
    )


@query(
    "renamed_stock_columns",
    with_view(
        WIDE,
        """
SELECT date AS ds, region, product AS sku, round(inventory_level, 6) AS on_hand, round(demand * 0.2::DOUBLE, 6) AS safety
FROM wide""",
    ),
)
def renamed_stock_columns(spark: SparkSession, folder: str) -> DataFrame:
    wide = views.daily_wide(spark, folder)
    renamed = wide.select("date", "region", "product", "inventory_level", costs.quantity_share("demand").alias("safety"))
    return rounded(renamed.withColumnsRenamed({"date": "ds", "product": "sku", "inventory_level": "on_hand"}), 6)


@query(
    "filtered_days",
    with_view(
        WIDE,
        """
SELECT date, region, product, round(lead_time, 6) AS lead_time, demand FROM wide
WHERE region = 'EUROPE' AND date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    ),
)
def filtered_days(spark: SparkSession, folder: str) -> DataFrame:
    wide = views.daily_wide(spark, folder).select("date", "region", "product", "lead_time", "demand")
    chosen = filters.dashboard_filter(wide, region="EUROPE", product="All", start="1996-01-01", end="1997-12-31")
    return rounded(chosen, 6)


STAR_CHOICE = """,
picked AS (SELECT * FROM star_orders WHERE region = 'ASIA' AND supplier_id = 7),
moved AS (SELECT * FROM star_shipments WHERE order_id IN (SELECT order_id FROM picked))
"""


@query(
    "filtered_star_tables",
    with_view(
        STAR,
        STAR_CHOICE
        + """
SELECT 'orders' AS source, count(*) AS rows, round(sum(quantity), 4) AS total FROM picked
UNION ALL
SELECT 'inventory', count(*), round(sum(quantity), 4) FROM star_inventory WHERE region = 'ASIA'
UNION ALL
SELECT 'shipments', count(*), round(sum(shipping_cost), 4) FROM moved""",
    ),
)
def filtered_star_tables(spark: SparkSession, folder: str) -> DataFrame:
    orders, stock, moved = filters.star_filter(
        views.star_orders(spark, folder),
        views.star_inventory(spark, folder),
        views.star_shipments(spark, folder),
        region="ASIA",
        supplier="7 - Supplier#000000007",
    )

    def line(df: DataFrame, name: str, value: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows"), F.round(F.sum(value), 4).alias("total")
        )

    return (
        line(orders, "orders", "quantity")
        .unionByName(line(stock, "inventory", "quantity"))
        .unionByName(line(moved, "shipments", "shipping_cost"))
    )


@query(
    "shipments_of_region",
    with_view(
        STAR,
        """
SELECT order_id, ship_date, delivery_date, carrier, round(shipping_cost, 4) AS shipping_cost
FROM star_shipments WHERE order_id IN (SELECT order_id FROM star_orders WHERE region = 'AFRICA')""",
    ),
)
def shipments_of_region(spark: SparkSession, folder: str) -> DataFrame:
    _, _, moved = filters.star_filter(
        views.star_orders(spark, folder),
        views.star_inventory(spark, folder),
        views.star_shipments(spark, folder),
        region="AFRICA",
    )
    return rounded(moved)


@query(
    "last_ninety_days",
    with_view(
        WIDE,
        """
SELECT date, region, product, demand FROM wide
WHERE date >= (SELECT max(date) FROM wide) - INTERVAL 90 DAY""",
    ),
)
def last_ninety_days(spark: SparkSession, folder: str) -> DataFrame:
    days = views.daily_wide(spark, folder).select("date", "region", "product", "demand")
    return filters.last_days(days)


@query(
    "latest_stock",
    with_view(
        WIDE,
        """
SELECT date, region, product, round(inventory_level, 6) AS inventory_level FROM wide
WHERE date = (SELECT max(date) FROM wide)""",
    ),
)
def latest_stock(spark: SparkSession, folder: str) -> DataFrame:
    days = views.daily_wide(spark, folder).select("date", "region", "product", "inventory_level")
    return rounded(filters.latest_slice(days), 6)


@query(
    "shipped_orders",
    with_view(STAR, "\nSELECT order_id, product, supplier_id, ship_date FROM star_orders WHERE ship_date IS NOT NULL"),
)
def shipped_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = views.star_orders(spark, folder).select("order_id", "product", "supplier_id", "ship_date")
    return filters.present(orders, "ship_date")


@query(
    "first_five_products",
    with_view(
        WIDE,
        """
SELECT date, region, product, round(inventory_level, 6) AS inventory_level, round(reorder_point, 6) AS reorder_point
FROM wide WHERE product IN (
  SELECT product FROM (SELECT product, min((date, region)) AS first FROM wide GROUP BY 1)
  ORDER BY first, product LIMIT 5)""",
    ),
)
def first_five_products(spark: SparkSession, folder: str) -> DataFrame:
    wide = views.daily_wide(spark, folder).select("date", "region", "product", "inventory_level", "reorder_point")
    return rounded(filters.first_products(wide, 5, order=["date", "region"]), 6)


@query(
    "train_test_days",
    with_view(
        FACTS,
        """,
days AS (SELECT region, CAST(order_date AS DATE) AS ds, sum(quantity) AS y FROM facts GROUP BY 1, 2),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY ds) AS rn, count(*) OVER (PARTITION BY region) AS n FROM days
)
SELECT region, ds, y, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM placed""",
    ),
)
def train_test_days(spark: SparkSession, folder: str) -> DataFrame:
    return filters.position_split(views.daily_demand(spark, folder), ["region"], ["ds"])


@query(
    "supplier_options",
    "SELECT DISTINCT s_suppkey || ' - ' || s_name AS label, s_suppkey AS supplier_id FROM supplier",
)
def supplier_options(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = views.star_suppliers(spark, folder)
    labels = filters.options(
        suppliers.withColumn("label", id_label("supplier_id", "supplier_name")), "label"
    )
    return labels.withColumn("supplier_id", label_id("label"))


@query(
    "region_options",
    with_view(FACTS, "\nSELECT DISTINCT region FROM facts"),
)
def region_options(spark: SparkSession, folder: str) -> DataFrame:
    return filters.options(views.order_facts(spark, folder), "region")


CARDS = """
SELECT round(avg(lead_time), 6) AS avg_lead_time, round(avg(fulfillment_rate), 6) AS fulfillment_rate,
       round(avg(stockout_probability), 6) AS stockout_probability, round({total}, 2) AS total_cost
FROM wide"""


def _cards(spark: SparkSession, folder: str, total) -> DataFrame:
    chosen = filters.dashboard_filter(views.daily_wide(spark, folder), region="All")
    return rounded(agg.kpi_cards(chosen, total), 6, total_cost=2)


@query("kpi_cards_price_total", with_view(WIDE, CARDS.format(total="sum(unit_cost)")))
def kpi_cards_price_total(spark: SparkSession, folder: str) -> DataFrame:
    return _cards(spark, folder, F.sum("unit_cost"))


@query("kpi_cards_cost_total", with_view(WIDE, CARDS.format(total="sum(total_cost)")))
def kpi_cards_cost_total(spark: SparkSession, folder: str) -> DataFrame:
    return _cards(spark, folder, F.sum("total_cost"))


@query("kpi_cards_mean_cost", with_view(WIDE, CARDS.format(total="avg(total_cost)")))
def kpi_cards_mean_cost(spark: SparkSession, folder: str) -> DataFrame:
    return _cards(spark, folder, F.avg("total_cost"))


@query(
    "kpi_deltas",
    with_view(
        WIDE,
        """,
part AS (
  SELECT avg(lead_time) AS l, avg(fulfillment_rate) AS f, avg(stockout_probability) AS s, sum(total_cost) AS t
  FROM wide WHERE region = 'ASIA'
),
everything AS (
  SELECT avg(lead_time) AS l, avg(fulfillment_rate) AS f, avg(stockout_probability) AS s, sum(total_cost) AS t FROM wide
)
SELECT round(part.l, 6) AS lead_time, round(part.l - everything.l, 6) AS lead_time_delta,
       round(part.f, 6) AS fulfillment_rate, round(part.f - everything.f, 6) AS fulfillment_rate_delta,
       round(part.s, 6) AS stockout_probability, round(part.s - everything.s, 6) AS stockout_probability_delta,
       round(part.t, 2) AS total_cost, round(part.t - everything.t, 2) AS total_cost_delta
FROM part, everything""",
    ),
)
def kpi_deltas(spark: SparkSession, folder: str) -> DataFrame:
    deltas = agg.kpi_deltas(views.daily_wide(spark, folder), F.col("region") == "ASIA")
    return rounded(deltas, 6, total_cost=2, total_cost_delta=2)


@query(
    "business_kpis",
    with_view(
        STAR,
        """,
o AS (
  SELECT count(*) AS n, sum(quantity * price_per_unit) AS revenue, count(ship_date) AS shipped,
         count(*) FILTER (ship_date <= due_date) AS on_time, count(*) FILTER (status = 'Delivered') AS delivered,
         sum(quantity) AS q, date_diff('day', min(order_date), max(order_date)) AS days
  FROM star_orders
),
d AS (SELECT date, sum(quantity) AS q FROM star_inventory GROUP BY 1),
i AS (SELECT avg(q) AS mean, date_diff('day', min(date), max(date)) AS days FROM d),
s AS (
  SELECT avg(floor((epoch_us(delivery_date) - epoch_us(ship_date)) / 86400000000)) AS lead FROM star_shipments
)
SELECT o.n AS total_orders, round(o.revenue, 2) AS total_revenue, round(100.0 * on_time / shipped, 6) AS on_time_delivery_rate,
       round(100.0 * delivered / o.n, 6) AS order_fulfillment_rate,
       round(o.q / i.mean * 365 / i.days, 6) AS inventory_turnover,
       round(i.mean / (o.q / o.days), 6) AS days_of_supply, round(s.lead, 6) AS avg_lead_time
FROM o, i, s""",
    ),
)
def business_kpis(spark: SparkSession, folder: str) -> DataFrame:
    kpis = agg.business_kpis(
        views.star_orders(spark, folder), views.star_inventory(spark, folder), views.star_shipments(spark, folder)
    )
    return rounded(kpis, 6, total_revenue=2)


@query(
    "status_counts",
    with_view(STAR, "\nSELECT status, count(*) AS count FROM star_orders GROUP BY 1"),
)
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return agg.counts_by(views.star_orders(spark, folder), "status")


@query(
    "orders_per_day",
    with_view(STAR, "\nSELECT order_date, count(*) AS count FROM star_orders GROUP BY 1"),
)
def orders_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return agg.counts_by(views.star_orders(spark, folder), "order_date").orderBy("order_date")


@query(
    "order_value_by_region",
    with_view(STAR, "\nSELECT region, round(sum(quantity * price_per_unit), 2) AS value FROM star_orders GROUP BY 1"),
)
def order_value_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(agg.sum_by(views.star_orders(spark, folder), ["region"], costs.order_value(), "value"), 2)


@query(
    "order_value_by_product",
    with_view(STAR, "\nSELECT product, round(sum(quantity * price_per_unit), 2) AS value FROM star_orders GROUP BY 1"),
)
def order_value_by_product(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(agg.sum_by(views.star_orders(spark, folder), ["product"], costs.order_value(), "value"), 2)


@query(
    "stock_over_time",
    with_view(STAR, "\nSELECT date, round(sum(quantity), 4) AS quantity FROM star_inventory GROUP BY 1"),
)
def stock_over_time(spark: SparkSession, folder: str) -> DataFrame:
    stock = views.star_inventory(spark, folder).withColumn("date", F.to_date("date"))
    return rounded(agg.sum_by(stock, ["date"], "quantity", "quantity"))


LATEST = """
SELECT {key}, round(sum(quantity), 4) AS quantity FROM star_inventory
WHERE date = (SELECT max(date) FROM star_inventory) GROUP BY 1"""


@query("latest_stock_by_product", with_view(STAR, LATEST.format(key="product")))
def latest_stock_by_product(spark: SparkSession, folder: str) -> DataFrame:
    latest = filters.latest_slice(views.star_inventory(spark, folder))
    return rounded(agg.sum_by(latest, ["product"], "quantity", "quantity"))


@query("latest_stock_by_region", with_view(STAR, LATEST.format(key="region")))
def latest_stock_by_region(spark: SparkSession, folder: str) -> DataFrame:
    latest = filters.latest_slice(views.star_inventory(spark, folder))
    return rounded(agg.sum_by(latest, ["region"], "quantity", "quantity"))


PIVOT = ", ".join(
    f"round(coalesce(sum(quantity) FILTER (region = '{r}'), 0), 4) AS \"{r}\"" for r in REGIONS
)


@query("stock_heatmap", with_view(STAR, f"\nSELECT product, {PIVOT} FROM star_inventory GROUP BY 1"))
def stock_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    regions = agg.pivot_values(views.table(spark, folder, "region"), "r_name")
    return rounded(agg.pivot_sum(views.star_inventory(spark, folder), "product", "region", "quantity", regions))


@query(
    "supplier_on_time",
    with_view(
        STAR,
        """,
performance AS (
  SELECT supplier_name, 100.0 * count(*) FILTER (ship_date <= due_date) / count(*) AS on_time_percentage
  FROM star_orders JOIN star_suppliers USING (supplier_id) WHERE ship_date IS NOT NULL GROUP BY 1
)
SELECT supplier_name, round(on_time_percentage, 6) AS on_time_percentage,
       round(reliability_score * 100, 6) AS reliability_score
FROM performance JOIN star_suppliers USING (supplier_name)""",
    ),
)
def supplier_on_time(spark: SparkSession, folder: str) -> DataFrame:
    """On-time percentage per supplier next to its reliability score."""
    performance = supplier_performance(views.star_orders(spark, folder), views.star_suppliers(spark, folder))
    return rounded(performance, 6)


@query(
    "supplier_quantity",
    with_view(
        STAR,
        """
SELECT supplier_name, sum(quantity) AS quantity FROM star_orders JOIN star_suppliers USING (supplier_id) GROUP BY 1""",
    ),
)
def supplier_quantity(spark: SparkSession, folder: str) -> DataFrame:
    # Sum per id before the join: far fewer rows meet the supplier table.
    per_id = agg.sum_by(views.star_orders(spark, folder), ["supplier_id"], "quantity", "quantity")
    names = views.star_suppliers(spark, folder).select("supplier_id", "supplier_name")
    return agg.sum_by(per_id.join(names, "supplier_id"), ["supplier_name"], "quantity", "quantity")


@query(
    "supplier_quadrants",
    with_view(
        WIDE,
        """,
means AS (SELECT supplier, avg(lead_time) AS lead_time, avg(fulfillment_rate) AS fulfillment_rate FROM wide GROUP BY 1),
middle AS (SELECT median(lead_time) AS mx, median(fulfillment_rate) AS my FROM means)
SELECT supplier, round(lead_time, 6) AS lead_time, round(fulfillment_rate, 6) AS fulfillment_rate,
       round(mx, 6) AS median_lead_time, round(my, 6) AS median_fulfillment_rate,
       CASE WHEN fulfillment_rate >= my THEN 'high' ELSE 'low' END || ' / ' ||
       CASE WHEN lead_time <= mx THEN 'fast' ELSE 'slow' END AS quadrant
FROM means, middle""",
    ),
)
def supplier_quadrants(spark: SparkSession, folder: str) -> DataFrame:
    wide = views.daily_wide(spark, folder)
    return rounded(agg.group_quadrants(wide, "supplier", "lead_time", "fulfillment_rate"), 6)


@query(
    "cost_breakdown",
    with_view(
        WIDE,
        """,
means AS (
  SELECT product, avg(shipping_cost) AS shipping_cost, avg(holding_cost) AS holding_cost,
         avg(stockout_cost) AS stockout_cost
  FROM wide GROUP BY 1
),
long AS (UNPIVOT means ON shipping_cost, holding_cost, stockout_cost INTO NAME cost_type VALUE cost)
SELECT product, cost_type, round(cost, 4) AS cost FROM long""",
    ),
)
def cost_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    wide = views.daily_wide(spark, folder)
    return rounded(agg.long_means(wide, "product", ["shipping_cost", "holding_cost", "stockout_cost"]))


@query(
    "cost_trend",
    with_view(WIDE, "\nSELECT date, product, avg(total_cost)::FLOAT::DOUBLE AS total_cost FROM wide GROUP BY 1, 2"),
)
def cost_trend(spark: SparkSession, folder: str) -> DataFrame:
    return in_single(agg.mean_by(views.daily_wide(spark, folder), ["date", "product"], "total_cost"))


@query(
    "daily_metric_mean",
    with_view(WIDE, "\nSELECT date, avg(inventory_level)::FLOAT::DOUBLE AS inventory_level FROM wide GROUP BY 1"),
)
def daily_metric_mean(spark: SparkSession, folder: str) -> DataFrame:
    return in_single(agg.mean_by(views.daily_wide(spark, folder), ["date"], "inventory_level"))


MONTHS = """,
sums AS (
  SELECT last_day(date) AS label, sum(shipping_cost) AS shipping_cost, sum(holding_cost) AS holding_cost,
         sum(stockout_cost) AS stockout_cost, sum(total_cost) AS total_cost
  FROM wide GROUP BY 1
),
spine AS (
  SELECT last_day(CAST(d AS DATE)) AS date
  FROM (SELECT unnest(generate_series(date_trunc('month', min(label)), date_trunc('month', max(label)),
                                      INTERVAL 1 MONTH)) AS d FROM sums)
)
SELECT date, round(coalesce(shipping_cost, 0), 4) AS shipping_cost, round(coalesce(holding_cost, 0), 2) AS holding_cost,
       round(coalesce(stockout_cost, 0), 2) AS stockout_cost, round(coalesce(total_cost, 0), 2) AS total_cost
FROM spine LEFT JOIN sums ON date = label"""


@query("monthly_costs", with_view(WIDE, MONTHS))
def monthly_costs(spark: SparkSession, folder: str) -> DataFrame:
    sums = agg.monthly_sums(views.daily_wide(spark, folder), "date", ["shipping_cost", "holding_cost", "stockout_cost", "total_cost"])
    return rounded(sums, 2, shipping_cost=4)


@query(
    "monthly_cost_model",
    with_view(
        WIDE,
        """,
f AS (
  SELECT facts.*, CASE WHEN return_flag = 'R' THEN 1.0::DOUBLE ELSE 0.0 END AS stockout FROM facts
),
sums AS (SELECT last_day(order_date) AS order_date, sum(price) AS price FROM f GROUP BY 1),
one AS (SELECT avg(lead_time) AS lead, sum(quantity) AS units, avg(stockout) AS stockout FROM f)
SELECT order_date, round(price, 4) AS unit_cost, round(price * 0.1::DOUBLE * lead / 5, 4) AS shipping_cost,
       round(price * 0.02::DOUBLE * units * 0.1::DOUBLE, 0) AS holding_cost,
       round(price * (units * stockout * 0.5::DOUBLE), -2) AS stockout_cost
FROM sums, one""",
    ),
)
def monthly_cost_model(spark: SparkSession, folder: str) -> DataFrame:
    facts = lead_time_days(views.order_facts(spark, folder)).withColumn(
        "stockout_probability", (F.col("return_flag") == "R").cast("double")
    )
    chosen = filters.dashboard_filter(facts, region="All", date="order_date")
    return rounded(agg.monthly_cost_model(chosen), 4, holding_cost=0, stockout_cost=-2)


@query(
    "lead_time_histogram",
    with_view(
        FACTS,
        """,
b AS (SELECT region, min(lead_time)::DOUBLE AS lo, max(lead_time)::DOUBLE AS hi FROM facts GROUP BY 1),
placed AS (
  SELECT region, lo, hi, least(CAST(floor((lead_time - lo) / (hi - lo) * 20) AS BIGINT), 19) AS bin
  FROM facts JOIN b USING (region)
)
SELECT region, bin, round(lo + (hi - lo) / 20 * bin, 6) AS bin_start, round(lo + (hi - lo) / 20 * (bin + 1), 6) AS bin_end,
       count(*) AS count
FROM placed GROUP BY region, bin, lo, hi""",
    ),
)
def lead_time_histogram(spark: SparkSession, folder: str) -> DataFrame:
    facts = lead_time_days(views.order_facts(spark, folder)).select("region", "lead_time")
    return rounded(agg.histogram(facts, "lead_time", 20, ["region"]), 6)


BOX = """,
q AS (
  SELECT {key} quantile_cont({value}, 0.25) AS q1, median({value}) AS median, quantile_cont({value}, 0.75) AS q3
  FROM {table} {group}
),
marked AS (
  SELECT {table}.*, q.*, {value} >= q1 - 1.5 * (q3 - q1) AND {value} <= q3 + 1.5 * (q3 - q1) AS inside
  FROM {table}, q {match}
)
SELECT {out} round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min({value}) FILTER (inside), 6) AS whisker_low, round(max({value}) FILTER (inside), 6) AS whisker_high,
       count(*) FILTER (NOT inside) AS outlier_count, count(*) AS count
FROM marked GROUP BY {out} q1, median, q3"""


@query(
    "supplier_lead_time_boxes",
    with_view(
        FACTS,
        BOX.format(
            key="supplier_id AS sid,", value="lead_time::DOUBLE", table="facts", group="GROUP BY 1",
            match="WHERE supplier_id = sid", out="supplier_id,",
        ),
    ),
)
def supplier_lead_time_boxes(spark: SparkSession, folder: str) -> DataFrame:
    facts = lead_time_days(views.order_facts(spark, folder)).select("supplier_id", "lead_time")
    return rounded(agg.box_statistics(facts, "lead_time", ["supplier_id"], "built_in"), 6)


@query(
    "price_box",
    with_view(FACTS, BOX.format(key="", value="price", table="facts", group="", match="", out="")),
)
def price_box(spark: SparkSession, folder: str) -> DataFrame:
    """Box statistics of a column with as many values as rows."""
    return rounded(agg.box_statistics(views.order_facts(spark, folder).select("price"), "price", method="banded"), 6)


@query(
    "lead_time_density",
    with_view(
        FACTS,
        """,
c AS (SELECT region, lead_time::DOUBLE AS v, count(*) AS n FROM facts GROUP BY 1, 2),
s AS (
  SELECT region, count(*) AS total, stddev_samp(lead_time) * pow(count(*), -0.2::DOUBLE) AS h,
         min(lead_time)::DOUBLE AS lo, max(lead_time)::DOUBLE AS hi
  FROM facts GROUP BY 1
),
grid AS (
  SELECT region, v, n, total, h, point, (lo - 3 * h) + ((hi + 3 * h) - (lo - 3 * h)) * point / 49.0::DOUBLE AS x
  FROM c JOIN s USING (region), generate_series(0, 49) AS g(point)
)
SELECT region, point::INT AS point, round(x, 6) AS x,
       round(sum(n * exp(-0.5::DOUBLE * ((x - v) / h) * ((x - v) / h))) / (total * h * sqrt(2 * pi())), 10) AS density
FROM grid GROUP BY region, point, x, total, h""",
    ),
)
def lead_time_density(spark: SparkSession, folder: str) -> DataFrame:
    facts = lead_time_days(views.order_facts(spark, folder)).select("region", "lead_time")
    return rounded(agg.density(facts, "lead_time", 50, ["region"]), 6, density=10)


@query("edge_weights", with_view(EDGES, "\nSELECT src, dst, weight FROM edges"))
def edge_weights(spark: SparkSession, folder: str) -> DataFrame:
    return agg.edge_weights(views.supply_edges(spark, folder), "src", "dst", "weight")


@query(
    "top_products_per_region",
    with_view(
        FACTS,
        """,
sums AS (SELECT region, product, sum(quantity) AS quantity FROM facts GROUP BY 1, 2)
SELECT region, product, quantity, row_number() OVER (PARTITION BY region ORDER BY quantity DESC, product)::INT AS rank
FROM sums QUALIFY rank <= 5""",
    ),
)
def top_products_per_region(spark: SparkSession, folder: str) -> DataFrame:
    sums = agg.sum_by(views.order_facts(spark, folder), ["region", "product"], "quantity", "quantity")
    return agg.top_n_per_group(sums, ["region"], [F.desc("quantity"), F.asc("product")], 5)


@query(
    "dashboard_order_quantity",
    with_view(
        WIDE,
        """
SELECT product, round_even(sqrt(2 * avg(demand) * 100 / (0.2::DOUBLE * avg(unit_cost))), 0) AS eoq,
       round_even(avg(reorder_point), 0) AS reorder_point, round_even(avg(safety_stock), 0) AS safety_stock,
       round(sum(holding_cost), 2) AS annual_holding_cost, round(sum(stockout_cost), 2) AS annual_stockout_cost
FROM wide GROUP BY 1""",
    ),
)
def dashboard_order_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(inventory.observed_policy(views.daily_wide(spark, folder), ["product"]), 2)
