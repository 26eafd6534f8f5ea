"""The canonical views as SQL, to put in front of a check query."""

from __future__ import annotations

FACTS = """
facts AS (
  SELECT o_orderkey AS order_id, l_linenumber AS line_number, o_orderdate AS order_date,
         l_shipdate AS delivery_date, l_partkey AS product_id, p_brand AS product,
         l_suppkey AS supplier_id, o_custkey AS retailer_id, l_quantity AS quantity,
         l_extendedprice / l_quantity AS price, l_extendedprice AS line_value, r_name AS region,
         o_orderpriority AS priority,
         CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'In Transit' ELSE 'Pending' END AS status,
         l_returnflag AS return_flag, o_orderdate + INTERVAL 30 DAY AS due_date,
         CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000) AS BIGINT) AS lead_time
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

RAW = (
    FACTS
    + """,
raw_once AS (
  SELECT order_id, line_number, product_id, strftime(order_date, '%Y-%m-%d') AS order_date,
         CASE WHEN line_number <> 7 THEN strftime(delivery_date, '%Y-%m-%d') END AS delivery_date,
         nullif(quantity, 13.0) AS quantity, line_value, nullif(region, 'ASIA') AS region, return_flag
  FROM facts
),
raw AS (SELECT * FROM raw_once UNION ALL SELECT * FROM raw_once WHERE return_flag = 'R')"""
)

DEMAND = (
    FACTS
    + """,
demand AS (
  SELECT region, CAST(order_date AS DATE) AS ds, sum(quantity) AS y FROM facts GROUP BY 1, 2
)"""
)

EVENTS = """
series AS (
  SELECT event_type, CAST(ts AS DATE) AS ds, sum(value) AS y FROM events GROUP BY 1, 2
)"""

WIDE = (
    FACTS
    + """,
wide_base AS (
  SELECT CAST(order_date AS DATE) AS date, region, product, min(supplier_id) AS supplier,
         avg(greatest(lead_time, 1)) AS lead_time, sum(quantity) AS demand,
         avg(CASE WHEN status = 'Delivered' THEN 1.0::DOUBLE ELSE 0.0 END) AS fulfillment_rate,
         avg(CASE WHEN return_flag = 'R' THEN 1.0::DOUBLE ELSE 0.0 END) AS stockout_probability,
         avg(price) AS unit_cost
  FROM facts GROUP BY 1, 2, 3
),
wide_policy AS (
  SELECT *, demand * 0.2::DOUBLE AS safety_stock,
         demand * 0.2::DOUBLE + demand * lead_time / 30 AS reorder_point,
         (demand * 0.2::DOUBLE + demand * lead_time / 30) * 1.2::DOUBLE AS inventory_level
  FROM wide_base
),
wide_cost AS (
  SELECT *, unit_cost * 0.1::DOUBLE * lead_time / 5 AS shipping_cost,
         inventory_level * unit_cost * 0.02::DOUBLE AS holding_cost,
         demand * stockout_probability * unit_cost * 0.5::DOUBLE AS stockout_cost
  FROM wide_policy
),
wide AS (SELECT *, shipping_cost + holding_cost + stockout_cost AS total_cost FROM wide_cost)"""
)

STAR = (
    WIDE
    + """,
star_orders AS (
  SELECT order_id, order_date, product, region, supplier_id, quantity, price AS price_per_unit, due_date,
         CASE WHEN status <> 'Pending' THEN delivery_date END AS ship_date, status
  FROM facts
),
star_inventory AS (
  SELECT date, product, region, inventory_level AS quantity, reorder_point, demand * 2 AS reorder_quantity FROM wide
),
star_shipments AS (
  SELECT l_orderkey AS order_id, l_shipdate AS ship_date,
         l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS delivery_date,
         l_linestatus AS carrier, l_extendedprice * l_tax AS shipping_cost
  FROM lineitem
),
star_suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
         (s_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE AS reliability_score,
         CAST(s_nationkey AS BIGINT) AS lead_time_days, s_acctbal / 100.0::DOUBLE AS cost_per_unit
  FROM supplier
)"""
)

ITEMS = (
    FACTS
    + """,
item_days AS (
  SELECT product_id, order_date, sum(quantity) AS q FROM facts GROUP BY 1, 2
),
item_demand AS (
  SELECT product_id, avg(q) AS demand_mean, coalesce(stddev_samp(q), 0.0::DOUBLE) AS demand_std
  FROM item_days GROUP BY 1
),
item_lead AS (
  SELECT product_id, coalesce(avg(lead_time) FILTER (lead_time >= 0), 0.0::DOUBLE) AS lead_time_mean,
         coalesce(stddev_samp(lead_time) FILTER (lead_time >= 0), 0.0::DOUBLE) AS lead_time_std
  FROM facts GROUP BY 1
),
items AS (
  SELECT 'P' || product_id AS item_id, demand_mean, demand_std, lead_time_mean, lead_time_std,
         p_retailprice * 0.2::DOUBLE AS holding_cost, p_retailprice * 0.5::DOUBLE AS stockout_cost,
         100.0::DOUBLE AS order_cost
  FROM item_demand JOIN item_lead USING (product_id) JOIN part ON product_id = p_partkey
)"""
)

EDGES = (
    FACTS
    + """,
flows AS (
  SELECT 'S' || supplier_id AS s, 'N' || n_nationkey AS n, 'R' || region AS r, weight
  FROM (SELECT supplier_id, region, sum(quantity) AS weight FROM facts GROUP BY 1, 2)
  JOIN supplier ON supplier_id = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
flow_edges AS (
  SELECT s AS src, n AS dst, weight FROM flows UNION ALL SELECT n AS src, r AS dst, weight FROM flows
),
edges AS (SELECT src, dst, sum(weight) AS weight FROM flow_edges GROUP BY 1, 2)"""
)

LANES = """
lane_pairs AS (
  SELECT 'N' || s_nationkey AS src, 'N' || c_nationkey AS dst, sum(l_quantity) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey <> c_nationkey GROUP BY 1, 2
),
lanes AS (SELECT * FROM lane_pairs WHERE weight > (SELECT avg(weight) FROM lane_pairs))"""

# The same without the filter: every pair of nations that trade.
WHOLE_LANES = LANES.replace(" WHERE weight > (SELECT avg(weight) FROM lane_pairs)", "")


def with_view(view: str, body: str) -> str:
    """A statement over one of the views above; ``body`` may open with further ones after a comma."""
    return f"WITH {view.strip()}{body}"
