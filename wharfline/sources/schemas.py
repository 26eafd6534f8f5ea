"""Declared table schemas."""

from __future__ import annotations

# The column contracts of the input tables.
ORDERS_MINIMUM = (
    "order_id bigint, order_date timestamp, delivery_date timestamp, product_id bigint, "
    "quantity double, price double, region string"
)
PRODUCTS = "product_id string, product_name string, category string, price double, weight double"
SUPPLIERS = (
    "supplier_id string, supplier_name string, country string, reliability_score double, lead_time_days bigint"
)
ORDERS = (
    "order_id string, product_id string, supplier_id string, quantity bigint, order_date timestamp, "
    "expected_delivery timestamp, actual_delivery timestamp, status string"
)
INVENTORY = (
    "inventory_id string, product_id string, warehouse_id string, quantity bigint, reorder_level bigint, "
    "last_restock_date timestamp"
)
ITEM_PARAMETERS = (
    "item_id string, demand_mean double, demand_std double, lead_time_mean double, lead_time_std double, "
    "holding_cost double, stockout_cost double, order_cost double"
)
STAR_ORDERS = (
    "order_id bigint, order_date timestamp, product string, region string, supplier_id bigint, quantity double, "
    "price_per_unit double, due_date timestamp, ship_date timestamp, status string"
)
STAR_INVENTORY = (
    "date timestamp, product string, region string, quantity double, reorder_point double, reorder_quantity double"
)
STAR_SHIPMENTS = (
    "shipment_id bigint, order_id bigint, ship_date timestamp, delivery_date timestamp, carrier string, "
    "status string, tracking_number string, shipping_cost double"
)
STAR_SUPPLIERS = (
    "supplier_id bigint, supplier_name string, reliability_score double, lead_time_days bigint, cost_per_unit double"
)

# The warehouse tables, read without inferring their schemas.
WAREHOUSE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
