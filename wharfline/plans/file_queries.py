"""Registered queries: readers, writers, tables, the curation job, the file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions.dates import grid_dates
from wharfline.functions.durable import scratch_path
from wharfline.plans import curation
from wharfline.plans.order_queries import rounded
from wharfline.plans.registry import query
from wharfline.plans.sql_views import RAW, STAR, with_view
from wharfline.sources import files, schemas, tables, views
from wharfline.streaming import file_cleaner


@query("csv_round_trip", "SELECT * FROM orders")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = files.save_data(views.table(spark, folder, "orders"), scratch_path(spark, "orders") + ".csv")
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string"
    )
    return files.load_data(spark, path, schema)


@query("json_round_trip", "SELECT * FROM part")
def json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    part = views.table(spark, folder, "part")
    path = files.save_data(part, scratch_path(spark, "part") + ".json")
    return files.load_data(spark, path, part.schema, records_array=False)


@query("parquet_round_trip", "SELECT * FROM customer")
def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = files.save_data(views.table(spark, folder, "customer"), scratch_path(spark, "customer") + ".parquet")
    files.load_dataset(spark, path)
    return spark.table(files.view_name(path))


@query(
    "star_tables_from_csv",
    with_view(
        STAR,
        """
SELECT region, count(*) AS orders, round(sum(quantity), 4) AS quantity, count(ship_date) AS shipped,
       min(order_date) AS first_order, max(due_date) AS last_due
FROM star_orders GROUP BY 1""",
    ),
)
def star_tables_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The order table written as csv and read back with a declared schema."""
    base = scratch_path(spark, "star")
    files.save_data(views.star_orders(spark, folder), f"{base}/orders.csv")
    loaded = files.load_tables(spark, base, {"orders": schemas.STAR_ORDERS})
    return loaded["orders"].groupBy("region").agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("quantity"), 4).alias("quantity"),
        F.count("ship_date").alias("shipped"),
        F.min("order_date").alias("first_order"),
        F.max("due_date").alias("last_due"),
    )


@query(
    "all_star_tables_from_csv",
    with_view(
        STAR,
        """
SELECT 'orders' AS name, count(*) AS rows, round(sum(quantity), 4) AS total, max(due_date)::DATE AS latest FROM star_orders
UNION ALL SELECT 'inventory', count(*), round(sum(quantity), 4), max(date)::DATE FROM star_inventory
UNION ALL SELECT 'shipments', count(*), round(sum(shipping_cost), 4), max(delivery_date)::DATE FROM star_shipments
UNION ALL SELECT 'suppliers', count(*), round(sum(lead_time_days), 4), NULL FROM star_suppliers""",
    ),
)
def all_star_tables_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The four star tables written as csv and read back together, dates included."""
    base = scratch_path(spark, "star")
    made = {"orders": views.star_orders, "inventory": views.star_inventory, "shipments": views.star_shipments, "suppliers": views.star_suppliers}
    declared = {
        "orders": schemas.STAR_ORDERS, "inventory": schemas.STAR_INVENTORY, "shipments": schemas.STAR_SHIPMENTS,
        "suppliers": schemas.STAR_SUPPLIERS,
    }
    for name, view in made.items():
        rows, columns = view(spark, folder), T.StructType.fromDDL(declared[name])
        given = [(F.col(c.name) if c.name in rows.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in columns]
        files.save_data(rows.select(*given), f"{base}/{name}.csv")
    loaded = files.load_tables(spark, base, declared)
    figures = {
        "orders": ("quantity", "due_date"), "inventory": ("quantity", "date"), "shipments": ("shipping_cost", "delivery_date"),
        "suppliers": ("lead_time_days", None),
    }
    out = None
    for name, (total, latest) in figures.items():
        part = loaded[name].agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col(total).cast("double")), 4).alias("total"),
            F.max(F.col(latest).cast("date") if latest else F.lit(None).cast("date")).alias("latest"),
        )
        out = part if out is None else out.union(part)
    return out


@query(
    "discovered_datasets",
    """
SELECT 'nation' AS dataset, count(*) AS rows FROM nation UNION ALL SELECT 'region', count(*) FROM region
UNION ALL SELECT 'supplier', count(*) FROM supplier""",
)
def discovered_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Every csv of a folder as a dataset of its own, told apart by file."""
    base = scratch_path(spark, "zone")
    for name in ("nation", "region", "supplier"):
        files.save_data(views.table(spark, folder, name), f"{base}/{name}.csv")
    listed = files.discover(spark, base).select("dataset").distinct()
    rows = files.read_folder(spark, base, "first_column string").groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(rows, "dataset").select("dataset", "rows")


@query(
    "registered_zone",
    """
SELECT year(o_orderdate)::INT AS order_year, count(*) AS orders, round(sum(o_totalprice), 2) AS value
FROM orders GROUP BY 1""",
)
def registered_zone(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written by year, registered as a partitioned table, and queried through it."""
    orders = views.table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate"))
    path = tables.write_zone(orders, scratch_path(spark, "orders_zone"), ["order_year"])
    zone = tables.register_zone(spark, f"wharfline_orders_{path[-32:]}", path, ["order_year"])
    return zone.groupBy("order_year").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value")
    )


@query(
    "crawled_zone",
    """
SELECT year(o_orderdate)::INT AS order_year, count(*) AS orders, round(sum(o_totalprice), 2) AS value,
       count(*) FILTER (year(o_orderdate) >= 1998 AND o_orderpriority = '1-URGENT') AS urgent
FROM orders GROUP BY 1""",
)
def crawled_zone(spark: SparkSession, folder: str) -> DataFrame:
    """Orders registered up to 1997; later years come with one more column, and the same table takes both up."""
    orders = views.table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate"))
    early, late = orders.where("order_year < 1998"), orders.where("order_year >= 1998 OR order_year IS NULL")
    path = tables.write_zone(early, scratch_path(spark, "crawled_zone"), ["order_year"])
    name = f"wharfline_crawled_{path[-32:]}"
    tables.register_zone(spark, name, path, ["order_year"])
    marked = late.withColumn("urgent", F.col("o_orderpriority") == "1-URGENT")
    marked.hint("rebalance", "order_year").write.mode("append").partitionBy("order_year").parquet(path)
    zone = tables.register_zone(spark, name, path, ["order_year"], merge_schemas=True)
    return zone.groupBy("order_year").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"), F.count_if("urgent").alias("urgent")
    )


CLEAN = """,
once AS (SELECT DISTINCT * FROM raw),
fills AS (
  SELECT (SELECT median(quantity) FROM once) AS q,
         (SELECT delivery_date FROM once WHERE delivery_date IS NOT NULL
          GROUP BY 1 ORDER BY count(*) DESC, delivery_date LIMIT 1) AS d,
         (SELECT region FROM once WHERE region IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, region LIMIT 1) AS r
),
clean AS (
  SELECT CAST(order_date AS TIMESTAMP) AS order_date, coalesce(quantity, q) AS quantity, coalesce(region, r) AS region,
         date_diff('day', CAST(order_date AS DATE), CAST(coalesce(delivery_date, d) AS DATE)) AS lead_time
  FROM once, fills
)"""


@query(
    "curated_months",
    with_view(
        RAW,
        CLEAN
        + """
SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS rows, round(sum(quantity), 4) AS quantity,
       round(avg(lead_time), 6) AS lead_time, count(*) FILTER (lead_time < 0) AS errors,
       count(*) FILTER (CAST(order_date AS DATE) = last_day(order_date)) AS month_end_rows
FROM clean GROUP BY 1""",
    ),
)
def curated_months(spark: SparkSession, folder: str) -> DataFrame:
    """The curation job over all raw lines, read back and summed by its partition column."""
    zone = curation.run(views.raw_orders(spark, folder), scratch_path(spark, "curated"))
    months = zone.groupBy(F.col("order_month").cast("string").alias("order_month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("quantity").alias("quantity"),
        F.avg("lead_time").alias("lead_time"),
        F.count_if("lead_time_error").alias("errors"),
        F.count_if("order_date_is_month_end").alias("month_end_rows"),
    )
    return rounded(months, 6, quantity=4)


STREAM_SCHEMA = (
    "order_id bigint, line_number int, product_id bigint, order_date string, delivery_date string, quantity double, "
    "line_value double, region string, return_flag string"
)
CLEAN_SCHEMA = STREAM_SCHEMA.replace("order_date string, delivery_date string", "order_date timestamp, delivery_date timestamp")


@query(
    "streamed_orders",
    with_view(
        RAW,
        """
SELECT DISTINCT order_id, line_number, product_id, CAST(order_date AS TIMESTAMP) AS order_date,
       CAST(delivery_date AS TIMESTAMP) AS delivery_date, quantity, line_value, region, return_flag
FROM raw""",
    ),
)
def streamed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines dropped as csv files, cleaned by the stream, read from the processed folder.

    All copies of a line lie in one file.
    """
    base = scratch_path(spark, "stream")
    raw = views.raw_orders(spark, folder)
    files.save_data(raw.repartition(*raw.columns), f"{base}/raw.csv")
    stream = file_cleaner.start_cleaner(spark, f"{base}/raw.csv", f"{base}/processed", f"{base}/state", STREAM_SCHEMA)
    stream.awaitTermination()
    return file_cleaner.processed_rows(spark, f"{base}/processed", CLEAN_SCHEMA).select(*raw.columns)


@query(
    "orders_on_calendar",
    """
WITH span AS (SELECT min(o_orderdate)::DATE AS low, max(o_orderdate)::DATE AS high FROM orders),
spine AS (SELECT high, unnest(generate_series(low, high + 100, INTERVAL 1 DAY))::DATE AS date FROM span),
grid AS (
  SELECT 'D' AS freq, date FROM spine WHERE date <= high
  UNION ALL SELECT 'W', date FROM spine WHERE isodow(date) = 7 AND date < high + 7
  UNION ALL SELECT 'M', date FROM spine WHERE last_day(date) = date AND date <= last_day(high)
  UNION ALL SELECT 'Q', date FROM spine
  WHERE last_day(date) = date AND month(date) % 3 = 0 AND date <= last_day((date_trunc('quarter', high) + INTERVAL 2 MONTH)::DATE)
),
days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
periods AS (
  SELECT 'D' AS freq, day AS date, n FROM days UNION ALL SELECT 'W', day + (7 - isodow(day))::INTEGER, n FROM days
  UNION ALL SELECT 'M', last_day(day), n FROM days
  UNION ALL SELECT 'Q', last_day((date_trunc('quarter', day) + INTERVAL 2 MONTH)::DATE), n FROM days
),
counted AS (SELECT freq, date, sum(n)::BIGINT AS orders FROM periods GROUP BY ALL)
SELECT grid.freq, grid.date, coalesce(orders, 0) AS orders FROM grid LEFT JOIN counted USING (freq, date)""",
)
def orders_on_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of every day, week, month and quarter of the calendar, dated by the period's last day."""
    days = views.table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ends = {
        "D": lambda day: day,
        "W": lambda day: F.next_day(F.date_sub(day, 1), "Sunday"),
        "M": F.last_day,
        "Q": lambda day: F.last_day(F.add_months(F.trunc(day, "quarter"), 2)),
    }
    span = days.agg(F.min("day").alias("low"), F.max("day").alias("high"))
    out = None
    for freq, end in ends.items():
        counts = days.groupBy(end(F.col("day")).alias("date")).agg(F.sum("n").alias("n"))
        spine = span.select(F.explode(grid_dates(F.col("low"), end(F.col("high")), freq)).alias("date"))
        part = spine.join(counts, "date", "left").select(
            F.lit(freq).alias("freq"), "date", F.coalesce("n", F.lit(0)).alias("orders")
        )
        out = part if out is None else out.union(part)
    return out


@query(
    "order_json_records",
    """
SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || ',"s_acctbal":'
       || round(s_acctbal, 2)::DECIMAL(18, 2) || '}' AS record
FROM supplier""",
)
def order_json_records(spark: SparkSession, folder: str) -> DataFrame:
    supplier = views.table(spark, folder, "supplier")
    return files.to_json_records(supplier.withColumn("s_acctbal", F.round("s_acctbal", 2).cast("decimal(18,2)")))
