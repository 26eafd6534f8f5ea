"""Registered queries: row rules, expectation suites, reports, profiles, catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import scratch_path
from wharfline.operators import catalog, quality
from wharfline.plans.order_queries import rounded
from wharfline.plans.registry import query
from wharfline.sources import files, views

# The four checked tables with faults, first as SQL, then as DataFrames.
CHECKED = """
products AS (
  SELECT CASE WHEN p_size = 13 THEN 'X' ELSE 'P' END || p_partkey AS product_id,
         nullif(p_name, 'small ring') AS product_name, p_type AS category,
         p_retailprice - 905 AS price, (p_size - 1)::DOUBLE AS weight
  FROM part
),
suppliers AS (
  SELECT 'S' || s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country,
         s_acctbal / 90 AS reliability_score, s_nationkey::BIGINT - 2 AS lead_time_days
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
orders_checked AS (
  SELECT 'O' || l_orderkey AS order_id, 'P' || l_partkey AS product_id, 'S' || l_suppkey AS supplier_id,
         l_quantity::BIGINT - 1 AS quantity, o_orderdate AS order_date, l_shipdate AS expected_delivery,
         CASE WHEN l_returnflag <> 'N' THEN o_orderdate + to_days(l_linenumber::INTEGER - 2) END AS actual_delivery,
         CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'P' THEN 'shipped'
              WHEN o_orderpriority = '5-LOW' THEN 'lost' ELSE 'pending' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
inventory AS (
  SELECT 'I' || l_partkey || l_linenumber AS inventory_id, 'P' || l_partkey AS product_id,
         CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 'Z' ELSE 'W' END || l_suppkey AS warehouse_id,
         l_quantity::BIGINT - 2 AS quantity, l_linenumber::BIGINT * 10 - 15 AS reorder_level,
         nullif(l_shipdate, TIMESTAMP '1998-01-01') AS last_restock_date
  FROM lineitem
)"""


def _text(column: str) -> F.Column:
    return F.col(column).cast("string")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "part").select(
        F.concat(F.when(F.col("p_size") == 13, "X").otherwise("P"), _text("p_partkey")).alias("product_id"),
        F.nullif(F.col("p_name"), F.lit("small ring")).alias("product_name"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") - 905).alias("price"),
        (F.col("p_size") - 1).cast("double").alias("weight"),
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    nation = views.table(spark, folder, "nation")
    return views.table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("S"), _text("s_suppkey")).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("country"),
        (F.col("s_acctbal") / 90).alias("reliability_score"),
        (F.col("s_nationkey").cast("bigint") - 2).alias("lead_time_days"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    head = views.table(spark, folder, "orders")
    shifted = F.timestamp_add("DAY", F.col("l_linenumber") - 2, F.col("o_orderdate"))
    return views.table(spark, folder, "lineitem").join(head, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("O"), _text("l_orderkey")).alias("order_id"),
        F.concat(F.lit("P"), _text("l_partkey")).alias("product_id"),
        F.concat(F.lit("S"), _text("l_suppkey")).alias("supplier_id"),
        (F.col("l_quantity").cast("bigint") - 1).alias("quantity"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("expected_delivery"),
        F.when(F.col("l_returnflag") != "N", shifted).alias("actual_delivery"),
        F.when(F.col("o_orderstatus") == "F", "DELIVERED")
        .when(F.col("o_orderstatus") == "P", "shipped")
        .when(F.col("o_orderpriority") == "5-LOW", "lost")
        .otherwise("pending")
        .alias("status"),
    )


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    odd = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7)
    return views.table(spark, folder, "lineitem").select(
        F.concat(F.lit("I"), _text("l_partkey"), _text("l_linenumber")).alias("inventory_id"),
        F.concat(F.lit("P"), _text("l_partkey")).alias("product_id"),
        F.concat(F.when(odd, "Z").otherwise("W"), _text("l_suppkey")).alias("warehouse_id"),
        (F.col("l_quantity").cast("bigint") - 2).alias("quantity"),
        (F.col("l_linenumber").cast("bigint") * 10 - 15).alias("reorder_level"),
        F.nullif(F.col("l_shipdate"), F.lit("1998-01-01").cast("timestamp")).alias("last_restock_date"),
    )


TABLES = {"products": products, "suppliers": suppliers, "orders": orders, "inventory": inventory}
SQL_NAMES = {"products": "products", "suppliers": "suppliers", "orders": "orders_checked", "inventory": "inventory"}

# Broken rules per row as SQL, in the order the row models list them.
ROW_SQL = {
    "products": (
        ["product_id"],
        [
            "CASE WHEN NOT regexp_matches(product_id, '^P[0-9]+$') THEN 'id_format:product_id' END",
            "CASE WHEN product_name IS NULL THEN 'required:product_name' END",
            "CASE WHEN price <= 0 THEN 'positive:price' END",
            "CASE WHEN weight <= 0 THEN 'positive:weight' END",
        ],
    ),
    "suppliers": (
        ["supplier_id"],
        [
            "CASE WHEN reliability_score < 0 OR reliability_score > 100 THEN 'score_range:reliability_score' END",
            "CASE WHEN lead_time_days < 0 THEN 'not_negative:lead_time_days' END",
        ],
    ),
    "orders": (
        ["order_id", "product_id", "supplier_id"],
        [
            "CASE WHEN quantity <= 0 THEN 'positive:quantity' END",
            "CASE WHEN lower(status) NOT IN ('pending', 'shipped', 'delivered', 'canceled') THEN 'known_state:status' END",
            "CASE WHEN expected_delivery < order_date THEN 'expected_after_order:__row__' "
            "WHEN actual_delivery < order_date THEN 'actual_after_order:__row__' END",
        ],
    ),
    "inventory": (
        ["inventory_id", "warehouse_id"],
        [
            "CASE WHEN NOT regexp_matches(warehouse_id, '^W[0-9]+$') THEN 'id_format:warehouse_id' END",
            "CASE WHEN quantity < 0 THEN 'not_negative:quantity' END",
            "CASE WHEN reorder_level < 0 THEN 'not_negative:reorder_level' END",
            "CASE WHEN last_restock_date IS NULL THEN 'required:last_restock_date' END",
            "CASE WHEN quantity >= 0 AND reorder_level >= 0 AND reorder_level > quantity * 2 "
            "THEN 'reorder_within_twice_stock:__row__' END",
        ],
    ),
}


def _row_sql(name: str) -> str:
    keys, problems = ROW_SQL[name]
    status = ", lower(status) AS status" if name == "orders" else ""
    listed = ",\n  ".join(problems)
    return (
        f"WITH {CHECKED},\nmarked AS (SELECT {', '.join(keys)}{status}, concat_ws('; ',\n  {listed}) AS errors "
        f"FROM {SQL_NAMES[name]})\nSELECT *, errors = '' AS valid FROM marked"
    )


def _register_row_check(name: str) -> None:
    @query(f"row_check_{name}", _row_sql(name))
    def row_check(spark: SparkSession, folder: str) -> DataFrame:
        """Every row with its broken rules."""
        checked = quality.validate_rows(TABLES[name](spark, folder), quality.MODELS[name])
        keys = ROW_SQL[name][0] + (["status"] if name == "orders" else [])
        problems = F.transform("errors", lambda e: F.concat_ws(":", e["rule"], e["column"]))
        return checked.select(*keys, F.array_join(problems, "; ").alias("errors"), "valid")


for _name in TABLES:
    _register_row_check(_name)


def _wrong_sql(item: dict) -> str:
    kind, kwargs = item["expectation_type"], item["kwargs"]
    column = kwargs.get("column")
    if kind == quality.NOT_NULL:
        return f"{column} IS NULL"
    if kind == quality.MATCH:
        return f"NOT regexp_matches({column}, '{kwargs['regex']}')"
    if kind == quality.IN_SET:
        return f"{column} NOT IN ({', '.join(repr(v) for v in kwargs['value_set'])})"
    bounds = [f"{column} {'<=' if kwargs.get('strict_min') else '<'} {kwargs['min_value']}"]
    if "max_value" in kwargs:
        bounds.append(f"{column} > {kwargs['max_value']}")
    return " OR ".join(bounds)


def _expectation_sql() -> str:
    lines = []
    for name, suite in quality.SUITES.items():
        for i, item in enumerate(suite):
            kind, column = item["expectation_type"], item["kwargs"].get("column")
            head = f"SELECT '{name}' AS dataset, {i} AS position, '{kind}' AS expectation_type, " + (
                f"'{column}' AS \"column\"" if column else "NULL::VARCHAR AS \"column\""
            )
            if kind in (quality.ORDERED_COLUMNS, quality.OF_TYPE):
                lines.append(f"{head}, NULL::BIGINT AS element_count, NULL::BIGINT AS unexpected_count, true AS success")
                continue
            table = SQL_NAMES[name]
            if kind == quality.UNIQUE:
                source = (
                    f"SELECT sum(n)::BIGINT AS e, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS w FROM "
                    f"(SELECT count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column})"
                )
            else:
                counted = "count(*)" if kind == quality.NOT_NULL else f"count({column})"
                source = f"SELECT {counted} AS e, count(*) FILTER ({_wrong_sql(item)}) AS w FROM {table}"
            lines.append(f"{head}, e AS element_count, w AS unexpected_count, w = 0 AS success FROM ({source})")
    return f"WITH {CHECKED},\nresults AS (\n" + "\nUNION ALL\n".join(lines) + "\n)"


RESULTS = _expectation_sql()


def _results(spark: SparkSession, folder: str) -> DataFrame:
    parts = [quality.validate_dataset(TABLES[n](spark, folder), quality.SUITES[n], n) for n in quality.SUITES]
    return reduce(DataFrame.unionByName, parts)


@query(
    "expectation_results",
    RESULTS
    + """
SELECT dataset, position, expectation_type, "column", element_count, unexpected_count, success,
       round(100.0 * unexpected_count / element_count, 6) AS unexpected_percent
FROM results""",
)
def expectation_results(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_results(spark, folder).drop("kwargs"), 6)


REPORT = """,
report AS (
  SELECT dataset, bool_and(success) AS success, count(*) AS total_expectations,
         count(*) FILTER (success) AS passed_expectations,
         coalesce(string_agg(expectation_type || '(' || "column" || ')', '; ' ORDER BY position) FILTER (NOT success), '') AS failed
  FROM results GROUP BY 1
)"""


@query(
    "quality_report",
    RESULTS
    + REPORT
    + """
SELECT *, round(100.0 * (total_expectations - passed_expectations) / total_expectations, 6) AS failure_percent FROM report""",
)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.quality_report(_results(spark, folder))
    names = F.transform(
        "failed_expectations",
        lambda e: F.concat(e["expectation_type"], F.lit("("), F.get_json_object(e["kwargs"], "$.column"), F.lit(")")),
    )
    return rounded(report.withColumn("failed", F.array_join(names, "; ")).drop("failed_expectations"), 6)


@query(
    "validated_folder",
    RESULTS
    + REPORT
    + """
SELECT dataset, success, total_expectations, passed_expectations,
       round(100.0 * (total_expectations - passed_expectations) / total_expectations, 6) AS failure_percent
FROM report""",
)
def validated_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The four tables written as parquet, found in their folder, checked, and the written report read back."""
    base = scratch_path(spark, "checked")
    for name, made in TABLES.items():
        files.save_data(made(spark, folder), f"{base}/{name}.parquet")
    found = files.discover(spark, base, "*.parquet").select("dataset").distinct()
    # One row per dataset of the folder, of which there are as many as the folder has entries.
    paths = [f"{base}/{r['dataset']}.parquet" for r in found.collect()]
    quality.validate_folder(spark, paths, f"{base}-reports")
    report = spark.read.json(f"{base}-reports/data_quality_report.json")
    return rounded(
        report.select("dataset", "success", "total_expectations", "passed_expectations", "failure_percent"), 6
    )


@query(
    "quality_summary",
    RESULTS
    + REPORT
    + """
SELECT count(*) AS total_datasets, count(*) FILTER (success) AS passed_datasets,
       sum(total_expectations)::BIGINT AS total_expectations, sum(passed_expectations)::BIGINT AS passed_expectations,
       round(100.0 * sum(passed_expectations) / sum(total_expectations), 6) AS success_percentage
FROM report""",
)
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.quality_summary(quality.quality_report(_results(spark, folder))), 6)


def _profile_sql(table: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, kind) in enumerate(columns):
        figures = (
            f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std"
            if kind in ("bigint", "int", "double")
            else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS std"
        )
        parts.append(
            f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
            f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS unique_count, {figures} FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


ORDER_COLUMNS = [
    ("order_id", "string"), ("product_id", "string"), ("supplier_id", "string"), ("quantity", "bigint"),
    ("order_date", "timestamp"), ("expected_delivery", "timestamp"), ("actual_delivery", "timestamp"),
    ("status", "string"),
]
PART_COLUMNS = [
    ("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"),
    ("p_retailprice", "double"),
]
SUPPLIER_COLUMNS = [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")]


@query("profile_orders", f"WITH {CHECKED}\n" + _profile_sql("orders_checked", ORDER_COLUMNS))
def profile_orders(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.profile(orders(spark, folder)))


@query(
    "dimension_scores",
    f"""WITH {CHECKED}
SELECT 'completeness' AS metric,
       round((avg((order_id IS NOT NULL)::INT) + avg((actual_delivery IS NOT NULL)::INT)
              + avg((status IS NOT NULL)::INT)) / 3, 6) AS score FROM orders_checked
UNION ALL
SELECT 'accuracy', round((avg((quantity > 0)::INT)
       + avg((lower(status) IN ('pending', 'shipped', 'delivered', 'canceled'))::INT)) / 2, 6) FROM orders_checked
UNION ALL
SELECT 'consistency', round(avg((expected_delivery >= order_date)::INT), 6) FROM orders_checked
UNION ALL
SELECT 'timeliness', round(avg(coalesce(actual_delivery <= expected_delivery, false)::INT), 6) FROM orders_checked""",
)
def dimension_scores(spark: SparkSession, folder: str) -> DataFrame:
    table = orders(spark, folder)
    rules = {
        "completeness": quality.completeness_rules(table, ["order_id", "actual_delivery", "status"]),
        "accuracy": [F.col("quantity") > 0, F.lower("status").isin(quality.ORDER_STATES)],
        "consistency": [F.col("expected_delivery") >= F.col("order_date")],
        "timeliness": [F.col("actual_delivery") <= F.col("expected_delivery")],
    }
    return rounded(quality.dimension_scores(table, rules), 6)


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    part = catalog.register_from_dataframe(
        views.table(spark, folder, "part"), "part", "Parts", "All parts", f"{folder}/part.parquet",
        ["reference", "product"], {"owner": "sales"},
    )
    supplier = catalog.register_from_dataframe(
        views.table(spark, folder, "supplier"), "supplier", "Suppliers", "All suppliers", f"{folder}/supplier.parquet",
        ["reference"],
    )
    return part.unionByName(supplier)


def _dictionary_sql(dataset: str, name: str, description: str, table: str, columns: list[tuple[str, str]]) -> str:
    return (
        f"SELECT '{dataset}' AS dataset_id, '{name}' AS dataset_name, column_name, data_type, null_count > 0 AS nullable, "
        f"unique_count, min, max, '{description}' AS description FROM ({_profile_sql(table, columns)})"
    )


@query(
    "data_dictionary",
    _dictionary_sql("part", "Parts", "All parts", "part", PART_COLUMNS)
    + "\nUNION ALL\n"
    + _dictionary_sql("supplier", "Suppliers", "All suppliers", "supplier", SUPPLIER_COLUMNS),
)
def data_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    rows = catalog.data_dictionary(_entries(spark, folder))
    return rows.withColumns({"min": F.col("min").cast("double"), "max": F.col("max").cast("double")})


@query(
    "saved_data_dictionary",
    _dictionary_sql("part", "Parts", "All parts", "part", PART_COLUMNS)
    + "\nUNION ALL\n"
    + _dictionary_sql("supplier", "Suppliers", "All suppliers", "supplier", SUPPLIER_COLUMNS),
)
def saved_data_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary written as csv and read back."""
    path = scratch_path(spark, "dictionary") + "/columns.csv"
    rows = catalog.data_dictionary(_entries(spark, folder), path)
    back = files.load_data(spark, path, rows.schema)
    return back.withColumns({"min": F.col("min").cast("double"), "max": F.col("max").cast("double")})


@query(
    "datasets_by_tag",
    "SELECT 'part' AS dataset_id, 'Parts' AS name, count(*) AS row_count, 6 AS column_count, 'sales' AS owner FROM part",
)
def datasets_by_tag(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.list_datasets(_entries(spark, folder), ["product", "reference"]).select(
        "dataset_id",
        "name",
        "schema.row_count",
        F.size("schema.columns").alias("column_count"),
        F.col("metadata")["owner"].alias("owner"),
    )
