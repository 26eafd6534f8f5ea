"""Registered queries: panels, windows, decomposition, anomalies, correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.operators import series
from wharfline.plans.order_queries import rounded
from wharfline.plans.registry import query
from wharfline.plans.sql_views import DEMAND, EVENTS, FACTS, WIDE, with_view
from wharfline.sources import views


@query(
    "product_panel_daily",
    with_view(
        FACTS,
        """,
mean AS (SELECT region, product, CAST(order_date AS DATE) AS ds, avg(quantity) AS y FROM facts GROUP BY 1, 2, 3),
spine AS (
  SELECT region, product, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM mean GROUP BY 1, 2
)
SELECT region, product, ds, round(y, 6) AS y FROM spine LEFT JOIN mean USING (region, product, ds)""",
    ),
)
def product_panel_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Mean line quantity per region and product on a daily grid, days without orders included."""
    facts = views.order_facts(spark, folder)
    return rounded(series.load_panel(facts, "order_date", "quantity", ["region", "product"], "D"), 6)


def _grid_sql(on_grid: str, spine: str) -> str:
    return with_view(
        DEMAND,
        f""",
spine AS (SELECT region, unnest({spine})::DATE AS ds FROM demand GROUP BY 1)
SELECT spine.region, spine.ds, y FROM spine LEFT JOIN demand ON demand.region = spine.region AND demand.ds = spine.ds
WHERE {on_grid}""",
    )


@query(
    "demand_panel_weekly",
    _grid_sql("isodow(spine.ds) = 7", "generate_series(min(ds), max(ds), INTERVAL 1 DAY)"),
)
def demand_panel_weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Demand on Sundays; other days are off the weekly grid."""
    return series.load_panel(views.daily_demand(spark, folder), "ds", "y", ["region"], "W")


@query(
    "demand_panel_monthly",
    _grid_sql("spine.ds = last_day(spine.ds)", "generate_series(min(ds), max(ds), INTERVAL 1 DAY)"),
)
def demand_panel_monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Demand on the last days of the months."""
    return series.load_panel(views.daily_demand(spark, folder), "ds", "y", ["region"], "M")


@query(
    "demand_lags",
    with_view(
        DEMAND,
        """
SELECT region, ds, y, lag(y, 1) OVER w AS y_lag_1, lag(y, 7) OVER w AS y_lag_7,
       lag(y, 14) OVER w AS y_lag_14, lag(y, 30) OVER w AS y_lag_30
FROM demand WINDOW w AS (PARTITION BY region ORDER BY ds)""",
    ),
)
def demand_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Default lags; no window is longer than 30 rows, so there are no rolling columns."""
    return series.lag_features(views.daily_demand(spark, folder), "ds", "y", ["region"], method="window")


ROLLING = """
       lag(quantity, 1) OVER w AS quantity_lag_1, lag(quantity, 3) OVER w AS quantity_lag_3,
       round(avg(quantity) OVER (w ROWS 6 PRECEDING), 6) AS quantity_rolling_mean_7,
       round(stddev_samp(quantity) OVER (w ROWS 6 PRECEDING), 4) AS quantity_rolling_std_7,
       round(avg(quantity) OVER (w ROWS 13 PRECEDING), 6) AS quantity_rolling_mean_14,
       round(stddev_samp(quantity) OVER (w ROWS 13 PRECEDING), 4) AS quantity_rolling_std_14"""
TIES = ["order_id", "line_number", "product_id", "supplier_id", "line_value"]
STDS = {f"quantity_rolling_std_{w}": 4 for w in (7, 14)}


@query(
    "order_line_lags",
    with_view(
        FACTS,
        f"""
SELECT region, order_id, line_number, product_id, supplier_id, line_value, quantity, {ROLLING}
FROM facts WINDOW w AS (PARTITION BY region ORDER BY order_date, {', '.join(TIES)})""",
    ),
)
def order_line_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Lags and rolling figures over the raw lines of five large regions, split into chunks."""
    facts = views.order_facts(spark, folder).select("region", "order_date", *TIES, "quantity")
    lagged = series.lag_features(
        facts, "order_date", "quantity", ["region"], (1, 3), (7, 14), TIES, method="chunked", chunk_rows=2000
    )
    return rounded(lagged.drop("order_date"), 6, line_value=2, **STDS)


@query(
    "all_order_lags",
    with_view(
        FACTS,
        f"""
SELECT order_id, line_number, product_id, supplier_id, line_value, quantity, {ROLLING}
FROM facts WINDOW w AS (ORDER BY order_date, {', '.join(TIES)})""",
    ),
)
def all_order_lags(spark: SparkSession, folder: str) -> DataFrame:
    """The same over all lines as one series."""
    facts = views.order_facts(spark, folder).select("order_date", *TIES, "quantity")
    lagged = series.lag_features(
        facts, "order_date", "quantity", (), (1, 3), (7, 14), TIES, method="chunked", chunk_rows=5000
    )
    return rounded(lagged.drop("order_date"), 6, line_value=2, **STDS)


@query(
    "metric_moving_average",
    with_view(
        WIDE,
        """,
days AS (SELECT date, avg(demand) AS demand FROM wide GROUP BY 1)
SELECT date, round(demand, 6) AS demand,
       round(CASE WHEN count(demand) OVER w = 7 THEN avg(demand) OVER w END, 6) AS demand_ma_7
FROM days WINDOW w AS (ORDER BY date ROWS 6 PRECEDING)""",
    ),
)
def metric_moving_average(spark: SparkSession, folder: str) -> DataFrame:
    from wharfline.operators.aggregates import mean_by

    days = mean_by(views.daily_wide(spark, folder), ["date"], "demand")
    return rounded(series.moving_average(days, "date", "demand", rows=7, method="window"), 6)


@query(
    "price_outliers",
    with_view(
        FACTS,
        """,
s AS (SELECT avg(price) AS m, stddev_samp(price) AS sd FROM facts)
SELECT order_id, line_number, product_id, supplier_id, round(price, 8) AS price,
       coalesce(abs((price - m) / sd) > 3, false) AS outlier
FROM facts, s""",
    ),
)
def price_outliers(spark: SparkSession, folder: str) -> DataFrame:
    facts = views.order_facts(spark, folder).select("order_id", "line_number", "product_id", "supplier_id", "price")
    return rounded(series.detect_outliers(facts, "price"), 8)


def _decomposition_sql(view: str, table: str, key: str, period: int, additive: bool) -> str:
    h = period // 2
    if period % 2:
        trend = f"avg(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    else:
        trend = (
            f"(sum(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
            f" - (lag(y, {h}) OVER w + lead(y, {h}) OVER w) / 2) / {period}"
        )
    apart, centred, rest = (
        ("y - trend", "pm - m", "y - trend - seasonal") if additive else ("y / trend", "pm / m", "y / trend / seasonal")
    )
    return f"""WITH {view.strip()},
placed AS (
  SELECT {key}, ds, y, (row_number() OVER w - 1) % {period} AS phase,
         CASE WHEN count(*) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) = {2 * h + 1} THEN {trend} END AS trend
  FROM {table} WINDOW w AS (PARTITION BY {key} ORDER BY ds)
),
phases AS (SELECT {key}, phase, avg({apart}) AS pm FROM placed GROUP BY 1, 2),
centres AS (SELECT {key}, avg(pm) AS m FROM phases GROUP BY 1),
parts AS (
  SELECT placed.*, {centred} AS seasonal FROM placed JOIN phases USING ({key}, phase) JOIN centres USING ({key})
),
decomposed AS (SELECT {key}, ds, y, trend, seasonal, {rest} AS residual FROM parts)
"""


PARTS = """SELECT {key}, ds, round(y, 4) AS y, round(trend, 4) AS trend, round(seasonal, 4) + 0.0 AS seasonal,
       round(residual, 4) + 0.0 AS residual FROM decomposed"""


@query(
    "demand_decomposition",
    _decomposition_sql(DEMAND, "demand", "region", 7, True) + PARTS.format(key="region"),
)
def demand_decomposition(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.decompose(views.daily_demand(spark, folder), ["region"], 7))


@query(
    "event_decomposition",
    _decomposition_sql(EVENTS, "series", "event_type", 7, True) + PARTS.format(key="event_type"),
)
def event_decomposition(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.decompose(views.event_series(spark, folder), ["event_type"], freq="D", period=None))


@query(
    "demand_decomposition_even_multiplicative",
    _decomposition_sql(DEMAND, "demand", "region", 12, False) + PARTS.format(key="region").replace(", 4)", ", 6)"),
)
def demand_decomposition_even_multiplicative(spark: SparkSession, folder: str) -> DataFrame:
    panel = views.daily_demand(spark, folder)
    return rounded(series.decompose(panel, ["region"], 12, "multiplicative"), 6)


ANOMALIES = (
    _decomposition_sql(DEMAND, "demand", "region", 7, True).rstrip()
    + """,
stats AS (SELECT region, avg(residual) AS m, stddev_samp(residual) AS s FROM decomposed GROUP BY 1),
scored AS (
  SELECT region, ds, y, residual, abs((residual - m) / s) AS z
  FROM decomposed JOIN stats USING (region) WHERE residual IS NOT NULL
)
"""
)


@query(
    "demand_anomalies",
    ANOMALIES + "SELECT region, ds, round(residual, 4) + 0.0 AS residual, round(z, 6) AS z_score, z > 3 AS anomaly FROM scored",
)
def demand_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    parts = series.decompose(views.daily_demand(spark, folder), ["region"], 7)
    found = series.detect_anomalies(parts, ["region"])
    return rounded(found.select("region", "ds", "residual", "z_score", "anomaly"), 4, z_score=6)


@query(
    "marked_demand_anomalies",
    ANOMALIES
    + """SELECT demand.region, demand.ds, demand.y, coalesce(z > 3, false) AS anomaly
FROM demand LEFT JOIN scored ON demand.region = scored.region AND demand.ds = scored.ds""",
)
def marked_demand_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Every date of the panel, with the flags of those that have a residual."""
    panel = durable(views.daily_demand(spark, folder))
    found = series.detect_anomalies(series.decompose(panel, ["region"], 7), ["region"])
    return series.mark_anomalies(panel, found, ["region", "ds"])


@query(
    "long_daily_metrics",
    with_view(
        WIDE,
        """,
days AS (
  SELECT date, avg(lead_time) AS lead_time, avg(fulfillment_rate) AS fulfillment_rate, sum(demand) AS demand
  FROM wide GROUP BY 1
),
long AS (UNPIVOT days ON lead_time, fulfillment_rate, demand INTO NAME metric VALUE value)
SELECT date, metric, round(value, 6) AS value FROM long""",
    ),
)
def long_daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    days = views.daily_wide(spark, folder).groupBy("date").agg(
        F.avg("lead_time").alias("lead_time"),
        F.avg("fulfillment_rate").alias("fulfillment_rate"),
        F.sum("demand").alias("demand"),
    )
    return rounded(series.long_metrics(days, ["date"], ["lead_time", "fulfillment_rate", "demand"]), 6)


@query(
    "series_extent",
    with_view(
        DEMAND,
        """
SELECT region, ds, y, row_number() OVER (PARTITION BY region ORDER BY ds)::INT AS position,
       count(*) OVER (PARTITION BY region) AS length, max(ds) OVER (PARTITION BY region) AS last_ds
FROM demand""",
    ),
)
def series_extent(spark: SparkSession, folder: str) -> DataFrame:
    return series.series_extent(views.daily_demand(spark, folder), ["region"])


LAG_COUNT = 40


ACF = f"""\
centred AS (
  SELECT region, y - avg(y) OVER (PARTITION BY region) AS d, row_number() OVER (PARTITION BY region ORDER BY ds) AS rn
  FROM demand
),
total AS (SELECT region, sum(d * d) AS v, count(*) AS n FROM centred GROUP BY 1),
pairs AS (
  SELECT a.region, k, sum(a.d * b.d) AS c
  FROM (SELECT region, d, k, rn - k AS earlier FROM centred, generate_series(0, {LAG_COUNT}) AS g(k)) a
  JOIN centred b ON a.region = b.region AND a.earlier = b.rn GROUP BY 1, 2
),
acf AS (SELECT region, n, k, c / v AS r FROM pairs JOIN total USING (region))
"""


@query(
    "demand_autocorrelation",
    with_view(
        DEMAND,
        f""",
{ACF}SELECT region, n, k::INT AS lag, round(r, 6) + 0.0 AS acf,
       round(CASE WHEN k = 0 THEN 0 ELSE 1.959963984540054::DOUBLE * sqrt((1 + 2 * coalesce(
         (SELECT sum(o.r * o.r) FROM acf o WHERE o.region = acf.region AND o.k BETWEEN 1 AND acf.k - 1), 0)) / n) END, 6) AS band
FROM acf""",
    ),
)
def demand_autocorrelation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.autocorrelation(views.daily_demand(spark, folder), ["region"], LAG_COUNT), 6)


@query(
    "demand_partial_autocorrelation",
    with_view(
        DEMAND,
        f""",
{ACF},
lists AS (SELECT region, max(n) AS n, list(r ORDER BY k) AS r FROM acf WHERE k < n GROUP BY 1),
steps(region, n, r, k, phi, last) AS (
  SELECT region, n, r, 0, []::DOUBLE[], 1.0::DOUBLE FROM lists
  UNION ALL
  SELECT region, n, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a * phi[k + 1 - j]), a), a
  FROM (
    SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0))
              / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1])), 0)) AS a
    FROM steps WHERE k + 2 <= len(r)
  )
)
SELECT region, n, k::INT AS lag, round(last, 6) + 0.0 AS pacf, round(1.959963984540054::DOUBLE / sqrt(n), 6) AS band
FROM steps""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def demand_partial_autocorrelation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.partial_autocorrelation(views.daily_demand(spark, folder), ["region"], LAG_COUNT), 6)
