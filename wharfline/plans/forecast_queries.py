"""Registered queries: stationarity, model forecasts, evaluation, baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.operators import forecasting as fc
from wharfline.operators.filters import position_split
from wharfline.operators.series import load_panel
from wharfline.plans.order_queries import rounded
from wharfline.plans.registry import query
from wharfline.plans.sql_views import DEMAND, EVENTS, WIDE, with_view
from wharfline.sources import views

KEYS = ["region"]


def regular_demand(spark: SparkSession, folder: str) -> DataFrame:
    """Demand per region on every day of its calendar; a day without orders has none."""
    return load_panel(views.daily_demand(spark, folder), "ds", "y", KEYS, "D").fillna(0.0, ["y"])


@query("demand_stationarity")
def demand_stationarity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(fc.check_stationarity(regular_demand(spark, folder), KEYS), 6)


@query("demand_holt_winters")
def demand_holt_winters(spark: SparkSession, folder: str) -> DataFrame:
    """History and a week ahead per region, weekly season."""
    panel = regular_demand(spark, folder)
    forecast = fc.holt_winters_forecast(fc.fit_holt_winters(panel, KEYS, 7), KEYS, 7)
    return rounded(fc.forecast_frame(panel, forecast, KEYS), 4)


# The smoothing recursion of every region, day by day, with alpha 0.3, beta 0.1, gamma 0.2 and a season of seven days.
SMOOTHED = """,
span AS (SELECT region, min(ds) AS low, max(ds) AS high FROM demand GROUP BY 1),
days AS (SELECT region, unnest(generate_series(low::TIMESTAMP, high::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ds FROM span),
series AS MATERIALIZED (
  SELECT region, max(ds) AS last_ds, list(coalesce(y, 0.0) ORDER BY ds) AS ys FROM days LEFT JOIN demand USING (region, ds) GROUP BY 1),
begun AS (
  SELECT region, 0 AS t, list_avg(ys[1:7]) AS level, (list_avg(ys[8:14]) - list_avg(ys[1:7])) / 7 AS slope,
         list_transform(ys[1:7], lambda v: v - list_avg(ys[1:7])) AS season, 0.0::DOUBLE AS sse FROM series),
run AS (
  SELECT * FROM begun
  UNION ALL
  SELECT region, t + 1, moved, 0.1 * (moved - level) + 0.9::DOUBLE * slope,
         list_concat(season[2:7], [0.2::DOUBLE * (y - base) + 0.8::DOUBLE * season[1]]),
         sse + (y - base - season[1]) * (y - base - season[1])
  FROM (SELECT r.*, s.ys[t + 1] AS y, level + slope AS base,
               0.3::DOUBLE * (s.ys[t + 1] - season[1]) + 0.7::DOUBLE * (level + slope) AS moved
        FROM run r JOIN series s USING (region) WHERE t < len(s.ys))),
ended AS (SELECT run.*, last_ds FROM run JOIN series USING (region) WHERE t = len(ys))
"""


@query(
    "demand_smoothing",
    with_view(
        DEMAND,
        SMOOTHED
        + """SELECT region, (last_ds + step::INT) AS ds, round(level + slope * step + season[(step - 1) % 7 + 1], 4) AS forecast,
       round(sse, 2) AS sse
FROM ended, (SELECT unnest(range(1, 15)) AS step)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def demand_smoothing(spark: SparkSession, folder: str) -> DataFrame:
    """Two weeks ahead per region under given smoothing parameters."""
    model = durable(fc.smooth(regular_demand(spark, folder), KEYS, 7, 0.3, 0.1, 0.2))
    ahead = fc.holt_winters_forecast(model, KEYS, 14).select(*KEYS, "ds", "forecast")
    return rounded(ahead.join(model.select(*KEYS, "sse"), KEYS), 4, sse=2)


@query(
    "demand_smoothing_frame",
    with_view(
        DEMAND,
        SMOOTHED
        + """SELECT region, ds, round(coalesce(y, 0), 4) AS forecast, 'Historical' AS type FROM days LEFT JOIN demand USING (region, ds)
UNION ALL
SELECT region, (last_ds + step::INT), round(level + slope * step + season[(step - 1) % 7 + 1], 4), 'Forecast'
FROM ended, (SELECT unnest(range(1, 15)) AS step)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def demand_smoothing_frame(spark: SparkSession, folder: str) -> DataFrame:
    """History and the smoothed forecast in one frame."""
    panel = durable(regular_demand(spark, folder))
    forecast = fc.holt_winters_forecast(fc.smooth(panel, KEYS, 7, 0.3, 0.1, 0.2), KEYS, 14)
    return rounded(fc.forecast_frame(panel, forecast, KEYS).select(*KEYS, "ds", "forecast", "type"), 4)


@query("stock_holt_winters")
def stock_holt_winters(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty days of stock per product, season of thirty days."""
    stock = views.star_inventory(spark, folder).groupBy("product", F.to_date("date").alias("ds"))
    panel = stock.agg(F.sum("quantity").alias("y"))
    model = fc.fit_holt_winters(panel, ["product"], 30)
    return rounded(fc.holt_winters_forecast(model, ["product"], 30), 4)


@query("demand_arima")
def demand_arima(spark: SparkSession, folder: str) -> DataFrame:
    model = fc.fit_arima(regular_demand(spark, folder), KEYS, (1, 1, 1))
    return rounded(fc.arima_forecast(model, KEYS, 30), 4)


@query("demand_sarima")
def demand_sarima(spark: SparkSession, folder: str) -> DataFrame:
    model = fc.fit_arima(regular_demand(spark, folder), KEYS, (1, 1, 1), (1, 0, 1, 7))
    return rounded(fc.arima_forecast(model, KEYS, 30), 4)


@query("demand_auto_arima")
def demand_auto_arima(spark: SparkSession, folder: str) -> DataFrame:
    """Order, AIC and BIC per region."""
    chosen = fc.auto_arima(regular_demand(spark, folder), KEYS)
    return rounded(chosen.select(*KEYS, "p", "d", "q", "n", "aic", "bic"), 4)


@query("demand_trend_season_forecast")
def demand_trend_season_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Additive trend and season regression, with history."""
    panel = views.daily_demand(spark, folder)
    forecast = fc.regression_forecast(fc.fit_regression(panel, KEYS), KEYS, 30)
    return rounded(fc.forecast_frame(panel, forecast, KEYS), 4)


@query("demand_multiplicative_forecast")
def demand_multiplicative_forecast(spark: SparkSession, folder: str) -> DataFrame:
    model = fc.fit_regression(views.daily_demand(spark, folder), KEYS, multiplicative=True)
    return rounded(fc.regression_forecast(model, KEYS, 30, multiplicative=True), 4)


SPLIT = """,
placed AS (
  SELECT {key}, ds, y, row_number() OVER (PARTITION BY {key} ORDER BY ds) AS rn, count(*) OVER (PARTITION BY {key}) AS n
  FROM {table}
),
train AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ds DESC) AS back, count(*) OVER (PARTITION BY {key}) AS m
          FROM placed WHERE rn <= floor(n * 0.8::DOUBLE)),
test AS (SELECT {key}, ds, y FROM placed WHERE rn > floor(n * 0.8::DOUBLE))"""


@query(
    "demand_flat_forecast",
    with_view(
        DEMAND,
        SPLIT.format(key="region", table="demand")
        + """,
flat AS (SELECT region, avg(y) AS forecast FROM train WHERE back <= 14 AND m > 14 GROUP BY 1)
SELECT test.region, ds, round(forecast, 6) AS forecast FROM test JOIN flat USING (region)""",
    ),
)
def demand_flat_forecast(spark: SparkSession, folder: str) -> DataFrame:
    split = position_split(views.daily_demand(spark, folder), KEYS, ["ds"])
    return rounded(fc.flat_forecast(split, KEYS), 6)


@query(
    "demand_baseline_accuracy",
    with_view(
        DEMAND,
        SPLIT.format(key="region", table="demand")
        + """,
flat AS (SELECT region, avg(y) AS forecast FROM train WHERE back <= 14 AND m > 14 GROUP BY 1)
SELECT region, round(max(forecast), 6) AS forecast, round(100 - avg(abs((y - forecast) / y)) * 100, 6) AS accuracy,
       count(*) AS horizon
FROM test LEFT JOIN flat USING (region) GROUP BY 1""",
    ),
)
def demand_baseline_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(fc.baseline(views.daily_demand(spark, folder), KEYS), 6)


@query(
    "event_baseline_accuracy",
    with_view(
        EVENTS,
        SPLIT.format(key="event_type", table="series")
        + """,
flat AS (SELECT event_type, avg(y) AS forecast FROM train WHERE back <= 14 AND m > 14 GROUP BY 1)
SELECT event_type, round(max(forecast), 6) AS forecast, round(100 - avg(abs((y - forecast) / y)) * 100, 6) AS accuracy,
       count(*) AS horizon
FROM test LEFT JOIN flat USING (event_type) GROUP BY 1""",
    ),
)
def event_baseline_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(fc.baseline(views.event_series(spark, folder), ["event_type"]), 6)


ERRORS = """count(*) AS n, round(avg((y - forecast) * (y - forecast)), 4) AS mse,
       round(sqrt(avg((y - forecast) * (y - forecast))), 6) AS rmse, round(avg(abs(y - forecast)), 6) AS mae,
       round(avg(abs((y - forecast) / nullif(y, 0))) * 100, 6) AS mape"""


@query(
    "demand_model_comparison",
    with_view(
        DEMAND,
        SPLIT.format(key="region", table="demand")
        + f""",
flats AS (
  SELECT 'mean_14' AS model, region, avg(y) AS forecast FROM train WHERE back <= 14 AND m > 14 GROUP BY ALL
  UNION ALL SELECT 'mean_56', region, avg(y) FROM train WHERE back <= 56 AND m > 56 GROUP BY ALL
  UNION ALL SELECT 'last_value', region, avg(y) FROM train WHERE back <= 1 AND m > 1 GROUP BY ALL
)
SELECT model, {ERRORS} FROM test JOIN flats USING (region) GROUP BY 1""",
    ),
)
def demand_model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    split = durable(position_split(views.daily_demand(spark, folder), KEYS, ["ds"]))
    models = {
        "mean_14": fc.flat_forecast(split, KEYS, 14),
        "mean_56": fc.flat_forecast(split, KEYS, 56),
        "last_value": fc.flat_forecast(split, KEYS, 1),
    }
    return rounded(fc.compare_models(split, models, [*KEYS, "ds"]), 6, mse=4)


@query(
    "demand_forecast_errors",
    with_view(
        DEMAND,
        SPLIT.format(key="region", table="demand")
        + f""",
flat AS (SELECT region, avg(y) AS forecast FROM train WHERE back <= 14 AND m > 14 GROUP BY 1)
SELECT region, {ERRORS} FROM test JOIN flat USING (region) GROUP BY 1""",
    ),
)
def demand_forecast_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors per region over a frame that also holds the history."""
    split = durable(position_split(views.daily_demand(spark, folder), KEYS, ["ds"]))
    frame = fc.forecast_frame(split.where(F.col("split") == "train"), fc.flat_forecast(split, KEYS), KEYS)
    return rounded(fc.evaluate(split, frame, [*KEYS, "ds"], KEYS), 6, mse=4)


@query("demand_model_ranking")
def demand_model_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted models against the baseline on the last fifth of every series."""
    split = durable(position_split(regular_demand(spark, folder), KEYS, ["ds"]))
    train = split.where(F.col("split") == "train")
    last = F.max(F.when(F.col("split") == "train", F.col("ds")))
    spans = split.groupBy(*KEYS).agg(F.datediff(F.max("ds"), last).alias("days"))
    ahead = spans.agg(F.max("days")).first()[0]  # as far as any series goes
    models = {
        "flat": fc.flat_forecast(split, KEYS),
        "holt_winters": fc.holt_winters_forecast(fc.fit_holt_winters(train, KEYS), KEYS, ahead),
        "arima": fc.arima_forecast(fc.fit_arima(train, KEYS), KEYS, ahead),
        "trend_season": fc.regression_forecast(fc.fit_regression(train, KEYS), KEYS, ahead),
    }
    return rounded(fc.compare_models(split, models, [*KEYS, "ds"]), 4)


@query(
    "days_until_reorder",
    with_view(
        WIDE,
        """,
stock AS (SELECT product, date AS ds, sum(inventory_level) AS y, avg(reorder_point) AS r FROM wide GROUP BY 1, 2),
points AS (SELECT product, avg(r) AS point FROM stock GROUP BY 1),
span AS (SELECT product, min(ds) AS low, max(ds) AS high FROM stock GROUP BY 1),
days AS (SELECT product, unnest(generate_series(low::TIMESTAMP, high::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ds FROM span),
series AS MATERIALIZED (
  SELECT product, max(ds) AS last_ds, list(y ORDER BY ds) AS ys FROM days LEFT JOIN stock USING (product, ds) GROUP BY 1),
begun AS (
  SELECT product, 0 AS t, list_avg(ys[1:7]) AS level, (list_avg(ys[8:14]) - list_avg(ys[1:7])) / 7 AS slope,
         list_transform(ys[1:7], lambda v: coalesce(v - list_avg(ys[1:7]), 0)) AS season
  FROM series WHERE len(ys) >= 14 AND list_avg(ys[1:7]) IS NOT NULL AND list_avg(ys[8:14]) IS NOT NULL),
run AS (
  SELECT * FROM begun
  UNION ALL
  SELECT product, t + 1, CASE WHEN y IS NULL THEN base ELSE moved END,
         CASE WHEN y IS NULL THEN slope ELSE 0.1 * (moved - level) + 0.9::DOUBLE * slope END,
         list_concat(season[2:7], [CASE WHEN y IS NULL THEN season[1] ELSE 0.2::DOUBLE * (y - base) + 0.8::DOUBLE * season[1] END])
  FROM (SELECT r.*, s.ys[t + 1] AS y, level + slope AS base,
               0.3::DOUBLE * (s.ys[t + 1] - season[1]) + 0.7::DOUBLE * (level + slope) AS moved
        FROM run r JOIN series s USING (product) WHERE t < len(s.ys))),
ahead AS (
  SELECT product, last_ds + step::INT AS ds, level + slope * step + season[(step - 1) % 7 + 1] AS forecast
  FROM run JOIN series USING (product), (SELECT unnest(range(1, 61)) AS step) WHERE t = len(ys))
SELECT product, date_diff('day', (SELECT max(ds) FROM stock), min(ds) FILTER (forecast < point))::INT AS days_until_reorder
FROM ahead JOIN points USING (product) GROUP BY 1""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def days_until_reorder(spark: SparkSession, folder: str) -> DataFrame:
    """When the stock forecast for the sixty days after the last one first falls below each product's mean
    reorder point."""
    stock = durable(
        views.daily_wide(spark, folder).groupBy("product", F.col("date").alias("ds")).agg(
            F.sum("inventory_level").alias("y"), F.avg("reorder_point").alias("r")
        )
    )
    points = stock.groupBy("product").agg(F.avg("r").alias("reorder_point"))
    model = fc.smooth(stock, ["product"], 7, 0.3, 0.1, 0.2)
    frame = fc.forecast_frame(stock, fc.holt_winters_forecast(model, ["product"], 60), ["product"])
    today = stock.agg(F.max("ds")).first()[0]
    return fc.days_until_reorder(frame, points, ["product"], str(today))
