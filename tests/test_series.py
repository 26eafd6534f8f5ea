import datetime as dt

import numpy as np
import pytest
from row_helpers import by
from pyspark.sql import functions as F

from wharfline.operators import aggregates as agg
from wharfline.operators import forecasting as fc
from wharfline.operators import series
from wharfline.operators.filters import position_split

START = dt.date(2023, 1, 1)


def panel(spark, **named):
    rows = [
        (key, START + dt.timedelta(days=i), None if v is None or np.isnan(v) else float(v))
        for key, values in named.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "key string, ds date, y double")


def wave(n, level=20.0, slope=0.2, period=10, size=5.0):
    t = np.arange(n)
    return level + slope * t + size * np.sin(2 * np.pi * t / period)


def reference_decomposition(y, p, additive=True):
    n, h = len(y), p // 2
    weights = np.ones(p) / p if p % 2 else np.r_[0.5, np.ones(p - 1), 0.5] / p
    trend = np.full(n, np.nan)
    trend[h : n - h] = np.convolve(y, weights, "valid")
    apart = y - trend if additive else y / trend
    phases = np.array([np.nanmean(apart[i::p]) for i in range(p)])
    phases = phases - phases.mean() if additive else phases / phases.mean()
    seasonal = np.resize(phases, n)
    return trend, seasonal, y - trend - seasonal if additive else y / trend / seasonal


@pytest.mark.parametrize("period, model", [(10, "additive"), (7, "additive"), (4, "multiplicative")])
def test_decomposition(spark, period, model):
    rng = np.random.default_rng(3)
    values = {"a": wave(100) + rng.normal(0, 1, 100), "b": wave(83, 50, -0.1) + rng.normal(0, 1, 83)}
    rows = by(series.decompose(panel(spark, **values), ["key"], period, model), "key", "ds")
    for key, y in values.items():
        mine = [r for r in rows if r["key"] == key]
        expected = reference_decomposition(y, period, model == "additive")
        for name, column in zip(("trend", "seasonal", "residual"), expected):
            found = np.array([np.nan if r[name] is None else r[name] for r in mine])
            np.testing.assert_allclose(found, column, atol=1e-9)


def test_short_or_gappy_series_are_not_decomposed(spark):
    rows = by(series.decompose(panel(spark, short=wave(13), gap=[*wave(20), None, *wave(20)]), ["key"], 7), "key", "ds")
    assert all(r["trend"] is None and r["residual"] is None for r in rows)


def test_planted_anomalies(spark):
    values = np.random.default_rng(5).normal(0, 1, 100)
    values[[25, 50, 75]] = 20
    df = panel(spark, a=values).withColumnRenamed("y", "residual")
    found = by(series.detect_anomalies(df, ["key"]), "ds")
    assert [i for i, r in enumerate(found) if r["anomaly"]] == [25, 50, 75]
    single = by(series.detect_anomalies(df.drop("key")), "ds")
    assert [r["anomaly"] for r in single] == [r["anomaly"] for r in found]
    marked = by(series.mark_anomalies(df, series.detect_anomalies(df, ["key"]).where("ds > '2023-03-01'"), ["key", "ds"]), "ds")
    assert [i for i, r in enumerate(marked) if r["anomaly"]] == [75]


def test_outliers_without_spread(spark):
    flat = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert not any(r["outlier"] for r in series.detect_outliers(flat, "v").collect())


def test_panel_grid_and_duplicates(spark):
    rows = [("a", "2023-01-01", 1.0), ("a", "2023-01-01", 3.0), ("a", "2023-01-04", 5.0), (None, "2023-01-01", 9.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double")
    daily = by(series.load_panel(df, "d", "v", ["k"], "D"), "ds")
    assert [r["y"] for r in daily] == [2.0, None, None, 5.0]
    assert series.load_panel(df, "d", "v", ["k"]).count() == 2
    monthly = spark.createDataFrame([("2023-01-31", 1.0), ("2023-02-10", 2.0), ("2023-03-31", 3.0)], "d string, v double")
    assert [r["y"] for r in by(series.load_panel(monthly, "d", "v", freq="M"), "ds")] == [1.0, None, 3.0]


def acf_of(y, lags):
    d = y - y.mean()
    return np.array([(d[k:] * d[: len(d) - k]).sum() for k in range(lags + 1)]) / (d * d).sum()


def test_autocorrelations(spark):
    y = np.random.default_rng(7).normal(0, 1, 200).cumsum() * 0.3 + wave(200, 0, 0, 7)
    df = panel(spark, a=y)
    acf = by(series.autocorrelation(df, ["key"], 12), "lag")
    expected = acf_of(y, 12)
    np.testing.assert_allclose([r["acf"] for r in acf], expected, atol=1e-10)
    assert acf[0]["band"] == 0 and acf[2]["band"] == pytest.approx(1.959964 * np.sqrt((1 + 2 * expected[1] ** 2) / 200), rel=1e-5)
    pacf = by(series.partial_autocorrelation(df, ["key"], 12), "lag")
    for k in range(1, 13):
        toeplitz = np.array([[expected[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k]["pacf"] == pytest.approx(np.linalg.solve(toeplitz, expected[1 : k + 1])[-1], abs=1e-8)


def test_stationarity(spark):
    noise, walk = np.random.default_rng(11).normal(0, 1, 300), np.random.default_rng(17).normal(0, 1, 300).cumsum()
    rows = {r["key"]: r for r in by(fc.check_stationarity(panel(spark, noise=noise, walk=walk), ["key"]))}
    assert rows["noise"]["is_stationary"] and not rows["walk"]["is_stationary"]
    assert rows["noise"]["critical_5"] == pytest.approx(-2.871, abs=5e-3)
    for name, y in (("noise", noise), ("walk", walk)):
        lag = rows[name]["lags"]
        d = np.diff(y)
        x = np.column_stack([np.ones(len(d) - lag), y[lag:-1], *[d[lag - k : len(d) - k] for k in range(1, lag + 1)]])
        beta, *_ = np.linalg.lstsq(x, d[lag:], rcond=None)
        s2 = ((d[lag:] - x @ beta) ** 2).sum() / (len(x) - x.shape[1])
        t = beta[1] / np.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1])
        assert rows[name]["test_statistic"] == pytest.approx(t, rel=1e-6)
        assert rows[name]["n_observations"] == len(x)


def test_holt_winters_continues_a_clean_season(spark):
    y = wave(84, 20, 0.5, 7)
    df = panel(spark, a=y, short=y[:10])
    model = fc.fit_holt_winters(df, ["key"], 7)
    assert [r["key"] for r in by(model)] == ["a"]
    ahead = by(fc.holt_winters_forecast(model, ["key"], 7), "ds")
    np.testing.assert_allclose([r["forecast"] for r in ahead], wave(91, 20, 0.5, 7)[84:], atol=0.3)
    assert ahead[0]["ds"] == START + dt.timedelta(days=84) and ahead[0]["lower_bound"] <= ahead[0]["forecast"]
    alone = by(fc.holt_winters_forecast(fc.fit_holt_winters(df.where("key = 'a'").drop("key"), (), 7), (), 7), "ds")
    assert [r["forecast"] for r in alone] == [r["forecast"] for r in ahead]


def test_arima_recovers_an_autoregression(spark):
    rng = np.random.default_rng(13)
    y = np.zeros(1500)
    for t in range(1, len(y)):
        y[t] = 2 + 0.7 * y[t - 1] + rng.normal()
    model = by(fc.fit_arima(panel(spark, a=y), ["key"], (1, 0, 0)))[0]
    assert model["ar"][0] == pytest.approx(0.7, abs=0.05) and model["sigma2"] == pytest.approx(1.0, abs=0.1)
    assert model["constant"] == pytest.approx(2.0, abs=0.35) and model["bic"] > model["aic"]
    ahead = by(fc.arima_forecast(fc.fit_arima(panel(spark, a=y), ["key"], (1, 0, 0)), ["key"], 3), "ds")
    expected, last = [], y[-1]
    for _ in range(3):
        last = model["constant"] + model["ar"][0] * last
        expected.append(last)
    np.testing.assert_allclose([r["forecast"] for r in ahead], expected, rtol=1e-9)
    spread = ahead[1]["upper_bound"] - ahead[1]["forecast"]
    assert spread == pytest.approx(1.959964 * np.sqrt(model["sigma2"] * (1 + model["ar"][0] ** 2)), rel=1e-5)


def test_differenced_and_seasonal_models(spark):
    line = panel(spark, a=np.arange(80) * 2.0 + 5)
    ahead = by(fc.arima_forecast(fc.fit_arima(line, ["key"], (1, 1, 0)), ["key"], 3), "ds")
    np.testing.assert_allclose([r["forecast"] for r in ahead], [165, 167, 169], atol=1e-6)
    y = wave(140, 10, 0, 7)
    ahead = by(fc.arima_forecast(fc.fit_arima(panel(spark, a=y), ["key"], (0, 0, 0), (1, 1, 0, 7)), ["key"], 7), "ds")
    np.testing.assert_allclose([r["forecast"] for r in ahead], y[:7], atol=1e-6)


def test_automatic_order(spark):
    rng = np.random.default_rng(17)
    walk = rng.normal(0, 1, 400).cumsum()
    steady = np.zeros(400)
    for t in range(1, 400):
        steady[t] = 0.6 * steady[t - 1] + rng.normal()
    rows = {r["key"]: r for r in by(fc.auto_arima(panel(spark, walk=walk, steady=steady), ["key"]))}
    assert rows["walk"]["d"] == 1 and rows["steady"]["d"] == 0 and rows["steady"]["p"] + rows["steady"]["q"] >= 1


def test_automatic_order_finds_long_lags_and_second_differences(spark):
    rng = np.random.default_rng(5)
    bent, lagged = rng.normal(0, 1, 400).cumsum().cumsum(), np.zeros(400)
    for t in range(5, 400):
        lagged[t] = -0.6 * lagged[t - 5] + rng.normal()
    series = panel(spark, bent=bent, lagged=lagged, line=np.arange(400) * 2.0)
    rows = {r["key"]: r for r in by(fc.auto_arima(series, ["key"]))}
    assert rows["bent"]["d"] == 2 and rows["line"]["d"] == 1
    assert rows["lagged"]["d"] == 0 and max(rows["lagged"]["p"], rows["lagged"]["q"]) == 5
    alone = fc.auto_arima(series.where("key = 'bent'").drop("key")).first()
    assert (alone["d"], alone["p"], alone["q"]) == (2, rows["bent"]["p"], rows["bent"]["q"])


def test_trend_and_season_regression(spark):
    t = np.arange(500)
    y = 30 + 0.05 * t + 4 * np.sin(2 * np.pi * (t + 3) / 7)
    ahead = by(fc.regression_forecast(fc.fit_regression(panel(spark, a=y), ["key"]), ["key"], 14), "ds")
    u = np.arange(500, 514)
    np.testing.assert_allclose([r["forecast"] for r in ahead], 30 + 0.05 * u + 4 * np.sin(2 * np.pi * (u + 3) / 7), atol=0.5)
    grown = panel(spark, a=np.exp(0.5 + 0.004 * t))
    model = fc.fit_regression(grown, ["key"], multiplicative=True)
    ahead = by(fc.regression_forecast(model, ["key"], 3, multiplicative=True), "ds")
    np.testing.assert_allclose([r["forecast"] for r in ahead], np.exp(0.5 + 0.004 * u[:3]), rtol=0.02)


def test_errors_leave_history_out(spark):
    df = panel(spark, a=[1, 2, 4, 0])
    forecast = df.where("ds > '2023-01-02'").select("key", "ds", F.lit(3.0).alias("forecast"))
    frame = fc.forecast_frame(df.where("ds <= '2023-01-02'"), forecast, ["key"])
    assert frame.count() == 4 and fc.forecast_frame(df, forecast, ["key"], False).count() == 2
    row = fc.evaluate(df, frame, ["key", "ds"]).first()
    assert (row["n"], row["mse"], row["mae"], row["mape"]) == (2, 5.0, 2.0, 25.0)


def test_baseline_needs_enough_rows(spark):
    rows = {r["key"]: r for r in by(fc.baseline(panel(spark, long=[5.0] * 40, short=[5.0] * 17), ["key"]))}
    assert rows["long"]["accuracy"] == 100.0 and rows["long"]["horizon"] == 8
    assert rows["short"]["accuracy"] is None and rows["short"]["horizon"] == 4
    split = position_split(panel(spark, a=range(10)), ["key"], ["ds"], train_size=0.35)
    assert [r["split"] for r in by(split, "ds")].count("train") == 3


def test_gap_months_are_zero(spark):
    df = spark.createDataFrame([("2023-01-15", 1.0), ("2023-01-20", 2.0), ("2023-04-02", 5.0)], "date string, cost double")
    rows = by(agg.monthly_sums(df.withColumn("date", F.to_date("date"))), "date")
    assert [(r["date"].isoformat(), r["cost"]) for r in rows] == [
        ("2023-01-31", 3.0), ("2023-02-28", 0.0), ("2023-03-31", 0.0), ("2023-04-30", 5.0),
    ]


@pytest.mark.parametrize(("trend", "seasonal"), [("add", "add"), (None, "add"), ("add", "mul"), ("add", None)])
def test_folded_smoothing_equals_the_recursion(spark, trend, seasonal):
    rng = np.random.default_rng(5)
    y = 20 + 0.1 * np.arange(90) + 3 * np.sin(np.arange(90) * 2 * np.pi / 7) + rng.normal(0, 0.5, 90)
    y[[20, 41, 88]] = np.nan
    start = dt.date(2023, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), None if np.isnan(v) else float(v)) for i, v in enumerate(y)]
    rows += [("short", start + dt.timedelta(days=i), 1.0) for i in range(13)]
    panel = spark.createDataFrame(rows, "key string, ds date, y double")
    got = fc.smooth(panel, ["key"], 7, 0.4, 0.2, 0.3, trend, seasonal).collect()
    sse, level, slope, season, residuals = fc._smooth(y, 7, np.array([[0.4, 0.2, 0.3]]), trend == "add", seasonal)
    assert [r["key"] for r in got] == ["a"]
    assert got[0]["level"] == pytest.approx(level[0]) and got[0]["slope"] == pytest.approx(slope[0]) and got[0]["sse"] == pytest.approx(sse[0])
    assert got[0]["residual_std"] == pytest.approx(np.nanstd(residuals[:, 0]))
    assert got[0]["season"] == pytest.approx(np.roll(season[0], -(90 % 7)).tolist())
