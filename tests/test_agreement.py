"""Methods that are chosen by size or width give the same result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from row_helpers import by
from wharfline.functions.joins import join_statistics
from wharfline.functions.quantiles import exact_quantiles
from wharfline.operators import aggregates as agg
from wharfline.operators import forecasting as fc
from wharfline.operators import leastsquares
from wharfline.operators.series import without_gaps
from wharfline.sources import files

GAPS = [("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", None), ("b", float("nan")), ("c", 2.0), ("c", None), (None, 5.0)]


@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles_by_either_method(spark, keys):
    df = spark.createDataFrame(GAPS, "k string, v double")
    one, two = (by(exact_quantiles(df, keys, {"m": ("v", 0.5)}, m), *keys) for m in ("built_in", "banded"))
    assert one == two
    if keys:
        assert one == [{"k": "a", "m": 2.0}, {"k": "b", "m": None}, {"k": "c", "m": 2.0}]


def test_products_by_either_method(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, 1.0), ("b", None, 3.0), ("c", 2.0, 2.0)], "k string, x double, y double")
    narrow = by(leastsquares.cross_products(df, ["k"], ["x", "y"]), "k")
    monkeypatch.setattr(leastsquares, "WRITTEN_OUT", 1)
    assert by(leastsquares.cross_products(df, ["k"], ["x", "y"]), "k") == narrow and [r["k"] for r in narrow] == ["a", "c"]


def test_pivot_loses_no_value(spark):
    sales = spark.createDataFrame([("A", "N", 1.0), ("A", "W", 2.0), ("A", None, 4.0)], "p string, r string, q double")
    assert by(agg.pivot_sum(sales, "p", "r", "q"), "p") == [{"p": "A", "N": 1.0, "W": 2.0}]
    with pytest.raises(Exception, match="not listed in r: W"):
        agg.pivot_sum(sales, "p", "r", "q", ["N"]).collect()


def test_statistics_joined_either_way(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    stats = rows.groupBy("k").agg(F.sum("v").alias("s"))
    small = by(join_statistics(rows, stats, ["k"]), "k", "v")
    monkeypatch.setattr("wharfline.functions.joins.SMALL_ROWS", 1)
    assert by(join_statistics(rows, stats, ["k"]), "k", "v") == small and len(small) == 3


@pytest.mark.parametrize(("order", "seasonal"), [((1, 1, 1), None), ((3, 0, 2), (1, 1, 1, 7)), ((0, 1, 0), None), ((2, 0, 0), None)])
def test_a_short_series_beside_a_long_one(spark, order, seasonal):
    days = [("long", i, float((i * 7919) % 13 + i * 0.1)) for i in range(160)] + [("short", i, float(i % 4)) for i in range(6)]
    panel = spark.createDataFrame(days, "k string, i int, y double").select(
        "k", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).cast("timestamp").alias("ds"), "y"
    )
    model = fc.fit_arima(panel, ["k"], order, seasonal)
    fits = {r["k"]: r["sigma2"] for r in by(model, "k")}
    assert set(fits) == {"long", "short"} and fits["long"] is not None
    ahead = fc.arima_forecast(model, ["k"], 5).groupBy("k").count()
    expected = {"long", *(["short"] if fits["short"] is not None else [])}
    assert {r["k"]: r["count"] for r in by(ahead, "k")} == dict.fromkeys(expected, 5)


def test_datasets_that_are_folders_are_found(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    files.save_data(frame, f"{tmp_path}/zone/first.csv")
    files.save_data(frame.limit(1), f"{tmp_path}/zone/second.csv")
    (tmp_path / "zone" / "third.csv").write_text("a,b\n7,z\n")
    found = {r["dataset"] for r in by(files.discover(spark, f"{tmp_path}/zone"))}
    counts = files.read_folder(spark, f"{tmp_path}/zone", "a int, b string").groupBy("dataset").count()
    assert found == {"first", "second", "third"}
    assert {r["dataset"]: r["count"] for r in by(counts)} == {"first": 2, "second": 1, "third": 1}


def test_gaps_do_not_shift_the_season(spark):
    """A weekly pattern without noise, every tenth day missing: the days ahead are right on the calendar."""
    days = [(i, float(10 * (i % 7) + 5)) for i in range(140) if i % 10 != 9]
    panel = spark.createDataFrame(days, "i int, y double").select(
        F.lit("a").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("ds"), "y"
    )
    ahead = by(fc.holt_winters_forecast(fc.fit_holt_winters(panel, ["k"], 7), ["k"], 7), "ds")
    start = dt.date(2024, 1, 1)
    for r in ahead:
        assert r["forecast"] == pytest.approx(10 * ((r["ds"] - start).days % 7) + 5, abs=0.05)


def test_gaps_are_filled_on_the_line(spark):
    rows = [("a", "2024-01-01", 1.0), ("a", "2024-01-04", 4.0), ("b", "2024-01-01", 2.0)]
    panel = spark.createDataFrame(rows, "k string, d string, y double").select("k", F.col("d").cast("date").alias("ds"), "y")
    assert [r["y"] for r in by(without_gaps(panel, ["k"]), "k", "ds")] == [1.0, 2.0, 3.0, 4.0, 2.0]
