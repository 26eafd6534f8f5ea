import datetime as dt
import math

import pytest
from row_helpers import by
from pyspark.sql import functions as F

from wharfline.functions import dates, expressions as ex
from wharfline.functions.normal import normal_quantile, service_factor


def test_elapsed_days_counts_spans_not_calendar_days(spark):
    df = spark.sql(
        "select timestamp'2023-01-01 23:00:00' a, timestamp'2023-01-02 01:00:00' b, timestamp'2023-01-03 22:00:00' c"
    )
    row = df.select(
        ex.elapsed_days("a", "b").alias("ab"), ex.elapsed_days("b", "a").alias("ba"), ex.elapsed_days("c", "a").alias("ca"),
        ex.elapsed_days("a", F.lit(None)).alias("none"),
    ).first()
    assert (row["ab"], row["ba"], row["ca"], row["none"]) == (0, -1, -2, None)


def test_missing_values_and_zero_division(spark):
    df = ex.nan_to_null(spark.createDataFrame([(float("nan"), 0.0), (4.0, 2.0)], "a double, b double"))
    rows = df.select("a", ex.flag(F.col("a") > 2).alias("f"), ex.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [tuple(r) for r in rows] == [(None, False, None), (4.0, True, 2.0)]
    assert df.select(ex.ratio(F.lit(1), F.lit(0)).alias("r")).first()["r"] is None


def test_small_expressions(spark):
    row = spark.range(1).select(
        ex.clamp(F.lit(-3), low=1).alias("low"),
        ex.clamp(F.lit(0.9), high=0.5).alias("high"),
        ex.clamp(F.lit(None).cast("int"), low=1).alias("none"),
        ex.map_values(F.lit("b"), {"a": 1, "b": 2}).alias("found"),
        ex.map_values(F.lit("x"), {"a": 1}, default=9).alias("lost"),
        ex.prefixed_id(F.lit("P12"), "P").alias("good"),
        ex.prefixed_id(F.lit("P"), "P").alias("short"),
        ex.label_id(F.lit("17 - Acme")).alias("id"),
        ex.label_id(F.lit("Acme")).alias("no_id"),
        ex.round_half_even(F.lit(2.5)).alias("even"),
        ex.has_all_tags(F.array(F.lit("a"), F.lit("b")), ["b"]).alias("tagged"),
        ex.has_all_tags(F.array(F.lit("a")), ["a", "c"]).alias("untagged"),
        ex.linspace(F.lit(1.0), F.lit(2.0), 3).alias("line"),
        ex.linspace(F.lit(1.0), F.lit(2.0), 1).alias("point"),
    ).first()
    assert (row["low"], row["high"], row["none"], row["found"], row["lost"]) == (1, 0.5, None, 2, 9)
    assert (row["good"], row["short"], row["id"], row["no_id"], row["even"]) == (True, False, 17, None, 2.0)
    assert (row["tagged"], row["untagged"], row["line"], row["point"]) == (True, False, [1.0, 1.5, 2.0], [1.0])


def test_fiscal_year_and_flags(spark):
    df = spark.createDataFrame([("2023-03-31",), ("2023-04-01",), (None,)], "d string")
    rows = df.select(
        dates.fiscal_year("d").alias("april"), dates.fiscal_year("d", 1).alias("january"),
        *[c.alias(n) for n, c in dates.boundary_flags("d", "d").items()],
    ).collect()
    assert [r["april"] for r in rows] == [2023, 2024, None]
    assert [r["january"] for r in rows] == [2024, 2024, None]
    assert [r["d_is_quarter_end"] for r in rows] == [True, False, False]
    assert [r["d_is_month_start"] for r in rows] == [False, True, False]


@pytest.mark.parametrize(
    "freq, expected",
    [
        ("D", ["2023-01-30", "2023-01-31", "2023-02-01"]),
        ("W", []),
        ("M", ["2023-01-31"]),
        ("Q", []),
    ],
)
def test_short_date_ranges(spark, freq, expected):
    rows = dates.date_range(spark, "2023-01-30", "2023-02-01", freq).collect()
    assert [r["date"].isoformat() for r in rows] == expected


def test_long_date_ranges(spark):
    weeks = [r["date"] for r in dates.date_range(spark, "2023-01-01", "2023-01-31", "W").collect()]
    assert weeks == [dt.date(2023, 1, d) for d in (1, 8, 15, 22, 29)]
    quarters = [r["date"] for r in dates.date_range(spark, "2023-02-01", "2023-12-31", "Q").collect()]
    assert quarters == [dt.date(2023, 3, 31), dt.date(2023, 6, 30), dt.date(2023, 9, 30), dt.date(2023, 12, 31)]


def test_normal_quantile(spark):
    assert math.isclose(normal_quantile(0.95), 1.6448536269514722, rel_tol=1e-12)
    with pytest.raises(ValueError):
        normal_quantile(1.0)
    df = spark.createDataFrame([(0.5,), (0.95,), (1.5,), (None,)], "level double")
    values = [r["z"] for r in df.select(service_factor(F.col("level")).alias("z")).collect()]
    assert values[0] == pytest.approx(0.0) and values[1] == pytest.approx(1.6448536269514722) and values[2:] == [None, None]


def test_key_helpers(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert by(ex.drop_null_keys(df, ["k"]), "v") == [{"k": "a", "v": 1}]
    with pytest.raises(ValueError):
        ex.require_columns(df, ["missing"])
