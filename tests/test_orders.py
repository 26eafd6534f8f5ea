import datetime as dt

import numpy as np
import pandas as pd
import pytest
from row_helpers import by

from wharfline.operators.cleaning import clean_data, fill_missing, parse_date_columns
from wharfline.operators.leadtimes import aggregate_metrics, calculate_lead_times, calculate_order_statistics

ORDERS = "order_id bigint, product_id bigint, order_date timestamp, delivery_date timestamp, quantity double, price double, region string"


@pytest.fixture(scope="module")
def seeded():
    """Fifty days of orders plus a repeated day, with gaps."""
    rng = np.random.default_rng(42)
    days = [dt.datetime(2023, 1, 1) + dt.timedelta(days=i) for i in range(50)] + [dt.datetime(2023, 1, 11)]
    rows = []
    for i, day in enumerate(days):
        delivery = None if i == 5 else day + dt.timedelta(days=int(rng.integers(1, 10)))
        rows.append(
            (
                1000 + i, int(rng.integers(1, 20)), day, delivery, None if i == 3 else float(rng.integers(1, 100)),
                float(rng.uniform(10, 1000)), None if i == 7 else str(rng.choice(["North", "South", "East", "West"])),
            )
        )
    return rows


def test_cleaning_fills_gaps(spark, seeded):
    frame = pd.DataFrame(seeded, columns=[c.split()[0] for c in ORDERS.split(", ")])
    rows = by(clean_data(spark.createDataFrame(seeded, ORDERS)), "order_id")
    assert len(rows) == 51
    assert rows[3]["quantity"] == frame["quantity"].median()
    assert rows[7]["region"] == sorted(frame["region"].dropna().mode())[0]
    assert rows[5]["delivery_date"] is None  # a date column is not filled


def test_duplicates_go_and_date_texts_are_filled_before_parsing(spark):
    schema = "order_id string, order_date string, delivery_date string, quantity int"
    rows = [
        ("ORD123", "2023-01-01", "2023-01-05", 5), ("ORD124", "2023-01-02", "2023-01-08", 10),
        ("ORD125", "2023-01-03", "2023-01-09", 15), ("ORD126", "2023-01-04", "2023-01-10", 20),
        ("ORD127", "2023-01-05", "2023-01-12", 25), ("ORD128", "2023-01-06", None, 30),
    ]
    scored = by(calculate_lead_times(clean_data(spark.createDataFrame(rows + rows[:1], schema))), "order_id")
    assert [r["lead_time"] for r in scored] == [4, 6, 6, 6, 7, -1]
    assert [r["lead_time_error"] for r in scored] == [False] * 5 + [True]


def test_filled_integers_become_double_and_unknown_is_the_last_resort(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "n int, t string")
    rows = by(fill_missing(df), "n")
    assert [r["n"] for r in rows] == [1.0, 1.5, 2.0] and {r["t"] for r in rows} == {"Unknown"}


def test_date_columns_of_any_type(spark):
    df = spark.createDataFrame([("2023-05-01", "nonsense", 1_000_000_000)], "Due_Date string, date2 string, update_ns bigint")
    row = parse_date_columns(df).first()
    assert row["Due_Date"] == dt.datetime(2023, 5, 1) and row["date2"] is None
    assert row["update_ns"] == dt.datetime(1970, 1, 1, 0, 0, 1)


def test_region_scores(spark, seeded):
    scored = by(calculate_lead_times(clean_data(spark.createDataFrame(seeded, ORDERS))), "order_id")
    frame = pd.DataFrame(scored)
    for region, group in frame.groupby("region"):
        lead = group["lead_time"].astype(float)
        assert group["mean"].iloc[0] == pytest.approx(lead.mean())
        assert group["median"].iloc[0] == pytest.approx(lead.median())
        assert group["std"].iloc[0] == pytest.approx(lead.std())
        expected = (lead - lead.mean()) / lead.std()
        np.testing.assert_allclose(group["lead_time_z_score"].astype(float), expected, rtol=1e-9)
    missing = frame[frame["lead_time"].isna()]
    assert not missing["lead_time_error"].any() and not missing["lead_time_anomaly"].any()


def test_no_spread_scores_zero_and_missing_region_drops_out(spark):
    rows = [(1, "2023-01-01", "2023-01-04", "A"), (2, "2023-01-01", "2023-01-04", "A"), (3, "2023-01-01", "2023-01-05", None)]
    df = parse_date_columns(spark.createDataFrame(rows, "order_id int, order_date string, delivery_date string, region string"))
    scored = by(calculate_lead_times(df), "order_id")
    assert [r["order_id"] for r in scored] == [1, 2] and {r["lead_time_z_score"] for r in scored} == {0.0}


def test_daily_metrics(spark, seeded):
    scored = calculate_lead_times(clean_data(spark.createDataFrame(seeded, ORDERS)))
    frame = scored.toPandas()
    for row in by(aggregate_metrics(scored), "order_date"):
        group = frame[frame["order_date"].dt.date == row["order_date"]]
        assert row["quantity_sum"] == pytest.approx(group["quantity"].sum())
        assert row["lead_time_count"] == group["lead_time"].count()
    assert aggregate_metrics(spark.createDataFrame([(1,)], "x int")).count() == 0


def test_order_statistics(spark, seeded):
    df = spark.createDataFrame(seeded, ORDERS)
    frame = pd.DataFrame(seeded, columns=df.columns)
    rows = by(calculate_order_statistics(df), "order_id")
    assert len(rows) == len(frame)
    for row in rows:
        group = frame[frame["product_id"] == row["product_id"]]
        assert row["order_count"] == len(group)
        assert row["price_median"] == pytest.approx(group["price"].median())
        if len(group) == 1:
            assert row["price_std"] is None
    only = spark.createDataFrame([(1, 2)], "order_id int, product_id int")
    assert calculate_order_statistics(only).columns == ["product_id", "order_id", "order_count"]
    assert calculate_order_statistics(only.drop("product_id")).columns == ["order_id"]
