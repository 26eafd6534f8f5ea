import math

import pytest
from row_helpers import by

from wharfline.functions.normal import normal_quantile
from wharfline.operators import inventory as inv
from wharfline.sources.schemas import ITEM_PARAMETERS

ITEMS = [
    ("A", 10.0, 2.0, 5.0, 1.0, 2.0, 5.0, 100.0),
    ("B", 4.0, 1.0, 10.0, 0.0, 1.0, 5.0, 50.0),
    ("C", 1.0, 0.5, 3.0, 1.0, 0.0, 5.0, 20.0),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, ITEM_PARAMETERS)


def test_validation(spark, items):
    assert inv.validate_items(items).count() == 3
    with pytest.raises(ValueError, match="missing"):
        inv.validate_items(items.drop("order_cost"))
    with pytest.raises(ValueError, match="numeric"):
        inv.validate_items(items.withColumn("order_cost", items["order_cost"].cast("string")))
    with pytest.raises(ValueError, match="lead_time_std"):
        inv.validate_items(spark.createDataFrame([(*ITEMS[0][:4], -1.0, *ITEMS[0][5:])], ITEM_PARAMETERS))
    assert inv.validate_items(spark.createDataFrame([("A", -1.0, -2.0, *ITEMS[0][3:])], ITEM_PARAMETERS)).count() == 1


def test_order_quantity(items):
    rows = {r["item_id"]: r["eoq"] for r in by(inv.calculate_eoq(items))}
    assert rows["A"] == pytest.approx(math.sqrt(2 * 3650 * 100 / 2)) and rows["C"] is None
    assert inv.calculate_eoq(items, "B").count() == 1
    with pytest.raises(ValueError, match="not found"):
        inv.calculate_eoq(items, "Z")


def test_safety_stock_and_reorder_point(items):
    spread = math.sqrt(5 * 4 + 100 * 1)
    for level in (0.9, 0.95):
        z = normal_quantile(level)
        assert inv.calculate_safety_stock(items, level, "A").first()["safety_stock"] == pytest.approx(z * spread)
        assert inv.calculate_reorder_point(items, level, "A").first()["reorder_point"] == pytest.approx(50 + z * spread)
    with pytest.raises(ValueError):
        inv.calculate_safety_stock(items, 1.0)


def test_abc(spark, items):
    rows = by(inv.abc_analysis(items), "item_id")
    assert [r["abc_category"] for r in rows] == ["A", "B", "C"]
    assert [r["cumulative_value"] for r in rows] == [10.0, 14.0, 15.0]
    big = spark.createDataFrame([("x", 90.0), ("y", 4.0), ("z", 6.0)], "item_id string, demand_mean double")
    assert [r["abc_category"] for r in by(inv.abc_analysis(big), "item_id")] == ["B", "C", "C"]
    with pytest.raises(ValueError):
        inv.abc_analysis(items, a_limit=0.9, b_limit=0.8)
    assert {r["abc_category"]: r["items"] for r in by(inv.category_counts(inv.abc_analysis(items)))} == {"A": 1, "B": 1, "C": 1}


def test_total_costs(spark, items):
    given = spark.createDataFrame([("A", 100)], "item_id string, quantity int")
    rows = by(inv.calculate_total_costs(items, given))
    assert len(rows) == 1 and rows[0]["total_cost"] == pytest.approx(3650 / 100 * 100 + 50 * 2)
    optimal = {r["item_id"]: r for r in by(inv.calculate_total_costs(items))}
    assert optimal["A"]["annual_ordering_cost"] == pytest.approx(optimal["A"]["annual_holding_cost"])


def test_sensitivity(items):
    rows = by(inv.sensitivity(items, "lead_time_mean", "A"), "step")
    assert len(rows) == 10 and rows[0]["parameter_value"] == pytest.approx(3.5) and rows[9]["parameter_value"] == pytest.approx(6.5)
    expected = 10 * 3.5 + normal_quantile(0.95) * math.sqrt(3.5 * 4 + 100)
    assert rows[0]["reorder_point"] == pytest.approx(expected)
    assert {r["eoq"] for r in rows} == {rows[0]["eoq"]}
    assert inv.sensitivity(items, "demand_mean").count() == 30
    assert by(inv.sensitivity(items, "demand_mean", "A", steps=1))[0]["parameter_value"] == pytest.approx(7.0)


def test_policy_from_rows(spark):
    df = spark.createDataFrame([("p", 10.0, 2.0), ("p", 14.0, 4.0), (None, 1.0, 1.0)], "k string, demand double, lead_time double")
    row = inv.policy_from_rows(df, ["k"]).first()
    spread = math.sqrt(3 * 8 + 144 * 2)
    assert row["safety_stock"] == pytest.approx(normal_quantile(0.95) * spread)
    assert row["reorder_point"] == pytest.approx(36 + normal_quantile(0.95) * spread)
