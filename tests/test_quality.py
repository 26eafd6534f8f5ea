import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from row_helpers import by

from wharfline.functions.durable import scratch_path
from wharfline.operators import catalog, quality
from wharfline.sources import files, schemas


def errors(df, model):
    return [
        [(e["rule"], e["column"]) for e in r["errors"]]
        for r in quality.validate_rows(df, model).orderBy(model.fields[0].name).collect()
    ]


def test_product_rules(spark):
    rows = [
        ("P1", "bolt", "metal", 2.0, 1.0), ("P2", None, "metal", 0.0, 1.0), ("P3x", "nut", "metal", -1.0, 0.0),
    ]
    df = spark.createDataFrame(rows, schemas.PRODUCTS)
    assert errors(df, quality.PRODUCT) == [
        [], [("required", "product_name"), ("positive", "price")],
        [("id_format", "product_id"), ("positive", "price"), ("positive", "weight")],
    ]
    checked = quality.validate_rows(df, quality.PRODUCT)
    assert quality.valid_rows(checked).columns == df.columns and quality.valid_rows(checked).count() == 1
    bad = quality.invalid_rows(checked).collect()
    assert len(bad) == 2 and json.loads(bad[0]["record"])["category"] == "metal"
    assert quality.validation_counts(checked).first().asDict() == {"valid_count": 1, "invalid_count": 2}
    assert {(r["rule"], r["column"]): r["rows"] for r in by(quality.error_counts(checked))}[("positive", "price")] == 2


def test_types_missing_columns_and_ranges(spark):
    df = spark.createDataFrame(
        [("S1", "a", "x", "50", "3"), ("S2", "b", "x", "abc", "-1"), ("S3", "c", "x", "101", None)],
        "supplier_id string, supplier_name string, country string, reliability_score string, lead_time_days string",
    )
    assert errors(df, quality.SUPPLIER) == [
        [], [("type", "reliability_score"), ("not_negative", "lead_time_days")],
        [("score_range", "reliability_score"), ("required", "lead_time_days")],
    ]
    assert errors(df.drop("country"), quality.SUPPLIER)[0] == [("required", "country")]


def test_order_rules(spark):
    rows = [
        ("O1", "P1", "S1", 1, "2023-01-02", "2023-01-05", None, "Shipped"),
        ("O2", "P1", "S1", 0, "2023-01-02", "2023-01-01", "2023-01-01", "lost"),
        ("O3", "P1", "S1", 1, "2023-01-02", "2023-01-05", "2023-01-01", "canceled"),
        ("O4", "P1", "S1", 1, None, "2023-01-01", "2023-01-01", "pending"),
    ]
    text = schemas.ORDERS.replace("timestamp", "string")
    df = spark.createDataFrame(rows, text)
    assert errors(df, quality.ORDER) == [
        [],
        [("positive", "quantity"), ("known_state", "status"), ("expected_after_order", "__row__")],
        [("actual_after_order", "__row__")],
        [("required", "order_date")],
    ]
    assert quality.validate_rows(df, quality.ORDER).orderBy("order_id").first()["status"] == "shipped"


def test_inventory_cross_rule_only_for_valid_fields(spark):
    rows = [("I1", "P1", "W1", 5, 10, "2023-01-01"), ("I2", "P1", "W1", 5, 11, "2023-01-01"), ("I3", "P1", "X1", -1, 11, "2023-01-01")]
    df = spark.createDataFrame(rows, schemas.INVENTORY.replace("timestamp", "string"))
    assert errors(df, quality.INVENTORY) == [
        [], [("reorder_within_twice_stock", "__row__")], [("id_format", "warehouse_id"), ("not_negative", "quantity")],
    ]


def test_expectations(spark):
    df = spark.createDataFrame(
        [("P1", "a", "x", 1.0, 1.0), ("P1", None, "x", 0.0, 1.0), ("Q2", "c", "x", None, 1.0), (None, "d", "x", 2.0, 1.0)],
        schemas.PRODUCTS,
    )
    rows = by(quality.validate_dataset(df, quality.SUITES["products"], "products"), "position")
    assert [(r["success"], r["unexpected_count"]) for r in rows] == [
        (True, None), (False, 1), (False, 1), (False, 2), (False, 1), (True, None), (False, 1),
    ]
    assert rows[2]["element_count"] == 3 and rows[1]["element_count"] == 4
    report = quality.quality_report(quality.validate_dataset(df, quality.SUITES["products"], "products")).first()
    assert (report["total_expectations"], report["passed_expectations"], report["success"]) == (7, 2, False)
    assert len(report["failed_expectations"]) == 5 and report["failure_percent"] == pytest.approx(500 / 7)


def test_other_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (5, "B"), (None, "c")], "n int, s string")
    suite = [
        quality.expect(quality.BETWEEN, "n", min_value=1, max_value=5),
        quality.expect(quality.BETWEEN, "n", max_value=5, strict_max=True),
        quality.expect(quality.IN_SET, "s", value_set=["a", "b", "c"]),
        quality.expect(quality.OF_TYPE, "n", type_="float"),
        quality.expect(quality.NOT_NULL, "absent"),
        quality.expect(quality.ORDERED_COLUMNS, column_list=["s", "n"]),
    ]
    rows = by(quality.validate_dataset(df, suite), "position")
    assert [r["success"] for r in rows] == [True, False, False, False, False, False]
    with pytest.raises(ValueError):
        quality.validate_dataset(df, [quality.expect("expect_magic", "n")])


def test_profile_and_scores(spark):
    df = spark.createDataFrame([(1, "a"), (3, "a"), (None, None)], "n int, s string")
    rows = by(quality.profile(df), "position")
    assert (rows[0]["null_count"], rows[0]["unique_count"], rows[0]["min"], rows[0]["max"], rows[0]["mean"]) == (1, 2, 1.0, 3.0, 2.0)
    assert rows[1]["unique_count"] == 1 and rows[1]["min"] is None
    scores = {r["metric"]: r["score"] for r in by(quality.dimension_scores(df, {"completeness": quality.completeness_rules(df)}))}
    assert scores["completeness"] == pytest.approx(2 / 3)


def test_catalog(spark):
    df = spark.createDataFrame([(1, "a"), (3, None)], "n int, s string")
    one = catalog.register_from_dataframe(df, "one", "One", "first", "/one", ["x", "y"], {"k": "v"})
    two = catalog.register_from_dataframe(df.select("n"), "two", "Two", "second", "/two", ["x"])
    entries = one.unionByName(two)
    assert [r["dataset_id"] for r in by(catalog.list_datasets(entries, ["y", "x"]))] == ["one"]
    assert catalog.list_datasets(entries).count() == 2
    path = scratch_path(spark, "dictionary")
    rows = by(catalog.data_dictionary(entries, path), "dataset_id", "column_name")
    assert [(r["dataset_id"], r["column_name"], r["nullable"], r["unique_count"]) for r in rows] == [
        ("one", "n", False, 2), ("one", "s", True, 1), ("two", "n", False, 2),
    ]
    assert spark.read.option("header", True).csv(path).count() == 3


def test_folder_run(spark):
    base = scratch_path(spark, "folder")
    files.save_data(spark.createDataFrame([("P1", "a", "x", 1.5, 1.0)], schemas.PRODUCTS), f"{base}/products.csv")
    files.save_data(spark.createDataFrame([(1, 2)], "a int, b int"), f"{base}/other.csv")
    report, details = quality.validate_folder(spark, [f"{base}/products.csv", f"{base}/other.csv"], f"{base}/report")
    assert report.first()["success"] and set(details) == {"products", "other"}
    assert details["products"].where("valid").count() == 1
    assert spark.read.json(f"{base}/report/other_profile.json").count() == 2
    assert spark.read.json(f"{base}/report/data_quality_report.json").first()["dataset"] == "products"
    with pytest.raises(FileNotFoundError):
        files.load_dataset(spark, f"{base}/none.csv")


def test_broken_rows_of_a_folder_are_written_compressed(spark, tmp_path):
    path = files.save_data(spark.createDataFrame([("bad", "a", "x", -1.5, 1.0)], schemas.PRODUCTS), f"{tmp_path}/products.parquet")
    quality.validate_folder(spark, [path], f"{tmp_path}/report")
    parts = list((tmp_path / "report/products_invalid.json").glob("part-*"))
    assert parts and all(p.name.endswith(".json.gz") for p in parts)
    broken = spark.read.json(f"{tmp_path}/report/products_invalid.json").first()
    assert "bad" in broken["record"] and len(broken["errors"]) == 2


def test_distinct_counts_of_every_type(spark):
    rows = [
        (1, 0.0, "a", True, b"x", [1, 2], (1, "p"), dt.datetime(2023, 1, 1), None),
        (1, -0.0, "a", False, b"y", [1, 2], (1, "q"), dt.datetime(2023, 1, 1, 1), None),
        (2, float("nan"), "A", None, b"x", [2, 1], (1, "p"), None, None),
        (None, None, "", True, None, None, None, dt.datetime(2023, 1, 1), None),
    ]
    schema = "i int, d double, s string, b boolean, r binary, l array<int>, t struct<a: int, b: string>, w timestamp, n string"
    df = spark.createDataFrame(rows, schema)
    counts = {r["column_name"]: r["unique_count"] for r in quality.profile(df).collect()}
    built_in = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert counts == built_in and counts["d"] == 2 and counts["n"] == 0
    assert {r["unique_count"] for r in quality.profile(df.limit(0)).collect()} == {0}
    assert "Expand" not in quality.profile(df)._jdf.queryExecution().executedPlan().toString()
