"""Rule checks per row, expectations per table, reports, profiles and scores."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions.expressions import flag, numeric_columns, prefixed_id, ratio

# ---------------------------------------------------------------- row rules


@dataclass(frozen=True)
class Field:
    """One column of a row model: its type, whether it may be missing, and one constraint."""

    name: str
    type: str
    rule: str | None = None
    holds: Callable[[Column], Column] | None = None
    message: str = ""
    required: bool = True
    convert: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class CrossRule:
    """A condition on several columns, checked where all of them are valid; missing values pass."""

    name: str
    columns: tuple[str, ...]
    broken: Callable[[], Column]
    message: str


@dataclass(frozen=True)
class RowModel:
    name: str
    fields: tuple[Field, ...]
    cross: tuple[CrossRule, ...] = field(default=())


def _id(name: str, prefix: str) -> Field:
    return Field(name, "string", "id_format", lambda c: prefixed_id(c, prefix), f"must be {prefix} followed by digits")


def _positive(name: str, kind: str) -> Field:
    return Field(name, kind, "positive", lambda c: c > 0, "must be greater than 0")


def _not_negative(name: str, kind: str) -> Field:
    return Field(name, kind, "not_negative", lambda c: c >= 0, "must not be negative")


# Allowed order states and the score range.
ORDER_STATES = ["pending", "shipped", "delivered", "canceled"]
SCORE_RANGE = (0, 100)

PRODUCT = RowModel(
    "product",
    (
        _id("product_id", "P"),
        Field("product_name", "string"),
        Field("category", "string"),
        _positive("price", "double"),
        _positive("weight", "double"),
    ),
)
SUPPLIER = RowModel(
    "supplier",
    (
        _id("supplier_id", "S"),
        Field("supplier_name", "string"),
        Field("country", "string"),
        Field("reliability_score", "double", "score_range", lambda c: c.between(*SCORE_RANGE), "must be 0 to 100"),
        _not_negative("lead_time_days", "bigint"),
    ),
)
ORDER = RowModel(
    "order",
    (
        _id("order_id", "O"),
        Field("product_id", "string"),
        Field("supplier_id", "string"),
        _positive("quantity", "bigint"),
        Field("order_date", "timestamp"),
        Field("expected_delivery", "timestamp"),
        Field("actual_delivery", "timestamp", required=False),
        Field(
            "status",
            "string",
            "known_state",
            lambda c: F.lower(c).isin(ORDER_STATES),
            "must be one of " + ", ".join(ORDER_STATES),
            convert=F.lower,
        ),
    ),
    # The first broken date rule is reported.
    (
        CrossRule(
            "expected_after_order",
            ("order_date", "expected_delivery"),
            lambda: F.col("expected_delivery") < F.col("order_date"),
            "expected delivery is before the order date",
        ),
        CrossRule(
            "actual_after_order",
            ("order_date", "actual_delivery"),
            lambda: F.col("actual_delivery") < F.col("order_date"),
            "actual delivery is before the order date",
        ),
    ),
)
INVENTORY = RowModel(
    "inventory",
    (
        _id("inventory_id", "I"),
        Field("product_id", "string"),
        _id("warehouse_id", "W"),
        _not_negative("quantity", "bigint"),
        _not_negative("reorder_level", "bigint"),
        Field("last_restock_date", "timestamp"),
    ),
    (
        CrossRule(
            "reorder_within_twice_stock",
            ("quantity", "reorder_level"),
            lambda: F.col("reorder_level") > F.col("quantity") * 2,
            "reorder level is more than twice the quantity",
        ),
    ),
)
MODELS = {"products": PRODUCT, "suppliers": SUPPLIER, "orders": ORDER, "inventory": INVENTORY}


def validate_rows(df: DataFrame, model: RowModel) -> DataFrame:
    """Every row with ``record`` (its original values as json), ``errors`` and ``valid``.

    Columns take the types of the model. All errors of a row are listed as
    (rule, column, message); rules over several columns give at most one.
    """
    raw = {f.name: F.col(f.name) if f.name in df.columns else F.lit(None) for f in model.fields}
    typed = {f.name: raw[f.name].try_cast(f.type) for f in model.fields}
    staged = df.select(
        F.to_json(F.struct(*df.columns)).alias("record"),
        *[raw[f.name].isNull().alias(f"_missing_{f.name}") for f in model.fields],
        *[typed[f.name].alias(f.name) for f in model.fields],
    )

    def error(rule: str, column: str, message: str) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.lit(message).alias("message"))

    problems, bad = [], {}
    for f in model.fields:
        missing, value = F.col(f"_missing_{f.name}"), F.col(f.name)
        case = F.when(~missing & value.isNull(), error("type", f.name, f"must be {f.type}"))
        if f.required:
            case = case.when(missing, error("required", f.name, "must not be missing"))
        if f.holds is not None:
            case = case.when(value.isNotNull() & ~F.coalesce(f.holds(value), F.lit(False)), error(f.rule, f.name, f.message))
        problems.append(case)
        bad[f.name] = case.isNotNull()
    crossed = None
    for rule in model.cross:
        usable = reduce(lambda a, b: a & b, [~bad[c] for c in rule.columns])
        broken = usable & flag(rule.broken())
        hit = error(rule.name, "__row__", rule.message)
        crossed = F.when(broken, hit) if crossed is None else crossed.when(broken, hit)
    if crossed is not None:
        problems.append(crossed)
    checked = staged.withColumn("errors", F.filter(F.array(*problems), lambda e: e.isNotNull()))
    converted = {f.name: f.convert(F.col(f.name)) for f in model.fields if f.convert}
    return checked.withColumns({"valid": F.size("errors") == 0, **converted}).select(
        *[f.name for f in model.fields], "record", "errors", "valid"
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where("valid").drop("record", "errors", "valid")


def invalid_rows(checked: DataFrame) -> DataFrame:
    return checked.where("not valid").select("record", "errors")


def validation_counts(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count_if("valid").alias("valid_count"), F.count_if(~F.col("valid")).alias("invalid_count"))


def error_counts(checked: DataFrame) -> DataFrame:
    """Number of rows per broken rule."""
    return (
        checked.select(F.inline("errors"))
        .groupBy("rule", "column")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# ------------------------------------------------------------- expectations

Expectation = dict

# Names of the expectation types.
ORDERED_COLUMNS = "expect_table_columns_to_match_ordered_list"
NOT_NULL = "expect_column_values_to_not_be_null"
MATCH = "expect_column_values_to_match_regex"
UNIQUE = "expect_column_values_to_be_unique"
OF_TYPE = "expect_column_values_to_be_of_type"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"

TYPE_NAMES = {
    "float": (T.DoubleType, T.FloatType),
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "str": (T.StringType,),
    "bool": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def expect(kind: str, column: str | None = None, **kwargs) -> Expectation:
    return {"expectation_type": kind, "kwargs": ({"column": column} if column else {}) | kwargs}


# The four built-in suites.
SUITES: dict[str, list[Expectation]] = {
    "products": [
        expect(ORDERED_COLUMNS, column_list=["product_id", "product_name", "category", "price", "weight"]),
        expect(NOT_NULL, "product_id"),
        expect(MATCH, "product_id", regex=r"^P\d+$"),
        expect(UNIQUE, "product_id"),
        expect(NOT_NULL, "product_name"),
        expect(OF_TYPE, "price", type_="float"),
        expect(BETWEEN, "price", min_value=0, strict_min=True),
    ],
    "suppliers": [
        expect(
            ORDERED_COLUMNS,
            column_list=["supplier_id", "supplier_name", "country", "reliability_score", "lead_time_days"],
        ),
        expect(NOT_NULL, "supplier_id"),
        expect(MATCH, "supplier_id", regex=r"^S\d+$"),
        expect(UNIQUE, "supplier_id"),
        expect(BETWEEN, "reliability_score", min_value=0, max_value=100),
        expect(BETWEEN, "lead_time_days", min_value=0),
    ],
    "orders": [
        expect(
            ORDERED_COLUMNS,
            column_list=[
                "order_id", "product_id", "supplier_id", "quantity", "order_date", "expected_delivery",
                "actual_delivery", "status",
            ],
        ),
        expect(NOT_NULL, "order_id"),
        expect(MATCH, "order_id", regex=r"^O\d+$"),
        expect(UNIQUE, "order_id"),
        expect(IN_SET, "status", value_set=["pending", "shipped", "delivered", "canceled"]),
        expect(BETWEEN, "quantity", min_value=0, strict_min=True),
    ],
    "inventory": [
        expect(
            ORDERED_COLUMNS,
            column_list=[
                "inventory_id", "product_id", "warehouse_id", "quantity", "reorder_level", "last_restock_date",
            ],
        ),
        expect(NOT_NULL, "inventory_id"),
        expect(MATCH, "inventory_id", regex=r"^I\d+$"),
        expect(UNIQUE, "inventory_id"),
        expect(MATCH, "warehouse_id", regex=r"^W\d+$"),
        expect(BETWEEN, "quantity", min_value=0),
        expect(BETWEEN, "reorder_level", min_value=0),
    ],
}


def _unexpected(kind: str, kwargs: dict) -> Column:
    """Condition of an unexpected value; missing values are only wrong where they are forbidden."""
    value = F.col(kwargs["column"])
    if kind == NOT_NULL:
        return value.isNull()
    if kind == MATCH:
        return ~value.cast("string").rlike(kwargs["regex"])
    if kind == IN_SET:
        return ~value.isin(kwargs["value_set"])
    if kind == BETWEEN:
        wrong = F.lit(False)
        if kwargs.get("min_value") is not None:
            low = F.lit(kwargs["min_value"])
            wrong = wrong | (value <= low if kwargs.get("strict_min") else value < low)
        if kwargs.get("max_value") is not None:
            high = F.lit(kwargs["max_value"])
            wrong = wrong | (value >= high if kwargs.get("strict_max") else value > high)
        return wrong
    raise ValueError(f"unknown expectation: {kind}")


def validate_dataset(df: DataFrame, expectations: Sequence[Expectation], dataset: str = "dataset") -> DataFrame:
    """One row per expectation: success, checked values and unexpected values.

    All value checks share one aggregation over the table; each uniqueness check
    adds a count per value.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    results = []
    for i, item in enumerate(expectations):
        kind, kwargs = item["expectation_type"], item["kwargs"]
        column = kwargs.get("column")
        elements, wrong, holds = F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), None
        if column is not None and column not in df.columns:
            holds = F.lit(False)
        elif kind == ORDERED_COLUMNS:
            holds = F.lit(df.columns == list(kwargs["column_list"]))
        elif kind == OF_TYPE:
            holds = F.lit(isinstance(df.schema[column].dataType, TYPE_NAMES[kwargs["type_"]]))
        elif kind == UNIQUE:
            copies = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            sums = copies.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("elements"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("wrong"),
            )
            both = sums.select(F.struct("elements", "wrong")).scalar()
            elements, wrong = both.getField("elements"), both.getField("wrong")
        else:
            aggregates.append(F.count_if(flag(_unexpected(kind, kwargs))).alias(f"_wrong{i}"))
            wrong = F.col(f"_wrong{i}")
            if kind == NOT_NULL:
                elements = F.col("rows")
            else:
                aggregates.append(F.count(column).alias(f"_n{i}"))
                elements = F.col(f"_n{i}")
        results.append(
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(i).alias("position"),
                F.lit(kind).alias("expectation_type"),
                F.lit(column).cast("string").alias("column"),
                F.lit(json.dumps(kwargs)).alias("kwargs"),
                (holds if holds is not None else wrong == 0).alias("success"),
                elements.alias("element_count"),
                wrong.alias("unexpected_count"),
                (ratio(wrong, elements) * 100).alias("unexpected_percent"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*results)))


def quality_report(results: DataFrame) -> DataFrame:
    """One row per dataset: success, totals, failure percentage and the failed expectations."""
    failed = F.array_sort(
        F.collect_list(F.when(~F.col("success"), F.struct("position", "expectation_type", "kwargs")))
    )
    return (
        results.groupBy("dataset")
        .agg(
            F.bool_and("success").alias("success"),
            F.count(F.lit(1)).alias("total_expectations"),
            F.count_if("success").alias("passed_expectations"),
            failed.alias("failed_expectations"),
        )
        .withColumn(
            "failure_percent",
            ratio(F.col("total_expectations") - F.col("passed_expectations"), F.col("total_expectations")) * 100,
        )
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """One row over all datasets of a report; 0 percent without expectations."""
    return report.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if("success").alias("passed_datasets"),
        F.coalesce(F.sum("total_expectations"), F.lit(0)).alias("total_expectations"),
        F.coalesce(F.sum("passed_expectations"), F.lit(0)).alias("passed_expectations"),
        F.coalesce(ratio(F.sum("passed_expectations"), F.sum("total_expectations")) * 100, F.lit(0.0)).alias(
            "success_percentage"
        ),
    )


# ----------------------------------------------------- profiles and scores


def _spelling(df: DataFrame, column: str) -> Column:
    """A text per value, equal where values are."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return value.cast("string")


def distinct_counts(df: DataFrame) -> DataFrame:
    """One row: ``distinct``, a map from a column's position to how many different values it has.

    A row becomes a narrow pair of position and value per column, and equal pairs
    are combined before they are shuffled; counting all columns in one
    aggregate would copy every row whole, once per column.
    """
    pairs = [F.struct(F.lit(i).alias("position"), _spelling(df, c).alias("value")) for i, c in enumerate(df.columns)]
    values = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    counts = values.groupBy("position").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.map_from_entries(F.collect_list(F.struct("position", "n"))).alias("distinct"))  # a row per column


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: type, missing and distinct values, and for numbers min, max, mean, deviation.

    Distinct counts are exact unless ``approximate`` asks for sketches.
    """
    numbers = set(numeric_columns(df))
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"_null{i}"))
        if approximate:
            aggregates.append(F.approx_count_distinct(c).alias(f"_distinct{i}"))
        if c in numbers:
            aggregates += [
                F.min(c).cast("double").alias(f"_min{i}"),
                F.max(c).cast("double").alias(f"_max{i}"),
                F.avg(c).alias(f"_mean{i}"),
                F.stddev_samp(c).alias(f"_std{i}"),
            ]
    one = df.agg(*aggregates)
    if not approximate:
        exact = distinct_counts(df).scalar()
        one = one.withColumns({f"_distinct{i}": F.coalesce(F.try_element_at(exact, F.lit(i)), F.lit(0)) for i in range(len(df.columns))})
    nothing = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("row_count"),
            F.col(f"_null{i}").alias("null_count"),
            F.col(f"_distinct{i}").alias("unique_count"),
            (F.col(f"_min{i}") if c in numbers else nothing).alias("min"),
            (F.col(f"_max{i}") if c in numbers else nothing).alias("max"),
            (F.col(f"_mean{i}") if c in numbers else nothing).alias("mean"),
            (F.col(f"_std{i}") if c in numbers else nothing).alias("std"),
        )
        for i, c in enumerate(df.columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def dimension_scores(df: DataFrame, rules: dict[str, Sequence[Column]]) -> DataFrame:
    """Score per dimension (completeness, accuracy, consistency, timeliness, ...): the mean share of rows meeting its rules."""
    scores = [
        F.struct(
            F.lit(name).alias("metric"),
            (sum((F.avg(flag(c).cast("double")) for c in conditions), F.lit(0.0)) / F.lit(float(len(conditions)))).alias(
                "score"
            ),
        )
        for name, conditions in rules.items()
    ]
    return df.agg(F.array(*scores).alias("s")).select(F.inline("s"))


def completeness_rules(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    return [F.col(c).isNotNull() for c in (columns or df.columns)]


# -------------------------------------------------------------- whole runs


def validate_folder(
    spark: SparkSession, paths: Sequence[str], report_folder: str | None = None, infer: bool = True
) -> tuple[DataFrame | None, dict[str, DataFrame]]:
    """Check every dataset of a list of files: known names by suite and row model, others by a profile.

    Returns the report over the known datasets (None without any) and the row
    checks or profiles by dataset name. With a folder, everything is also written as json,
    the details gzipped.
    """
    from wharfline.sources.files import dataset_name, load_dataset, save_report
    from wharfline.sources import schemas

    declared = {
        "products": schemas.PRODUCTS, "suppliers": schemas.SUPPLIERS, "orders": schemas.ORDERS,
        "inventory": schemas.INVENTORY,
    }
    results, details = [], {}
    for path in paths:
        name = dataset_name(path)
        df = load_dataset(spark, path, None if infer else declared.get(name))
        if name in SUITES:
            results.append(validate_dataset(df, SUITES[name], name))
            details[name] = validate_rows(df, MODELS[name])
        else:
            details[name] = profile(df)
    report = quality_report(reduce(DataFrame.unionByName, results)) if results else None
    if report_folder:
        for name, df in details.items():
            kept = invalid_rows(df) if name in MODELS else df
            kind = "invalid" if name in MODELS else "profile"
            # Broken rows may be most of the data, each with its record and its errors in words.
            save_report(kept, f"{report_folder.rstrip('/')}/{name}_{kind}.json", "gzip")
        if report is not None:
            save_report(report, f"{report_folder.rstrip('/')}/data_quality_report.json")
    return report, details
