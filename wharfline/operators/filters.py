"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.functions.expressions import as_column, drop_null_keys, label_id

ALL = "All"


def dashboard_filter(
    df: DataFrame,
    region: str | None = None,
    product: str | None = None,
    supplier: str | int | None = None,
    start: str | None = None,
    end: str | None = None,
    date: str = "date",
    supplier_column: str = "supplier",
) -> DataFrame:
    """Equality on the given dimensions and a closed date range; what is not given does not filter.

    ``All`` counts as not given. The range applies only when both ends are given.
    """
    out = df
    for column, wanted in (("region", region), ("product", product), (supplier_column, supplier)):
        if wanted is not None and wanted != ALL:
            out = out.where(F.col(column) == F.lit(wanted))
    if start is not None and end is not None:
        kind = df.schema[date].dataType
        out = out.where(F.col(date).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))
    return out


def star_filter(
    orders: DataFrame,
    inventory: DataFrame,
    shipments: DataFrame,
    region: str = ALL,
    product: str = ALL,
    supplier: str = ALL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Filter the three tables together.

    A supplier comes as ``"id - name"`` and applies to orders; shipments follow
    the orders that are left.
    """
    picked, stock = orders, inventory
    if region != ALL:
        picked, stock = picked.where(F.col("region") == region), stock.where(F.col("region") == region)
    if product != ALL:
        picked, stock = picked.where(F.col("product") == product), stock.where(F.col("product") == product)
    if supplier != ALL:
        picked = picked.where(F.col("supplier_id") == label_id(F.lit(supplier)))
    moved = shipments.join(picked.select("order_id"), "order_id", "left_semi")
    return picked, stock, moved


def latest_value(df: DataFrame, date: str = "date") -> Column:
    """The latest date of a frame as a scalar."""
    return df.agg(F.max(date)).scalar()


def last_days(df: DataFrame, days: int = 90, date: str = "date") -> DataFrame:
    """Rows within ``days`` days of the latest date."""
    return df.where(F.col(date) >= F.date_sub(latest_value(df, date), days))


def latest_slice(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the latest date."""
    return df.where(F.col(date) == latest_value(df, date))


def first_products(df: DataFrame, n: int = 5, product: str = "product", order: Sequence[str] = ("date",)) -> DataFrame:
    """Rows of the first ``n`` products by first appearance.

    Rows have no order of their own here: appearance is the smallest ``order``
    value, then the product name.
    """
    first = df.groupBy(product).agg(F.min(F.struct(*order)).alias("_first"))
    return df.join(first.orderBy("_first", product).limit(n), product, "left_semi")


def position_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    test_size: float = 0.2,
    train_size: float | None = None,
    name: str = "split",
) -> DataFrame:
    """Label the leading rows of each series ``train`` and the rest ``test``.

    One series is sorted in one task, so give panels with one row per date;
    ``row_positions`` numbers longer ones.
    """
    share = train_size if train_size is not None else 1 - test_size
    ranked = Window.partitionBy(*keys).orderBy(*order)
    whole = Window.partitionBy(*keys)
    cut = F.floor(F.count(F.lit(1)).over(whole) * F.lit(float(share)))
    return df.withColumn(name, F.when(F.row_number().over(ranked) <= cut, "train").otherwise("test"))


def options(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column in order."""
    return drop_null_keys(df, [column]).select(column).distinct().orderBy(column)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with none of the given columns missing."""
    return df.dropna(subset=list(columns))


def between(column: str | Column, low, high) -> Column:
    return as_column(column).between(low, high)
