"""Aggregations behind the dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.functions.joins import join_statistics
from wharfline.functions.dates import period_start
from wharfline.functions.expressions import drop_null_keys, elapsed_days, flag, numeric_columns, ratio
from wharfline.functions.quantiles import exact_quantiles
from wharfline.operators.costs import HOLDING_RATE, SHIPPING_DAYS, SHIPPING_RATE, STOCKOUT_RATE, order_value


def kpi_cards(df: DataFrame, cost: Column) -> DataFrame:
    """Mean lead time, fulfilment and stockout rate, and a total given as an aggregate of cost.

    The three dashboards total ``sum(price)``, ``sum(total_cost)`` and ``avg(total_cost)``.
    """
    return df.agg(
        F.avg("lead_time").alias("avg_lead_time"),
        F.avg("fulfillment_rate").alias("fulfillment_rate"),
        F.avg("stockout_probability").alias("stockout_probability"),
        cost.alias("total_cost"),
    )


def kpi_deltas(df: DataFrame, condition: Column) -> DataFrame:
    """KPIs of the rows that meet a condition and their distance from all rows, in one pass."""
    chosen = flag(condition)
    means = ["lead_time", "fulfillment_rate", "stockout_probability"]
    aggregates = []
    for c in means:
        part = F.avg(F.when(chosen, F.col(c)))
        aggregates += [part.alias(c), (part - F.avg(c)).alias(f"{c}_delta")]
    part = F.coalesce(F.sum(F.when(chosen, F.col("total_cost"))), F.lit(0.0))
    aggregates += [part.alias("total_cost"), (part - F.sum("total_cost")).alias("total_cost_delta")]
    return df.agg(*aggregates)


def business_kpis(orders: DataFrame, inventory: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row: orders, revenue, on-time and fulfilment rate, turnover, days of supply, lead time.

    Rates are 0 without rows; stock figures are 0 without inventory.
    """
    shipped = F.col("ship_date").isNotNull()
    from_orders = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum(order_value()), F.lit(0.0)).alias("total_revenue"),
        F.count_if(shipped).alias("shipped"),
        F.count_if(shipped & (F.col("ship_date") <= F.col("due_date"))).alias("on_time"),
        F.count_if(F.col("status") == "Delivered").alias("delivered"),
        F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("ordered"),
        elapsed_days(F.min("order_date"), F.max("order_date")).alias("order_days"),
    )
    per_day = inventory.groupBy("date").agg(F.sum("quantity").alias("on_hand"))
    from_stock = per_day.agg(
        F.avg("on_hand").alias("mean_stock"), elapsed_days(F.min("date"), F.max("date")).alias("stock_days")
    )
    from_shipments = shipments.agg(F.avg(elapsed_days("ship_date", "delivery_date")).alias("mean_lead"))

    def scalar(df: DataFrame, column: str) -> Column:
        return df.select(F.struct("*")).scalar().getField(column)

    mean_stock, stock_days = scalar(from_stock, "mean_stock"), scalar(from_stock, "stock_days")
    hundred = F.lit(100.0)
    turnover = F.try_divide(ratio(F.col("ordered"), mean_stock) * 365, stock_days.cast("double"))
    supply = F.try_divide(mean_stock, ratio(F.col("ordered"), F.col("order_days")))
    return from_orders.select(
        "total_orders",
        "total_revenue",
        F.coalesce(ratio(F.col("on_time"), F.col("shipped")) * hundred, F.lit(0.0)).alias("on_time_delivery_rate"),
        F.coalesce(ratio(F.col("delivered"), F.col("total_orders")) * hundred, F.lit(0.0)).alias(
            "order_fulfillment_rate"
        ),
        F.when(mean_stock.isNull(), F.lit(0.0)).otherwise(turnover).alias("inventory_turnover"),
        F.when(mean_stock.isNull(), F.lit(0.0)).otherwise(supply).alias("days_of_supply"),
        F.coalesce(scalar(from_shipments, "mean_lead"), F.lit(0.0)).alias("avg_lead_time"),
    )


def counts_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Row count per group."""
    return drop_null_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], value: str | Column, name: str) -> DataFrame:
    """Sum per group; no group for a missing key."""
    return drop_null_keys(df, keys).groupBy(*keys).agg(F.sum(value).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """Means per group; no group for a missing key."""
    return drop_null_keys(df, keys).groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


PIVOT_COLUMNS = 1000


def pivot_values(df: DataFrame, column: str) -> list[str]:
    """The sorted values of a column that is to become a header; more than ``PIVOT_COLUMNS`` are an error."""
    found = drop_null_keys(df, [column]).select(column).distinct().limit(PIVOT_COLUMNS + 1).collect()
    if len(found) > PIVOT_COLUMNS:
        raise ValueError(f"{column} has more than {PIVOT_COLUMNS} values, too many for columns")
    return sorted(r[0] for r in found)


def pivot_sum(df: DataFrame, rows: str, columns: str, measure: str, values: Sequence[str] | None = None) -> DataFrame:
    """Cross table of sums with 0 for empty cells.

    ``values`` may come from a dimension table (``pivot_values``), which saves a
    scan of the facts; a row with another value stops the query instead of
    vanishing from the table.
    """
    values = pivot_values(df, columns) if values is None else list(values)
    listed = F.col(columns).isNull() | F.col(columns).isin(values)
    checked = F.when(listed, F.col(columns)).otherwise(
        F.raise_error(F.concat(F.lit(f"not listed in {columns}: "), F.col(columns).cast("string")))
    )
    cells = drop_null_keys(df, [rows]).withColumn(columns, checked)
    return cells.groupBy(rows).pivot(columns, values).agg(F.sum(measure)).na.fill(0.0)


def group_quadrants(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Group means of two measures, the medians of those means, and the quadrant of each group.

    The medians run over one row per group, however many groups there are.
    """
    means = mean_by(df, [key], x, y)
    middle = exact_quantiles(means, [], {"mx": (x, 0.5), "my": (y, 0.5)}).select(F.struct("mx", "my")).scalar()
    mx, my = middle.getField("mx"), middle.getField("my")
    side = F.concat_ws(
        " / ",
        F.when(F.col(y) >= my, "high").otherwise("low"),
        F.when(F.col(x) <= mx, "fast").otherwise("slow"),
    )
    return means.withColumns({f"median_{x}": mx, f"median_{y}": my}).withColumn("quadrant", side)


def long_means(df: DataFrame, key: str, measures: Sequence[str], name: str = "cost_type", value: str = "cost") -> DataFrame:
    """Group means in long form, one row per group and measure."""
    return mean_by(df, [key], *measures).unpivot([key], list(measures), name, value)


def monthly_sums(df: DataFrame, date: str = "date", columns: Sequence[str] | None = None, freq: str = "M") -> DataFrame:
    """Sums per month labelled by its last day; months without rows between first and last are 0."""
    columns = list(columns) if columns else [c for c in numeric_columns(df) if c != date]
    label = F.last_day(period_start(F.col(date).cast("date"), freq)) if freq == "M" else F.last_day(
        F.add_months(period_start(F.col(date).cast("date"), freq), 2)
    )
    sums = (
        df.dropna(subset=[date])
        .groupBy(label.alias("_label"))
        .agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    )
    step = F.expr("interval 1 month") if freq == "M" else F.expr("interval 3 months")
    starts = F.sequence(F.trunc(F.min("_label"), "month"), F.trunc(F.max("_label"), "month"), step)
    spine = sums.agg(F.transform(starts, F.last_day).alias("d")).select(F.explode("d").alias(date))
    filled = spine.join(sums, F.col(date) == F.col("_label"), "left").drop("_label")
    return filled.select(date, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns])


def monthly_cost_model(df: DataFrame, date: str = "order_date") -> DataFrame:
    """Monthly price sums scaled into unit, shipping, holding and stockout cost by figures of all rows."""
    months = monthly_sums(df, date, ["price"])
    one = df.agg(
        F.avg("lead_time").alias("lead"),
        F.sum("quantity").alias("units"),
        F.avg("stockout_probability").alias("stockout"),
    ).select(F.struct("*")).scalar()
    price, units = F.col("price"), one.getField("units")
    return months.select(
        date,
        price.alias("unit_cost"),
        (price * SHIPPING_RATE * one.getField("lead") / SHIPPING_DAYS).alias("shipping_cost"),
        (price * HOLDING_RATE * units * SHIPPING_RATE).alias("holding_cost"),
        (price * (units * one.getField("stockout") * STOCKOUT_RATE)).alias("stockout_cost"),
    )


def histogram(df: DataFrame, value: str, bins: int = 20, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between the extremes of each group; the last bin is closed."""
    clean = drop_null_keys(df, keys).where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    bounds = clean.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    if keys:
        placed = join_statistics(clean, bounds, keys)
    else:
        one = bounds.select(F.struct("_lo", "_hi")).scalar()
        placed = clean.withColumns({"_lo": one.getField("_lo"), "_hi": one.getField("_hi")})
    # A group with a single value fills its first bin.
    slot = F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * bins), F.lit(0))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (
        placed.withColumn("bin", F.least(slot, F.lit(bins - 1)))
        .groupBy(*keys, "bin", "_lo", "_hi")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            *keys,
            "bin",
            (F.col("_lo") + width * F.col("bin")).alias("bin_start"),
            (F.col("_lo") + width * (F.col("bin") + 1)).alias("bin_end"),
            "count",
        )
    )


def box_statistics(df: DataFrame, value: str, keys: Sequence[str] = (), method: str = "auto") -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and the number of points beyond them.

    ``built_in`` keeps a group's distinct values in one state (day counts: few);
    ``banded`` suits any column, ``auto`` decides by the largest group.
    """
    clean = drop_null_keys(df, keys).where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = exact_quantiles(clean, keys, {n: ("_v", p) for n, p in wanted.items()}, method)
    if keys:
        joined = join_statistics(clean, quartiles, keys)
    else:
        one = quartiles.select(F.struct(*wanted)).scalar()
        joined = clean.withColumns({n: one.getField(n) for n in wanted})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = (F.col("_v") >= low) & (F.col("_v") <= high)
    return joined.groupBy(*keys, *wanted).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outlier_count"),
        F.count(F.lit(1)).alias("count"),
    )


def density(df: DataFrame, value: str, points: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """Gaussian density estimate on a grid from min-3h to max+3h, bandwidth by Scott's rule.

    Equal values are counted first; each distinct value then meets the fixed
    grid of its own group, so the work is distinct values times ``points``.
    """
    clean = drop_null_keys(df, keys).where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    counts = clean.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    stats = clean.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_total"),
        (F.stddev_samp("_v") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("_h"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    ).where(F.col("_h") > 0)
    if keys:
        placed = counts.join(stats, list(keys))
    else:
        one = stats.select(F.struct("_total", "_h", "_lo", "_hi")).scalar()
        placed = counts.withColumns({c: one.getField(c) for c in ("_total", "_h", "_lo", "_hi")}).where("_h > 0")
    start, end = F.col("_lo") - F.col("_h") * 3, F.col("_hi") + F.col("_h") * 3
    grid = placed.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", start + (end - start) * F.col("point") / F.lit(float(points - 1))
    )
    z = (F.col("x") - F.col("_v")) / F.col("_h")
    kernel = F.exp(z * z * -0.5) * F.col("_n")
    return (
        grid.groupBy(*keys, "point", "x", "_total", "_h")
        .agg(F.sum(kernel).alias("_k"))
        .select(
            *keys,
            "point",
            "x",
            (F.col("_k") / (F.col("_total") * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        )
    )


def edge_weights(df: DataFrame, source: str, target: str, weight: str | None = None) -> DataFrame:
    """One edge per pair with summed weight; without a weight every row counts 1."""
    value = F.col(weight).cast("double") if weight and weight in df.columns else F.lit(1.0)
    return (
        df.dropna(subset=[source, target])
        .groupBy(F.col(source).alias("src"), F.col(target).alias("dst"))
        .agg(F.sum(value).alias("weight"))
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows; the order must end in a column that breaks ties."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group; Spark drops rows beyond rank n before the shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)
