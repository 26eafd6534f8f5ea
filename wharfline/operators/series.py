"""Panels of time series: loading, decomposition, anomalies, correlation, row features.

A panel has the columns ``(keys..., ds, y)`` with one row per key and date. Its
series are as long as the calendar, so a window or a group over one key is
small; only the raw rows behind it can be heavy, and those are aggregated first.
A single series is a panel without keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wharfline.functions.dates import grid_dates
from wharfline.functions.expressions import drop_null_keys, flag, full_window_mean, outside, ratio, trailing
from wharfline.functions.ordering import look_back

# Seasonal period by calendar frequency, and without one.
PERIODS = {"D": 7, "W": 52, "M": 12, "Q": 4}
DEFAULT_PERIOD = 12


def load_panel(
    df: DataFrame,
    date: str,
    value: str,
    keys: Sequence[str] = (),
    freq: str | None = None,
) -> DataFrame:
    """The panel of a table: rows of one date are averaged.

    With a frequency every series is laid on that calendar grid between its
    first and last date: gaps become missing values, dates off the grid go.
    """
    keys = list(keys)
    kind = df.schema[date].dataType.simpleString()
    day = F.col(date).cast("timestamp") if kind == "string" else F.col(date)
    panel = (
        drop_null_keys(df, [*keys, date])
        .groupBy(*keys, day.alias("ds"))
        .agg(F.avg(F.col(value).cast("double")).alias("y"))
    )
    if freq is None:
        return panel
    panel = panel.withColumn("ds", F.col("ds").cast("date"))
    spine = panel.groupBy(*keys).agg(F.explode(grid_dates(F.min("ds"), F.max("ds"), freq)).alias("ds"))
    return spine.join(panel, [*keys, "ds"], "left")


def without_gaps(panel: DataFrame, keys: Sequence[str] = (), freq: str = "D") -> DataFrame:
    """The panel on its calendar grid, missing values on the line between their neighbours."""
    keys = list(keys)
    grid = load_panel(panel, "ds", "y", keys, freq)
    known = F.when(F.col("y").isNotNull(), F.struct("ds", "y"))
    back = Window.partitionBy(*keys).orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy("ds").rowsBetween(0, Window.unboundedFollowing)
    both = grid.withColumns({"_a": F.last(known, ignorenulls=True).over(back), "_b": F.first(known, ignorenulls=True).over(ahead)})
    span, gone = F.datediff("_b.ds", "_a.ds"), F.datediff("ds", "_a.ds")
    line = F.col("_a.y") + (F.col("_b.y") - F.col("_a.y")) * F.coalesce(F.try_divide(gone, span), F.lit(0.0))
    return both.withColumn("y", line).drop("_a", "_b")


def series_window(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("ds")


def decompose(
    panel: DataFrame,
    keys: Sequence[str] = (),
    period: int | None = 7,
    model: str = "additive",
    freq: str | None = None,
) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``residual`` to a panel by classical decomposition.

    The trend is a centred moving average, NULL at both ends; the seasonal part
    is the mean of the detrended values per position in the period, centred over
    the period. A series with a gap or fewer than two periods gets NULLs.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown model: {model}")
    p = period or PERIODS.get(freq, DEFAULT_PERIOD)
    additive, half = model == "additive", p // 2
    order, whole = series_window(keys), Window.partitionBy(*keys)
    n, y = F.count(F.lit(1)).over(whole), F.col("y")
    usable = (n >= 2 * p) & (F.count("y").over(whole) == n)
    frame = order.rowsBetween(-half, half)
    full = F.count(F.lit(1)).over(frame) == 2 * half + 1
    if p % 2:
        centred = F.avg(y).over(frame)
    else:
        ends = F.lag(y, half).over(order) + F.lead(y, half).over(order)
        centred = (F.sum(y).over(frame) - ends / 2) / p
    staged = panel.withColumns(
        {"_phase": F.pmod(F.row_number().over(order) - 1, F.lit(p)), "trend": F.when(usable & full, centred)}
    )
    detrended = y - F.col("trend") if additive else ratio(y, F.col("trend"))
    phase = Window.partitionBy(*keys, "_phase")
    staged = staged.withColumn("_mean", F.avg(detrended).over(phase)).withColumn(
        "_share", F.col("_mean") / F.count(F.lit(1)).over(phase)
    )
    # Every phase contributes its mean once: its rows carry equal shares of it.
    centre = F.sum("_share").over(whole) / p
    seasonal = F.col("_mean") - F.col("_centre") if additive else ratio(F.col("_mean"), F.col("_centre"))
    with_season = staged.withColumn("_centre", centre).withColumn("seasonal", seasonal)
    residual = y - F.col("trend") - F.col("seasonal") if additive else ratio(y, F.col("trend") * F.col("seasonal"))
    return with_season.withColumn("residual", residual).drop("_phase", "_mean", "_share", "_centre")


def detect_anomalies(
    df: DataFrame, keys: Sequence[str] = (), value: str = "residual", threshold: float = 3.0
) -> DataFrame:
    """Rows with a residual and whether it lies more than ``threshold`` deviations from the mean.

    Rows without a residual drop out.
    """
    present = df.where(F.col(value).isNotNull())
    # One series is as long as the calendar, and it is already together from the decomposition.
    whole = Window.partitionBy(*keys)
    mean, std = F.avg(value).over(whole), F.stddev_samp(value).over(whole)
    z = F.abs(ratio(F.col(value) - mean, std))
    return present.withColumn("z_score", z).withColumn("anomaly", flag(F.col("z_score") > threshold))


def detect_outliers(df: DataFrame, value: str, n_sigmas: float = 3.0, name: str = "outlier") -> DataFrame:
    """Flag values far from the column's mean; nothing is flagged without spread."""
    one = df.agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("s")).select(F.struct("m", "s")).scalar()
    return df.withColumn(name, outside(F.col(value), one.getField("m"), one.getField("s"), n_sigmas))


def mark_anomalies(df: DataFrame, anomalies: DataFrame, on: Sequence[str], flag_column: str = "anomaly") -> DataFrame:
    """Carry anomaly flags over to other rows of the same dates; unmatched rows are False."""
    flags = anomalies.select(*on, F.col(flag_column).alias("_flag"))
    return df.join(flags, list(on), "left").withColumn(flag_column, flag(F.col("_flag"))).drop("_flag")


def long_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Several metric columns as rows of ``(ids..., metric, value)``."""
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(ids), list(metrics), "metric", "value"
    )


def lag_features(
    df: DataFrame,
    date: str,
    target: str,
    keys: Sequence[str] = (),
    lags: Sequence[int] = (1, 7, 14, 30),
    windows: Sequence[int] = (7, 14, 30),
    ties: Sequence[str] = (),
    method: str = "auto",
    chunk_rows: int = 500_000,
) -> DataFrame:
    """Values ``lags`` rows back, and rolling mean and deviation over the windows longer than every lag.

    Rolling figures start with the first row. ``ties`` order rows of one date.
    Rows without a key have no neighbours. See ``look_back`` for ``method``.
    """
    rolling = [w for w in windows if w > max(lags)]
    order = [F.col(date), *[F.col(t) for t in ties]]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    def columns(window: WindowSpec) -> dict[str, Column]:
        out = {f"{target}_lag_{k}": F.when(known, F.lag(target, k).over(window)) for k in lags}
        for w in rolling:
            frame = trailing(window, w)
            out[f"{target}_rolling_mean_{w}"] = F.when(known, F.avg(target).over(frame))
            out[f"{target}_rolling_std_{w}"] = F.when(known, F.stddev_samp(target).over(frame))
        return out

    reach = max([*lags, *[w - 1 for w in rolling]])
    return look_back(df, keys, order, reach, columns, method, chunk_rows)


def moving_average(
    df: DataFrame,
    date: str,
    value: str,
    keys: Sequence[str] = (),
    rows: int = 7,
    ties: Sequence[str] = (),
    method: str = "auto",
    name: str | None = None,
) -> DataFrame:
    """Mean of the last ``rows`` rows, NULL until that many values are there."""
    order = [F.col(date), *[F.col(t) for t in ties]]
    name = name or f"{value}_ma_{rows}"
    return look_back(df, keys, order, rows - 1, lambda w: {name: full_window_mean(value, w, rows)}, method)


def series_extent(panel: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Position of every row in its series, the series' length and its last date."""
    whole = Window.partitionBy(*keys)
    return panel.withColumns(
        {
            "position": F.row_number().over(series_window(keys)),
            "length": F.count(F.lit(1)).over(whole),
            "last_ds": F.max("ds").over(whole),
        }
    )


def autocorrelation(panel: DataFrame, keys: Sequence[str] = (), lags: int = 40) -> DataFrame:
    """One row per key and lag: ``acf``, the half width of Bartlett's 95 % band, and the series length.

    Missing values are left out before lags are counted; lags reach at most the series' length.
    """
    present = panel.where(F.col("y").isNotNull())
    # One array per key, as long as the calendar; the mean is a sum that combines map-side.
    gathered = present.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("_s"), F.avg("y").alias("_m"), F.count(F.lit(1)).alias("n")
    )
    centred = gathered.where("n > 0").select(*keys, "n", F.transform("_s.y", lambda y: y - F.col("_m")).alias("_d"))

    # A row per lag: a product is added up once, where an array of all lags would be planned into each use of it.
    lagged = centred.select(*keys, "n", "_d", F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag")).where(F.col("lag") < F.col("n"))
    long = F.col("n").cast("int") - F.col("lag")
    pairs = F.zip_with(F.slice("_d", F.lit(1), long), F.slice("_d", F.col("lag") + 1, long), lambda a, b: a * b)
    sums = lagged.select(*keys, "n", "lag", F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x).alias("_p"))
    by_lag = Window.partitionBy(*keys).orderBy("lag")  # as many rows as lags
    rated = sums.withColumn("acf", F.try_divide("_p", F.first("_p").over(by_lag)))
    earlier = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(by_lag.rowsBetween(Window.unboundedPreceding, -1))
    variance = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise((F.coalesce(earlier, F.lit(0.0)) * 2 + 1) / F.col("n"))
    # Fixed value: 97.5 % quantile of the normal distribution.
    return rated.withColumn("band", F.sqrt(variance) * 1.959963984540054).select(*keys, "n", "lag", "acf", "band")


def partial_autocorrelation(panel: DataFrame, keys: Sequence[str] = (), lags: int = 40) -> DataFrame:
    """One row per key and lag: ``pacf`` by the Durbin-Levinson recursion over the autocorrelations."""
    acf = autocorrelation(panel, keys, lags)
    arrays = acf.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda e: e["acf"]).alias("_r"),
        F.max("n").alias("n"),
    )
    r = F.col("_r")

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        dot = F.aggregate(
            F.sequence(F.lit(1), F.greatest(k - 1, F.lit(1))),
            F.lit(0.0),
            lambda s, j: s + F.coalesce(F.get(phi, j - 1) * F.get(r, k - j), F.lit(0.0)),
        )
        norm = F.aggregate(
            F.sequence(F.lit(1), F.greatest(k - 1, F.lit(1))),
            F.lit(0.0),
            lambda s, j: s + F.coalesce(F.get(phi, j - 1) * F.get(r, j), F.lit(0.0)),
        )
        last = F.try_divide(F.get(r, k) - dot, F.lit(1.0) - norm)
        moved = F.transform(phi, lambda v, j: v - last * F.get(phi, F.size(phi) - 1 - j))
        return F.struct(
            F.concat(moved, F.array(last)).alias("phi"), F.concat(state["out"], F.array(last)).alias("out")
        )

    start = F.struct(
        F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out")
    )
    steps = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    solved = arrays.withColumn("_out", F.aggregate(steps, start, step, lambda s: s["out"]))
    return solved.select(*keys, "n", F.posexplode("_out").alias("lag", "pacf")).withColumn(
        "band", F.lit(1.959963984540054) / F.sqrt("n")
    )
