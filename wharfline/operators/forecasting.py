"""Forecasts for every series of a panel at once.

Models are estimated by least squares or on a parameter grid, so parameters can
differ from those of likelihood optimisers. Forecast rows are
``(keys..., ds, forecast, lower_bound, upper_bound)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions.dates import step_date
from wharfline.functions.durable import durable
from wharfline.functions.expressions import ratio
from wharfline.functions.normal import normal_quantile
from wharfline.operators.filters import position_split
from wharfline.operators.leastsquares import cross_products, dot, vector_products
from wharfline.operators.series import load_panel, series_window, without_gaps

DOUBLES = T.ArrayType(T.DoubleType())


def _match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put per-series columns next to the rows of each series."""
    if keys:
        return df.join(other, list(keys))
    one = other.select(F.struct("*")).scalar()
    return df.withColumns({c: one.getField(c) for c in other.columns})


def _field(name: str):
    return lambda entry: entry[name]


# ------------------------------------------------------------ stationarity

# Published response surfaces of the unit-root test with a
# constant: small-p and large-p polynomials, their limits, critical values.
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
CRITICAL = {
    "critical_1": (-3.43035, -6.5393, -16.786, -79.433),
    "critical_5": (-2.86154, -2.8903, -4.234, -40.040),
    "critical_10": (-2.56677, -1.5384, -2.809, 0.0),
}


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = total * x + c
    return total


def _unit_root_p(tau: float) -> float:
    """Probability of a smaller statistic under a unit root."""
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    surface = SMALL_P if tau <= TAU_STAR else LARGE_P
    return NormalDist().cdf(sum(c * tau**i for i, c in enumerate(surface)))


def check_stationarity(panel: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant; the lag with the smallest AIC is used.

    All lags are compared on the same rows, so one matrix of products per series
    serves them all; a second one covers the rows the chosen lag can use.
    """
    keys = list(keys)
    panel = durable(panel)  # read several times; the rows behind it are not
    order, whole = series_window(keys), Window.partitionBy(*keys)
    present = panel.where(F.col("y").isNotNull()).select(*keys, "ds", (F.col("y") - F.avg("y").over(whole)).alias("_x"))
    n = F.count(F.lit(1)).over(whole)
    rule = F.ceil(F.pow(n / 100.0, F.lit(0.25)) * 12)
    sized = present.withColumns(
        {
            "_lags": F.least(rule, F.floor(n / 2) - 2),
            "_row": F.row_number().over(order),
            "_level": F.lag("_x", 1).over(order),
            "_diff": F.col("_x") - F.lag("_x", 1).over(order),
        }
    ).where(F.col("_lags") >= 0)
    # One number: the lag rule applied to the longest series.
    most = sized.agg(F.max("_lags")).first()[0]
    if most is None:
        most = 0
    width = most + 3
    # Newest difference first; lags a series has not got yet count 0 and are never picked.
    past = F.reverse(F.collect_list("_diff").over(order.rowsBetween(-most, -1))) if most else F.array().cast("array<double>")
    padded = F.concat(past, F.array_repeat(F.lit(0.0), F.lit(most) - F.size(past)))
    vectors = sized.withColumn(
        "_v", F.concat(F.array(F.lit(1.0), F.col("_level")), padded, F.array(F.col("_diff")))
    ).select(*keys, "_row", "_lags", "_v")

    @F.pandas_udf(T.LongType())
    def best_lag(matrices: pd.Series, counts: pd.Series, limits: pd.Series) -> pd.Series:
        picks = []
        for flat, count, limit in zip(matrices, counts, limits):
            m = np.asarray(flat, dtype=float).reshape(width, width)
            scores = []
            for lag in range(int(limit) + 1):
                k = lag + 2
                beta = np.linalg.lstsq(m[:k, :k], m[:k, -1], rcond=None)[0]
                sse = max(m[-1, -1] - beta @ m[:k, -1], 1e-300)
                scores.append(count * np.log(sse / count) + 2 * k)
            picks.append(int(np.argmin(scores)))
        return pd.Series(picks, dtype="int64")

    common = vectors.where(F.col("_row") > F.col("_lags") + 1)
    limits = common.groupBy(*keys).agg(F.max("_lags").alias("_limit"))
    first = _match(vector_products(common, keys, F.col("_v")), limits, keys)
    chosen = first.select(*keys, best_lag("gram", "n", "_limit").alias("_best"))
    usable = _match(vectors, chosen, keys).where(F.col("_row") > F.col("_best") + 1)
    final = _match(vector_products(usable, keys, F.col("_v")), chosen, keys)

    tested = T.StructType([T.StructField("tau", T.DoubleType()), T.StructField("p", T.DoubleType())])

    @F.pandas_udf(tested)
    def test(matrices: pd.Series, counts: pd.Series, lags: pd.Series) -> pd.DataFrame:
        rows = []
        for flat, count, lag in zip(matrices, counts, lags):
            m = np.asarray(flat, dtype=float).reshape(width, width)
            k = int(lag) + 2
            inverse = np.linalg.pinv(m[:k, :k])
            beta = inverse @ m[:k, -1]
            spread = max(m[-1, -1] - beta @ m[:k, -1], 0.0) / max(count - k, 1)
            error = float(np.sqrt(spread * inverse[1, 1]))
            tau = float(beta[1] / error) if error > 0 else None
            rows.append((tau, None if tau is None else _unit_root_p(tau)))
        return pd.DataFrame(rows, columns=["tau", "p"]).astype("float64")

    inverse_n = F.lit(1.0) / F.col("n_observations")
    return (
        final.withColumn("_t", test("gram", "n", "_best"))
        .select(
            *keys,
            F.col("_t.tau").alias("test_statistic"),
            F.col("_t.p").alias("p_value"),
            F.col("_best").alias("lags"),
            F.col("n").alias("n_observations"),
        )
        .withColumns(
            {
                **{name: _polynomial(c, inverse_n) for name, c in CRITICAL.items()},
                "is_stationary": F.coalesce(F.col("p_value") < 0.05, F.lit(False)),
            }
        )
    )


# ----------------------------------------------------------- Holt-Winters


def _present_mean(values: Column) -> Column:
    present = F.filter(values, lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(present, F.lit(0.0), lambda total, v: total + v), F.size(present))


def smoothed(
    values: Column, m: int, alpha: Column, beta: Column, gamma: Column, trend: str | None = "add", seasonal: str | None = "add"
) -> Column:
    """The state after smoothing an array of values: level, slope, season, and sums and number of the residuals.

    ``season`` starts with the next step's. The recursion is one fold over the
    array; it starts from the means of the first two seasons and steps over
    missing values.
    """
    first, second = _present_mean(F.slice(values, 1, m)), _present_mean(F.slice(values, m + 1, m))
    apart = (lambda v: F.try_divide(v, first)) if seasonal == "mul" else (lambda v: v - first)
    season = F.transform(F.slice(values, 1, m), lambda v: F.coalesce(apart(v), F.lit(0.0)) if seasonal else F.lit(0.0))
    start = F.struct(
        first.alias("level"), ((second - first) / m if trend else F.lit(0.0)).alias("slope"), season.alias("season"),
        F.lit(0.0).alias("sse"), F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("seen"),
    )

    def step(state: Column, value: Column) -> Column:
        s = F.get(state["season"], F.lit(0))
        base = state["level"] + state["slope"]
        expected = base * s if seasonal == "mul" else base + s
        bare = F.try_divide(value, s) if seasonal == "mul" else value - s
        moved = alpha * bare + (1 - alpha) * base
        own = F.try_divide(value, base) if seasonal == "mul" else value - base
        turned = gamma * own + (1 - gamma) * s if seasonal else s
        slope = beta * (moved - state["level"]) + (1 - beta) * state["slope"] if trend else state["slope"]
        missed, gone = value - expected, value.isNull()

        def unless_gone(new: Column, old: Column) -> Column:
            return F.when(gone, old).otherwise(new)

        return F.struct(
            unless_gone(moved, base).alias("level"),
            unless_gone(slope, state["slope"]).alias("slope"),
            F.concat(F.slice(state["season"], 2, m - 1), F.array(unless_gone(turned, s))).alias("season"),
            (state["sse"] + unless_gone(missed * missed, F.lit(0.0))).alias("sse"),
            (state["total"] + unless_gone(missed, F.lit(0.0))).alias("total"),
            (state["seen"] + F.when(gone, 0).otherwise(1)).alias("seen"),
        )

    return F.aggregate(values, start, step)


def _smoothing_series(panel: DataFrame, keys: Sequence[str], m: int, freq: str | None) -> DataFrame:
    """Keys, last_ds, n, _values: each series of two seasons or more as one array in order of its dates, as long as the calendar."""
    series = panel.select(*keys, F.col("ds").cast("date").alias("ds"), F.nanvl(F.col("y").cast("double"), F.lit(None)).alias("y"))
    if freq:
        series = load_panel(series, "ds", "y", list(keys), freq).select(*keys, "ds", "y")
    gathered = series.groupBy(*keys).agg(
        F.max("ds").alias("last_ds"), F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("_s")
    )
    arrays = durable(gathered.select(*keys, "last_ds", "n", F.col("_s.y").alias("_values")))
    known = [_present_mean(F.slice("_values", at, m)).isNotNull() for at in (1, m + 1)]
    return arrays.where((F.col("n") >= 2 * m) & known[0] & known[1])


def _smoothing_states(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    mean = F.try_divide(F.col("_state.total"), F.col("_state.seen"))
    spread = F.sqrt(F.greatest(F.try_divide(F.col("_state.sse"), F.col("_state.seen")) - mean * mean, F.lit(0.0)))
    return fits.select(
        *keys, "last_ds", "n", "alpha", "beta", "gamma", "_state.level", "_state.slope", "_state.sse",
        spread.alias("residual_std"), "_state.season",
    )


def smooth(
    panel: DataFrame, keys: Sequence[str] = (), seasonal_periods: int = 7, alpha: float = 0.3, beta: float = 0.1, gamma: float = 0.2,
    trend: str | None = "add", seasonal: str | None = "add", freq: str | None = "D",
) -> DataFrame:
    """Level, slope and seasonal state of each series under given smoothing parameters."""
    series = _smoothing_series(panel, keys, seasonal_periods, freq)
    given = [F.lit(float(x)) for x in (alpha, beta, gamma)]
    named = {n: c for n, c in zip(("alpha", "beta", "gamma"), given)}
    return _smoothing_states(series.withColumns({**named, "_state": smoothed(F.col("_values"), seasonal_periods, *given, trend, seasonal)}), keys)


def _smooth(y: np.ndarray, m: int, grid: np.ndarray, trend: bool, seasonal: str | None):
    """Run the smoothing recursion for all parameter rows of the grid side by side."""
    alpha, beta, gamma = grid.T
    first, second = y[:m], y[m : 2 * m]
    level = np.full(len(grid), np.nanmean(first))
    slope = np.full(len(grid), (np.nanmean(second) - np.nanmean(first)) / m if trend else 0.0)
    start = first / np.nanmean(first) if seasonal == "mul" else first - np.nanmean(first)
    season = np.tile(np.nan_to_num(start) if seasonal else np.zeros(m), (len(grid), 1))
    sse, residuals = np.zeros(len(grid)), np.zeros((len(y), len(grid)))
    for t, value in enumerate(y):
        s = season[:, t % m]
        base = level + slope
        expected = base * s if seasonal == "mul" else base + s
        if np.isnan(value):
            level = base
            residuals[t] = np.nan
            continue
        residuals[t] = value - expected
        sse += residuals[t] ** 2
        bare = value / s if seasonal == "mul" else value - s
        moved = alpha * bare + (1 - alpha) * base
        if seasonal:
            season[:, t % m] = gamma * (value / base if seasonal == "mul" else value - base) + (1 - gamma) * s
        if trend:
            slope = beta * (moved - level) + (1 - beta) * slope
        level = moved
    return sse, level, slope, season, residuals


def fit_holt_winters(
    panel: DataFrame,
    keys: Sequence[str] = (),
    seasonal_periods: int = 7,
    trend: str | None = "add",
    seasonal: str | None = "add",
    freq: str | None = "D",
) -> DataFrame:
    """Level, slope and seasonal state of each series under its best smoothing parameters.

    The series is laid on its calendar grid first, so that a season counts
    dates; the recursion steps over missing values. ``freq=None`` takes the rows
    as consecutive.

    The recursion runs over one series of the panel, as long as the calendar,
    for a grid of parameters at once; the grid is narrowed twice around the
    best point. Series shorter than two seasons are left out. For parameters that
    are given, ``smooth`` does the same as a fold on the JVM; for 375 points that
    fold takes five times as long as arrays of all points side by side.
    """
    keys, m = list(keys), seasonal_periods
    if trend not in ("add", None) or seasonal not in ("add", "mul", None):
        raise ValueError("trend must be 'add' or None, seasonal 'add', 'mul' or None")
    use_trend = trend == "add"
    if not keys:
        panel, group = panel.withColumn("_all", F.lit(0)), ["_all"]
    else:
        group = keys
    schema = T.StructType(
        [panel.schema[k] for k in group]
        + [T.StructField("last_ds", T.DateType()), T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("alpha", "beta", "gamma", "level", "slope", "sse", "residual_std")]
        + [T.StructField("season", DOUBLES)]
    )
    columns = [f.name for f in schema.fields]

    def axis(centre: float, width: float, used: bool) -> np.ndarray:
        return np.clip(centre + width * np.array([-1.0, -0.5, 0.0, 0.5, 1.0]), 0.01, 0.99) if used else np.zeros(1)

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        y = pdf["y"].to_numpy(dtype=float)
        if len(y) < 2 * m or np.isnan(y[:m]).all() or np.isnan(y[m : 2 * m]).all():
            return pd.DataFrame(columns=columns)
        best, width = np.array([0.5, 0.5, 0.5]), 0.49
        for _ in range(3):
            axes = [axis(best[0], width, True), axis(best[1], width, use_trend), axis(best[2], width, seasonal is not None)]
            grid = np.stack(np.meshgrid(*axes, indexing="ij"), axis=-1).reshape(-1, 3)
            sse, level, slope, season, residuals = _smooth(y, m, grid, use_trend, seasonal)
            i = int(np.nanargmin(sse))
            best, width = grid[i], width / 3
        at = len(y) % m
        state = np.roll(season[i], -at).tolist()
        figures = (*best, level[i], slope[i], sse[i], float(np.nanstd(residuals[:, i])))
        row = (*key, pdf["ds"].iloc[-1], len(y), *[float(v) for v in figures], state)
        return pd.DataFrame([row], columns=columns)

    series = panel.select(*group, F.col("ds").cast("date").alias("ds"), F.col("y").cast("double").alias("y"))
    if freq:
        series = load_panel(series, "ds", "y", group, freq).select(*group, "ds", "y")
    fitted = series.groupBy(*group).applyInPandas(fit, schema)
    return fitted if keys else fitted.drop("_all")


def holt_winters_forecast(
    model: DataFrame, keys: Sequence[str] = (), periods: int = 7, freq: str | None = "D", seasonal: str | None = "add"
) -> DataFrame:
    """Future rows of fitted series; bounds are 1.96 population deviations of the residuals away."""
    steps = model.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    line = F.col("level") + F.col("slope") * F.col("step")
    s = F.get("season", F.pmod(F.col("step") - 1, F.size("season")))
    value = line * s if seasonal == "mul" else line + s
    # Fixed value: the interval factor is always that of 95 %.
    reach = F.col("residual_std") * 1.96
    return steps.select(
        *keys,
        step_date(F.col("last_ds"), F.col("step"), freq).alias("ds"),
        value.alias("forecast"),
        (value - reach).alias("lower_bound"),
        (value + reach).alias("upper_bound"),
    )


# ------------------------------------------------------------------ ARIMA


def _lags(order: int, seasonal: int, period: int) -> list[int]:
    """Lags of a multiplied-out seasonal polynomial."""
    return sorted({i + period * j for i in range(order + 1) for j in range(seasonal + 1)} - {0})


def _difference(d: int, seasonal_d: int, period: int) -> np.ndarray:
    """Coefficients of the differencing polynomial, constant term first."""
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    step = np.zeros(period + 1)
    step[0], step[-1] = 1.0, -1.0
    for _ in range(seasonal_d):
        poly = np.convolve(poly, step)
    return poly


def fit_arima(
    panel: DataFrame,
    keys: Sequence[str] = (),
    order: tuple[int, int, int] = (1, 1, 1),
    seasonal_order: tuple[int, int, int, int] | None = None,
    candidates: Sequence[tuple[int, int]] | None = None,
    freq: str | None = "D",
) -> DataFrame:
    """Two-stage least-squares (S)ARIMA of every series, with AIC and BIC.

    Lags count steps of the calendar grid; gaps are filled on the line between
    their neighbours. ``freq=None`` takes the rows as consecutive.

    A long autoregression gives the innovations, a second regression on lagged
    values and innovations the coefficients; seasonal lags enter multiplied
    out. With ``candidates`` of (p, q) the pair with the smallest AIC is taken
    per series: all of them are sub-matrices of one matrix of products. The
    model has a constant when nothing is differenced. A series too short for an
    order has NULL coefficients and no forecast.
    """
    keys = list(keys)
    p, d, q = order
    sp, sd, sq, period = seasonal_order or (0, 0, 0, 1)
    pairs = [tuple(c) for c in candidates] if candidates else [(p, q)]
    ar = _lags(max(c[0] for c in pairs), sp, period)
    ma = _lags(max(c[1] for c in pairs), sq, period)
    poly, constant = _difference(d, sd, period), d + sd == 0
    window = series_window(keys)

    differenced = F.lit(0.0)
    for i, c in enumerate(poly):
        if c:
            differenced = differenced + F.lag("y", i).over(window) * float(c)
    panel = panel.where(F.col("y").isNotNull())
    if freq:
        panel = without_gaps(panel, keys, freq)
    base = (
        durable(panel.where(F.col("y").isNotNull()).select(*keys, "ds", F.col("y").cast("double").alias("y")))
        .withColumns({"_w": differenced, "_one": F.lit(1.0)})
    )
    long = max([*ar, *ma, 3]) + 5
    lagged = base.withColumns({f"_w{k}": F.lag("_w", k).over(window) for k in range(1, long + 1)})
    first_names = ["_one", *[f"_w{k}" for k in range(1, long + 1)], "_w"]
    width = len(first_names)

    solved = T.StructType([T.StructField("coef", DOUBLES)])

    @F.pandas_udf(solved)
    def autoregression(matrices: pd.Series) -> pd.DataFrame:
        out = []
        for flat in matrices:
            m = np.asarray(flat, dtype=float).reshape(width, width)
            out.append(np.linalg.lstsq(m[:-1, :-1], m[:-1, -1], rcond=None)[0].tolist())
        return pd.DataFrame({"coef": out})

    stage = cross_products(lagged, keys, first_names).select(*keys, autoregression("gram").getField("coef").alias("_long"))
    expected = dot(F.col("_long"), [F.col(c) for c in first_names[:-1]])
    matched = lagged.join(stage, keys, "left") if keys else _match(lagged, stage, keys)
    innovated = matched.withColumn("_e", F.col("_w") - expected)
    innovated = innovated.withColumns({f"_e{k}": F.lag("_e", k).over(window) for k in ma})
    names = [*(["_one"] if constant else []), *[f"_w{k}" for k in ar], *[f"_e{k}" for k in ma]]
    head = 1 if constant else 0
    choices = []
    for cp, cq in pairs:
        a, b = _lags(cp, sp, period), _lags(cq, sq, period)
        index = [*range(head), *[head + ar.index(k) for k in a], *[head + len(ar) + ma.index(k) for k in b]]
        choices.append((cp, cq, index))
    full = len(names) + 1
    result = T.StructType(
        [
            T.StructField("p", T.IntegerType()),
            T.StructField("q", T.IntegerType()),
            T.StructField("constant", T.DoubleType()),
            T.StructField("ar", DOUBLES),
            T.StructField("ma", DOUBLES),
            T.StructField("sigma2", T.DoubleType()),
            T.StructField("aic", T.DoubleType()),
            T.StructField("bic", T.DoubleType()),
        ]
    )
    n_ar = len(ar)

    @F.pandas_udf(result)
    def select(matrices: pd.Series, counts: pd.Series) -> pd.DataFrame:
        rows = []
        for flat, n in zip(matrices, counts):
            m = None if flat is None else np.asarray(flat, dtype=float).reshape(full, full)
            best = None
            for cp, cq, index in choices:
                if flat is None or n <= len(index) + 1:  # too few rows for this order
                    continue
                beta = np.zeros(full - 1)
                if index:
                    block = np.ix_(index, index)
                    beta[index] = np.linalg.lstsq(m[block], m[index, -1], rcond=None)[0]
                sse = max(m[-1, -1] - beta @ m[:-1, -1], 1e-300)
                level = n * (math.log(2 * math.pi * sse / n) + 1)
                k = len(index) + 1
                found = (
                    cp, cq, float(beta[0]) if head else 0.0, beta[head : head + n_ar].tolist(),
                    beta[head + n_ar :].tolist(), sse / n, level + 2 * k, level + math.log(n) * k,
                )
                if best is None or found[6] < best[6]:
                    best = found
            rows.append(best or (None,) * len(result.fields))
        return pd.DataFrame(rows, columns=[f.name for f in result.fields]).astype(object)

    if names:
        second = cross_products(innovated, keys, [*names, "_w"])
    else:
        kept = innovated.where(F.col("_w").isNotNull())
        second = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(F.sum(F.col("_w") * F.col("_w"))).alias("gram"))
    if keys:  # also the series without a single complete row
        second = base.select(*keys).distinct().join(second, keys, "left")
    fits = second.withColumn("_fit", select("gram", "n")).select(*keys, "n", "_fit.*")
    # The newest values and innovations are all a forecast needs: a bounded tail per series.
    need = max([len(poly) - 1, *ar, *ma, 1])
    backwards = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    tail = innovated.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= need)
    entries = F.array_sort(
        F.collect_list(F.struct("_back", "y", F.coalesce("_w", F.lit(0.0)).alias("w"), F.coalesce("_e", F.lit(0.0)).alias("e")))
    )
    states = tail.groupBy(*keys).agg(F.max("ds").alias("last_ds"), entries.alias("_entries")).select(
        *keys,
        "last_ds",
        *[F.transform("_entries", _field(c)).alias(f"last_{c}") for c in ("y", "w", "e")],
    )
    return _match(fits, states, keys).withColumns(
        {
            "d": F.lit(d),
            "seasonal_order": F.array(*[F.lit(v) for v in (sp, sd, sq, period)]),
            "ar_lags": F.array(*[F.lit(k) for k in ar]).cast("array<int>"),
            "ma_lags": F.array(*[F.lit(k) for k in ma]).cast("array<int>"),
            "difference": F.array(*[F.lit(float(c)) for c in poly]),
        }
    )


def arima_forecast(
    model: DataFrame, keys: Sequence[str] = (), periods: int = 30, alpha: float = 0.05, freq: str | None = "D"
) -> DataFrame:
    """Future rows of fitted series with normal prediction intervals."""
    out = T.ArrayType(T.StructType([T.StructField("forecast", T.DoubleType()), T.StructField("error", T.DoubleType())]))

    @F.pandas_udf(out)
    def paths(
        const: pd.Series, ar: pd.Series, ma: pd.Series, ar_lags: pd.Series, ma_lags: pd.Series, poly: pd.Series,
        sigma2: pd.Series, ys: pd.Series, ws: pd.Series, es: pd.Series,
    ) -> pd.Series:
        results = []
        for c, a, b, al, bl, dif, s2, y, w, e in zip(const, ar, ma, ar_lags, ma_lags, poly, sigma2, ys, ws, es):
            if a is None:
                results.append(None)
                continue
            y, w, e = list(y)[::-1], list(w)[::-1], list(e)[::-1]
            phi = np.zeros(max([*al, 0]) + 1)
            phi[0] = 1.0
            phi[list(al)] = -np.asarray(a)[: len(al)]
            whole = np.convolve(phi, dif)
            psi, total, rows = [1.0], 0.0, []
            theta = dict(zip(bl, b))
            for h in range(periods):
                w.append(c + sum(v * w[-k] for v, k in zip(a, al)) + sum(v * e[-k] for v, k in zip(b, bl)))
                e.append(0.0)
                y.append(w[-1] - sum(v * y[-k] for k, v in enumerate(dif) if k))
                total += psi[h] ** 2
                rows.append((float(y[-1]), float(math.sqrt(s2 * total))))
                j = h + 1
                psi.append(theta.get(j, 0.0) - sum(whole[k] * psi[j - k] for k in range(1, min(j, len(whole) - 1) + 1)))
            results.append(rows)
        return pd.Series(results)

    path = paths(
        "constant", "ar", "ma", "ar_lags", "ma_lags", "difference", "sigma2", "last_y", "last_w", "last_e"
    )
    z = normal_quantile(1 - alpha / 2)
    steps = model.withColumn("_path", path).where(F.col("_path").isNotNull())
    steps = steps.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    value, error = (F.get("_path", F.col("_h") - 1).getField(c) for c in ("forecast", "error"))
    return steps.select(
        *keys,
        step_date(F.col("last_ds"), F.col("_h"), freq).alias("ds"),
        value.alias("forecast"),
        (value - error * z).alias("lower_bound"),
        (value + error * z).alias("upper_bound"),
    )


def differences_needed(panel: DataFrame, keys: Sequence[str], max_d: int = 2) -> DataFrame:
    """Keys and ``_d``: the fewest differences after which a series tests stationary, ``max_d`` if none.

    A series that differencing leaves constant, or too short to test, needs no further difference.
    """
    keys = list(keys)
    window = series_window(keys)
    found = check_stationarity(panel, keys).select(*keys, F.col("is_stationary").alias("_stays"))
    found = found.withColumn("_d", F.when(F.col("_stays"), 0).otherwise(min(1, max_d))).drop("_stays")
    changed = without_gaps(panel.where(F.col("y").isNotNull()), keys)
    for d in range(1, max_d):
        step = changed.withColumn("y", F.col("y") - F.lag("y").over(window))
        changed = durable(step.where(F.col("y").isNotNull()).select(*keys, "ds", "y"))
        varies = changed.groupBy(*keys).agg((F.min("y") < F.max("y")).alias("_varies"))
        tested = check_stationarity(changed, keys).select(*keys, (~F.col("is_stationary")).alias("_moves"))
        more = _match(tested, varies, keys).where("_moves AND _varies").select(*keys, F.lit(True).alias("_more"))
        found = found.join(more, keys, "left")
        again = (F.col("_d") == d) & F.coalesce("_more", F.lit(False))
        found = found.withColumn("_d", F.when(again, d + 1).otherwise(F.col("_d"))).drop("_more")
    return durable(found)


def auto_arima(
    panel: DataFrame, keys: Sequence[str] = (), max_p: int = 5, max_q: int = 5, max_d: int = 2
) -> DataFrame:
    """Order per series: as many differences as make it stationary, then (p, q) by AIC; no seasonal lags."""
    if not keys:
        return auto_arima(panel.withColumn("_all", F.lit(0)), ["_all"], max_p, max_q, max_d).drop("_all")
    grid = [(i, j) for i in range(max_p + 1) for j in range(max_q + 1)]
    panel = durable(panel)
    needed = differences_needed(panel, keys, max_d)
    placed = durable(_match(panel, needed, keys))
    # Every series is fitted at its own d alone.
    fits = [fit_arima(placed.where(F.col("_d") == d).drop("_d"), keys, (max_p, d, max_q), candidates=grid) for d in range(max_d + 1)]
    return reduce(DataFrame.unionByName, fits)


# ------------------------------------------------ trend and season regression


def _season_columns(ds: Column, yearly: int, weekly: int) -> list[Column]:
    days = F.datediff(ds, F.lit("1970-01-01").cast("date")).cast("double")
    out = []
    for period, terms in ((365.25, yearly), (7.0, weekly)):
        for k in range(1, terms + 1):
            angle = days * (2 * math.pi * k / period)
            out += [F.sin(angle), F.cos(angle)]
    return out


def _design(t: Column, ds: Column, changepoints: int, yearly: int, weekly: int) -> list[Column]:
    """Constant, time, hinges over the first four fifths of the history, Fourier terms."""
    hinges = [F.greatest(t - 0.8 * (i + 1) / (changepoints + 1), F.lit(0.0)) for i in range(changepoints)]
    return [F.lit(1.0), t, *hinges, *_season_columns(ds, yearly, weekly)]


def fit_regression(
    panel: DataFrame,
    keys: Sequence[str] = (),
    yearly_seasonality: bool = True,
    weekly_seasonality: bool = True,
    changepoint_prior_scale: float = 0.05,
    multiplicative: bool = False,
    changepoints: int = 25,
) -> DataFrame:
    """Piecewise linear trend plus yearly and weekly terms, by ridge regression per series.

    The multiplicative form regresses log y and needs positive values; others are left out.
    """
    keys = list(keys)
    yearly, weekly = (10 if yearly_seasonality else 0), (3 if weekly_seasonality else 0)
    target = F.when(F.col("y") > 0, F.log("y")) if multiplicative else F.col("y")
    rows = durable(
        panel.select(*keys, F.col("ds").cast("date").alias("ds"), target.cast("double").alias("_y")).dropna(subset=["_y"])
    )
    extent = rows.groupBy(*keys).agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.max(F.abs("_y")).alias("scale")
    ).where(F.col("first_ds") < F.col("last_ds"))
    placed = _match(rows, extent, keys)
    t = F.datediff("ds", "first_ds") / F.datediff("last_ds", "first_ds")
    design = _design(t, F.col("ds"), changepoints, yearly, weekly)
    names = [f"_x{i}" for i in range(len(design))]
    ready = placed.select(*keys, *[c.alias(n) for c, n in zip(design, names)], ratio(F.col("_y"), F.col("scale")).alias("_t"))
    width = len(names) + 1
    hinge = np.zeros(width - 1)
    hinge[2 : 2 + changepoints] = 1.0

    @F.pandas_udf(T.StructType([T.StructField("coef", DOUBLES), T.StructField("sigma", T.DoubleType())]))
    def ridge(matrices: pd.Series, counts: pd.Series) -> pd.DataFrame:
        coefs, sigmas = [], []
        for flat, n in zip(matrices, counts):
            m = np.asarray(flat, dtype=float).reshape(width, width)
            x, xy = m[:-1, :-1], m[:-1, -1]
            weak = 1e-8 * np.eye(width - 1)
            for penalty in (1.0, None):
                if penalty is None:  # noise level of the first fit against the prior spread of the slope changes
                    penalty = max(sse / n, 1e-12) / changepoint_prior_scale**2
                beta = np.linalg.solve(x + weak + np.diag(hinge * penalty), xy)
                sse = max(m[-1, -1] - 2 * beta @ xy + beta @ x @ beta, 0.0)
            coefs.append(beta.tolist())
            sigmas.append(math.sqrt(sse / n))
        return pd.DataFrame({"coef": coefs, "sigma": sigmas})

    fitted = cross_products(ready, keys, [*names, "_t"]).select(*keys, "n", ridge("gram", "n").alias("_r"))
    return _match(fitted.select(*keys, "n", "_r.coef", "_r.sigma"), extent, keys).withColumns(
        {
            "multiplicative": F.lit(multiplicative),
            "terms": F.struct(
                F.lit(changepoints).alias("changepoints"), F.lit(yearly).alias("yearly"), F.lit(weekly).alias("weekly")
            ),
        }
    )


def regression_forecast(
    model: DataFrame,
    keys: Sequence[str] = (),
    periods: int = 30,
    alpha: float = 0.05,
    freq: str | None = "D",
    multiplicative: bool = False,
    yearly_seasonality: bool = True,
    weekly_seasonality: bool = True,
    changepoints: int = 25,
) -> DataFrame:
    """Future rows of fitted series; give the same settings as to the fit."""
    yearly, weekly = (10 if yearly_seasonality else 0), (3 if weekly_seasonality else 0)
    future = model.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(periods)))).withColumn(
        "ds", step_date(F.col("last_ds"), F.col("_step"), freq)
    )
    t = F.datediff("ds", "first_ds") / F.datediff("last_ds", "first_ds")
    value = dot(F.col("coef"), _design(t, F.col("ds"), changepoints, yearly, weekly)) * F.col("scale")
    reach = F.col("sigma") * F.col("scale") * normal_quantile(1 - alpha / 2)
    shown = (lambda c: F.exp(c)) if multiplicative else (lambda c: c)
    return future.select(
        *keys,
        "ds",
        shown(value).alias("forecast"),
        shown(value - reach).alias("lower_bound"),
        shown(value + reach).alias("upper_bound"),
    )


# ------------------------------------------------- frames, scores, baseline


def forecast_frame(
    panel: DataFrame, forecast: DataFrame, keys: Sequence[str] = (), include_history: bool = True
) -> DataFrame:
    """Forecast rows, after the history where wanted; history has no bounds."""
    future = forecast.withColumn("type", F.lit("Forecast"))
    if not include_history:
        return future
    past = panel.select(
        *keys, F.col("ds").cast("date").alias("ds"), F.col("y").cast("double").alias("forecast"), F.lit("Historical").alias("type")
    )
    return past.unionByName(future, allowMissingColumns=True)


def days_until_reorder(
    frame: DataFrame, reorder: DataFrame, keys: Sequence[str], as_of: str, point: str = "reorder_point"
) -> DataFrame:
    """Days from ``as_of`` to the first forecast below each series' reorder point, NULL when none is."""
    joined = frame.where(F.col("type") == "Forecast").join(reorder.select(*keys, point), list(keys))
    first = F.min(F.when(F.col("forecast") < F.col(point), F.col("ds")))
    return joined.groupBy(*keys).agg(F.datediff(first, F.lit(as_of).cast("date")).alias("days_until_reorder"))


def evaluate(actual: DataFrame, forecast: DataFrame, on: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Errors of forecast rows against actual ``y`` on the dates both have.

    History rows of a forecast frame are no forecasts and are left out; a zero
    actual has no percentage error.
    """
    if "type" in forecast.columns:
        forecast = forecast.where(F.col("type") == "Forecast")
    pairs = forecast.join(actual.select(*on, "y"), list(on))
    error = F.col("y") - F.col("forecast")
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(ratio(error, F.col("y")))) * 100).alias("mape"),
    )


def compare_models(actual: DataFrame, forecasts: dict[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Errors per model, best RMSE first."""
    named = [f.withColumn("model", F.lit(name)) for name, f in forecasts.items()]
    stacked = named[0]
    for other in named[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return evaluate(actual, stacked, on, ["model"]).orderBy("rmse", "model")


def flat_forecast(split: DataFrame, keys: Sequence[str] = (), window: int = 14) -> DataFrame:
    """The last moving average of each training part, as the forecast of its test dates.

    A training part of at most ``window`` rows gives no forecast.
    """
    backwards = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    train = split.where(F.col("split") == "train").withColumns(
        {"_back": F.row_number().over(backwards), "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    )
    last = train.where((F.col("_back") <= window) & (F.col("_n") > window))
    level = last.groupBy(*keys).agg(
        F.when(F.count("y") == window, F.avg("y")).alias("forecast")
    )
    return _match(split.where(F.col("split") == "test").select(*keys, "ds"), level, keys)


def baseline(panel: DataFrame, keys: Sequence[str] = (), window: int = 14, test_size: float = 0.2) -> DataFrame:
    """Accuracy (100 - MAPE) and horizon of the flat forecast per series, after an 80/20 split by position.

    Accuracy is NULL for a training part of at most ``window`` rows.
    """
    split = position_split(panel, keys, ["ds"], test_size)
    backwards = Window.partitionBy(*keys, "split").orderBy(F.desc("ds"))
    ranked = split.withColumn("_back", F.row_number().over(backwards))
    in_train = F.col("split") == "train"
    level = F.when(
        (F.count_if(in_train) > window) & (F.count_if(in_train & (F.col("_back") <= window) & F.col("y").isNotNull()) == window),
        F.avg(F.when(in_train & (F.col("_back") <= window), F.col("y"))),
    )
    stats = ranked.groupBy(*keys).agg(level.alias("forecast"))
    scored = _match(split.where(~in_train), stats, keys)
    mape = F.avg(F.abs(ratio(F.col("y") - F.col("forecast"), F.col("y")))) * 100
    return scored.groupBy(*keys).agg(
        F.max("forecast").alias("forecast"), (F.lit(100.0) - mape).alias("accuracy"), F.count(F.lit(1)).alias("horizon")
    )
