"""Exact interpolated quantiles for groups of any size.

Small groups use the built-in percentile, whose state holds a group's distinct
values. For large ones equal values are counted first, so copies cost nothing. The distinct values are
then cut into bands at approximate quantiles of the whole column; per group only
the band holding the wanted rank is ordered. The bands decide how the work is
spread, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.functions.expressions import drop_null_keys
from wharfline.functions.ordering import largest_group

BANDS = 128
STATE_ROWS = 1_000_000


def _band_of(cuts: Column, value: Column, bands: int) -> Column:
    """Number of sorted cuts below a value, found by halving steps."""
    steps = [2**i for i in reversed(range(bands.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at),
    )


def fits_one_state(df: DataFrame, keys: Sequence[str], limit: int = STATE_ROWS) -> bool:
    """Whether every group is small enough for its distinct values to be one aggregation state.

    Costs one aggregation over the key columns; a single number comes back.
    """
    return largest_group(drop_null_keys(df, keys), keys) <= limit


def built_in_quantile(column: str, probability: float) -> Column:
    value = F.col(column).cast("double")
    return F.percentile(F.when(~F.isnan(value), value), probability)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: dict[str, tuple[str, float]],
    method: str = "auto",
) -> DataFrame:
    """One row per key with the columns of ``wanted``: output name -> (value column, probability).

    ``method`` is ``built_in``, ``banded``, or ``auto`` to decide by the largest group; the
    result is the same. NaN counts as missing; a group without values gets NULL.
    """
    if method == "auto":
        method = "built_in" if fits_one_state(df, keys) else "banded"
    if method == "banded":
        return banded_quantiles(df, keys, wanted)
    if method != "built_in":
        raise ValueError(f"unknown method: {method}")
    aggregates = [built_in_quantile(v, p).alias(name) for name, (v, p) in wanted.items()]
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggregates)


def banded_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: dict[str, tuple[str, float]],
    bands: int = BANDS,
) -> DataFrame:
    """The same for groups of any size; the value counts are stored once and read twice."""
    values = list(dict.fromkeys(v for v, _ in wanted.values()))
    pairs = F.array(*[F.struct(F.lit(v).alias("_measure"), F.col(v).cast("double").alias("_value")) for v in values])
    long = (
        drop_null_keys(df, keys)
        .select(*keys, F.inline(pairs))
        .where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    )
    counts = durable(long.groupBy(*keys, "_measure", "_value").agg(F.count(F.lit(1)).alias("_n")))
    cuts = counts.groupBy("_measure").agg(
        F.percentile_approx("_value", [i / bands for i in range(1, bands)], 10 * bands).alias("_cuts")
    )
    # One row per value column of the call.
    banded = counts.join(F.broadcast(cuts), "_measure").select(
        *keys,
        "_measure",
        "_value",
        "_n",
        _band_of(F.col("_cuts"), F.col("_value"), bands).alias("_band"),
    )
    group = [*keys, "_measure"]
    sizes = banded.groupBy(*group, "_band").agg(F.sum("_n").alias("_band_n"))
    # At most ``bands`` rows per group and measure from here on.
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select(
        *group,
        "_band",
        "_band_n",
        F.coalesce(F.sum("_band_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_band_n").over(whole).alias("_total"),
    )
    ranks = [(name, v, p, (F.col("_total") - 1) * F.lit(float(p))) for name, (v, p) in wanted.items()]
    needed = F.lit(False)
    for _, v, _, rank in ranks:
        hit = F.lit(False)
        for r in (F.floor(rank), F.ceil(rank)):
            hit = hit | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_band_n")))
        needed = needed | ((F.col("_measure") == v) & hit)
    chosen = placed.where(needed).drop("_band_n")
    in_band = Window.partitionBy(*group, "_band").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ordered = banded.join(chosen, [*group, "_band"]).withColumn(
        "_end", F.col("_before") + F.sum("_n").over(in_band)
    )

    def at(rank, v):
        holds = (F.col("_measure") == v) & (rank >= F.col("_end") - F.col("_n")) & (rank < F.col("_end"))
        return F.max(F.when(holds, F.col("_value")))

    aggregates, results = [], []
    for i, (name, v, _, rank) in enumerate(ranks):
        aggregates += [
            at(F.floor(rank), v).alias(f"_lo{i}"),
            at(F.ceil(rank), v).alias(f"_hi{i}"),
            F.max(F.when(F.col("_measure") == v, rank - F.floor(rank))).alias(f"_f{i}"),
        ]
        results.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(name))
    found = ordered.groupBy(*keys).agg(*aggregates).select(*keys, *results)
    # A group without any value is a row, too; the missing row of an ungrouped frame comes from the aggregate.
    return drop_null_keys(df, keys).select(*keys).distinct().join(found, list(keys), "left") if keys else found
