"""Order-dependent work without one task holding a whole group.

``running_totals`` and ``row_positions`` sort by range partitioning, take one
small total per slice, and add the totals of the preceding slices; ``in_chunks``
runs a row-frame window over bounded chunks, each extended by the rows before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wharfline.functions.durable import durable

SLICE = "_slice"
POSITION = "_position"
CHUNK_ROWS = 500_000


def _sliced(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in range-ordered slices; stored, so every later read sees the same slices."""
    return durable(df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id()))


def running_totals(
    df: DataFrame, order: Sequence[Column], value: str, total: str, share: str | None = None
) -> DataFrame:
    """Running sum of ``value`` in the given order, and optionally its share of the grand total."""
    sliced = _sliced(df, order)
    # One row per slice: at most spark.sql.shuffle.partitions rows.
    sums = sliced.groupBy(SLICE).agg(F.sum(value).cast("double").alias("_sum"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        SLICE,
        F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_before"),
        F.sum("_sum").over(everything).alias("_grand"),
    )
    within = Window.partitionBy(SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = sliced.join(F.broadcast(offsets), SLICE).withColumn(total, F.col("_before") + F.sum(value).over(within))
    if share:
        out = out.withColumn(share, F.try_divide(F.col(total), F.col("_grand")))
    return out.drop(SLICE, "_before", "_grand")


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], position: str = POSITION) -> DataFrame:
    """Number the rows of each key from 1; a key of any size is spread over many tasks."""
    by_key = [F.col(k) for k in keys]
    sliced = _sliced(df, [*by_key, *order])
    counts = sliced.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(SLICE).alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    match = F.col(SLICE) == F.col("_s")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    within = Window.partitionBy(*keys, SLICE).orderBy(*order)
    return (
        sliced.join(offsets, match)
        .withColumn(position, F.col("_before") + F.row_number().over(within))
        .drop(SLICE, "_s", "_before", *[f"_k{i}" for i in range(len(keys))])
    )


def in_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    reach: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Window columns that look back at most ``reach`` rows, computed chunk by chunk.

    Each chunk of a key gets copies of the last ``reach`` rows before it, so the
    result equals the window over the whole key.
    """
    size = max(chunk_rows, reach, 1)
    placed = row_positions(df, keys, order).withColumn("_chunk", F.floor((F.col(POSITION) - 1) / size))
    tail = F.col(POSITION) > (F.col("_chunk") + 1) * size - reach
    homes = F.when(tail, F.array(F.col("_chunk"), F.col("_chunk") + 1)).otherwise(F.array(F.col("_chunk")))
    spread = placed.withColumn("_home", F.explode(homes))
    window = Window.partitionBy(*keys, "_home").orderBy(POSITION)
    return (
        spread.withColumns(columns(window))
        .where(F.col("_home") == F.col("_chunk"))
        .drop("_chunk", "_home", POSITION)
    )


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest key; one number, aggregated map-side first."""
    if not keys:
        return df.count()
    top = df.groupBy(*keys).count().agg(F.max("count").alias("n")).first()
    return top["n"] or 0


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    reach: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    method: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Window columns with a bounded look-back.

    ``window`` sorts each key in one task: right where a key is known to be
    short, such as one row per date. ``chunked`` splits every key. ``auto``
    counts rows per key and splits when the largest exceeds ``chunk_rows``.
    """
    if method == "auto":
        method = "chunked" if largest_group(df, keys) > chunk_rows else "window"
    if method == "chunked":
        return in_chunks(df, keys, order, reach, columns, chunk_rows)
    if method != "window":
        raise ValueError(f"unknown method: {method}")
    return df.withColumns(columns(Window.partitionBy(*keys).orderBy(*order)))
