"""What several operators share: words, tables, counting rows cheaply."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the result contracts: words are runs of anything but the six ASCII
# white-space characters. ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with its SQL where SQL can express it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, size: str = "16m") -> None:
    """Bound what one Arrow batch of texts takes in a Python worker, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def packed(documents: DataFrame) -> DataFrame:
    """All columns in one struct ``_row``, so that names an operator adds cannot clash with them."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))


def unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``_row`` again, some of them replaced."""
    return rows.select(*[(changed[c] if c in changed else F.col("_row")[c]).alias(c) for c in columns])
