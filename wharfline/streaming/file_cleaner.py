"""Clean csv files as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wharfline.operators.cleaning import parse_date_columns

FILE = "source_file"


def incoming_files(spark: SparkSession, folder: str, schema: T.StructType | str, per_batch: int = 1000) -> DataFrame:
    """New csv files of a folder as a stream; a file is never split between batches."""
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", per_batch)
        .csv(folder)
    )
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def clean_batch(rows: DataFrame) -> DataFrame:
    """Drop duplicates within each file and parse date columns."""
    return parse_date_columns(rows.dropDuplicates())


def start_cleaner(
    spark: SparkSession,
    raw_folder: str,
    processed_folder: str,
    checkpoint: str,
    schema: T.StructType | str,
    per_batch: int = 1000,
    continuous: bool = False,
) -> StreamingQuery:
    """Write every new file, cleaned, to the processed folder as gzipped csv, each file once.

    Each row carries the path of its file, which costs next to nothing compressed.
    A batch that is repeated after a failure overwrites its own folder. By
    default the query handles what is there and ends; ``continuous`` keeps it waiting.
    """

    def write(batch: DataFrame, number: int) -> None:
        target = f"{processed_folder.rstrip('/')}/batch={number}"
        clean_batch(batch).write.mode("overwrite").option("header", True).csv(target, compression="gzip")

    writer = (
        incoming_files(spark, raw_folder, schema, per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def processed_rows(spark: SparkSession, processed_folder: str, schema: T.StructType | str) -> DataFrame:
    """The cleaned rows of all batches so far."""
    return spark.read.schema(schema).option("header", True).csv(processed_folder)
