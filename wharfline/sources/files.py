"""Reading and writing by file extension."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}


def file_format(path: str) -> str:
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension not in FORMATS:
        raise ValueError(f"unsupported file format: {extension or path}")
    return FORMATS[extension]


def load_data(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    records_array: bool = True,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Read csv, parquet or json, told by the extension; any file system Spark knows.

    Give a schema for large text input: inferring one costs a pass over it.
    ``records_array`` reads a json array per file; turn it off for one object
    per line, which can be split between tasks.
    """
    kind = file_format(path)
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:  # a header of other names is an error, not columns in the wrong place
            reader = reader.option("enforceSchema", False)
        if timestamp_format:
            reader = reader.option("timestampFormat", timestamp_format)
    if kind == "json":
        reader = reader.option("multiLine", records_array)
    return reader.load(path)


def save_data(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write csv, parquet or json, told by the extension; one file per task."""
    writer = df.write.mode(mode).format(file_format(path))
    if path.rstrip("/").lower().endswith(".csv"):
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def dataset_name(path: str) -> str:
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]


def view_name(path: str) -> str:
    """The dataset name with everything but letters, digits and underscores replaced."""
    return re.sub(r"\W", "_", dataset_name(path))


def load_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a file and register it as a temporary view named after it."""
    try:
        df = load_data(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    df.createOrReplaceTempView(view_name(path))
    return df


def load_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType | str], extension: str = "csv",
                timestamp_format: str | None = None) -> dict[str, DataFrame]:
    """Read several tables of one folder with declared schemas, dates included."""
    return {
        name: load_data(spark, f"{folder.rstrip('/')}/{name}.{extension}", schema, timestamp_format=timestamp_format)
        for name, schema in schemas.items()
    }


def discover(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """One row per matching file: dataset, path, bytes. File contents are not read.

    A dataset is a file of the folder, or a folder of part files such as
    ``save_data`` writes; it is named after the first step below the folder.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("length").alias("bytes"))
    )
    return found.select(_dataset_of(F.col("path"), folder).alias("dataset"), "path", "bytes")


def _dataset_of(path: Column, folder: str) -> Column:
    """The first step of a path below a folder, without extension."""
    below = F.element_at(F.split(path, f"/{re.escape(folder.rstrip('/').rsplit('/', 1)[-1])}/"), -1)
    return F.regexp_replace(F.get(F.split(below, "/"), F.lit(0)), r"\.[^.]*$", "")


def read_folder(spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str = "*.csv") -> DataFrame:
    """All matching csv files of a folder with the dataset each row came from."""
    options = {"header": True, "pathGlobFilter": pattern, "recursiveFileLookup": True}
    rows = spark.read.schema(schema).options(**options).csv(folder)
    return rows.withColumn("dataset", _dataset_of(F.col("_metadata.file_path"), folder))


def save_predictions(df: DataFrame, path: str) -> str:
    """Predictions as json lines."""
    df.write.mode("overwrite").json(path)
    return path


def save_report(df: DataFrame, path: str, compression: str = "none") -> str:
    """A validation, profile or report table as json lines."""
    df.write.mode("overwrite").json(path, compression=compression)
    return path


def save_dictionary(df: DataFrame, path: str) -> str:
    """A data dictionary as csv."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def to_json_records(df: DataFrame, name: str = "record") -> DataFrame:
    """Every row as one json text."""
    return df.select(F.to_json(F.struct("*")).alias(name))
