"""Partitioned tables over folders that keep growing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_zone(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Write parquet partitioned by low-cardinality columns, one shuffle first so that files stay large.

    AQE splits a partition value that holds far more rows than the others.
    """
    df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def _partitions_on_disk(spark: SparkSession, path: str, partition_by: Sequence[str]) -> set[tuple[str, ...]]:
    """Partition values of the folders below a path, level by level; names only, no file is opened."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    system = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [((), path.rstrip("/"))]
    for column in partition_by:
        found = [
            ((*values, unescape(name.split("=", 1)[1])), f"{folder}/{name}")
            for values, folder in found
            for status in system.listStatus(hadoop.Path(folder))
            if (name := status.getPath().getName()).startswith(f"{column}=")
        ]
    return {values for values, _ in found}


def _partitions_in_catalog(spark: SparkSession, name: str) -> set[tuple[str, ...]]:
    """A row per partition, as the catalog lists them."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {tuple(unescape(part.split("=", 1)[1]) for part in r["partition"].split("/")) for r in rows}


def register_zone(
    spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = (), merge_schemas: bool = False
) -> DataFrame:
    """Create an external table over a folder, or bring it up to date with what the folder has gained.

    A table that is there stays: new partitions are added by name, one statement
    for all, those that are gone are dropped, and new columns are appended. A column that has
    changed its type is an error. The schema comes from one file;
    ``merge_schemas`` reads the footers of all, which costs with many files.
    """
    found = spark.read.option("mergeSchema", merge_schemas).parquet(path)
    typed = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{c}` {t}" for c, t in typed.items())
        partitioned = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet {partitioned} LOCATION '{path}'")
        if partition_by:
            spark.catalog.recoverPartitions(name)
        return spark.table(name)
    known = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields}
    changed = [c for c, t in typed.items() if c in known and known[c] != t]
    if changed:
        raise ValueError(f"columns of {name} have changed their type: {', '.join(changed)}")
    added = ", ".join(f"`{c}` {t}" for c, t in typed.items() if c not in known)
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    if partition_by:
        there, listed = _partitions_on_disk(spark, path, partition_by), _partitions_in_catalog(spark, name)

        def clause(values: tuple[str, ...]) -> str:
            quoted = [v.replace("\\", "\\\\").replace("'", "\\'") for v in values]
            pairs = ["`{}` = {}".format(c, "NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'") for c, v in zip(partition_by, quoted)]
            return f"PARTITION ({', '.join(pairs)})"

        if there - listed:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(map(clause, sorted(there - listed)))}")
        if listed - there:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(clause, sorted(listed - there)))}")
    spark.catalog.refreshTable(name)
    return spark.table(name)
