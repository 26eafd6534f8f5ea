"""Labelled rows for the classifiers: who may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, by ``folds``; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def training_rows(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int = TRAIN_ROWS
) -> DataFrame:
    """text and label (0.0 or 1.0) of at most ``rows`` labelled documents outside the held-out fold.

    The sample is the first ``rows`` ids in a hashed order, so it is the same in
    every run. It is broadcast: its size is bounded by ``rows``. An id that
    stands on several rows gives one, with its least text.
    """
    chosen = (  # one row per label: an id labelled twice counts twice
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("label"))
        .orderBy(F.md5(F.col("_id").cast("string")), "label")
        .limit(rows)
    )
    texts = documents.select("doc_id", "text")
    ids = chosen.groupBy("_id").agg(F.collect_list("label").alias("_labels"))
    found = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    # Least texts are found map-side first, so a repeated id moves one text per task.
    one = found.groupBy("_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("_labels").alias("_labels"))
    return one.select("text", F.explode("_labels").alias("label"))
