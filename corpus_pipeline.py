"""A corpus pipeline of five stages over ``documents``.

Quality classifier, SimHash near-dedup, substring dedup, mixing to target weights,
byte-level BPE. Every stage gets what its predecessor kept; all but the last
return the columns of documents.

A row without an id stands for a group only where no other row can. A document
that substring dedup empties stays, with an empty text: it has no words, so the
mix does not take it. Null texts are empty to every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import scratch_path
from wharfline.llm import byte_bpe, mixing, quality_gam, recompression, simhash
from wharfline.llm.common import table

# Models and graph searches have no SQL; tests compare with plain re-computation.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier predicts to be good; it learns from those outside the held-out fold."""
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_gam.quality(model, F.col("text")) >= quality_gam.THRESHOLD)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents of smaller id have, too."""
    return recompression.without_repeats(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixture(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix as counts and digests, and of their decoded bytes."""
    return byte_bpe.digests(docs, *byte_bpe.public_vocabulary())


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each_group),
    ("substring dedup", without_repeated_passages),
    ("mixing sources", mixed_to_weights),
    ("byte-level bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage kept is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            place = scratch_path(spark, f"pipeline-{at}-{name.replace(' ', '-')}")
            docs.write.parquet(place)
            docs = spark.read.parquet(place)
    return docs
