"""Mixing sources to target weights by capped water-filling.

A budget of words is shared out by weight. A source takes at most
``max_epochs`` times its own words; what it cannot take goes to the others in
proportion to their weights, until no target is above its ceiling. The targets
are then all of the form ``least(ceiling, level * weight)``, and one number, the
water level, is what the rounds look for.

A target of 1.37 sources is drawn as one whole repetition of every document and
a fractional repetition of the source: documents in a seeded order of their ids
until the missing words are there. The document at the cut gives only as many
words as are still missing, so a source misses its target by rounding alone.

Only sums per source and per hash bucket of a source are shuffled. A hot source
is summed map-side, and its running sum covers at most ``BUCKETS`` rows plus the
rows of one bucket.

Defined cases: null text and text without words have size 0 and are never
taken; a null source is a source of its own, the last one; a null id is hashed
as an empty one; rows that share an id and lie at the cut share the missing
words in proportion to their sizes, rounded down; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.functions.ordering import row_positions
from wharfline.llm.common import GAP, n_words, packed, query, table, unpacked

SEED = "mix-1"
BUCKETS = 4096  # three hex digits of the order key
BROADCAST_SOURCES = 100_000  # rows of a few dozen bytes; more sources are joined by shuffle


def order_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))


def measured(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """One narrow row per document: id, source, size in words, order key."""
    return documents.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), order_key(F.col("doc_id"), seed).alias("order_key")
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2
) -> DataFrame:
    """One row per source: its size, weight, target, whole repetitions and words of the fractional one.

    Sources in order of code points, null last, take the weights in turn.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = row_positions(totals, [], [F.col("source").asc_nulls_last()], "_nth")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_nth") - 1).cast("int") % len(weights) + 1)
    sources = durable(
        ordered.select(
            "source", "source_size", turn.alias("weight"), (F.col("source_size") * float(max_epochs)).alias("_cap")
        )
    )
    whole = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    budget = float(share) * (whole["n"] or 0)
    level, before = (budget / whole["w"] if whole["w"] else 0.0), None
    while True:  # every round closes at least one more source, or is the last
        full = F.col("_cap") <= F.lit(level) * F.col("weight")
        sums = sources.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0.0)).alias("closed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
        ).first()
        if sums["n"] == before or not sums["open"]:
            break
        before, level = sums["n"], (budget - sums["closed"]) / sums["open"]
    target = F.least(F.col("_cap"), F.lit(level) * F.col("weight")) if before != 0 or level else F.lit(0.0)
    words = F.floor(F.col("target") + 0.5)
    size = F.col("source_size")
    return sources.withColumn("target", target).select(
        "source",
        "source_size",
        "weight",
        "target",
        F.when(size > 0, F.floor(words / F.when(size > 0, size))).otherwise(0).cast("long").alias("whole"),
        F.when(size > 0, words % F.when(size > 0, size)).otherwise(0).cast("long").alias("part"),
    )


def cut_points(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the order key at which its fractional repetition ends.

    ``cut_before`` words lie before that key, ``cut_size`` at it.
    """
    bucket = F.substring("order_key", 1, 3)
    narrow = targets.select(F.col("source").alias("_s"), "part")
    sums = sizes.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("_n").over(before), F.lit(0))
    here = (F.col("part") >= F.col("_before")) & (F.col("part") < F.col("_before") + F.col("_n"))
    buckets = (
        sums.withColumn("_before", at)
        .join(narrow, F.col("source").eqNullSafe(F.col("_s")))
        .where(here)
        .select("_s", F.col("_bucket").alias("_b"), F.col("_before").alias("_start"), "part")
    )
    inside = (
        sizes.join(buckets, F.col("source").eqNullSafe(F.col("_s")) & (bucket == F.col("_b")))
        .groupBy("_s", "_start", "part", "order_key")
        .agg(F.sum("size").alias("_n"))
    )
    earlier = Window.partitionBy("_s").orderBy("order_key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        inside.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where(here)
        .select("_s", F.col("order_key").alias("cut"), F.col("_before").alias("cut_before"), F.col("_n").alias("cut_size"))
    )


def drawing_plan(sizes: DataFrame, **settings) -> DataFrame:
    """Everything a document needs to know about its source, one row per source."""
    targets = durable(source_targets(sizes, **settings))
    cuts = cut_points(sizes, targets)
    plan = durable(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            F.col("source").alias("_source"),
            F.struct("source_size", "target", "whole", "part", "cut", "cut_before", "cut_size").alias("_plan"),
        )
    )
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def partial_words(size: Column, key: Column) -> Column:
    """Words of a document in the fractional repetition of its source."""
    plan = F.col("_plan")
    missing = plan["part"] - plan["cut_before"]
    at_cut = F.floor(size * missing / F.when(plan["cut_size"] > 0, plan["cut_size"]))
    return F.coalesce(F.when(key < plan["cut"], size).when(key == plan["cut"], at_cut), F.lit(0)).cast("long")


def mixed(documents: DataFrame, seed: str = SEED, **settings) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes."""
    sizes = durable(measured(documents, seed))
    plan = drawing_plan(sizes, **settings)
    part = partial_words(F.col("size"), F.col("order_key"))
    whole = F.col("_plan.whole")
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "_plan.source_size", "_plan.target", whole.alias("whole"),
        part.alias("part_words"), (whole * F.col("size") + part).alias("taken"),
    )


def mixture(documents: DataFrame, seed: str = SEED, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, the one at the cut shortened.

    Columns are those of ``documents``; repeated rows are repetitions. A
    shortened text keeps its first words.
    """
    plan = drawing_plan(durable(measured(documents, seed)), **settings)
    text = F.col("_row.text")
    sized = packed(documents).withColumns({"_size": n_words(text), "_key": order_key(F.col("_row.doc_id"), seed)})
    drawn = sized.join(plan, F.col("_row.source").eqNullSafe(F.col("_source"))).withColumn(
        "_part", partial_words(F.col("_size"), F.col("_key"))
    )
    whole = F.array_repeat(F.lit(-1).cast("long"), F.col("_plan.whole").cast("int"))
    takes = F.when(F.col("_part") > 0, F.concat(whole, F.array("_part"))).otherwise(whole)
    taken = drawn.select("_row", "_size", F.explode(takes).alias("_take"))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    shortened = F.array_join(F.slice(words, 1, F.col("_take").cast("int")), " ")
    new = F.when((F.col("_take") < 0) | (F.col("_take") >= F.col("_size")), text).otherwise(shortened)
    taken = taken.withColumn("_text", new)
    return unpacked(taken, documents.columns, text=F.col("_text"), n_chars=F.char_length("_text").cast("long"))


SQL_MIX = """
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
src AS (
  SELECT source, n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
         2.0::DOUBLE * n AS cap
  FROM (SELECT source, sum(size)::BIGINT AS n FROM sizes GROUP BY source)),
whole AS (SELECT 1.5::DOUBLE * sum(n) AS t, sum(w) AS w, count(*) AS m FROM src),
level(i, lam) AS (
  SELECT 0, (t / w)::DOUBLE FROM whole
  UNION ALL
  SELECT i + 1, coalesce((SELECT ((SELECT t FROM whole) - sum(CASE WHEN cap <= lam * w THEN cap ELSE 0 END))
                          / nullif(sum(CASE WHEN cap <= lam * w THEN 0 ELSE w END), 0) FROM src), lam)::DOUBLE
  FROM level WHERE i <= (SELECT m FROM whole)),
targets AS (
  SELECT source, n, least(cap, lam * w) AS target, floor(least(cap, lam * w) + 0.5)::BIGINT AS words
  FROM src, (SELECT lam FROM level ORDER BY i DESC LIMIT 1)),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.n, t.target, s.k,
         CASE WHEN t.n > 0 THEN t.words // t.n ELSE 0 END AS whole, CASE WHEN t.n > 0 THEN t.words % t.n ELSE 0 END AS part
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
keyed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, k) AS here,
         sum(size) OVER (PARTITION BY source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM placed)
SELECT doc_id, size, n AS source_size, target,
       (whole * size + CASE WHEN upto <= part THEN size
                            WHEN upto - here <= part AND here > 0 THEN floor(size * (part - (upto - here)) / here)::BIGINT
                            ELSE 0 END)::BIGINT AS taken
FROM keyed
"""


@query("op6_mixing", SQL_MIX)
def op6_mixing(spark, folder):
    return mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
