"""Token totals by source, language and tokenizer version, kept up to date by deltas.

A change is an insert, a delete or a revised count and carries the count it
takes away and the count it brings. A batch of changes is summed to one signed
row per source, language and tokenizer version and written once, in a folder
named after the batch. Totals are the sum of the committed batches, so nothing
old is ever read again per document.

A batch counts from the moment its folder has Spark's ``_SUCCESS`` file, which
is written last. A batch that died halfway is not counted and is overwritten by
its next attempt; a batch that is committed again changes nothing.

``compact`` sums what is committed to a base and names the batches in it, so that
totals read the newest base and the few batches behind it. A base counts from its own
``_SUCCESS`` file, too; batches in it stay known, so sending one again still
changes nothing, and ``drop_compacted`` removes their folders.

Counts may be of any tokenizer: ``counted`` has two that SQL can count,
``counted_by`` that of a byte-level vocabulary.

Sums are taken map-side, so a hot source costs one row per task.

Defined cases: a null source, language or version is a group of its own; a null
count is 0; repeated change rows count each; groups with neither documents nor
tokens left vanish from the totals; an empty batch commits and adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import durable, scratch_path
from wharfline.llm.byte_bpe import Encoder, encode_batches, public_vocabulary, read_ranks
from wharfline.llm.common import WORD, query, small_batches, table

KEYS = ("source", "lang", "tokenizer")
# Two tokenizer versions that SQL can count, too: white-space words, and runs of
# letters, of digits and of other marks.
PIECE = r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]+"
ADDRESS = r"[^\x20\x09-\x0D]*(?:@|://)[^\x20\x09-\x0D]*"

SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def changes(rows: DataFrame, tokenizer: str, new: str | None = None, old: str | None = None) -> DataFrame:
    """Signed change rows: inserts have a new count only, deletes an old one, revisions both."""
    brought = F.coalesce(F.col(new), F.lit(0)) if new else F.lit(0)
    taken = F.coalesce(F.col(old), F.lit(0)) if old else F.lit(0)
    documents = (1 if new else 0) - (1 if old else 0)
    return rows.select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"),
        F.lit(documents).cast("long").alias("documents"), (brought - taken).cast("long").alias("tokens"),
    )


class Rollup:
    """Committed batches under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, text: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(text)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _place(self, batch: str) -> str:
        if not batch or not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a batch is named by letters, digits, - and _: {batch!r}")
        return f"{self.folder}/batch={batch}"

    def _complete(self, place: str) -> bool:
        system, path = self._path(f"{place}/_SUCCESS")
        return system.exists(path)

    def _names(self, kind: str) -> list[str]:
        system, path = self._path(self.folder)
        if not system.exists(path):
            return []
        names = [s.getPath().getName() for s in system.listStatus(path)]
        return sorted(n.removeprefix(f"{kind}=") for n in names if n.startswith(f"{kind}="))

    def _base(self) -> str | None:
        """The newest base that is complete."""
        whole = [n for n in self._names("base") if self._complete(f"{self.folder}/base={n}/totals")]
        return f"{self.folder}/base={whole[-1]}" if whole else None

    def compacted(self) -> set[str]:
        """Batches in the newest base."""
        base = self._base()
        return {r["batch"] for r in self.spark.read.schema("batch string").json(f"{base}/batches").collect()} if base else set()

    def committed(self, batch: str) -> bool:
        return self._complete(self._place(batch)) or batch in self.compacted()

    def _behind(self, compacted: set[str]) -> list[str]:
        return [b for b in self._names("batch") if b not in compacted and self._complete(self._place(b))]

    def batches(self) -> list[str]:
        compacted = self.compacted()
        return sorted({*compacted, *self._behind(compacted)})

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch; False where it is already in, and then nothing is read or written."""
        if self.committed(batch):
            return False
        delta = signed.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(self._place(batch))
        return True

    def _sums(self, places: list[str]) -> DataFrame:
        deltas = self.spark.read.schema(SCHEMA).parquet(*places)
        return deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def _places(self) -> list[str]:
        base = self._base()
        return [*([f"{base}/totals"] if base else []), *map(self._place, self._behind(self.compacted()))]

    def totals(self) -> DataFrame:
        places = self._places()
        if not places:
            return self.spark.createDataFrame([], SCHEMA)
        return self._sums(places).where("documents <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Sum everything committed to a new base; its totals are written last, and only then does it count."""
        places, batches = self._places(), self.batches()
        if not places:
            return
        base = f"{self.folder}/base={len(self._names('base')):08d}"
        rows = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        rows.coalesce(1).write.mode("overwrite").json(f"{base}/batches")
        self._sums(places).write.mode("overwrite").parquet(f"{base}/totals")

    def drop_compacted(self) -> None:
        """Remove the folders of batches that the newest base holds, and older bases."""
        base = self._base()
        places = [self._place(b) for b in self.compacted()] + [f"{self.folder}/base={n}" for n in self._names("base")]
        for place in places:
            if base and place < base or not place.startswith(f"{self.folder}/base="):
                system, path = self._path(place)
                system.delete(path, True)


def counted(documents: DataFrame) -> DataFrame:
    """One narrow row per document with its counts under both versions and without addresses."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(WORD))
    return documents.select(
        "doc_id", "source", "lang",
        words.cast("long").alias("words"),
        F.regexp_count(text, F.lit(PIECE)).cast("long").alias("pieces"),
        (words - F.regexp_count(text, F.lit(ADDRESS))).cast("long").alias("masked"),
    )


def counted_by(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, source, lang, tokens: the whole texts counted by a byte-level vocabulary."""
    small_batches(documents.sparkSession)
    vocabulary = documents.sparkSession.sparkContext.broadcast(read_ranks(path))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            whole = [len(ids) // 4 for _, part in encode_batches([batch], encoder, pattern) for ids in part]
            columns = [batch.column(c) for c in ("doc_id", "source", "lang")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(whole, pa.int64())], names=["doc_id", "source", "lang", "tokens"])

    rows = documents.select(F.col("doc_id").cast("long"), "source", "lang", "text")
    return rows.mapInArrow(counts, "doc_id long, source string, lang string, tokens long")


SQL_COUNTS = """
WITH counted AS (
  SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words,
         len(regexp_extract_all(coalesce(text, ''), '\\p{L}+|\\p{N}+|[^\\x20\\x09-\\x0D\\p{L}\\p{N}]+')) AS pieces,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]*(?:@|://)[^\\x20\\x09-\\x0D]*')) AS addresses
  FROM documents),
kept AS (SELECT * FROM counted WHERE words - addresses >= 5),
both_versions AS (
  SELECT source, lang, 'words-1' AS tokenizer, words - addresses AS n FROM kept
  UNION ALL SELECT source, lang, 'pieces-2', pieces FROM kept)
SELECT source, lang, tokenizer, count(*)::BIGINT AS documents, sum(n)::BIGINT AS tokens
FROM both_versions GROUP BY ALL
"""


@query("op10_token_counts", SQL_COUNTS)
def op10_token_counts(spark, folder):
    """All documents loaded in four batches, counted by a second tokenizer, revised once addresses are
    masked, and withdrawn where fewer than five words are left; two batches are sent twice."""
    rows = durable(counted(table(spark, folder, "documents")))
    rollup = Rollup(spark, scratch_path(spark, "token-counts"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    for n in range(4):
        rollup.commit(f"load-{n}", changes(rows.where(part == n), "words-1", new="words"))
    rollup.commit("load-2", changes(rows.where(part == 2), "words-1", new="words"))
    rollup.commit("second-tokenizer", changes(rows, "pieces-2", new="pieces"))
    masked = changes(rows.where("masked <> words"), "words-1", new="masked", old="words")
    rollup.commit("mask", masked)
    rollup.commit("mask", masked)
    gone = rows.where("masked < 5")
    rollup.commit("withdraw", changes(gone, "words-1", old="masked").union(changes(gone, "pieces-2", old="pieces")))
    return rollup.totals()


@query("token_counts_by_vocabulary")
def token_counts_by_vocabulary(spark, folder):
    """All documents counted by the public vocabulary in two batches, one of them sent twice, and compacted between."""
    rows = durable(counted_by(table(spark, folder, "documents"), *public_vocabulary()))
    rollup = Rollup(spark, scratch_path(spark, "vocabulary-counts"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    first = changes(rows.where(part == 0), "byte-bpe-50k", new="tokens")
    rollup.commit("first", first)
    rollup.compact()
    rollup.drop_compacted()
    rollup.commit("first", first)
    rollup.commit("second", changes(rows.where(part == 1), "byte-bpe-50k", new="tokens"))
    return rollup.totals()
