"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are taken text by text. Equal ones are one code from then on, so a
group of copies costs one row. Codes that differ in at most ``REACH`` of 64 bits
agree in one of four blocks of 16; a code is sent to four buckets, one per
block, and only codes of a bucket are compared.

In a bucket the codes are sorted by Gray rank, where neighbours differ in few
bits. ``FAN`` neighbours form a node, ``FAN`` nodes a node above, up to one root.
A node keeps the bits that all its codes share: a mask and their pattern. The
index is joined with itself from the root down: two nodes differ in at least the
bits that both share and that disagree, and once these exceed ``REACH`` the whole
pair of groups is dropped. What is left at the bottom is compared code by code.
Pairs of nodes whose codes are linked to each other already are skipped, as they
cannot change a component. A task sends on a spanning forest, never all pairs.

A bucket of more than ``HOT`` codes is dealt out again by four blocks of the bits
that its codes do not share, and so on; after four rounds a bucket shares 43 bits,
so no task ever holds more than 2^21 codes of one bucket.

Defined cases: null text and text without words have fingerprint zero; fewer
words than a shingle are one shingle; null ids get a row and are never the
smallest of a component (a component of null ids alone has a null id); repeated
rows are linked like copies; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.llm.common import packed, query, small_batches, table, unpacked
from wharfline.llm.unions import link
from wharfline.operators.network import components

SEED = 42
SHINGLE = 3
REACH = 3
HOT = 50_000
FAN = 8
ROWS_AT_ONCE = 200_000
PAIRS_AT_ONCE = 250_000
BLOCKS = (16, 12, 9, 7)  # bits of each of four blocks, level by level: 64, 48, 36 and 27 bits in all


def fingerprint_text(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width]))
    spans = zip(starts.tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # 64 bytes for each hash of a part
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Per document its 64-bit fingerprint as a signed integer; ``twin`` tells texts of equal id apart."""
    small_batches(documents.sparkSession)

    def hashed(batches):  # ids stay Arrow values: pandas has no nulls among integers
        for batch in batches:
            codes = [fingerprint_text(t, shingle, seed) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("twin"), pa.array(codes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "twin", "code"])

    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("twin"), "text")
    return rows.mapInArrow(hashed, "doc_id long, twin long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class Forest:
    """The hierarchical indexes of several buckets, one root each.

    ``levels[0]`` are the codes in order of bucket and Gray rank; each level has
    the shared mask and pattern of its nodes and where their children start.
    """

    def __init__(self, buckets: np.ndarray, codes: np.ndarray):
        codes = codes.view(np.uint64)
        order = np.lexsort((gray_rank(codes), buckets))
        self.order, self.codes = order, codes[order]
        owner = buckets[order]
        full = np.full(len(codes), 2**64 - 1, np.uint64)
        self.levels = [(full, self.codes, np.arange(len(codes) + 1))]
        both, either = self.codes, self.codes
        while True:
            new = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            size = np.diff(np.append(new, len(owner)))
            if size.max() == 1:
                break
            within = np.arange(len(owner)) - np.repeat(new, size)
            starts = np.flatnonzero(within % FAN == 0)
            both, either = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(either, starts)
            mask = ~(both ^ either)
            self.levels.append((mask, both & mask, np.append(starts, len(owner))))
            owner = owner[starts]
        self.parent = np.arange(len(codes))

    def _link(self, left: np.ndarray, right: np.ndarray) -> None:
        self.parent = link(self.parent, left, right)

    def _same(self) -> list[np.ndarray]:
        """Per level the component of a node, or -1 where its codes are in several."""
        low = high = self.parent
        out = [self.parent]
        for _, _, starts in self.levels[1:]:
            low, high = np.minimum.reduceat(low, starts[:-1]), np.maximum.reduceat(high, starts[:-1])
            out.append(np.where(low == high, low, -1))
        return out

    def join(self, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of all pairs within reach: positions of a code and of the first of its component."""
        for step in range(1, FAN):  # neighbours in Gray order are close: link them first
            if len(self.codes) > step:
                near = np.bitwise_count(self.codes[step:] ^ self.codes[:-step]) <= reach
                at = np.flatnonzero(near)
                self._link(at, at + step)
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        for at in range(0, len(roots), PAIRS_AT_ONCE):
            part = roots[at : at + PAIRS_AT_ONCE]
            self._descend(top, part, part, self._same(), reach)
        linked = np.flatnonzero(self.parent != np.arange(len(self.codes)))
        return self.order[linked], self.order[self.parent[linked]]

    def _descend(self, level: int, left: np.ndarray, right: np.ndarray, same: list[np.ndarray], reach: int) -> None:
        mask, pattern, starts = self.levels[level]
        apart = np.bitwise_count((pattern[left] ^ pattern[right]) & mask[left] & mask[right])
        linked = (same[level][left] == same[level][right]) & (same[level][left] >= 0)
        open_ = (apart <= reach) & ~linked
        left, right = left[open_], right[open_]
        if level == 0:
            self._link(left, right)
            return
        n_left, n_right = starts[left + 1] - starts[left], starts[right + 1] - starts[right]
        rows = max(1, PAIRS_AT_ONCE // (FAN * FAN))
        for at in range(0, len(left), rows):
            part = slice(at, at + rows)
            many = n_left[part] * n_right[part]
            first = np.repeat(np.arange(len(many)), many)
            nth = np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
            a = starts[left[part]][first] + nth // n_right[part][first]
            b = starts[right[part]][first] + nth % n_right[part][first]
            keep = a < b if level == 1 else (left[part] != right[part])[first] | (a <= b)
            if at:
                same = self._same()
            self._descend(level - 1, a[keep], b[keep], same, reach)


def whole_buckets(frames: Iterable[pd.DataFrame], key: str, rows: int = ROWS_AT_ONCE) -> Iterator[pd.DataFrame]:
    """Frames of sorted rows joined to larger ones that end where a key ends."""
    held, n = [], 0
    for frame in frames:
        held.append(frame)
        n += len(frame)
        if n >= rows:
            joined = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(joined[key].to_numpy(), joined[key].iloc[-1], "left"))
            if cut:
                yield joined.iloc[:cut]
            held, n = [joined.iloc[cut:]], len(joined) - cut
    if n:
        yield pd.concat(held, ignore_index=True)


def _block(rest: Column, width: int, bits: int, nth: int) -> tuple[Column, Column]:
    """The nth block of the bits that are left, and the others closed up."""
    low = rest.bitwiseAND(F.lit((1 << (bits * nth)) - 1))
    above = bits * (nth + 1)
    high = F.shiftleft(F.shiftrightunsigned(rest, above), bits * nth) if above < width else F.lit(0).cast("long")
    mask = (1 << min(bits, width - bits * nth)) - 1
    return F.shiftrightunsigned(rest, bits * nth).bitwiseAND(F.lit(mask)), high.bitwiseOR(low)


def bucketed(codes: DataFrame, hot: int = HOT) -> DataFrame:
    """Rows of bucket and code; codes within reach share at least one bucket."""
    rows = codes.select("code", F.lit(0).cast("long").alias("bucket"), F.col("code").alias("rest"))
    width, done = 64, None
    for level, bits in enumerate(BLOCKS):
        dealt = []
        for nth in range(4):
            block, others = _block(F.col("rest"), width, bits, nth)
            dealt.append(F.struct(F.xxhash64("bucket", F.lit(level * 4 + nth), block).alias("bucket"), others.alias("rest")))
        rows = rows.select("code", F.inline(F.array(*dealt)))
        width -= bits
        crowded = None
        if level + 1 < len(BLOCKS):
            crowded = durable(rows.groupBy("bucket").count().where(F.col("count") > hot).select("bucket"))
            if crowded.isEmpty():
                crowded = None
        part = rows if crowded is None else rows.join(crowded, "bucket", "left_anti")
        part = part.select("bucket", "code")
        done = part if done is None else done.union(part)
        if crowded is None:
            return done
        rows = rows.join(crowded, "bucket", "left_semi")
    return done


def links(codes: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges src, dst that connect all codes within reach; every edge is a component's member and its first."""

    def joined(frames):
        for frame in whole_buckets(frames, "bucket"):
            buckets, values = frame["bucket"].to_numpy(), frame["code"].to_numpy(np.int64)
            src, dst = Forest(buckets, values).join()
            edges = pd.DataFrame({"src": values[src], "dst": values[dst]})
            yield edges[edges["src"] != edges["dst"]]  # a code meets itself in another bucket of the task

    dealt = bucketed(codes, hot).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(joined, "src long, dst long")


def near_duplicates(documents: DataFrame, hot: int = HOT) -> DataFrame:
    """Per document its code and the smallest id that links reach from it; ``root`` is the same within a component."""
    rows = durable(fingerprints(documents))
    codes = durable(rows.groupBy("code").agg(F.min("doc_id").alias("low")))
    found = durable(links(codes.select("code"), hot).distinct())
    roots = components(found).select(F.col("node").alias("_node"), "component")
    placed = durable(
        codes.join(roots, F.col("code") == F.col("_node"), "left").select(
            "code", "low", F.coalesce("component", "code").alias("root")
        )
    )
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id")).withColumnRenamed("root", "_root")
    named = placed.join(lowest, F.col("root") == F.col("_root")).select(F.col("code").alias("_code"), "root", "component_id")
    return rows.join(named, F.col("code") == F.col("_code")).select("doc_id", "twin", "code", "root", "component_id")


def one_of_each(documents: DataFrame, hot: int = HOT) -> DataFrame:
    """All columns of one document per component: the one of smallest id.

    Where rows share that id, one of them stays; null ids stay only where a
    component has no other.
    """
    first = near_duplicates(documents, hot).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min(F.struct("doc_id", "twin")).alias("_first")).select("_first.*")
    chosen = chosen.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("_key"), F.col("twin").alias("_twin"))
    row = F.col("_row")
    keyed = packed(documents).withColumns(
        {"_id": F.coalesce(row["doc_id"].cast("long"), F.lit(-(2**63))), "_hash": F.xxhash64(row["text"])}
    )
    rows = keyed.join(chosen.distinct(), (F.col("_id") == F.col("_key")) & (F.col("_hash") == F.col("_twin")))
    copies = Window.partitionBy("_id", "_hash").orderBy("_hash")
    return unpacked(rows.withColumn("_nth", F.row_number().over(copies)).where("_nth = 1"), documents.columns)


@query("op4_simhash")
def op4_simhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
