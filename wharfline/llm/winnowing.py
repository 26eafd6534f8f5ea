"""Document fingerprints by winnowing; DataFrame functions only.

The words of a text are hashed, and from them every run of ``K`` words. Of each
``W`` neighbouring runs the one with the least hash is kept, the rightmost where
several share it, with its position. Two texts that share ``W + K - 1`` words in a
row are certain to share a kept hash; runs shorter than ``K`` words never meet.

Hashes of K-word runs and minima of W of them are built by doubling: a run of
four words is hashed from its two halves, the least of eight from the least of
four. That is a fixed number of passes over an array per text. Hash and position
are packed into one integer (32 bits of hash, then the position counted
backwards), so that the least integer is the rightmost least hash.

A text of fewer than ``W + K - 1`` words promises nothing by its words: one long
word may be a page without spaces. Such a text is fingerprinted by its code points,
too, in runs of ``K_POINTS``, by the same windows; these runs are marked ``c`` and
never meet runs of words.

Nothing is shuffled to fingerprint a text.

Defined cases: null text is empty; a text without words has no runs of words, a
text without code points none at all; a text of fewer than K units has one run,
all of it; one of fewer than W runs keeps the least of them. Two empty
fingerprints are alike (1), an empty one and another are not (0). Positions need
texts below 2^31 units, which a row cannot exceed. Ids that are null or stand on very
many rows are put in order by a hash of the text within the id, and equal rows by
their place in the input, which must be a stored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.llm.common import GAP, let, partitions, query, table

K = 4
K_POINTS = 4
W = 8
POINT_SEED = 8  # sets hashes of code points apart from hashes of words
_POSITIONS = 2**31 - 1


def _neighbours(values: Column, step: int, join) -> Column:
    """``join`` of each value and the one ``step`` later; ``step`` fewer values come out."""
    return let(
        values,
        lambda v: let(
            F.greatest(F.size(v) - step, F.lit(0)),
            lambda n: F.zip_with(F.slice(v, F.lit(1), n), F.slice(v, F.lit(step + 1), n), join),
        ),
    )


def _doubled(values: Column, width: int, join) -> Column:
    step = 1
    while step < width:
        values, step = _neighbours(values, step, join), step * 2
    return values


def _packed(hashed: Column, at: Column) -> Column:
    """The upper 32 bits of a hash, then the position counted backwards."""
    return F.shiftleft(F.shiftrightunsigned(hashed, 32), 31).bitwiseOR(F.lit(_POSITIONS).cast("long") - at)


def _kept(units: Column, whole: Column, k: int, w: int, hashed) -> Column:
    """Kept runs of units as packed integers in order of their positions; ``whole`` stands for fewer than k of them."""

    def of_units(found: Column) -> Column:
        hashes = F.transform(found, hashed)
        runs = _doubled(hashes, k, lambda a, b: F.xxhash64(a, b))
        one = F.when(F.size(found) > 0, F.array(whole)).otherwise(F.slice(hashes, 1, 0))
        packed = F.transform(F.when(F.size(found) < k, one).otherwise(runs), lambda h, i: _packed(h, i))
        return let(packed, kept)

    def kept(packed: Column) -> Column:
        least = F.when(F.size(packed) > 0, F.array(F.array_min(packed))).otherwise(packed)
        minima = F.array_distinct(_doubled(packed, w, lambda a, b: F.least(a, b)))
        return F.when(F.size(packed) < w, least).otherwise(minima)

    return let(units, of_units)


def winnowed(text: Column, k: int = K, w: int = W, k_points: int = K_POINTS) -> Column:
    """``words`` and ``points``: kept runs of a text as packed integers; k, w and k_points are powers of two."""
    if k & (k - 1) or w & (w - 1) or k_points & (k_points - 1):
        raise ValueError("k, w and k_points are powers of two")
    given = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(given, GAP), lambda x: x != "")

    def both(found: Column) -> Column:
        # Without words nothing is said; with few of them the code points speak, too.
        points = F.when((F.size(found) > 0) & (F.size(found) < w + k - 1), F.split(given, "")).otherwise(F.slice(found, 1, 0))
        return F.struct(
            _kept(found, F.xxhash64(F.array_join(found, " ")), k, w, lambda x: F.xxhash64(x)).alias("words"),
            _kept(points, F.xxhash64(F.lit(POINT_SEED), given), k_points, w, lambda x: F.xxhash64(F.lit(POINT_SEED), x)).alias("points"),
        )

    return let(words, both)


def hashes_of(kept: Column) -> Column:
    """The distinct 32-bit hashes of kept runs; those of code points above all others."""
    hashed = lambda runs, more: F.transform(runs, lambda x: F.shiftrightunsigned(x, 31) + F.lit(more))
    return F.array_distinct(F.concat(hashed(kept["words"], 0), hashed(kept["points"], 1 << 32)))


def written(kept: Column) -> Column:
    """A fingerprint as text: position and hash of each kept run, ``c`` before those of code points."""

    def runs(packed: Column, mark: str) -> Column:
        return F.transform(
            packed,
            lambda x: F.concat(
                F.lit(mark),
                (F.lit(_POSITIONS).cast("long") - x.bitwiseAND(F.lit(_POSITIONS).cast("long"))).cast("string"),
                F.lit(":"),
                F.hex(F.shiftrightunsigned(x, 31)),
            ),
        )

    return F.array_join(F.concat(runs(kept["words"], ""), runs(kept["points"], "c")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two sets of distinct hashes."""
    return let(
        F.size(F.array_intersect(a, b)),
        lambda both: F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
            both / (F.size(a) + F.size(b) - both)
        ),
    )


def fingerprints(documents: DataFrame, k: int = K, w: int = W, k_points: int = K_POINTS) -> DataFrame:
    """Per document its kept runs: unit (word or point), position and 32-bit hash."""

    def runs(packed: Column, unit: str) -> Column:
        return F.transform(
            packed,
            lambda x: F.struct(
                F.lit(unit).alias("unit"),
                (F.lit(_POSITIONS).cast("long") - x.bitwiseAND(F.lit(_POSITIONS).cast("long"))).cast("int").alias("position"),
                F.shiftrightunsigned(x, 31).alias("hash"),
            ),
        )

    kept = documents.select("doc_id", winnowed(F.col("text"), k, w, k_points).alias("_kept"))
    return kept.select("doc_id", F.concat(runs(F.col("_kept.words"), "word"), runs(F.col("_kept.points"), "point")).alias("runs"))


_LEAST, _MOST = -(2**63), 2**63 - 1


def _slice_of(borders: list[tuple[int, ...]], key: tuple[Column, ...]) -> Column:
    """How many borders are below a key, found by halving steps."""
    if not borders:
        return F.lit(0)
    steps = [2**i for i in reversed(range(len(borders).bit_length()))]
    held = [F.lit([b[n] for b in borders]).cast("array<bigint>") for n in range(len(key))]

    def below(at: Column) -> Column:
        less = F.lit(False)
        for values, own in reversed(list(zip(held, key, strict=True))):
            less = (F.get(values, at) < own) | ((F.get(values, at) == own) & less)
        return less

    return F.aggregate(
        F.lit(steps), F.lit(0),
        lambda at, step: F.when(F.coalesce(below(at + step - 1), F.lit(False)), at + step).otherwise(at),
    )


def borders_of(keyed: DataFrame, n: int) -> list[tuple[int, int, int, int]]:
    """Upper ends of slices of about a like number of rows, by whether there is an id, the id, hash and part.

    Ids are cut at n - 1 of their quantiles. An id that holds more than a slice's
    share is cut at equal steps of the hash, and one text of such an id that does,
    too, into parts.
    """
    counted = keyed.agg(
        F.percentile_approx("_id", [i / n for i in range(1, n)] or [0.5], 20 * n).alias("cuts"), F.count(F.lit(1)).alias("rows")
    ).first()
    if not counted["rows"]:
        return []
    share = -(-counted["rows"] // n)
    cuts = sorted(set(counted["cuts"]))
    # An id of two shares is sure to be a quantile, so at most n ids are counted.
    full = keyed.where(F.col("_id").isin(cuts)).groupBy("_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > share).collect()
    hot = {r["_id"]: -(-r["rows"] // share) for r in full}
    texts = {}
    if hot:
        same = keyed.where(F.col("_id").isin(list(hot))).groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("rows"))
        texts = {(r["_id"], r["_hash"]): -(-r["rows"] // share) for r in same.where(F.col("rows") > share).collect()}
    given = lambda i: (0, 1) if i == _LEAST else (1,)  # noqa: E731 - a null id is counted as the least one
    borders = {(g, c, _MOST, _MOST) for c in cuts for g in given(c)}
    for i, parts in hot.items():
        for g in given(i):
            borders.add((g, i, _LEAST, -1))
            borders |= {(g, i, _LEAST + 2**64 * step // parts, _MOST) for step in range(1, parts)}
    for (i, h), parts in texts.items():
        borders |= {(g, i, h, part) for part in range(-1, parts) for g in given(i)}
    return sorted(borders)


def with_next(documents: DataFrame, slices: int | None = None) -> tuple[DataFrame, Window]:
    """Each document beside the next one in descending id, and the window that pairs them.

    Documents are cut into slices, and the largest document of a slice is copied to
    the next slice above that has any, where it ends the order; the largest of all
    ends the lowest slice. So every text moves once, and no task orders more than a
    slice. Copies are marked ``_copy`` and must be dropped. Rows of one id follow
    each other in descending hash and text. Null ids come last.
    """
    n = slices or 6 * partitions(documents.sparkSession)  # several to a task, so that tasks come out alike
    keyed = documents.select(
        F.col("doc_id").isNotNull().cast("int").alias("_given"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("_id"), F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_place"), "doc_id", "text",
    )
    borders = borders_of(keyed, n)
    parts: dict[tuple[int, int], int] = {}
    for _, i, h, part in borders:
        if -1 <= part < _MOST and h != _LEAST:
            parts[i, h] = max(parts.get((i, h), 0), part + 1)
    part = F.lit(0).cast("long")
    for (i, h), many in parts.items():
        part = F.when((F.col("_id") == i) & (F.col("_hash") == h), F.pmod("_place", F.lit(max(many, 1)))).otherwise(part)
    own = _slice_of(borders, (F.col("_given"), F.col("_id"), F.col("_hash"), part))
    order = F.struct("_given", "_id", "_hash")
    sliced = keyed.withColumn("_own", own)
    largest = {r["_own"]: tuple(r["top"]) for r in sliced.groupBy("_own").agg(F.max(order).alias("top")).collect()}
    filled = sorted(largest)
    above = dict(zip(filled, filled[1:] + filled[:1], strict=True))
    homes = F.array(F.struct(F.lit(False).alias("copy"), F.col("_own").alias("slice")))
    if filled:
        at = range(filled[-1] + 1)

        def held(values: list, kind: str) -> Column:
            return F.get(F.lit(values).cast(f"array<{kind}>"), F.col("_own"))

        tops = [largest.get(s, (-1, 0, 0)) for s in at]
        is_top = (
            (F.col("_given") == held([t[0] for t in tops], "int")) & (F.col("_id") == held([t[1] for t in tops], "bigint"))
            & (F.col("_hash") == held([t[2] for t in tops], "bigint"))
        )
        copied = F.array(F.struct(F.lit(True).alias("copy"), held([above.get(s, 0) for s in at], "int").alias("slice")))
        homes = F.when(is_top, F.concat(homes, copied)).otherwise(homes)
    rows = sliced.select("doc_id", "text", "_hash", F.explode(homes).alias("_home")).select(
        "doc_id", "text", "_hash", F.col("_home.copy").alias("_copy"), F.col("_home.slice").alias("_slice")
    )
    in_order = ("_copy", F.col("doc_id").desc_nulls_last(), F.col("_hash").desc(), F.col("text").desc())
    return rows, Window.partitionBy("_slice").orderBy(*in_order)


@query("op8_winnowing")
def op8_winnowing(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, following = with_next(documents)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), F.left(F.coalesce("_next", F.lit("")), half))
    paired = rows.withColumns({"_next": F.lead("text").over(following), "n_chars": F.char_length("text").cast("long")})
    fingered = paired.withColumn("edited", edited).select(
        "doc_id", "_copy", "_slice", "_hash", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        winnowed(F.col("text")).alias("own"), winnowed(F.col("edited")).alias("other"),
    )
    hashed = fingered.withColumn("own_hashes", hashes_of(F.col("own")))
    beside = hashed.withColumn("next_hashes", F.coalesce(F.lead("own_hashes").over(following), F.array().cast("array<bigint>")))
    return beside.where(~F.col("_copy")).select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("own")).alias("fingerprint"),
        written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), hashes_of(F.col("other"))).alias("near_edited"),
        likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
    )
