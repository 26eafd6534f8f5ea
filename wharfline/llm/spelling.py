"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are one inserted, deleted or replaced code point apart if their common
prefix and suffix together reach the longer length less one. So of two near words
of longer length L, the common prefix has L // 2 code points, or the suffix has. A word
therefore goes to tiles of its first and of its last halves, once for L its own
length and once for L one more, four rows in all, and near words meet in a tile.

A tile is dense: its words are padded matrices of code points, flush left and
flush right, and blocks of pairs of rows are compared at once. The first unequal
column from the left is the common prefix, from the right the common suffix.

In a tile of known prefix and suffix the edit lies between them, and the same argument
holds there: a crowded tile is cut again by the first and the last half of what
is between, down to one code point. A tile then holds one word of length L - 1 and
as many of length L as the alphabet has letters, so no tile grows with the corpus. Cuts
by prefix take the pairs whose common prefix reaches that far, cuts by suffix the
others, so each pair counts in one tile.

A task returns a row per word: its near words in the tile as a number, and the
most frequent of them. Never a list of pairs.

Words are counted map-side before the shuffle. A word's form is its most frequent
near word (ties: the smallest) if that is ``TIMES`` times as frequent; forms of
forms are followed by doubling steps, and since counts grow tenfold with each step a
chain is short.

Defined cases: null and empty texts have no words; a null id is an empty one in the hash
that picks a letter to drop; repeated rows count each; other columns are not
read; an empty table gives no rows. A word without near words has n_near 0, no form,
and is its own root. Words of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.llm.common import query, small_batches, table

# Fixed by the result contract.
LETTERS = r"A-Za-zÀ-ÿ"
SHORTEST, LEAST_COUNT, TIMES, DROPPED_OF = 7, 2, 10, 31

HOT = 1 << 15  # code points of a tile
FEW = 8  # words that may be in a tile, however long they are
CELLS_AT_ONCE = 1 << 22
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(documents: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """_id (as text) and run: maximal runs of letters of at least so many code points, A-Z lower-cased."""
    found = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{shortest},}}+"), F.lit(0))).alias("run"),
    )
    # Most runs have no capitals, and ``lower`` is much cheaper than ``translate``.
    plain = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    return found.select("_id", plain.alias("run"))


def misspelt(run: Column, doc_id: Column, one_of: int = DROPPED_OF) -> Column:
    """The run, less a letter where the crc32 of id and run is divisible by ``one_of``."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    dropped = F.concat(F.left(run, at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % one_of == 0, dropped).otherwise(run)


def counted_words(documents: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT, one_of: int = DROPPED_OF) -> DataFrame:
    """word, n: the words of a corpus with their counts."""
    words = runs(documents, shortest).select(misspelt(F.col("run"), F.col("_id"), one_of).alias("word"))
    words = words.where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _cut(rows: DataFrame) -> DataFrame:
    """Tiles cut by the first and by the last half of what lies between their prefix and suffix."""
    half = F.floor((F.col("wide") - F.col("front") - F.col("back")) / 2).cast("int")

    def tile(front: Column, back: Column, below: Column) -> Column:
        key = F.xxhash64("wide", front, back, below, F.left("word", front), F.right("word", back))
        return F.struct(front.alias("front"), back.alias("back"), below.alias("below"), key.alias("tile"))

    by_prefix = tile(F.col("front") + half, F.col("back"), F.col("below"))
    by_suffix = tile(F.col("front"), F.col("back") + half, F.col("front") + half)
    return rows.select("word", "n", "wide", F.inline(F.array(by_prefix, by_suffix)))


def tiles(words: DataFrame, hot: int = HOT) -> DataFrame:
    """Rows of words in tiles: near words of longer length ``wide`` with a common prefix in [front, below) share one."""
    length = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("wide"))
    start = F.lit(0).cast("int")
    rows = _cut(rows.select("*", start.alias("front"), start.alias("back"), (F.col("wide") + 1).alias("below")))
    done = None
    while True:
        divisible = rows.where("wide - front - back > 1")
        crowded = durable(
            divisible.groupBy("tile").agg(F.count(F.lit(1)).alias("_n"), F.max("wide").cast("long").alias("_wide"))
            .where((F.col("_n") > FEW) & (F.col("_n") * F.col("_wide") > hot)).select("tile")
        )
        if crowded.isEmpty():
            return rows if done is None else done.union(rows)
        calm = rows.join(crowded, "tile", "left_anti").select(rows.columns)
        done = calm if done is None else done.union(calm)
        rows = _cut(rows.join(crowded, "tile", "left_semi"))


def whole_tiles(frames: Iterable[pd.DataFrame], cells: int = CELLS_AT_ONCE) -> Iterator[pd.DataFrame]:
    """Frames in order of tiles joined to larger ones, of about so many code points, that end where a tile ends."""
    held, n = [], 0
    for frame in frames:
        held.append(frame)
        n += int(frame["wide"].sum())
        if n >= cells:
            joined = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(joined["tile"].to_numpy(), joined["tile"].iloc[-1], "left"))
            if cut:
                yield joined.iloc[:cut].reset_index(drop=True)
            held = [joined.iloc[cut:]]
            n = int(held[0]["wide"].sum())
    if n:
        yield pd.concat(held, ignore_index=True)


def padded(words: list[str], wide: int, right: bool = False) -> np.ndarray:
    """Code points, a row per word, zeros on the other side; as narrow as the largest allows."""
    filled = [w.rjust(wide, "\0") for w in words] if right else words
    points = np.array(filled, f"<U{wide}").view(np.uint32).reshape(len(words), wide)
    return points.astype(np.min_scalar_type(int(points.max(initial=0))))


def pair_blocks(tile: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one tile, tiles being neighbours, in blocks of about ``at_once``."""
    ends = np.append(np.flatnonzero(tile[1:] != tile[:-1]) + 1, len(tile))
    end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
    partners = end - np.arange(len(tile)) - 1
    total = np.cumsum(partners)
    top = 0
    while top < len(tile):
        before = total[top - 1] if top else 0
        bottom = max(top + 1, int(np.searchsorted(total, before + at_once, "right")))
        many = partners[top:bottom]
        left = np.repeat(np.arange(top, bottom), many)
        nth = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
        for at in range(0, len(left), at_once):
            part = slice(at, at + at_once)
            yield left[part], left[part] + 1 + nth[part]
        top = bottom


def near_in_tiles(frame: pd.DataFrame) -> pd.DataFrame:
    """Per word that has near ones in these tiles: their number, and the first by falling count, then word."""
    out = []
    for wide, part in frame.groupby("wide", sort=False):
        words, n = part["word"].to_list(), part["n"].to_numpy(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        front, below = part["front"].to_numpy(), part["below"].to_numpy()
        left, right = padded(words, wide), padded(words, wide, right=True)
        by_fame = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        fame = np.empty(len(words), np.int64)
        fame[by_fame] = np.arange(len(words))
        links, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
        for i, j in pair_blocks(part["tile"].to_numpy(), max(1, CELLS_AT_ONCE // wide)):
            longest = (lengths[i] == wide) | (lengths[j] == wide)
            i, j = i[longest], j[longest]
            prefix = (left[i] == left[j]).argmin(axis=1)
            # A tile is named by a hash, so the shared prefix is checked, too.
            own = (front[i] <= prefix) & (prefix < below[i])
            i, j, prefix = i[own], j[own], prefix[own]
            suffix = (right[i] == right[j])[:, ::-1].argmin(axis=1)
            near = prefix + suffix >= wide - 1
            i, j = i[near], j[near]
            np.add.at(links, i, 1), np.add.at(links, j, 1)
            np.minimum.at(best, i, fame[j]), np.minimum.at(best, j, fame[i])
        some = np.flatnonzero(links)
        chosen = [by_fame[k] for k in best[some]]
        out.append(pd.DataFrame({
            "word": [words[k] for k in some], "links": links[some],
            "near": [words[k] for k in chosen], "near_n": n[chosen],
        }))
    return pd.concat(out, ignore_index=True)


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """word, n_near, near, near_n: how many near words a word has, and the most frequent one."""
    small_batches(words.sparkSession)

    def compared(frames):
        for frame in whole_tiles(frames):
            yield near_in_tiles(frame)

    dealt = tiles(words, hot).select("word", "n", "wide", "front", "below", "tile")
    found = dealt.repartition("tile").sortWithinPartitions("tile").mapInPandas(
        compared, "word string, links long, near string, near_n long"
    )
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("_first")
    return found.groupBy("word").agg(F.sum("links").alias("n_near"), first).select(
        "word", "n_near", F.col("_first.near").alias("near"), (-F.col("_first.less")).alias("near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form: the last of the forms reached from a word."""
    chain = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = chain.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        longer = chain.join(ahead, F.col("root") == F.col("_word"), "left")
        longer = durable(longer.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")))
        chain = longer.select("word", "root")
        if longer.where("_moved").isEmpty():
            return chain


def variants(documents: DataFrame, hot: int = HOT) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = durable(counted_words(documents.select("doc_id", "text")))
    near = near_words(words, hot).select(F.col("word").alias("_word"), "n_near", "near", "near_n")
    is_form = F.col("near_n") >= TIMES * F.col("n")
    named = durable(
        words.join(near, F.col("word") == F.col("_word"), "left").select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    last = roots(named.where("form IS NOT NULL")).select(F.col("word").alias("_word"), "root")
    return named.join(last, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


SQL_VARIANTS = """
WITH RECURSIVE crc_steps AS (
  SELECT range AS b, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM crc_steps WHERE k = 8),
raw AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]{7,}')) AS run
  FROM documents),
lowered AS MATERIALIZED (
  SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM raw GROUP BY 1, 2),
hashed AS (
  SELECT run, times, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(strlen(doc || ':' || run)),
      lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM lowered, crc_table),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
places AS MATERIALIZED (
  SELECT word, n, substr(word, 1, i) || '?' || substr(word, i + 2) AS swapped, substr(word, 1, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
dropped AS (SELECT DISTINCT p.word, p.n, w.word AS other, w.n AS other_n FROM places p JOIN words w ON p.less = w.word),
pairs AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n AS near_n FROM places a JOIN places b ON a.swapped = b.swapped AND a.word <> b.word
  UNION ALL SELECT word, other, other_n FROM dropped
  UNION ALL SELECT other, word, n FROM dropped),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
named AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
followed AS (
  SELECT word, word AS root FROM named
  UNION ALL SELECT f.word, m.form FROM followed f JOIN named m ON f.root = m.word WHERE m.form IS NOT NULL),
last AS (SELECT f.word, f.root FROM followed f JOIN named m ON f.root = m.word WHERE m.form IS NULL)
SELECT m.word, m.form, l.root, m.n, m.n_near, m.form_n FROM named m JOIN last l ON m.word = l.word
"""


@query("op13_spelling_variants", SQL_VARIANTS)
def op13_spelling_variants(spark, folder):
    return variants(table(spark, folder, "documents"))
