"""Substring dedup by recompression: repeated windows of words are found by shared symbols.

The words of a text are symbols. A first round names runs of equal words; then
``ROUNDS`` rounds name pairs: a symbol's name says whether it may be the left or
the right half of a pair, and every left half before a right half merges with it.
A name is a hash of the names below it, so equal runs and pairs get equal names
in every text, on every machine and in every attempt, without a dictionary of
pairs; a round that asked one would shuffle every word of the corpus.

What lies outside a window can change only its outermost symbols. A run at
either end may go on outside, and in each round the first symbol may be taken by
a left neighbour if it is a right half, the last one by a right neighbour if it
is a left half. The symbols between are the same wherever the window stands. Of
them, at the highest level that has any, the longest one stands for the window
(ties: least hash, then leftmost), together with the word on either side, which
the window always holds. Equal windows thus share a symbol with certainty, and
neighbouring windows mostly have the same one, so that one row is shuffled for
about five words. Windows of one or two runs have no inner symbol and stand for
themselves.

Equal texts are one text: a row whose whole text a smaller id has, too, loses every
word that a window covers, and sends no windows to find that out. Texts are equal
where their md5 is.

1. Rows of symbol, document and the windows it stands for meet by symbol.
   Symbols of one document only are dropped.
2. The windows of the others are hashed whole (88 bits) and meet by that hash;
   those that also start in a document of smaller id are repeats. Words are not
   compared: among 10^13 different windows any two of like hash are expected with a
   chance of about 0.2, among 10^11 with one of 0.00002.
3. Repeats go to their documents, whose covered words are removed.

Texts move once, by id, for steps 2 and 3. No group is collected: minima over a
symbol or a window are spillable window functions over narrow rows. What a text
says again and again is one row of it before anything is shuffled. A passage in a
third of all documents then makes many groups of so many rows, never one group of
a third of all rows, since every document has a row for every five of its words.
Long texts are parsed in overlapping parts, which is exact because a window's
symbol depends on the window alone.

Defined cases: null text and text without words have no words and lose none;
null ids count as larger than all others; a repeated row (equal id) is never a
smaller document, so twins keep what only they share; empty tables give no rows.
Where ids are null or repeated, lists and joins go by id and a hash of the text,
so no row gets the windows of another one; rows equal in both have one list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.llm.common import packed, query, small_batches, table, unpacked

WINDOW = 13  # words; fixed by the result contract
ROUNDS = 2  # a third one makes more symbols per window and tells hardly more windows apart
WORDS_AT_ONCE = 200_000
WORDS_REMEMBERED = 500_000
LAST = 2**63 - 1
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LENGTH = np.uint64(56)


def mix(a, b, salt: int = 0) -> np.ndarray:
    """A 64-bit name of an ordered pair."""
    b = np.atleast_1d(np.asarray(b, np.uint64))  # arrays wrap around silently
    z = (a + np.uint64(salt * 2 + 1)) * _C[0] + b * _C[1]
    z ^= z >> np.uint64(32)
    z *= _C[2]
    z ^= z >> np.uint64(29)
    z *= _C[3]
    z ^= z >> np.uint64(32)
    return z


class Names(dict):
    """Word -> 64-bit name; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_REMEMBERED:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(word, 7)
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def window_hashes(names: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hash of every ``width`` neighbouring names, from hashes of halves."""
    n = len(names) - width + 1
    power, at, out = names, 0, None
    step = 1
    while step <= width:
        if width & step:
            part = power[at : at + n]
            out = mix(part, np.uint64(width), salt) if out is None else mix(out, part, salt)
            at += step
        if step * 2 <= width:
            power = mix(power[:-step], power[step:], salt)
        step *= 2
    return out


def anchors(names: np.ndarray, owner: np.ndarray, width: int = WINDOW, rounds: int = ROUNDS):
    """For words of several texts: per symbol that stands for windows its key, first and last window.

    ``owner`` is the text of each word, in ascending order. Starts are positions
    in ``names``. The last start may be beyond windows of other symbols, which
    only makes more windows candidates.
    """
    n = len(names)
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < width:
        return empty
    starts = np.flatnonzero(owner[: n - width + 1] == owner[width - 1 :])
    if not len(starts):
        return empty
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    size = np.diff(np.append(at, n))
    symbol = mix(names[at], size.astype(np.uint64), 1)
    left, right = run[starts] + 1, run[starts + width - 1]  # inner symbols are [left, right)
    levels = [(symbol, at, size, left, right)]
    for level in range(rounds):
        first_half = mix(symbol, np.uint64(level), 2) >> np.uint64(63) == 0
        pair = np.zeros(len(symbol), bool)
        pair[:-1] = first_half[:-1] & ~first_half[1:] & (owner[at[:-1]] == owner[at[1:]])
        keep = np.ones(len(symbol), bool)
        keep[1:] = ~pair[:-1]
        index = np.cumsum(keep) - 1
        inner = left < right
        clipped = np.minimum(left, len(symbol) - 1)
        left = left + (inner & ~first_half[clipped])
        right = right - (inner & first_half[np.maximum(right - 1, 0)])
        inner = left < right
        left = np.where(inner, index[np.minimum(left, len(symbol) - 1)], 0)
        right = np.where(inner, index[np.maximum(right - 1, 0)] + 1, 0)
        merged = symbol.copy()
        both = np.flatnonzero(pair)
        merged[both] = mix(symbol[both], symbol[both + 1], 3)
        longer = size.copy()
        longer[both] += size[both + 1]
        symbol, at, size = merged[keep], at[keep], longer[keep]
        levels.append((symbol, at, size, left, right))
    place = np.full(len(starts), -1)  # first word of the chosen symbol
    length = np.zeros(len(starts), np.int64)
    chosen = np.zeros(len(starts), np.uint64)
    todo = np.arange(len(starts))
    for symbol, at, size, left, right in reversed(levels):
        have = todo[left[todo] < right[todo]]
        todo = todo[left[todo] >= right[todo]]
        if not len(have):
            continue
        order = (np.uint64(255) - np.minimum(size, 255).astype(np.uint64) << _LENGTH) | (mix(symbol, np.uint64(0), 4) >> np.uint64(8))
        best, here, end = left[have].copy(), left[have].copy(), right[have]
        while True:
            here = here + 1
            more = here < end
            if not more.any():
                break
            better = more.copy()
            better[more] = order[here[more]] < order[best[more]]
            best[better] = here[better]
        place[have], length[have] = at[best], size[best]
        chosen[have] = symbol[best]
    key = np.zeros(len(starts), np.uint64)
    found = place >= 0
    before, after = names[place[found] - 1], names[place[found] + length[found]]
    key[found] = mix(mix(before, chosen[found], 5), after, 6)
    if not found.all():  # runs that fill a window
        plain = window_hashes(names, width, 8)
        key[~found] = plain[starts[~found]]
    # One row for neighbouring windows of one key, so a repeated word or phrase is one row.
    change = np.ones(len(starts), bool)
    change[1:] = (key[1:] != key[:-1]) | (owner[starts[1:]] != owner[starts[:-1]])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(starts)) - 1
    return key[first], starts[first], starts[last]


def _parts(frame: pd.DataFrame, known: Names) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names of words of some texts, their row in the frame, and their position in the text."""
    names, rows, places, n = [], [], [], 0
    for row, text in enumerate(frame["text"]):
        words = text.encode().split() if isinstance(text, str) else []
        for at in range(0, max(1, len(words) - WINDOW + 1), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE + WINDOW - 1]
            if len(part) < WINDOW:
                continue
            names.append(known.of(part))
            rows.append(np.full(len(part), row)), places.append(np.arange(at, at + len(part)))
            n += len(part)
            if n >= WORDS_AT_ONCE:
                yield np.concatenate(names), np.concatenate(rows), np.concatenate(places)
                names, rows, places, n = [], [], [], 0
    if n:
        yield np.concatenate(names), np.concatenate(rows), np.concatenate(places)


def shared_symbols(documents: DataFrame, keys: list[str], width: int = WINDOW) -> DataFrame:
    """Keys and windows: windows of a text whose symbol is in another document, too."""

    def parsed(batches):
        known = Names()
        for frame in batches:
            own = {k: frame[k].to_numpy() for k in keys}
            for names, rows, places in _parts(frame, known):
                # Parts of one long text lie side by side only if they overlap, so a jump in place is a border.
                owner = np.cumsum(np.concatenate(([0], (np.diff(rows) != 0) | (np.diff(places) != 1))))
                key, first, last = anchors(names, owner, width)
                yield pd.DataFrame({
                    "symbol": (key >> np.uint64(8)).view(np.int64), **{k: v[rows[first]] for k, v in own.items()},
                    "windows": (places[first] << 20) | (places[last] - places[first]),
                })

    found = documents.mapInPandas(parsed, f"symbol long, {_longs(keys)}, windows long")
    together = Window.partitionBy("symbol")
    spread = found.withColumns({"_low": F.min("id").over(together), "_high": F.max("id").over(together)})
    return spread.where("_low < _high").select(*keys, "windows")


def _longs(keys: list[str]) -> str:
    return ", ".join(f"{k} long" for k in keys)


def gathered(keys: list[str], column: str) -> Column:
    """The values of a key. Equal rows have equal values, which a set keeps once, map-side already."""
    return F.collect_list(column) if keys == ["id"] else F.collect_set(column)


def whole_copies(documents: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of rows whose whole text stands in a document of smaller id, too."""
    texts = documents.where(F.octet_length("text") >= 2 * WINDOW - 1)  # shorter ones have no window
    same = durable(texts.select(*keys, F.unhex(F.md5("text")).alias("_same")))
    lowest = same.groupBy("_same").agg(F.min("id").alias("_low"), F.max("id").alias("_high")).where("_low < _high")
    return same.join(lowest, "_same").where("id > _low").select(*keys).distinct()


def repeats(documents: DataFrame, shared: DataFrame, copies: DataFrame, keys: list[str], width: int = WINDOW) -> DataFrame:
    """Keys and start: different windows of a text that also start in a document of smaller id.

    The start is that of the window's first place in the text, or, where the text
    repeats the window, that start less 2^31. Rows of ``copies`` are left out.
    """
    grouped = shared.groupBy(*keys).agg(gathered(keys, "windows").alias("spans")).join(copies, keys, "left_anti")

    def candidates(names: np.ndarray, spans: np.ndarray) -> np.ndarray:
        n = len(names) - width + 1
        edges = np.zeros(n + 1, np.int64)
        first = np.minimum(spans >> 20, n)
        np.add.at(edges, first, 1)
        np.add.at(edges, np.minimum(first + (spans & (2**20 - 1)) + 1, n), -1)
        return np.flatnonzero(np.cumsum(edges[:-1]) > 0)

    def frame_of(parts: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(["one", "rest", *keys], map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    def hashed(batches):
        known = Names()
        for frame in batches:
            parts, n = [], 0
            for text, spans, *own in zip(frame["text"], frame["spans"], *[frame[k] for k in keys], strict=True):
                names = known.of(text.encode().split() if isinstance(text, str) else [])
                if len(names) < width:
                    continue
                starts = candidates(names, np.asarray(spans, np.int64))
                one = window_hashes(names, width, 9)[starts].view(np.int64)
                two = (window_hashes(names, width, 10)[starts] >> np.uint64(40)).astype(np.int64)
                # A window that a text repeats is one row, marked so that its other places are found again.
                _, at, many = np.unique(one, return_index=True, return_counts=True)
                order = np.argsort(at)  # in order of the text, rows compress better
                at, many = at[order], many[order]
                rest = (two[at] << 32) | ((many > 1).astype(np.int64) << 31) | starts[at]
                parts.append((one[at], rest, *[np.full(len(at), k) for k in own]))
                n += len(at)
                if n >= WORDS_AT_ONCE:
                    yield frame_of(parts)
                    parts, n = [], 0
            if parts:
                yield frame_of(parts)

    windows = documents.join(grouped, keys).mapInPandas(hashed, f"one long, rest long, {_longs(keys)}")
    lowest = F.min("id").over(Window.partitionBy("one", F.shiftright("rest", 32)))
    found = windows.withColumn("_low", lowest).where("id > _low")
    low = F.col("rest").bitwiseAND(F.lit(2**32 - 1))
    return found.select(*keys, F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int").alias("start"))


def row_key(doc_id: Column) -> Column:
    """A null id counts as the largest."""
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def row_keys(documents: DataFrame) -> list[str]:
    """What tells rows apart: their id where ids are unique, else also a hash of their text."""
    repeated = documents.groupBy(row_key(F.col("doc_id")).alias("id")).count().where("count > 1")
    return ["id"] if repeated.isEmpty() else ["id", "twin"]


def key_columns(doc_id: Column, text: Column, keys: list[str]) -> dict[str, Column]:
    both = {"id": row_key(doc_id), "twin": F.xxhash64(text)}
    return {k: both[k] for k in keys}


def prepared(documents: DataFrame, keys: list[str]) -> DataFrame:
    own = key_columns(F.col("doc_id"), F.col("text"), keys)
    return documents.select(*[c.alias(k) for k, c in own.items()], "text")


def repeated_starts(rows: DataFrame, keys: list[str], width: int = WINDOW) -> DataFrame:
    """_id (and _twin), starts, copy: the repeated windows of each of the ``prepared`` rows that has some; all of a copy's are."""
    copies = durable(whole_copies(rows, keys))
    found = repeats(rows, shared_symbols(rows, keys, width), copies, keys, width)
    whole = copies.select(*keys, F.lit(None).cast("int").alias("start"), F.lit(True).alias("copy"))
    both = found.withColumn("copy", F.lit(False)).unionByName(whole)
    lists = [gathered(keys, "start").alias("starts"), F.bool_or("copy").alias("copy")]
    return both.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*lists)


def all_places(words: list[bytes], starts: np.ndarray, width: int) -> np.ndarray:
    """Every place of the windows that ``repeats`` names by one."""
    several = starts < 0
    if not several.any():
        return starts
    hashes = window_hashes(Names().of(words), width, 9)
    again = np.flatnonzero(np.isin(hashes, hashes[starts[several] + 2**31]))
    return np.concatenate((starts[~several], again))


def kept_words(text: str | None, starts: np.ndarray | None, copy: bool | None, width: int = WINDOW) -> tuple[int, list[bytes]]:
    """The number of words of a text, and the words no repeated window covers; in a copy of a whole text, all windows are."""
    words = text.encode().split() if isinstance(text, str) else []
    if copy is True and len(words) >= width:
        return len(words), []
    if starts is None or not len(starts):
        return len(words), words
    edges = np.zeros(len(words) + width + 1, np.int32)
    starts = np.unique(all_places(words, np.asarray(starts, np.int64), width))
    edges[starts] += 1
    edges[starts + width] -= 1
    covered = np.cumsum(edges[: len(words)]) > 0
    return len(words), [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]


def without_repeats(documents: DataFrame, width: int = WINDOW) -> DataFrame:
    """The documents, all columns, with repeated passages cut out of the text (and ``n_chars`` counted anew).

    Texts that lose nothing are kept as they are, white space included.
    """
    small_batches(documents.sparkSession)
    keys = row_keys(documents)
    found = repeated_starts(prepared(documents, keys), keys, width)

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            out = []
            for text, starts, copy in zip(*columns, strict=True):
                n, kept = kept_words(text, starts, copy, width)
                out.append(text if n == len(kept) else b" ".join(kept).decode())
            yield pd.Series(out, dtype=object)

    own = key_columns(F.col("_row.doc_id"), F.col("_row.text"), keys)
    rows = packed(documents).withColumns({f"_own_{k}": c for k, c in own.items()})
    rows = rows.join(found, [F.col(f"_own_{k}") == F.col(f"_{k}") for k in keys], "left").withColumn("_text", cut("_row.text", "starts", "copy"))
    return unpacked(rows, documents.columns, text=F.col("_text"), n_chars=F.char_length("_text").cast("long"))


def digests(documents: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document its number of words, of removed words, and a digest of the kept ones."""
    small_batches(documents.sparkSession)
    keys = row_keys(documents)
    rows = prepared(documents, keys)

    def cut(batches):
        for frame in batches:
            rows = zip(frame["text"], frame["starts"], frame["copy"], strict=True)
            out = [kept_words(text, starts, copy, width) for text, starts, copy in rows]
            yield pd.DataFrame({
                "id": frame["id"],
                "n_words": [n for n, _ in out],
                "n_removed": [n - len(kept) for n, kept in out],
                "kept_sha256": [hashlib.sha256(b" ".join(kept)).hexdigest() for _, kept in out],
            })

    # Both joins are by the same keys, so that the texts are shuffled once.
    found = repeated_starts(rows, keys, width)
    marked = rows.join(found, [F.col(k) == F.col(f"_{k}") for k in keys], "left").select("id", "text", "starts", "copy")
    out = marked.mapInPandas(cut, "id long, n_words long, n_removed long, kept_sha256 string")
    return out.select(F.nullif(F.col("id"), F.lit(LAST)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


SQL_REPEATS = """
WITH worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 12)) AS start, words FROM worded WHERE len(words) >= 13),
keyed AS (SELECT doc_id, start, array_to_string(words[start:start + 12], ' ') AS k FROM windows),
first_seen AS (SELECT doc_id, start, min(doc_id) OVER (PARTITION BY k) AS low FROM keyed),
covered AS (
  SELECT DISTINCT doc_id, unnest(generate_series(start, start + 12)) AS place FROM first_seen WHERE low < doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM worded WHERE len(words) > 0),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM placed p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.place = c.place WHERE c.place IS NULL GROUP BY p.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


@query("op7_recompression", SQL_REPEATS)
def op7_recompression(spark, folder):
    return digests(table(spark, folder, "documents"))
