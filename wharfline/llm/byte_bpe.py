"""Byte-level BPE over padded matrices.

A text is cut into pieces by the vocabulary's pattern, and every piece is merged
by itself. The distinct pieces of a batch are sorted into buckets by length, and
a bucket is one padded matrix of token ids, a row per piece. In each round every
row finds the rank of each neighbouring pair in a hashed pair table, merges its
leftmost pair of least rank, and closes the gap; rows without a mergeable pair
leave the matrix. Merged pieces are remembered within a task, in a dictionary
that is emptied when it reaches a fixed size.

A round costs the width of its bucket, so a row of n bytes costs n * n at worst.
Pieces above ``WIDEST`` bytes (one word of thousands of letters) go through the
same merges in the same order with a heap over pairs, which costs n log n.

Decoding looks up the bytes of every id and joins them.

Nothing is shuffled. The vocabulary has a fixed size and is sent to the tasks
once, so executors need not see its file.

Defined cases: null text is empty and has no ids; an empty vocabulary merges
nothing and is an error only where a single byte has no rank; other columns are
dropped, and repeated rows are encoded each; null ids and ids of any size come
through unchanged.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.llm.common import query, small_batches, table

WIDEST = 256
BUCKETS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, WIDEST)
REMEMBERED = 400_000
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing.

    A pair merges when its joined bytes are a token; that token's rank is both
    the order of the merge and the id of the result.
    """

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, _NONE, np.int32)
        self.probes = 0
        slots, values, todo = self._slot(keys), np.array(merged, np.int32), np.arange(len(keys))
        while len(todo):
            free = self.keys[slots[todo]] == -1
            _, first = np.unique(slots[todo][free], return_index=True)
            put = todo[free][first]
            self.keys[slots[put]], self.merged[slots[put]] = keys[put], values[put]
            todo = todo[self.keys[slots[todo]] != keys[todo]]
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        flat = keys.ravel()
        slots = self._slot(flat)
        found = self.keys[slots]
        out = np.where(found == flat, self.merged[slots], _NONE)
        todo = np.flatnonzero((found != flat) & (found != -1))
        for _ in range(self.probes):
            if not len(todo):
                break
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[todo]]
            hit = found == flat[todo]
            out[todo[hit]] = self.merged[slots[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out.reshape(keys.shape)


class Encoder:
    """Pieces to ids with one vocabulary, and back."""

    def __init__(self, ranks: dict[bytes, int]):
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.whole = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def _bytes(self, data: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(data, np.uint8)]
        if len(ids) and ids.min() < 0:
            raise ValueError("the vocabulary has no token for a byte of the text")
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.whole.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > WIDEST:
                out[i] = self._merge_long(piece)
            elif piece:
                rows.setdefault(next(w for w in BUCKETS if len(piece) <= w), []).append(i)
        for width, members in rows.items():
            for at in range(0, len(members), 1 << 14):
                part = members[at : at + (1 << 14)]
                matrix, lengths = self._merge(width, [pieces[i] for i in part])
                flat, ends = matrix.astype("<u4"), lengths.tolist()
                for row, i in enumerate(part):
                    out[i] = flat[row, : ends[row]].tobytes()
        return out

    def _merge(self, width: int, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in pieces])
        ids = self._bytes(b"".join(p.ljust(width, b"\0") for p in pieces)).reshape(len(pieces), width).copy()
        done, live = np.zeros_like(ids), np.arange(len(pieces))
        sizes = lengths.copy()
        ranks = self.pairs.look_up(ids[:, :-1], ids[:, 1:])
        ranks[np.arange(width - 1)[None, :] >= (lengths - 1)[:, None]] = _NONE
        while len(live):
            at = ranks.argmin(axis=1)  # the leftmost of the least
            row = np.arange(len(live))
            least = ranks[row, at]
            over = least == _NONE
            if over.any():
                done[live[over], : ids.shape[1]] = ids[over]
                keep = ~over
                live, ids, ranks, at, least = live[keep], ids[keep], ranks[keep], at[keep], least[keep]
                if not len(live):
                    break
                row = np.arange(len(live))
                widest = max(2, int(sizes[live].max()))  # the matrix narrows as its rows do
                ids, ranks = ids[:, :widest], ranks[:, : widest - 1]
            ids[row, at] = least
            # Close the gap behind every merge: later columns move one to the left.
            columns = np.arange(ids.shape[1])[None, :]
            source = np.minimum(columns + (columns > at[:, None]), ids.shape[1] - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            pair_columns = columns[:, :-1]
            pair_source = np.minimum(pair_columns + (pair_columns > at[:, None]), ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, pair_source, axis=1)
            sizes[live] -= 1
            size = sizes[live]
            # Only the two pairs that touch the merged token have new ranks.
            for side in (-1, 0):
                where = at + side
                inside = (where >= 0) & (where + 1 < size)
                some = row[inside]
                ranks[some, where[inside]] = self.pairs.look_up(ids[some, where[inside]], ids[some, where[inside] + 1])
            ranks[pair_columns >= (size - 1)[:, None]] = _NONE
        return done, sizes

    def _merge_long(self, piece: bytes) -> bytes:
        ids = self._bytes(piece).tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        first = self.pairs.look_up(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(first) if rank != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else len(ids)
            if j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(ids)
                if right < len(ids):
                    new = int(self.pairs.look_up(np.array([ids[left]], np.int32), np.array([ids[right]], np.int32))[0])
                    if new != _NONE:
                        heapq.heappush(heap, (new, left, ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Remembered(dict):
    """Piece -> ids; pieces of a text that are new are encoded together."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        new = list({piece for pieces in texts for piece in pieces if piece not in self})
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list({piece for pieces in texts for piece in pieces})
        # Lone surrogates cannot come out of Spark strings, so plain UTF-8 is enough.
        self.update(zip(new, self.encoder.encode_pieces([p.encode() for p in new]), strict=True))
        return [b"".join(map(self.__getitem__, pieces)) for pieces in texts]


ENCODED_AT_ONCE = 256  # texts whose new pieces share matrices,
CHARS_AT_ONCE = 1_000_000  # or fewer where texts are long


def encode_batches(batches: Iterable[pa.RecordBatch], encoder: Encoder, pattern: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """doc ids and the ids of their texts, from batches of both. Doc ids stay Arrow values: pandas has no nulls among integers."""
    import regex

    find = regex.compile(pattern).findall
    memory = Remembered(encoder)
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        start = chars = 0
        for at, text in enumerate(texts, 1):
            chars += len(text)
            if at == len(texts) or at - start == ENCODED_AT_ONCE or chars >= CHARS_AT_ONCE:
                yield batch.column("doc_id").slice(start, at - start), memory.encode([find(t) for t in texts[start:at]])
                start, chars = at, 0


def _vocabulary(spark: SparkSession, path: str):
    small_batches(spark)
    return spark.sparkContext.broadcast(read_ranks(path))


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document its ids as an array."""
    vocabulary = _vocabulary(documents.sparkSession, path)

    def encoded(batches):
        for doc_ids, ids in encode_batches(batches, Encoder(vocabulary.value), pattern):
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([doc_ids, lists], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per document the bytes its ids stand for."""
    vocabulary = _vocabulary(encoded.sparkSession, path)

    def decoded(batches):
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            data = [encoder.decode(np.asarray(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(decoded, "doc_id long, data binary")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text and keep counts and digests of both, ids staying in the task."""
    vocabulary = _vocabulary(documents.sparkSession, path)

    def digested(batches):
        encoder = Encoder(vocabulary.value)
        for doc_ids, ids in encode_batches(batches, encoder, pattern):
            columns = [
                doc_ids,
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(digested, schema)


def public_vocabulary() -> tuple[str, str]:
    """Place and pattern of the public 50k vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op3_byte_bpe")
def op3_byte_bpe(spark, folder):
    return digests(table(spark, folder, "documents"), *public_vocabulary())
