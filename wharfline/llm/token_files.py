"""Token ids in binary files: frequency-ranked ids, byte-aligned, control bytes apart.

A file holds documents in order. Its ids are ranked by how often the file has them
(ties: the smaller id first), and ranks are written in one to four bytes, least
byte first. The lengths are not among those bytes: a control byte holds the
lengths of four ranks, and all control bytes of a block stand before its data. So a
block is decoded without a branch per id: a table of 256 rows tells for each
control byte how long its group is and which of its bytes goes where, and one
numpy look-up moves all bytes at once.

    file   = magic, number of ranks (u32), id of each rank (u32), blocks
    block  = documents, ids, data bytes (u64), crc32 of what follows (u32),
             doc_id (i64), 1 for a null doc_id (u8), ids of the document (u64),
             control bytes, data bytes

Spark writes and reads the files as a data source (``tokenfiles``). Rows are dealt
out by ranges of doc_id and sorted, so that partition after partition, file after
file, documents ascend. A task closes a file after ``FILE_IDS`` ids, so it holds no
more than that and a document. Only what a finished attempt reports comes into the
manifest, which also says how many ids stand before each file; files of lost or
doubled attempts are in no manifest and are removed. A few files make a reading task.

Texts move once, by range, and the task that writes a file encodes them, so ids
never leave it but for the file. A text is cut as the tokenizer cuts it, each
different piece goes to the library's model once, and the ids of a batch of texts
are gathered from those of its pieces at once. What is remembered of pieces is
dropped when it is full.

Paths are opened through pyarrow's file systems, so the
folder may be on any store that executors and driver share.

Defined cases: null text is empty and has the end id alone; null ids come last; rows
of one id stand in order of their place in the input, which must therefore be a
stored table (a scan that runs again gives its rows in the same places); an empty
table has a manifest without files; other columns are dropped.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from wharfline.functions.durable import scratch_path
from wharfline.llm.common import query, small_batches, table

END = 2  # fixed by the result contract
FILE_IDS = 1 << 22
BLOCK_IDS = 1 << 18
READ_IDS = 1 << 24  # of a reading task, in whole files
MAGIC = b"TOKFILE1"
MANIFEST = "manifest.json"
CHARS_AT_ONCE = 1_000_000
REMEMBERED = 400_000  # pieces
_HEAD = "<QQQI"

# Fixed values of the byte-level scheme: how its definition reads, the classes
# of characters it knows, and the short forms it cuts off.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
KINDS = (r"\p{L}", r"\p{N}", r"\s")
SHORT_FORMS = ("s", "t", "re", "ve", "m", "ll", "d")

# How many bytes each of the four ranks of a control byte has, how many all have,
# and for each of 16 result bytes its place in the group (16: there is none).
_LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3) + 1
_TOTALS = _LENGTHS.sum(axis=1)
_BEGINS = np.cumsum(_LENGTHS, axis=1) - _LENGTHS
_PLACES = np.where(np.arange(4) < _LENGTHS[:, :, None], _BEGINS[:, :, None] + np.arange(4), 16).reshape(256, 16)


# -------------------------------------------------------------------- coding


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids by falling frequency, and the rank of every id."""
    if ids.max(initial=0) < 1 << 24:
        counts = np.bincount(ids)
        found, at = np.flatnonzero(counts), ids
        order = found[np.argsort(-counts[found], kind="stable")]
    else:
        found, at, counts = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
    ranks = np.zeros(len(counts), np.uint32)
    ranks[order] = np.arange(len(order))
    return (order if at is ids else found[order]).astype(np.uint32), ranks[at]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes; the last group is filled up with zeros."""
    values = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    values[: len(ranks)] = ranks
    extra = (values > 0xFF).view(np.uint8)
    if values.max(initial=0) > 0xFFFF:
        extra = extra + (values > 0xFFFF) + (values > 0xFFFFFF)
    fours = extra.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    begins = np.cumsum(extra, dtype=np.int64) - extra + np.arange(len(values))
    data = np.empty(len(values) + int(extra.sum(dtype=np.int64)), np.uint8)
    data[begins] = values.astype(np.uint8)
    for byte in range(1, int(extra.max(initial=0)) + 1):
        some = np.flatnonzero(extra >= byte)
        data[begins[some] + byte] = (values[some] >> (8 * byte)).astype(np.uint8)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of a block, by table look-up."""
    groups = np.frombuffer(control, np.uint8)
    ends = np.cumsum(_TOTALS[groups])
    places = _PLACES[groups]
    source = np.append(np.frombuffer(data, np.uint8), np.uint8(0))
    where = np.where(places < 16, (ends - _TOTALS[groups])[:, None] + places, len(source) - 1)
    return source[where].reshape(-1).view("<u4")[:n]


def blocks_of(doc_ids: list[int | None], ids: list[np.ndarray]) -> Iterator[tuple[slice, int]]:
    """Cuts of documents into blocks of about ``BLOCK_IDS`` ids, whole documents each."""
    start = n = 0
    for at, own in enumerate(ids, 1):
        n += len(own)
        if n >= BLOCK_IDS or at == len(ids):
            yield slice(start, at), n
            start, n = at, 0


def write_file(stream, doc_ids: list[int | None], ids: list[np.ndarray]) -> None:
    """One file of whole documents."""
    order, ranks = ranked(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32, copy=False))
    stream.write(MAGIC + struct.pack("<I", len(order)) + order.astype("<u4").tobytes())
    done = 0
    for cut, n in blocks_of(doc_ids, ids):
        control, data = pack(ranks[done : done + n])
        done += n
        own = doc_ids[cut]
        body = b"".join((
            np.array([0 if d is None else d for d in own], "<i8").tobytes(),
            np.array([d is None for d in own], np.uint8).tobytes(),
            np.array([len(x) for x in ids[cut]], "<u8").tobytes(),
            control, data,
        ))
        stream.write(struct.pack(_HEAD, len(own), n, len(data), zlib.crc32(body)) + body)


def read_file(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: doc ids, which are null, ids per document, ids."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    (n_ranks,) = struct.unpack("<I", stream.read(4))
    order = np.frombuffer(stream.read(4 * n_ranks), "<u4")
    while head := stream.read(struct.calcsize(_HEAD)):
        documents, n, n_data, crc = struct.unpack(_HEAD, head)
        n_control = -(-n // 4)
        body = stream.read(17 * documents + n_control + n_data)
        if zlib.crc32(body) != crc:
            raise ValueError("a block of a token file is damaged")
        nulls, sizes, control = 8 * documents, 9 * documents, 17 * documents
        ranks = unpack(body[control : control + n_control], body[control + n_control :], n)
        yield (
            np.frombuffer(body, "<i8", documents), np.frombuffer(body, np.uint8, documents, nulls).astype(bool),
            np.frombuffer(body, "<u8", documents, sizes).astype(np.int64), order[ranks],
        )


# ------------------------------------------------------------------ encoding


def byte_names() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it can be seen, else the next above 255."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def classes() -> tuple[str, str, str]:
    """The letters, numbers and white space up to U+FFFF, as classes of ``re`` name them."""
    import regex

    plane = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x10000))))

    def characters(kind: str) -> str:
        runs = regex.findall(f"{kind}+", plane)
        return "".join(re.escape(r[0]) + (f"-{re.escape(r[-1])}" if len(r) > 1 else "") for r in runs)

    return tuple(map(characters, KINDS))


def cutter(known: tuple[str, str, str]):
    """The pieces of a text as the byte-level tokenizer cuts it.

    ``re`` is twice as fast as the module that knows classes of characters by
    name, given their characters; it is used up to U+FFFF, which its tables hold.
    """
    import regex

    def pattern(letters: str, numbers: str, space: str) -> str:
        return (
            f" ?[{letters}]++| ?[{numbers}]++|'(?:{'|'.join(SHORT_FORMS)})| ?[^{space}{letters}{numbers}]++"
            f"|[{space}]+(?![^{space}])|[{space}]+"
        )

    beyond = re.compile("[\U00010000-\U0010ffff]").search
    fast, any_text = re.compile(pattern(*known)).findall, regex.compile(pattern(*KINDS)).findall
    return lambda text: any_text(text) if beyond(text) else fast(text)


class Pieces(dict):
    """Piece -> place among the remembered; a new piece is merged by the library's model."""

    def __init__(self, merge, names: dict[int, str]):
        super().__init__()
        self.merge, self.names = merge, names
        self.begins, self.ids = array("q", [0]), array("I")

    def __missing__(self, piece: str) -> int:
        ids = self.ids
        plain = piece if piece.isascii() else piece.encode().decode("latin-1")  # a character per byte
        ids.extend([token.id for token in self.merge(plain.translate(self.names))])
        self.begins.append(len(ids))
        place = self[piece] = len(self)
        return place

    def forget(self) -> None:
        self.clear()
        self.begins, self.ids = array("q", [0]), array("I")


class Coder:
    """Texts to ids by a byte-level tokenizer's definition, as the library has them for whole texts."""

    def __init__(self, definition: str, end: int | None = END, known: tuple[str, str, str] | None = None):
        from tokenizers import Tokenizer

        described = json.loads(definition)
        if described["normalizer"] is not None or described["pre_tokenizer"] != BYTE_LEVEL:
            raise ValueError("the definition is not one of a byte-level tokenizer")
        self.library = Tokenizer.from_str(definition)
        self.find = cutter(known or classes())
        self.pieces = Pieces(self.library.model.tokenize, byte_names())
        self.end = [] if end is None else [end]

    def _batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.pieces) > REMEMBERED:
            self.pieces.forget()
        found = [self.find(t) for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        place = np.fromiter(map(self.pieces.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum()))
        begins, ids = np.array(self.pieces.begins), np.array(self.pieces.ids, "<u4")
        size = begins[place + 1] - begins[place]
        ends = np.cumsum(size)
        flat = ids[np.repeat(begins[place] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        borders = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        last = np.array(self.end, "<u4")
        for start, stop in zip(borders[:-1], borders[1:], strict=True):
            yield np.concatenate((flat[start:stop], last))

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        start = chars = 0
        for at, text in enumerate(texts, 1):
            chars += len(text or "")
            if chars >= CHARS_AT_ONCE or at == len(texts):
                yield from self._batch([t or "" for t in texts[start:at]])
                start, chars = at, 0


# --------------------------------------------------------------- data source


def opened(path: str):
    """File system and path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.rstrip("/"))


@dataclass
class Written(WriterCommitMessage):
    """Files of a finished task: order in the folder, name, documents, ids."""

    files: list[tuple[int, int, str, int, int]]


class Files(InputPartition):
    """Neighbouring files for one reading task: names and the ids before each."""

    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(files)
        self.files = files


class TokenWriter(DataSourceArrowWriter):
    """Rows of doc_id and ids, or of doc_id and text where there is a tokenizer."""

    def __init__(self, path: str, file_ids: int, definition: str | None = None, end: int | None = END):
        self.path, self.file_ids, self.definition, self.end = path, file_ids, definition, end
        self.known = None if definition is None else classes()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        partition, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, doc_ids, ids, n = [], [], [], 0

        def close():
            nonlocal doc_ids, ids, n
            name = f"part-{partition:06d}-{len(files):06d}-{attempt}.tok"
            with system.open_output_stream(f"{folder}/{name}") as stream:
                write_file(stream, doc_ids, ids)
            files.append((partition, len(files), name, len(doc_ids), n))
            doc_ids, ids, n = [], [], 0

        coder = None if self.definition is None else Coder(self.definition, self.end, self.known)
        for batch in iterator:
            own = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            if coder is not None:
                coded = coder.encode(batch.column(batch.schema.get_field_index("text")).to_pylist())
            else:
                lists = batch.column(batch.schema.get_field_index("ids"))
                coded = np.split(lists.flatten().to_numpy(), lists.offsets.to_numpy()[1:-1] - lists.offsets[0].as_py())
            for doc_id, found in zip(own, coded, strict=True):
                doc_ids.append(doc_id)
                ids.append(found)
                n += len(found)
                if n >= self.file_ids:
                    close()
        if doc_ids:
            close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        files, start = [], 0
        for _, _, name, documents, n in sorted(f for m in messages if m is not None for f in m.files):
            files.append({"name": name, "documents": documents, "ids": n, "start": start})
            start += n
        self._drop_all_but({f["name"] for f in files})
        with system.open_output_stream(f"{folder}/{MANIFEST}") as stream:
            stream.write(json.dumps({"ids": start, "files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        self._drop_all_but(set())

    def _drop_all_but(self, names: set[str]) -> None:
        from pyarrow import fs

        system, folder = opened(self.path)
        for found in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if found.base_name.endswith(".tok") and found.base_name not in names:
                system.delete_file(found.path)


class TokenReader(DataSourceReader):
    def __init__(self, path: str, digests: bool):
        self.path, self.digests = path, digests

    def partitions(self) -> list[Files]:
        tasks, n = [Files([])], 0
        for f in manifest(self.path)["files"]:
            if n and n + f["ids"] > READ_IDS:
                tasks.append(Files([]))
                n = 0
            tasks[-1].files.append((f["name"], f["start"]))
            n += f["ids"]
        return tasks

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, folder = opened(self.path)
        for name, start in partition.files:
            with system.open_input_stream(f"{folder}/{name}") as stream:
                for doc_ids, nulls, sizes, ids in read_file(stream):
                    ends = np.concatenate(([0], np.cumsum(sizes)))
                    columns = {"doc_id": pa.array(doc_ids, mask=nulls), "start": pa.array(start + ends[:-1])}
                    if self.digests:
                        data = ids.astype("<u4").tobytes()
                        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                        columns |= {"n_tokens": pa.array(sizes), "ids_crc32": pa.array(crc, pa.int64())}
                    else:
                        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_pydict(columns)
                    start += int(ends[-1])


class TokenFiles(DataSource):
    """Token files of a folder.

    Writes doc_id and ids, or doc_id and text by the tokenizer whose definition
    is at ``tokenizer`` on the driver, ``end`` behind each document. Reads
    doc_id, start, ids; with ``content`` "digests" doc_id, start, n_tokens, ids_crc32.
    """

    @classmethod
    def name(cls) -> str:
        return "tokenfiles"

    def _digests(self) -> bool:
        return self.options.get("content", "ids") == "digests"

    def schema(self) -> str:
        return "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if self._digests() else "ids array<int>")

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        definition, end = None, self.options.get("end", "")
        if "tokenizer" in self.options:
            with open(self.options["tokenizer"], encoding="utf-8") as file:
                definition = file.read()
        return TokenWriter(
            self.options["path"], int(self.options.get("fileIds", FILE_IDS)), definition, int(end) if end else None
        )

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"], self._digests())


def manifest(path: str) -> dict:
    """Files in order with their documents, ids, and ids before them."""
    system, folder = opened(path)
    with system.open_input_stream(f"{folder}/{MANIFEST}") as stream:
        return json.loads(stream.read())


# ------------------------------------------------------------------ operator


def in_order(documents: DataFrame) -> DataFrame:
    """doc_id and text, partition after partition in ascending doc_id, null ids last; hot ids are split."""
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_place")
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("_place")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def write(documents: DataFrame, path: str, tokenizer: str, end: int | None = END, file_ids: int = FILE_IDS) -> str:
    """All texts as ids in files of an empty folder, in ascending doc_id."""
    spark = documents.sparkSession
    small_batches(spark)
    spark.dataSource.register(TokenFiles)
    options = {"tokenizer": tokenizer, "end": "" if end is None else str(end), "fileIds": str(file_ids)}
    in_order(documents).write.format(TokenFiles.name()).mode("append").options(**options).save(path)
    return path


def read(spark: SparkSession, path: str, content: str = "ids") -> DataFrame:
    """doc_id, start (ids of all documents before), and ids, or digests of them."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format(TokenFiles.name()).option("content", content).load(path)


def public_tokenizer() -> str:
    """Place of the public definition."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op12_token_files")
def op12_token_files(spark, folder):
    path = write(table(spark, folder, "documents"), scratch_path(spark, "token-files"), public_tokenizer())
    return read(spark, path, "digests")
