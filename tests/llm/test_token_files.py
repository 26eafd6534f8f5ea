import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from row_helpers import by

from wharfline.llm import token_files

ROWS = [
    (3, "One two three, straße.", ), (1, None), (2**60 + 3, "above what a double holds"), (2**60 + 1, ""), (None, "no id, first"),
    (None, "no id, second"), (7, "same"), (7, "same"), (7, "other text of that id"), (-5, "<|endoftext|> is text"), (9, "word " * 30_000),
]


def plain(rows, end=token_files.END):
    """Digests by the public library, documents in order."""
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(token_files.public_tokenizer())
    coder.encode_special_tokens = True
    coded = [(d, coder.encode(t or "", add_special_tokens=False).ids + [end]) for d, t in rows]
    out, start = [], 0
    for d, ids in coded:
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=60))
def test_packing_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


def test_frequent_ids_take_one_byte():
    ids = np.array([50_000] * 9 + [70_000] * 9 + [3] * 2 + list(range(1000, 1400)))
    order, ranks = token_files.ranked(ids)
    assert order[:3].tolist() == [50_000, 70_000, 3] and (order[ranks] == ids).all()
    large, again = token_files.ranked(ids + 2**24)
    assert (large == order + 2**24).all() and (again == ranks).all()
    control, data = token_files.pack(ranks)
    assert control[:5] == b"\0" * 5 and len(data) < 1.5 * len(ids)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-(2**63), 2**63 - 1), st.lists(st.integers(0, 60_000), max_size=20)), max_size=8))
def test_file_round_trip(documents):
    stream = io.BytesIO()
    token_files.write_file(stream, [d for d, _ in documents], [np.array(x, np.int32) for _, x in documents])
    stream.seek(0)
    got = []
    for ids, nulls, sizes, values in token_files.read_file(stream):
        cuts = np.split(values, np.cumsum(sizes)[:-1])
        got += [(None if gone else d, c.tolist()) for d, gone, c in zip(ids.tolist(), nulls, cuts, strict=True)]
    assert got == documents


def test_a_damaged_block_is_noticed():
    stream = io.BytesIO()
    token_files.write_file(stream, [1], [np.arange(100, dtype=np.int32)])
    data = bytearray(stream.getvalue())
    data[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_file(io.BytesIO(bytes(data))))
    with pytest.raises(ValueError, match="not a token file"):
        list(token_files.read_file(io.BytesIO(b"something else")))


@pytest.mark.parametrize("file_ids", [token_files.FILE_IDS, 5])
def test_digests_equal_the_library(spark, documents, tmp_path, file_ids):
    path = str(tmp_path / "ids")
    token_files.write(documents(ROWS), path, token_files.public_tokenizer(), file_ids=file_ids)
    got = token_files.read(spark, path, "digests").collect()
    assert [r["start"] for r in sorted(got, key=lambda r: r["start"])] == np.cumsum([0] + [r["n_tokens"] for r in sorted(got, key=lambda r: r["start"])])[:-1].tolist()
    want = {(d, n, crc) for d, _, n, crc in plain(ROWS)}
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got} == want and len(got) == len(ROWS)
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted([i for i in ids if i is not None]) + [None, None]
    unique = sorted({d: t for d, t in ROWS if d is not None and d != 7 and d < 2**60}.items())
    assert {(r["doc_id"]) for r in got} >= {d for d, _ in unique}
    names = [f["name"] for f in token_files.manifest(path)["files"]]
    assert len(names) == len(set(names)) and (len(names) > 5 or file_ids > 5)


def test_starts_of_unique_ids(spark, documents, tmp_path):
    rows = [(i * 37 % 101, f"text {i} " * (i % 13)) for i in range(101)]
    path = token_files.write(documents(rows), str(tmp_path / "ids"), token_files.public_tokenizer(), file_ids=50)
    got = by(token_files.read(spark, path, "digests"), "start")
    assert [tuple(r.values()) for r in sorted(got, key=lambda r: r["doc_id"])] == plain(sorted(rows))


def test_ids_come_back(spark, documents, tmp_path):
    path = token_files.write(documents([(1, "a b"), (2, None)]), str(tmp_path / "ids"), token_files.public_tokenizer(), end=None)
    rows = by(token_files.read(spark, path), "doc_id")
    assert [r["start"] for r in rows] == [0, len(rows[0]["ids"])] and rows[1]["ids"] == []


def test_parts_join_to_whole_texts(monkeypatch):
    """White space, letters and numbers of all kinds, and a memory that is emptied."""
    from tokenizers import Tokenizer

    rng = np.random.default_rng(4)
    some = [" ", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2003", "\u200b", "\u3000", "a", "Ab", "'s", "é", "日本", "12", ".", "…", "\u180e", "\ufeff", "<|endoftext|>", "😀", "𝔸", "Ⅷ", "²", "१", "ͅ", "\u0301", "'ll", "'S"]
    texts = ["".join(rng.choice(some, rng.integers(0, 40))) for _ in range(3000)] + [None, "", " ", " a", "a ", "a  b", "word " * 9000]
    with open(token_files.public_tokenizer(), encoding="utf-8") as file:
        coder = token_files.Coder(file.read(), None)
    library = Tokenizer.from_file(token_files.public_tokenizer())
    library.encode_special_tokens = True
    want = [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode(texts)] == want
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    monkeypatch.setattr(token_files, "CHARS_AT_ONCE", 500)
    assert [x.tolist() for x in coder.encode(texts)] == want


def test_rows_of_ids_can_be_written(spark, tmp_path):
    rows = [(1, [5, 6]), (None, []), (2, [70_000])]
    spark.dataSource.register(token_files.TokenFiles)
    spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1).write.format("tokenfiles").mode("append").save(str(tmp_path / "x"))
    got = by(token_files.read(spark, str(tmp_path / "x")), "start")
    assert [(r["doc_id"], r["ids"]) for r in got] == rows or sorted(map(str, [(r["doc_id"], r["ids"]) for r in got])) == sorted(map(str, rows))


def test_empty_table(spark, documents, tmp_path):
    path = token_files.write(documents([]), str(tmp_path / "ids"), token_files.public_tokenizer())
    assert token_files.manifest(path) == {"ids": 0, "files": []}
    assert token_files.read(spark, path, "digests").collect() == []


def test_files_of_lost_attempts_are_removed(tmp_path):
    (tmp_path / "part-000000-000000-lost.tok").write_bytes(b"half a file")
    (tmp_path / "part-000000-000000-kept.tok").write_bytes(b"")
    writer = token_files.TokenWriter(str(tmp_path), 10)
    writer.commit([token_files.Written([(0, 0, "part-000000-000000-kept.tok", 0, 0)]), None])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["manifest.json", "part-000000-000000-kept.tok"]
    writer.abort([])
    assert [p.name for p in tmp_path.iterdir()] == ["manifest.json"]
