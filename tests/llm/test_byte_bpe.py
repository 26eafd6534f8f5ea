import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from wharfline.llm import byte_bpe as bpe

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Encoder(ranks)


def hard_texts():
    rng = random.Random(2)
    out = ["", " ", "\n\n  \t", "a" * 3000, "ab" * 900, "😀" * 200, "x" * bpe.WIDEST, "x" * (bpe.WIDEST + 1), "\x00\x00 ", "don't I'll 12345 …—", "<|endoftext|>"]
    out += ["".join(rng.choice("abeé日 .\n1") for _ in range(rng.randint(0, 400))) for _ in range(150)]
    return out + ["".join(rng.choice("aeinrst") for _ in range(n)) for n in (250, 256, 257, 700, 5000)]


def test_equals_the_library(library):
    encoding, encoder = library
    given = hard_texts()
    got = [i for _, ids in bpe.encode_batches([pa.RecordBatch.from_pydict({"doc_id": list(range(len(given))), "text": given})], encoder, public.PATTERN) for i in ids]
    for text, ids in zip(given, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_full_memory_is_emptied(library, monkeypatch):
    encoding, encoder = library
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "ENCODED_AT_ONCE", 2)
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 500)
    given = hard_texts()[:60]
    got = [i for _, ids in bpe.encode_batches([pa.RecordBatch.from_pydict({"doc_id": list(range(len(given))), "text": given})], encoder, public.PATTERN) for i in ids]
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == [encoding.encode_ordinary(t) for t in given]


def test_other_vocabularies():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"bcab": 259}
    library = tiktoken.Encoding("tiny", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(ranks)
    for text in ("abc", "abcabc", "bcab", "abbcabc", "ab" * 200 + "c" * 100):
        assert np.frombuffer(encoder.encode_pieces([text.encode()])[0], "<u4").tolist() == library.encode_ordinary(text)
    with pytest.raises(ValueError):
        bpe.Encoder({b"a": 0, b"b": 1}).encode_pieces([b"ac"])


def test_frames(spark, documents, library):
    encoding, _ = library
    rows = [(i, t) for i, t in enumerate(hard_texts())] + [(1, None), (None, "null id"), (2, "twice"), (2, "twice")]
    got = bpe.digests(documents(rows), *bpe.public_vocabulary()).collect()
    digest = lambda data: hashlib.sha256(data).hexdigest()
    expected = []
    for i, t in rows:
        ids = np.array(encoding.encode_ordinary(t or ""), "<u4")
        expected.append((i, len(ids), digest(ids.tobytes()), digest((t or "").encode())))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    path, pattern = bpe.public_vocabulary()
    back = bpe.decode(bpe.encode(documents(rows[:20]), path, pattern), path).collect()
    assert {r.doc_id: bytes(r.data) for r in back} == {i: t.encode() for i, t in rows[:20]}
    assert bpe.digests(documents([]), path, pattern).count() == 0


def test_large_ids_beside_null_ones(documents):
    rows = [(2**60 + 1, "a b"), (2**60 + 3, "c"), (None, "d e f"), (-(2**63), ""), (2**63 - 1, None)]
    path, pattern = bpe.public_vocabulary()
    coded = bpe.encode(documents(rows), path, pattern)
    back = {r.doc_id: bytes(r.data) for r in bpe.decode(coded, path).collect()}
    assert back == {i: (t or "").encode() for i, t in rows} == {r.doc_id: "".join(t or "" for i, t in rows if i == r.doc_id).encode() for r in coded.collect()}
    assert {r.doc_id for r in bpe.digests(documents(rows), path, pattern).collect()} == {i for i, _ in rows}
