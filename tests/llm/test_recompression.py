import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import plain_repeats
from wharfline.llm import recompression as rec


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.integers(0, 4))
def test_equal_windows_share_a_symbol(texts, rounds):
    names = np.array([w * 977 + 13 for t in texts for w in t], np.uint64)
    owner = np.array([n for n, t in enumerate(texts) for _ in t], np.int64)
    key, first, last = rec.anchors(names, owner, rounds=rounds)
    symbol, flat = {}, [w for t in texts for w in t]
    for k, a, b in zip(key.tolist(), first.tolist(), last.tolist(), strict=True):
        for s in range(a, b + 1):
            if s + 13 <= len(owner) and owner[s] == owner[s + 12]:
                symbol.setdefault(s, k)
    windows = [s for s in range(len(flat) - 12) if owner[s] == owner[s + 12]]
    assert sorted(symbol) == windows
    seen = {}
    for s in windows:
        assert seen.setdefault(tuple(flat[s : s + 13]), symbol[s]) == symbol[s]


def test_window_hashes_follow_content():
    names = np.array([1, 2, 3, 4, 1, 2, 3, 5, 1, 2, 3, 4], np.uint64)
    one = rec.window_hashes(names, 4, 1)
    assert one[0] == one[8] and len(set(one.tolist())) == 8 and len(one) == 9


def made_rows(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 3)
    passages = [" ".join(word() for _ in range(n)) for n in (12, 13, 14, 40, 90)] + ["same " * 60, "a b " * 30]
    rows = []
    for i in range(80):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((i * 3 % 97, " \n".join(parts)))
    rows += [(500, rows[0][1]), (rows[4][0], rows[5][1]), (501, None), (502, ""), (None, rows[7][1]), (None, passages[4])]
    return [*rows, (503, "only\ta few  words"), (504, rows[3][1]), (504, rows[3][1])]


@pytest.mark.parametrize("at_once", [200_000, 50])
def test_equals_a_dictionary_of_windows(spark, documents, monkeypatch, at_once):
    monkeypatch.setattr(rec, "WORDS_AT_ONCE", at_once)
    rows = made_rows(at_once)
    docs = documents(rows)
    expected = plain_repeats(rows)
    got = rec.digests(docs).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(tuple, got), key=str) == sorted(((i, n, g, digest(t)) for i, n, g, t in expected), key=str)
    left = rec.without_repeats(docs)
    assert left.columns == docs.columns
    texts = sorted(((r.doc_id, " ".join((r.text or "").split())) for r in left.collect()), key=str)
    assert texts == sorted(((i, t) for i, _, _, t in expected), key=str)
    untouched = {(i, t) for (i, t), e in zip(rows, expected, strict=True) if not e[2]}
    assert untouched <= {(r.doc_id, r.text) for r in left.collect()}


def test_whole_copies_lose_all_words_and_send_no_windows(documents):
    rng = random.Random(8)
    text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(50))
    other = text + " and more"
    rows = [(5, text), (3, text), (9, text), (None, text), (7, other), (3, text), (1, "short " * 12), (2, "short " * 12), (4, " " * 40)]
    docs = documents(rows)
    got = sorted((tuple(r)[:3] for r in rec.digests(docs).collect()), key=str)
    assert got == sorted((x[:3] for x in plain_repeats(rows)), key=str)
    keys = rec.row_keys(docs)
    prepared = rec.prepared(docs, keys)
    copies = rec.whole_copies(prepared, keys)
    assert sorted(r.id for r in copies.collect()) == [2, 5, 9, rec.LAST]
    found = rec.repeats(prepared, rec.shared_symbols(prepared, keys), copies, keys).collect()
    assert {r.id for r in found} == {7}


def test_empty(documents):
    assert rec.digests(documents([])).count() == 0 and rec.without_repeats(documents([])).count() == 0


@pytest.mark.parametrize("shared_id", [None, 900])
def test_a_row_gets_only_its_own_windows(documents, monkeypatch, shared_id):
    """Many rows without an id, or of one id, share passages with others; no list holds windows of several rows."""
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(n))
    passages = [words(30) for _ in range(4)]
    rows = [(i, f"{passages[i % 4]} {words(9)}") for i in range(8)]
    rows += [(shared_id, f"{words(5)} {passages[i % 4]} {words(i % 7)}") for i in range(60)]
    rows += [rows[-1]] * 9  # equal rows have one list
    starts_of, seen = rec.repeated_starts, []

    def kept(*given):
        seen.append(starts_of(*given))
        return seen[-1]

    monkeypatch.setattr(rec, "repeated_starts", kept)
    got = sorted((tuple(r)[:3] for r in rec.digests(documents(rows)).collect()), key=str)
    assert got == sorted((x[:3] for x in plain_repeats(rows)), key=str)
    lists = [len(r.starts) for r in seen[0].collect()]
    assert len(lists) == 64 and max(lists) <= 29  # a text has 41 words at most
