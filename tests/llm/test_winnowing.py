import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from wharfline.llm import winnowing as win

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashed_longs(a, b):
    """Spark's xxhash64 of two longs: the hash of the first seeds the second."""
    seed = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed)


def windows(level, whole, k, w):
    """Windows one by one: (position, hash) of the rightmost least of each."""
    if not level:
        return []
    if len(level) < k:
        level = [whole]
    else:
        step = 1
        while step < k:
            level = [hashed_longs(level[i], level[i + step]) for i in range(len(level) - step)]
            step *= 2
    short = [h >> 32 for h in level]
    kept = set()
    for i in range(max(1, len(short) - w + 1)):
        window = short[i : i + w]
        kept.add(i + max(j for j, h in enumerate(window) if h == min(window)))
    return [(p, short[p]) for p in sorted(kept)]


def plain(text, k=4, w=8):
    """Runs of words, and of code points where there are few words: (unit, position, hash)."""
    text = text or ""
    words = [x.encode() for x in WORD.findall(text)]
    hashed = lambda data, seed=42: xxhash.xxh64_intdigest(data, seed)
    out = [("word", *x) for x in windows([hashed(x) for x in words], hashed(b" ".join(words)), k, w)]
    if 0 < len(words) < w + k - 1:
        salt = hashed((8).to_bytes(4, "little"))
        out += [("point", *x) for x in windows([hashed(c.encode(), salt) for c in text], hashed(text.encode(), salt), 4, w)]
    return out


def texts(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(12)]
    return [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in [*range(14), 40, 300]] + [None, " \t\n", "same " * 50, "x" * 3000]


def test_equals_windows_one_by_one(spark, documents):
    given = texts()
    got = {r.doc_id: [(x.unit, x.position, x.hash) for x in r.runs] for r in win.fingerprints(documents(list(enumerate(given)))).collect()}
    assert got == {i: plain(t) for i, t in enumerate(given)}


def test_shared_passage_is_certain_to_be_found(spark, documents):
    rng = random.Random(1)
    rows = []
    for i in range(30):
        shared = " ".join(str(rng.random()) for _ in range(win.W + win.K - 1))
        for side in range(2):
            own = lambda: " ".join(str(rng.random()) for _ in range(rng.randint(0, 30)))
            rows.append((2 * i + side, f"{own()} {shared} {own()}"))
    got = {r.doc_id: {x.hash for x in r.runs} for r in win.fingerprints(documents(rows)).collect()}
    assert all(got[2 * i] & got[2 * i + 1] for i in range(30))


@pytest.mark.parametrize("slices", [1, 2, 7, 40])
def test_next_document(spark, documents, slices):
    rng = random.Random(slices)
    ids = rng.sample(range(1000), 60)
    rows = [(i, f"t{i}") for i in ids] + [(ids[0], "twin a"), (None, "n")]
    assert following_of(documents, rows, slices) == in_order(rows)


def following_of(documents, rows, slices):
    pairs, following = win.with_next(documents(rows).select("doc_id", "text"), slices)
    found = pairs.select("*", F.lead("text").over(following).alias("next")).where("NOT _copy").collect()
    return sorted(((r.doc_id, r.text, r.next) for r in found), key=str)


def in_order(rows):
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]), r[1]), reverse=True)
    return sorted(((*r, order[(n + 1) % len(order)][1]) for n, r in enumerate(order)), key=str)


@pytest.mark.parametrize("slices", [2, 9])
@pytest.mark.parametrize("hot", [None, 7])
def test_an_id_on_very_many_rows_is_cut(documents, slices, hot):
    rows = [(i, f"t{i}") for i in range(40)] + [(hot, f"x{i}") for i in range(150)] + [(hot, "equal")] * 120 + [(-(2**63), "least")]
    assert following_of(documents, rows, slices) == in_order(rows)
    pairs, _ = win.with_next(documents(rows).select("doc_id", "text"), slices)
    largest = max(r["count"] for r in pairs.where("NOT _copy").groupBy("_slice").count().collect())
    assert largest <= 2 * (-(-len(rows) // slices))


def test_text_without_spaces_is_like_its_edited_text(spark, documents, tmp_path):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400))) for i in range(4)] + [(9, "extraordinary harbour installations"), (8, "")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in win.op8_winnowing(spark, str(tmp_path)).collect()}
    assert all(0.2 < got[i].near_edited < 0.9 and got[i].near_next < 0.05 for i in range(1, 4))
    assert got[9].near_edited > 0 and got[8].near_edited == 1.0


def test_query_and_edges(spark, documents, tmp_path):
    given = texts(6)
    rows = list(enumerate(given))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in win.op8_winnowing(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        own, nxt = text or "", given[i - 1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == " ".join(f"{'c' if u == 'point' else ''}{p}:{h:X}" for u, p, h in plain(own))
        a, b, c = ({(u, h) for u, _, h in plain(t)} for t in (own, edited, nxt))
        like = lambda x, y: 1.0 if not x and not y else len(x & y) / len(x | y)
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))


def test_empty_table_and_one_row(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert win.op8_winnowing(spark, f"{tmp_path}/a").count() == 0
    documents([(1, "one two three four five six")]).write.parquet(f"{tmp_path}/b/documents.parquet")
    row = win.op8_winnowing(spark, f"{tmp_path}/b").collect()
    assert len(row) == 1 and row[0].near_next == 1.0
    documents([(None, "a"), (None, "b")]).write.parquet(f"{tmp_path}/c/documents.parquet")
    assert win.op8_winnowing(spark, f"{tmp_path}/c").count() == 2
