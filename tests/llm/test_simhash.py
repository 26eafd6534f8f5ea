import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import all_links, components_of, plain_fingerprint
from wharfline.llm import simhash


def test_fingerprint():
    for text in (None, "", " \n", "One", "one TWO", "Ä B c d", "a b c a b c a b c", "x\x0by\x1cz é É q", "w " * 500):
        assert simhash.fingerprint_text(text) % 2**64 == plain_fingerprint(text)


def clustered(seed=1, n=200):
    rng = np.random.default_rng(seed)
    base = rng.integers(-(2**63), 2**63 - 1, n, dtype=np.int64)
    out = [base]
    for _ in range(5):
        far = base.copy()
        for _ in range(rng.integers(1, 5)):
            far = far ^ (np.int64(1) << rng.integers(0, 63, n))
        out.append(far)
    dense = base[0] ^ np.array([(1 << a) ^ (1 << b) for a in range(30) for b in range(a)], np.int64)
    return np.unique(np.concatenate([*out, dense]))


def test_forest_finds_all_links_of_each_bucket():
    codes = clustered()
    a, b = simhash.Forest(np.zeros(len(codes), np.int64), codes).join()
    assert components_of(zip(a, b, strict=True), len(codes)) == components_of(all_links(codes), len(codes))
    buckets = np.arange(len(codes)) % 3
    a, b = simhash.Forest(buckets, codes).join()
    within = [(i, j) for i, j in all_links(codes) if buckets[i] == buckets[j]]
    assert components_of(zip(a, b, strict=True), len(codes)) == components_of(within, len(codes))


@pytest.mark.parametrize("hot", [10**9, 60])
def test_links_over_buckets(spark, hot):
    codes = clustered(2)
    place = {int(c): i for i, c in enumerate(codes)}
    found = simhash.links(spark.createDataFrame([(int(c),) for c in codes], "code long"), hot).collect()
    pairs = [(place[r.src], place[r.dst]) for r in found]
    assert all(bin((int(codes[i]) ^ int(codes[j])) % 2**64).count("1") for i, j in pairs)
    assert components_of(pairs, len(codes)) == components_of(all_links(codes), len(codes))


def made_rows():
    rng = random.Random(4)
    base = [" ".join(f"{rng.choice('abcdefg')}{rng.randint(0, 999)}" for _ in range(300)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t + " tail") for i, t in enumerate(base[:6])] + [(200 + i, base[0]) for i in range(40)]
    return rows + [(300, None), (301, ""), (302, "\t"), (None, base[3]), (None, "alone of its kind"), (5, base[5]), (11, "other text of eleven")]


def test_components_and_one_of_each(spark, documents):
    rows = made_rows()
    got = simhash.near_duplicates(documents(rows)).collect()
    codes = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    root = components_of(all_links(codes), len(rows))
    lowest = {}
    for (i, _), r in zip(rows, root, strict=True):
        lowest[r] = min((x for x in (lowest.get(r), i) if x is not None), default=None)
    expected = sorted(((i, int(c.astype(np.int64)), lowest[r]) for (i, _), c, r in zip(rows, codes, root, strict=True)), key=str)
    assert sorted(((r.doc_id, r.code, r.component_id) for r in got), key=str) == expected
    docs = documents(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(lowest.values(), key=str)


def test_large_ids_beside_null_ones(documents):
    texts = ["one two three four " * 9, "quite another text about harbours", "a third one, of ships and cranes"]
    rows = [(2**60 + 1, texts[0]), (2**60 + 3, texts[1]), (None, texts[2]), (2**60 + 5, texts[0])]
    docs = documents(rows)
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(2**60 + 1, 2**60 + 1), (2**60 + 3, 2**60 + 3), (None, None), (2**60 + 5, 2**60 + 1)}
    assert {(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()} == set(rows[:3])


def test_empty(documents):
    assert simhash.near_duplicates(documents([])).count() == 0 and simhash.one_of_each(documents([])).count() == 0


def test_spread(spark):
    """Every pair within reach shares a bucket, and buckets are dealt out again only where they are hot."""
    codes = spark.range(1000).select(F.xxhash64("id").alias("code"))
    assert simhash.bucketed(codes).count() == 4000
