import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from row_helpers import by

from wharfline.llm import spelling


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append({"word": w, "form": form[w], "root": root, "n": n, "n_near": len(near[w]),
                    "form_n": None if form[w] is None else words[form[w]]})
    return sorted(out, key=lambda r: r["word"])


def corpus(seed=3, documents=40):
    rng = random.Random(seed)
    stems = ["engine" + "x" * k + "room" for k in range(4)] + ["aaaaaaa", "aaaaaaaa", "straße" + "nbahn", "Übermaßig", "interior"]
    stems += ["".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(60)]
    rows = []
    for doc in range(documents):
        words = [rng.choice(stems[: rng.choice([5, 20, len(stems)])]) for _ in range(rng.randint(0, 60))]
        words = [w[:3] + rng.choice("xyz") + w[4:] if rng.random() < 0.1 else w for w in words]
        rows.append((doc, rng.choice([" ", "-", "7"]).join(words)))
    return rows + [(None, "interior interior Interior ÷÷÷÷÷÷÷×"), (5, None), (6, ""), (7, "q" * 5000 + " " + "q" * 5001), (7, "q" * 5000 + " " + "q" * 5001)]


@pytest.mark.parametrize("hot", [spelling.HOT, 40])
def test_variants_equal_brute_force(documents, hot):
    rows = corpus()
    expected = plain_variants(plain_words(rows))
    assert any(r["form"] for r in expected) and any(r["n_near"] > 3 for r in expected)
    assert by(spelling.variants(documents(rows), hot), "word") == expected


def test_forms_are_followed_to_the_last(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(7)] + [("v", "w3")]
    got = by(spelling.roots(spark.createDataFrame(forms, "word string, form string")), "word")
    assert {r["word"]: r["root"] for r in got} == {w: "w7" for w, _ in forms}


def test_a_crowded_prefix_is_cut_until_tiles_are_small(spark):
    words = [("shared" * 3 + a + b + c, 2) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    df = spark.createDataFrame(words, "word string, n long")
    largest = max(r["count"] for r in spelling.tiles(df, 200).groupBy("tile").count().collect())
    assert largest <= spelling.FEW + 1
    assert {r["n_near"] for r in spelling.near_words(df, 200).collect()} == {21}


def test_empty_tables(documents):
    assert spelling.variants(documents([])).collect() == []
    assert spelling.variants(documents([(1, "one word only"), (2, None)])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abÀ", min_size=1, max_size=6), min_size=1, max_size=25, unique=True))
def test_a_tile_of_all_words_is_exact(words):
    """Any words, tiled without prefix or suffix: the dense comparison alone."""
    rows = [(w, 1 + len(w), wide, 0, wide + 1, wide) for w in words for wide in (len(w), len(w) + 1)]
    frame = pd.DataFrame(rows, columns=["word", "n", "wide", "front", "below", "tile"]).sort_values("tile", kind="stable")
    found = spelling.near_in_tiles(frame)
    links = found.groupby("word")["links"].sum().to_dict() if len(found) else {}
    assert links == {w: k for w in words if (k := sum(one_edit(w, v) for v in words))}


def test_blocks_cover_every_pair_once():
    tile = np.array([1, 1, 1, 2, 3, 3, 3, 3, 3])
    for at_once in (1, 2, 5, 100):
        pairs = [p for a, b in spelling.pair_blocks(tile, at_once) for p in zip(a.tolist(), b.tolist(), strict=True)]
        assert sorted(pairs) == [(i, j) for i in range(9) for j in range(i + 1, 9) if tile[i] == tile[j]]
