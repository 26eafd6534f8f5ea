import glob
import hashlib
import os
import sys

import numpy as np
import pytest

import corpus_pipeline
from llm_helpers import all_links, components_of, folder_of, plain_fingerprint, plain_repeats
from wharfline.llm import byte_bpe, common, mixing, quality_gam, registered

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")
duckdb = pytest.importorskip("duckdb")

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))
from compare import comparable  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_plain_recomputation(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    (_, quality), (_, near), (_, repeats), (_, mix), (_, bpe) = corpus_pipeline.STAGES
    # Quality: what the operator's scores say, every kept row unchanged.
    good = quality(spark, docs, FOLDER)
    scores = {r.doc_id: r.score for r in quality_gam.op5_quality_gam(spark, FOLDER).collect()}
    rows = {r.doc_id: r for r in good.collect()}
    assert good.columns == columns and set(rows) == {i for i, s in scores.items() if s >= quality_gam.THRESHOLD}
    # Near-duplicates: one of each group, the smallest id.
    good = spark.createDataFrame(list(rows.values()), good.schema)
    ids = sorted(rows)
    codes = np.array([plain_fingerprint(rows[i].text) for i in ids], np.uint64)
    root = components_of(all_links(codes), len(ids))
    single = near(spark, good, FOLDER)
    kept = {r.doc_id: r for r in single.collect()}
    assert single.columns == columns and set(kept) == {i for n, i in enumerate(ids) if root[n] == n}
    # Passages: a dictionary of windows.
    single = spark.createDataFrame(list(kept.values()), single.schema)
    expected = {i: (gone, text) for i, _, gone, text in plain_repeats([(i, kept[i].text) for i in sorted(kept)])}
    left = repeats(spark, single, FOLDER)
    found = {r.doc_id: r for r in left.collect()}
    assert left.columns == columns and set(found) == set(expected)
    for i, (gone, text) in expected.items():
        assert found[i].text == (text if gone else kept[i].text) and found[i].n_chars == len(found[i].text)
    # The mix: as often as the drawing says.
    left = spark.createDataFrame(list(found.values()), left.schema)
    drawn = {r.doc_id: r for r in mixing.mixed(left).collect()}
    mixed = mix(spark, left, FOLDER)
    out = mixed.collect()
    assert mixed.columns == columns
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == {i: r.taken for i, r in drawn.items() if r.taken}
    # Tokens: the library's.
    ranks = byte_bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    final = bpe(spark, spark.createDataFrame(out, mixed.schema), FOLDER).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in final) == sorted(
        (r.doc_id, len(library.encode_ordinary(r.text)), digest(r.text)) for r in out
    )
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, final))


def test_no_row_is_lost_beside_null_ids(spark, documents, labels, tmp_path):
    """Ids above what a double holds, next to a null one, through every stage."""
    rows = [(2**60 + 1, "the first of the harbour logs " * 3), (2**60 + 3, "cranes and ships and quays"), (None, "a note on tides")]
    folder = folder_of(tmp_path, documents=documents(rows), labels=labels([(i, 1, 0, "", 0.0) for i, _ in rows]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, folder)
        assert {r.doc_id for r in docs.collect()} == {i for i, _ in rows}, name
    ids = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    assert ids and ids <= {i for i, _ in rows}


def test_nulls_extra_columns_and_empty_tables(spark, documents, labels, tmp_path):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "a few good words"), (3, "a few good words"), (4, "w " * 30_000, None)]
    for n, docs in enumerate((documents(rows), documents([]))):
        folder = folder_of(tmp_path / str(n), documents=docs, labels=labels([]))
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == columns, name
            out.collect()
        assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(registered.oracle_sql()[name])
    expected = comparable([d[0] for d in result.description], result.fetchall())
    df = registered.queries()[name](spark, FOLDER)
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_every_operator_is_registered_once():
    import __spark_entry__ as contract

    names = set(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(common.QUERIES) <= names
