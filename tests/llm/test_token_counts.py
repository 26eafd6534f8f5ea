import pytest
from pyspark.sql import functions as F

from wharfline.functions.durable import scratch_path
from wharfline.llm import token_counts


@pytest.fixture
def rollup(spark):
    return token_counts.Rollup(spark, scratch_path(spark, "test-rollup"))


def rows(spark, data):
    return spark.createDataFrame(data, "source string, lang string, new long, old long, tokenizer string, tokens string")


def totals(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=str)


def test_inserts_deletes_revisions_and_replays(spark, rollup):
    first = rows(spark, [("a", "en", 5, None, "x", "y"), ("a", "en", 5, None, "x", "y"), (None, None, None, None, "x", "y")])
    assert rollup.totals().count() == 0
    assert rollup.commit("one", token_counts.changes(first, "v1", new="new"))
    assert totals(rollup) == sorted([("a", "en", "v1", 2, 10), (None, None, "v1", 1, 0)], key=str)
    assert not rollup.commit("one", token_counts.changes(first, "v1", new="new"))
    revised = rows(spark, [("a", "en", 3, 5, "x", "y")])
    assert rollup.commit("two", token_counts.changes(revised, "v1", new="new", old="old"))
    assert ("a", "en", "v1", 2, 8) in totals(rollup)
    gone = rows(spark, [("a", "en", None, 3, "", ""), ("a", "en", None, 5, "", ""), (None, None, None, None, "", "")])
    assert rollup.commit("three", token_counts.changes(gone, "v1", old="old"))
    assert totals(rollup) == [] and rollup.batches() == ["one", "three", "two"]


def test_a_batch_that_died_is_not_counted_and_can_be_sent_again(spark, rollup):
    batch = token_counts.changes(rows(spark, [("a", "en", 5, None, "", "")]), "v1", new="new")
    batch.limit(0).write.parquet(f"{rollup.folder}/batch=late")
    system, path = rollup._path(f"{rollup.folder}/batch=late/_SUCCESS")
    system.delete(path, False)
    assert not rollup.committed("late") and rollup.totals().count() == 0
    assert rollup.commit("late", batch) and totals(rollup) == [("a", "en", "v1", 1, 5)]


def test_empty_batch_and_bad_name(spark, rollup):
    assert rollup.commit("none", token_counts.changes(rows(spark, []), "v1", new="new")) and totals(rollup) == []
    with pytest.raises(ValueError):
        rollup.commit("../x", token_counts.changes(rows(spark, []), "v1", new="new"))


def test_counts(documents):
    text = "Mail a.b@c.de or http://x.yz now, 12 times!"
    got = {r.doc_id: r for r in token_counts.counted(documents([(1, text), (2, None), (None, " \n")])).collect()}
    assert (got[1].words, got[1].masked) == (7, 5)
    assert [(got[i].words, got[i].pieces, got[i].masked) for i in (2, None)] == [(0, 0, 0)] * 2
    assert got[1].pieces == 19


def test_a_hot_source_is_one_row_per_batch(spark, rollup):
    hot = spark.range(5000).select(F.lit("hot").alias("source"), F.lit("en").alias("lang"), F.lit(2).alias("new"))
    rollup.commit("hot", token_counts.changes(hot, "v1", new="new"))
    assert spark.read.parquet(f"{rollup.folder}/batch=hot").count() == 1 and totals(rollup) == [("hot", "en", "v1", 5000, 10000)]


def test_compaction_keeps_totals_and_batches(spark, rollup):
    one = token_counts.changes(rows(spark, [("a", "en", 5, None, "", ""), ("b", "en", 2, None, "", "")]), "v1", new="new")
    rollup.compact()
    assert rollup.batches() == []
    rollup.commit("one", one)
    rollup.compact()
    rollup.drop_compacted()
    assert rollup._names("batch") == [] and rollup.batches() == ["one"] and not rollup.commit("one", one)
    rollup.commit("two", token_counts.changes(rows(spark, [("a", "en", None, 5, "", "")]), "v1", old="old"))
    assert totals(rollup) == [("b", "en", "v1", 1, 2)]
    rollup.compact()
    assert rollup.batches() == ["one", "two"] and totals(rollup) == [("b", "en", "v1", 1, 2)]
    rollup.drop_compacted()
    assert len(rollup._names("base")) == 1 and totals(rollup) == [("b", "en", "v1", 1, 2)]


def test_a_base_that_died_does_not_count(spark, rollup):
    one = token_counts.changes(rows(spark, [("a", "en", 5, None, "", "")]), "v1", new="new")
    rollup.commit("one", one)
    rollup.compact()
    system, path = rollup._path(f"{rollup.folder}/base=00000000/totals/_SUCCESS")
    system.delete(path, False)
    assert rollup.compacted() == set() and totals(rollup) == [("a", "en", "v1", 1, 5)]
    rollup.compact()
    assert rollup.compacted() == {"one"} and totals(rollup) == [("a", "en", "v1", 1, 5)]


def test_vocabulary_counts_equal_a_replay_of_the_encoder(spark, documents, tmp_path):
    from wharfline.llm import byte_bpe

    docs = documents([(1, "some words here", "a"), (2, None, "a"), (None, "more of them", "b"), (2**60 + 1, "x " * 500, None)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    expected = {}
    tokens = {r.doc_id: r.n_tokens for r in byte_bpe.digests(docs, *byte_bpe.public_vocabulary()).collect()}
    for r in docs.collect():
        n, t = expected.get(r.source, (0, 0))
        expected[r.source] = (n + 1, t + tokens[r.doc_id])
    got = token_counts.token_counts_by_vocabulary(spark, str(tmp_path)).collect()
    assert {r.source: (r.documents, r.tokens) for r in got} == expected
