import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wharfline.llm import chat_formatting as chat

TRICKY = ["</s>", "[INST] ok [/INST]", "<\\/s>", "<\\\\/s> <s", "[ROLE]user[/ROLE]", "[\\ROLE]", "<", "<s", "\\", "a\nb", "", "é日😀</s>", "$1\\", "[[/ROLE]"]


def formatted(records, key="conv_id", order="turn"):
    out = chat.format_turns(chat.canonical_turns(records, key, order))
    return {
        r["key"]: r
        for r in out.select(
            "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
        ).collect()
    }


def test_round_trip_of_control_strings(spark):
    rng = random.Random(3)
    rows = [
        (c, t, rng.choice(["user", "assistant", "tool</s>", "[ROLE]"]), "".join(rng.choice(TRICKY) for _ in range(rng.randint(0, 6))), "x")
        for c in range(40)
        for t in range(rng.randint(1, 6))
    ]
    got = formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string"))
    for c, r in got.items():
        mine = [x for x in rows if x[0] == c]
        assert [(t["role"], t["text"]) for t in r.turns] == [(x[2], x[3]) for x in mine]
        assert r.loss == [x[3] for x in mine if x[2] == "assistant"]
        assert r.formatted.count("</s>") == len(mine) and r.formatted.count("[/ROLE]") == len(mine)
        spans = [r.formatted[s["start"] : s["start"] + s["length"]] for s in r.loss_spans]
        assert len("".join(spans)) == sum(s["length"] for s in r.loss_spans) and all("</s>" not in s for s in spans)


LAYOUTS = {
    "messages": ("array<struct<role:string,content:string>>", [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}], [("user", "q"), ("assistant", "")]),
    "conversations": ("array<struct<from:string,value:string>>", [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], [("user", "q"), ("assistant", "a")]),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_lists(spark, name):
    kind, value, expected = LAYOUTS[name]
    frame = spark.createDataFrame([(1, 0, value)], f"conv_id long, turn long, {name} {kind}").drop("turn").withColumn("at", F.lit(0))
    got = formatted(frame, order="at")[1]
    assert [(t["role"], t["text"]) for t in got.turns] == expected


def test_roles_of_turn_rows_stay(spark, tmp_path):
    """Other layouts' names of roles are ordinary roles in a table of turns."""
    said = [(1, 0, "human", "q"), (1, 1, "gpt", "a"), (1, 2, "model", "b"), (1, 3, "assistant", "c")]
    frame = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    got = formatted(frame)[1]
    assert [(t["role"], t["text"]) for t in got.turns] == [x[2:] for x in said] and got.loss == ["c"]


def test_flat_layouts_and_unknown_ones_side_by_side(spark):
    schema = "conv_id long, at int, system string, instruction string, input string, output string, prompt string, completion string, question string, answer string, context string"
    rows = [
        (1, 0, None, "i", "n", "o", None, None, None, None, None),
        (2, 0, "s", None, None, None, "p", "c", None, None, None),
        (3, 0, None, None, None, None, None, None, "q", "a", "x"),
        (4, 0, None, "i", None, None, "p", None, None, None, None),
        (5, 0, None, None, None, None, None, None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, schema)
    got = {k: [(t["role"], t["text"]) for t in r.turns] for k, r in formatted(frame, order="at").items()}
    assert got == {
        1: [("user", "i\nn"), ("assistant", "o")],
        2: [("system", "s"), ("user", "p"), ("assistant", "c")],
        3: [("user", "x\nq"), ("assistant", "a")],
        4: [], 5: [],
    }
    named = {r["key"]: r.layout for r in chat.canonical_turns(frame, "conv_id", "at").collect()}
    assert named == {1: "instruction", 2: "prompt", 3: "question", 4: None, 5: None}


def test_nulls_ties_repeats_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 2, "assistant", "z"), (None, 1, "user", None)]
    got = formatted(spark.createDataFrame(rows, schema))
    assert [(t["role"], t["text"]) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert [(t["role"], t["text"]) for t in got[None].turns] == [("user", ""), ("assistant", "z")] and got[None].loss == ["z"]
    assert formatted(spark.createDataFrame([], schema)) == {}


def test_ambiguous_layouts_are_refused():
    with pytest.raises(ValueError):
        chat.mapping_table((*chat.LAYOUTS, chat.Layout("again", ("prompt", "completion"), (), ())))


def test_query(spark, tmp_path):
    rows = [(3, 1, "assistant", "Ünï</s>"), (3, 0, "user", None), (4, 0, "assistant", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op1_chat_formatting(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {-1, 3, 4} and got[3].n_turns == 2 and got[3].loss_chars == 7
    assert got[3].turns_sha256 == sha("user\n\nassistant\nÜnï</s>\n") and got[3].loss_sha256 == sha("Ünï</s>")
    tricky = "</s>[INST] ok [/INST]"
    assert got[-1].turns_sha256 == sha(f"user\n{tricky}\nassistant\n{tricky}\n") and got[-1].loss_sha256 == sha(tricky)
