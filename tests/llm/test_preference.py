from docklake.llm.preference import preference_pairs
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, prompt string"


def _pairs(spark, rows):
    turns = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA)
    found = preference_pairs(turns, F.expr("conv_id div 2"), F.col("conv_id") % 2 == 0).collect()
    return {r.pair_id: r for r in found}


def test_shared_turns_are_rendered_once(spark):
    r = _pairs(spark, [
        (0, 1, "user", "hi"), (0, 2, "assistant", "good"), (0, 3, "user", "more"), (0, 3, "user", "more"),
        (1, 2, "assistant", "bad"), (1, 1, "user", "hi"), (1, 3, "assistant", None),
    ])[0]
    assert r.complete and r.prompt_turns == 1 and r.prompt == "<|user|>\nhi<|end|>\n"
    assert r.chosen == "<|assistant|>\ngood<|end|>\n<|user|>\nmore<|end|>\n"
    start, end = map(int, r.chosen_spans.split(":"))
    assert r.chosen[start:end] == "good<|end|>\n"
    assert [r.rejected[slice(*map(int, s.split(":")))] for s in r.rejected_spans.split(",")] == ["bad<|end|>\n", "<|end|>\n"]


def test_odd_conversations(spark):
    found = _pairs(spark, [
        (2, 0, "user", "same"), (3, 0, "user", "same"),  # equal
        (4, 0, "user", "a"), (5, 0, "user", "a"), (5, 1, "assistant", "b"),  # one goes on
        (6, None, None, None), (8, 0, "user", "<|end|> in a text"), (None, 0, "user", "x"),
    ])
    assert set(found) == {1, 2, 3, 4}
    assert found[1].prompt_turns == 1 and found[1].chosen == found[1].rejected == ""
    assert found[2].prompt_turns == 1 and found[2].chosen == "" and found[2].rejected_spans == "14:23"
    assert not found[3].complete and found[3].prompt == "" and found[3].chosen == "<||>\n<|end|>\n" and found[3].rejected == ""
    assert found[4].chosen == "<|user|>\n< |end|> in a text<|end|>\n" and found[4].chosen_spans == ""
    assert _pairs(spark, []) == {}
