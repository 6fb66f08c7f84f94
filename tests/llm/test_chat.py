from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from retourlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)


def test_each_reply_is_trained_once_with_all_turns_before(spark):
    turns = conversations(spark, [
        (1, 3, "user", "more"), (1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
        (1, 4, "assistant", "yes"), (1, 5, "user", "bye"),
    ])
    found = chat.expand(turns).orderBy("example").collect()
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] if r["loss_end"] else None for r in found] == ["hello", "yes", None]
    assert found[0]["formatted"] == (
        "<|im_start|>system\nbe<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
    )
    assert found[1]["formatted"].startswith(found[0]["formatted"])
    back = chat.read_back(chat.expand(turns)).first()
    assert [tuple(t) for t in back["turns"]] == [
        ("system", "be"), ("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "yes"), ("user", "bye")
    ]
    assert back["loss_text"] == "helloyes"
    assert back["formatted_chars"] == sum(len(r["formatted"]) for r in found)


HARD = st.text(st.sampled_from("<|\\n\nim_startend>é "), max_size=12)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "user", "assistant", "a\nb", "x\\n", "<|im_end|>"]), st.none() | HARD), min_size=1, max_size=6))
def test_control_strings_come_back(spark, said):
    turns = conversations(spark, [(7, i, role, text) for i, (role, text) in enumerate(said)])
    examples = chat.expand(turns)
    back = chat.read_back(examples).first()
    assert [tuple(t) for t in back["turns"]] == [(role or "", text or "") for role, text in said]
    assert back["loss_text"] == "".join(text or "" for role, text in said if role == "assistant")
    marks = examples.orderBy(F.desc("example")).first()["formatted"]
    assert marks.count(chat.START) == marks.count(chat.END) == len(said)


def test_nulls_ties_and_long_texts(spark):
    long = "x" * 200_000
    turns = conversations(spark, [(None, None, None, None), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (3, 0, "assistant", long)])
    back = {r["conv_id"]: r for r in chat.read_back(chat.expand(turns)).collect()}
    assert [tuple(t) for t in back[None]["turns"]] == [("", "")]
    assert [t["text"] for t in back[2]["turns"]] == ["a", "a", "b"] and back[2]["loss_text"] == ""
    assert back[3]["loss_text"] == long


def test_empty_table(spark):
    assert chat.read_back(chat.expand(conversations(spark, []))).count() == 0
