import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from retourlens.llm import bpe
from retourlens.llm.queries import byte_bpe_50k
from tests.llm.helpers import documents

library = Tokenizer.from_file(byte_bpe_50k())
vocabulary = bpe.Vocabulary(byte_bpe_50k())
small_leaves = bpe.Encoder(vocabulary, leaf_bytes=8)


def expected(text):
    return library.encode(text or "", add_special_tokens=False).ids


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab cde'srelt\n\té1-."), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_texts_equal_the_library(text):
    assert ids_of(small_leaves.text(text)) == expected(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aab bcd'srel\n 1é"), max_size=120), st.integers(1, 30))
def test_pieces_cut_anywhere_join_exactly(text, size):
    cut = [text[i : i + size] for i in range(0, max(1, len(text)), size)]
    parts = [(words := small_leaves.find(p), [small_leaves.word(w) for w in words]) for p in cut]
    assert ids_of(b"".join(bpe._tree(small_leaves, parts)[1])) == expected(text)


def test_unsplit_runs_are_joined_exactly():
    r = random.Random(3)
    for letters in ("a", "ab", "thein", "étr", "€", "xyz01"):
        text = "".join(r.choice(letters) for _ in range(5000))
        assert ids_of(small_leaves.text(text)) == expected(text)


def test_own_merging_equals_the_compiled_one():
    r = random.Random(4)
    for _ in range(200):
        data = bytes(r.choice(b"theing aionrst") for _ in range(r.randrange(1, 30)))
        assert bpe.Encoder.merge(small_leaves, data) == small_leaves.merge(data)


@pytest.mark.parametrize("piece_chars", [50, 1 << 16])
def test_rows_through_spark(spark, piece_chars):
    texts = [
        None, "", " ", "a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y" * 9, "ab" * 400, "we're  all\n\nhere " * 30,
        "don't" * 50, "é€😀" * 60, "same text again " * 10, "same text again " * 10, "1 2  3" * 40,
    ]
    docs = documents(spark, texts).withColumnRenamed("source", "ids").withColumnRenamed("lang", "value")
    encoded = bpe.encode(docs, byte_bpe_50k(), piece_chars=piece_chars)
    assert encoded.columns == ["doc_id", "text", "value", "n_chars", "ids"]
    found = bpe.decode(encoded.withColumn("list", bpe.unpack("ids")), byte_bpe_50k()).collect()
    assert len(found) == len(texts)
    for row in found:
        want = expected(texts[row["doc_id"]])
        assert ids_of(row["ids"]) == want == row["list"]
        assert row["decoded"] == library.decode(want, skip_special_tokens=False) == (texts[row["doc_id"]] or "")


def test_decoding_of_broken_and_missing_ids(spark):
    broken = np.array([i for i, p in enumerate(vocabulary.pieces) if p == b"\xc3"][:1], "<u4").tobytes()
    table = spark.createDataFrame([(1, None), (2, bytearray(broken))], "doc_id long, ids binary")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(table, byte_bpe_50k()).collect()}
    assert found == {1: "", 2: "�"}


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(documents(spark, []), byte_bpe_50k()), byte_bpe_50k()).count() == 0
