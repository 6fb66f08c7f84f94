import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retourlens.llm import bpe, jaccard, langid, mixing
from retourlens.llm.queries import byte_bpe_50k
from retourlens.session import settle
from tests.llm.helpers import SMALL, documents, needs_tables
from tests.llm.test_jaccard import sets_of

pytestmark = needs_tables


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(settle(stage(spark, docs[-1], SMALL), "pipeline-test"))
    return docs


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(d.columns == stages[0].columns for d in stages[1:-1])


def test_clean_documents_pass_the_language_stage(stages):
    texts = {r["doc_id"] for r in stages[0].collect() if any(map(str.isalpha, r["text"] or ""))}
    assert {r["doc_id"] for r in stages[1].collect()} == texts


def test_exact_copies_go(stages):
    before = [(r["doc_id"], " ".join(r["text"].split())) for r in stages[1].collect()]
    first = {}
    for i, text in sorted(before):
        first.setdefault(text, i)
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(first.values())


def test_near_copies_go(stages):
    sets = {r["doc_id"]: sets_of(r["text"], 5) for r in stages[2].collect()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted({find(i) for i in sets})


def test_mix_repeats_what_it_takes(stages):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(stages[3], keep_text=False).collect()}
    got = [r["doc_id"] for r in stages[4].collect()]
    assert {i: got.count(i) for i in set(got)} == {i: c for i, c in copies.items() if c}


def test_encoding_comes_back(stages):
    before = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    encoder = bpe.Encoder(bpe.Vocabulary(byte_bpe_50k()))
    found = stages[5].collect()
    assert len(found) == stages[4].count()
    for row in found:
        assert row["decoded"] == before[row["doc_id"]] and bytes(row["ids"]) == encoder.text(before[row["doc_id"]])
        assert row["n_tokens"] == len(np.frombuffer(row["ids"], "<u4"))


def test_run_equals_its_stages(spark, stages):
    key = lambda df: sorted((r["doc_id"], bytes(r["ids"])) for r in df.select("doc_id", "ids").collect())
    assert key(corpus_pipeline.run(spark, SMALL)) == key(stages[5])


def test_rejected_documents_go(spark):
    docs = documents(spark, ["the and of that " * 20] * 30 + [None, "", "12 !!"])
    kept = corpus_pipeline.identify_language(spark, docs, SMALL)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))
    assert langid.fit(docs).languages


def test_stages_on_an_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SMALL), "pipeline-empty")
        assert docs.count() == 0


def test_stages_leave_nothing_in_their_workers(spark, stages):
    """Words that a stage remembers are gone when its tasks end; encoders belong to a task."""
    import pandas as pd

    def held(batches):
        for _ in batches:
            yield pd.DataFrame({"words": [len(jaccard._words)]})

    found = spark.range(64, numPartitions=16).mapInPandas(held, "words long").collect()
    assert len(found) >= 16 and all(r["words"] == 0 for r in found)
    shipped = pickle.loads(pickle.dumps(bpe.Vocabulary(byte_bpe_50k())))
    assert shipped.ranked and not shipped.merges and not hasattr(bpe, "_held")


def test_stages_with_clashing_columns_nulls_and_ties(spark):
    """Names that operators use inside belong to the documents; defined results for gaps."""
    texts = ["alpha beta gamma delta epsilon zeta " * 9] * 3 + ["one two three four five six seven " * 9, None, "", "x" * 70_000, "12 34"]
    names = ["row", "size", "Copies", "__copy", "target", "score", "rejected", "keep_id", "kept", "key", "hash", "content", "sha", "value"]
    docs = documents(spark, texts, lang=["en", None] * 4, source=[None, "s"] * 4)
    docs = docs.union(docs.limit(1)).select("*", *[F.lit(n).alias(n) for n in names])
    left = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SMALL), "pipeline-clash")
        assert docs.columns[5:] == names
        assert all(tuple(r[n] for n in names) == tuple(names) for r in docs.collect())
        left.append(sorted(r["doc_id"] for r in docs.collect()))
    assert left[0] == [0, 0, 1, 2, 3, 6] and left[1] == left[2] == [0, 3, 6]
    encoded = corpus_pipeline.encode(spark, docs, SMALL)
    assert {r["doc_id"] for r in encoded.collect()} <= {0, 3, 6}


def test_encoding_and_decoding_do_not_share_tasks(spark, stages):
    """Workers of both in one task would hold an executor's memory twice."""
    text = corpus_pipeline.encode(spark, stages[4], SMALL)._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") == 1 and "MapInPandas" not in text
