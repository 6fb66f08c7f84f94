"""Every query beside its SQL twin; learned and coded ones by brute force or held-out accuracy."""

import hashlib
import os
import subprocess
import sys
import zlib

import numpy as np
import pytest

from retourlens.llm import pii
from retourlens.llm.oracle import all_sql
from retourlens.llm.queries import all_queries, byte_bpe_50k
from tests.llm.helpers import SMALL, needs_tables, rows, sql_rows
from tests.llm.test_pii import brute

pytestmark = needs_tables


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, name):
    found = all_queries()[name](spark, SMALL)
    assert rows(found) == sql_rows(all_sql()[name], found.columns)


def test_every_twin_has_a_query():
    assert set(all_sql()) <= set(all_queries())


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return {r["doc_id"]: (r["text"], r["lang"]) for r in docs}


def test_bpe_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_bpe_50k())
    for row in all_queries()["op3_bpe"](spark, SMALL).collect():
        text = texts[row["doc_id"]][0] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_language_of_held_out_texts(spark, texts):
    found = all_queries()["op2_language_id"](spark, SMALL).collect()
    assert len(found) == len(texts)
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["lang_pred"] == texts[r["doc_id"]][1] for r in held]) >= 0.9
    assert not any(r["rejected"] for r in found) and all(0 <= r["score"] <= 1 for r in found)


def test_quality_of_held_out_texts(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = all_queries()["op8_quality"](spark, SMALL).collect()
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.85
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in found)


def test_pii_base_columns_against_plain_patterns(spark, texts):
    found = {r["doc_id"]: r for r in all_queries()["op4_pii"](spark, SMALL).collect()}
    assert sorted(found) == sorted(texts)
    for doc_id, (text, _) in texts.items():
        spans = [f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in brute(text or "")]
        row = found[doc_id]
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        for kind in pii.BASE_KINDS:
            assert row[f"n_{kind}"] == sum(s.startswith(f"{kind}:") for s in spans)
        everything = row["spans"].split(",")
        assert [s for s in everything if s.split(":")[0] in pii.BASE_KINDS] == spans


def test_entry_works_without_the_subpackage(tmp_path):
    """As when the driver deletes the folders: nothing else imports them."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('retourlens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op') and n[2].isdigit()]\n"
        "assert 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
