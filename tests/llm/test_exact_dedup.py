import hashlib
import re

import pytest
from pyspark.sql import functions as F

from retourlens.llm import exact_dedup
from tests.llm.helpers import documents, exchanges, prose, rows


def brute(items):
    """(id, keep, size, kept, sha) of each (id, text)."""
    groups = {}
    normal = [(i, re.sub("[ \t-\r]+", " ", t or "")) for i, t in items]
    for i, text in normal:
        groups.setdefault(text, []).append(i)
    out = []
    for i, text in normal:
        keep = min((x for x in groups[text] if x is not None), default=None)
        out.append((i, keep, len(groups[text]), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items():
    base = [prose(i, 40) for i in range(60)]
    texts = [base[i % 60] for i in range(150)] + [base[0]] * 100 + [base[1].replace(" ", " \t\n"), None, "", " ", " ", "  "]
    return list(enumerate(texts)) + [(None, "lonely"), (None, "lonely"), (3, "twice"), (3, "twice"), (9000, "x" * 300_000)]


@pytest.mark.parametrize("bucket_bytes", [200, 5_000, exact_dedup.BUCKET_BYTES])
def test_against_brute_force(spark, items, bucket_bytes):
    """Small buckets spill again and again; the answer stays."""
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in items], "doc_id long, text string, kept string, content string")
    found = exact_dedup.mark_copies(docs.repartition(7), bucket_bytes=bucket_bytes)
    assert found.columns == ["doc_id", "text", "content", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(items)


def test_one_row_of_each_group_stays(spark, items):
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in items], "doc_id long, text string, kept string, sha string")
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    want = {(keep, sha) for _, keep, _, _, sha in brute(items)}
    got = kept.select("doc_id", F.sha2(exact_dedup.normalised("text"), 256)).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_rows_move_once(spark, items):
    """One shuffle of the rows, one of the ids that stay."""
    docs = spark.createDataFrame(items, "doc_id long, text string")
    assert exchanges(spark, lambda: exact_dedup.deduplicate(docs)) == 2


def test_table_compares_contents_not_hashes():
    table = exact_dedup.ContentTable(slots=2)
    for n in range(50):
        table.add(7, b"%d" % (n % 5), n, 1)
    assert [(e[1], e[2], e[3]) for e in table.entries] == [(b"%d" % n, n, 10) for n in range(5)]


def test_empty_table(spark):
    assert exact_dedup.mark_copies(documents(spark, [])).count() == 0
    assert exact_dedup.deduplicate(documents(spark, [])).count() == 0
