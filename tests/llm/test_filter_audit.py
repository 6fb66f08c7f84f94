import random
import re
from itertools import permutations

import pytest

from retourlens.llm import filter_audit
from tests.llm.helpers import DOCS, documents, prose, rows


def brute_masks(items):
    """(id, part, mask) of each (id, text, part)."""
    out = []
    first = {}
    for i, text, _ in items:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, part in items:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        mask = (
            (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
            + 4 * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))
        )
        smaller = first.get(text)
        mask += 16 * (smaller is not None and (i is None or smaller < i))
        out.append((i, part or "", mask))
    return sorted(out, key=repr)


def brute_audit(marked):
    """``audit`` of (part, mask, good, toxic) rows."""
    out = []
    for part in {p for p, *_ in marked}:
        own = [m for m in marked if m[0] == part]
        removals = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            before = 0
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                here = [m for m in own if not m[1] & before and m[1] & bit]
                found.append([
                    part, "".join(order), step, sum(not m[1] & (before | bit) for m in own), len(here),
                    sum(bool(m[1] & before and m[1] & bit) for m in own), sum(m[1] == bit for m in own),
                    sum(m[2] for m in here), sum(m[3] for m in here), name,
                ])
                removals[name] += len(here)
                before |= bit
        out += [(*f[:-1], removals[f[-1]]) for f in found]
    return sorted(out, key=repr)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.fixture(scope="module")
def items():
    r = random.Random(4)
    long = prose(5, 30_000, 9000)
    texts = [prose(i % 40, r.choice([30, 199, 200, 400]), 5000) for i in range(160)]
    texts += ["A" + prose(1, 300), "A" * 5 + "b" * 95, "A" * 3 + "b" * 97, "x # y", None, "", "", " ", "é中" * 5, "é中" * 5 + "é"]
    texts += [long, long, long + " end", long[:-1], "same text " * 5] + ["same text " * 5] * 60
    texts += [f"shared beginning {'of many texts ' * 30}{i}" for i in range(40)]
    found = [(i, t, r.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    return found + [(None, "", "en"), (None, "lonely", "en"), (None, "lonely", "de"), (7, "twice", "de"), (7, "twice", "de"), (-3, texts[0], "fr")]


@pytest.mark.parametrize("trie_bytes, prefix_bytes", [(1, 60), (3_000, 900), (filter_audit.TRIE_BYTES, None)])
def test_masks_against_brute_force(spark, items, trie_bytes, prefix_bytes):
    """Small tries forget early, small prefixes grow long; the answer stays."""
    docs = spark.createDataFrame([(i, t, p, "x", 1) for i, t, p in items], "doc_id long, text string, lang string, mask string, record int")
    found = filter_audit.masks(docs.repartition(5), trie_bytes=trie_bytes, prefix_bytes=prefix_bytes, range_bytes=prefix_bytes or filter_audit.RANGE_BYTES)
    assert rows(found, "id", "part", "mask") == brute_masks(items)


def test_audit_against_brute_force(spark, items):
    docs = spark.createDataFrame([(i, t, p, "s", 0) for i, t, p in items], DOCS)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 200, 2)] + [(0, 1, 1), (4, None, None), (10**6, 1, 1), (None, 1, 1)]
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    marked = [(p, m, i is not None and i in good, i is not None and i in toxic) for i, p, m in brute_masks(items)]
    found = filter_audit.audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(found.columns) == sorted(COLUMNS)
    assert rows(found, *COLUMNS) == brute_audit(marked)


def test_long_prefixes_stay_split(spark):
    """Texts with one long beginning get prefixes beyond it; a text that is alone keeps the short one."""
    texts = [("z" * 300) + str(i) for i in range(50)] + ["other words"] + ["copy of a text"] * 40
    docs = documents(spark, texts)
    rows_ = docs.selectExpr("doc_id as record", "text", "substring(text, 1, 64) as head", "octet_length(text) as bytes", "length(text) as chars")
    found = {r["record"]: r for r in filter_audit.with_prefixes(rows_, 400).collect()}
    assert len(found) == len(texts)
    assert all(r["text"].startswith(r["prefix"]) for r in found.values())
    assert len({found[i]["prefix"] for i in range(50)}) == 50 and found[50]["prefix"] == "othe"
    assert all(found[i]["hot"] and found[i]["prefix"] == texts[i] for i in range(51, 91)) and not any(found[i]["hot"] for i in range(51))


def test_a_round_joins_heavy_prefixes_once(spark, monkeypatch):
    """Each round looks for the heavy prefixes of the last one only, not again for those of all before."""
    plans, own = [], filter_audit.settle
    monkeypatch.setattr(filter_audit, "settle", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or own(df, name))
    docs = documents(spark, [("z" * 600) + str(i) for i in range(50)] + ["z" * n for n in (4, 16, 64, 300)] * 3 + ["zebra"])
    rows_ = docs.selectExpr("doc_id as record", "text", "substring(text, 1, 64) as head", "octet_length(text) as bytes", "length(text) as chars")
    found = filter_audit.with_prefixes(rows_, 400).collect()
    assert [p.count("LeftSemi") for p in plans] == [0] + [1] * (len(plans) - 1) and len(plans) > 5
    assert len(found) == 63 and all(r["text"].startswith(r["prefix"]) for r in found)
    assert {len(r["text"]) for r in found if r["hot"]} == {300, 601, 602} and all(r["prefix"] == r["text"] for r in found if r["hot"])


def test_trie():
    r = random.Random(8)
    keys = [bytes(r.choices(b"ab", k=r.randrange(0, 40))) for _ in range(800)] + [b"ab" * 5_000, b"ab" * 5_000 + b"c", b""]
    trie = filter_audit.Trie()
    for k in keys:
        node = trie.terminal(k)
        node[2] = (node[2] or 0) + 1
    assert list(trie.items()) == sorted((k, keys.count(k)) for k in set(keys))
    assert sorted(trie.values()) == sorted(keys.count(k) for k in set(keys))


def test_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = filter_audit.audit_filters(documents(spark, []), labels)
    assert found.count() == 0 and sorted(found.columns) == sorted(COLUMNS)
