import random

import pytest

from retourlens.llm import jaccard
from retourlens.llm.graph import connected_components
from tests.llm.helpers import documents, exchanges, prose, rows


def sets_of(text, words):
    parts = (text or "").encode().lower().split()
    if len(parts) < words:
        return {tuple(parts)} if parts else set()
    return {tuple(parts[i : i + words]) for i in range(len(parts) - words + 1)}


def brute(items, words, percent):
    """(id, set size, smallest id of the class) of (id, text)."""
    sets = [(i, sets_of(t, words)) for i, t in items]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b in range(a):
            o = sets[b][1]
            if s and 100 * len(s & o) >= percent * len(s | o):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        least.setdefault(find(a), []).append(i)
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted([(i, len(s), smallest[find(a)]) for a, (i, s) in enumerate(sets)], key=repr)


def edited(text, seed, changes):
    r, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def items():
    passage = prose("passage", 60)
    texts = [prose(i, 20 + i % 90) + (" " + passage if i % 3 == 0 else "") for i in range(60)]
    texts += [edited(texts[1], n, n % 4) for n in range(70)]
    texts += [edited(prose("long", 300), n, n % 9) for n in range(60)]
    # A chain in which only neighbours are similar, in sentences of one order.
    pool = prose("chain", 400).split()
    texts += [" ".join(pool[3 * n : 3 * n + 80]) for n in range(40)]
    texts += [None, "", " \t", "one", "One", "one two", "a b c", "a  b\nc", texts[0], texts[0].upper(), "x" * 50_000]
    return list(enumerate(texts)) + [(5, texts[5]), (None, texts[7]), (None, "nobody else says this at all")]


@pytest.mark.parametrize("words, percent, frequent", [(4, 85, 100_000), (5, 80, 100_000), (5, 80, 0), (2, 60, 20)])
def test_classes_against_brute_force(spark, items, words, percent, frequent, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET_ROWS", 16)
    monkeypatch.setattr(jaccard, "PART_MEMBERS", 4)
    monkeypatch.setattr(jaccard, "PART_QUERIES", 3)
    monkeypatch.setattr(jaccard, "LEAST_COUNT", 2)
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in items], "doc_id long, text string, value string, digest string")
    found = jaccard.link_classes(docs, words, percent, frequent=frequent)
    assert rows(found, "id", "n_shingles", "component_id") == brute(items, words, percent)


def test_part_whose_bound_is_least_below_its_largest_size(spark):
    """A links to B of 93 shingles; C of 94 in one group with B alone would ask for one more of them."""
    pool = sorted((f"w{n}" for n in range(94)), key=lambda w: jaccard.shingles(w, 1)[0])
    rare, common, tail = pool[:5], pool[5:], [f"boilerplate{n}" for n in range(11)]
    texts = [common + rare[:4], common + rare, common + tail]
    texts += [tail + [f"other{n}x{m}" for m in range(60)] for n in range(20)]
    items = [(i, " ".join(words)) for i, words in enumerate(texts)]
    found = jaccard.link_classes(documents(spark, [t for _, t in items]), words=1, percent=85)
    got = rows(found, "id", "n_shingles", "component_id")
    assert got == brute(items, 1, 85)
    assert (2, 100, 0) in got


@pytest.mark.parametrize("percent", [20, 35, 60, 80, 85, 100])
def test_least_shared_prefix_over_sizes(spark, percent):
    overlap = lambda n, m: -(-percent * (n + m) // (100 + percent))
    own = lambda m: -(-percent * m // 100)
    ranges = [(n, low, high) for n in range(1, 90, 4) for low in range(own(n), n + 1, 3) for high in range(low, 100 * n // percent + 1, 2)]
    table = spark.createDataFrame(ranges, "n long, low long, high long")
    n, low, high = (table[c] for c in table.columns)
    for row in table.withColumn("need", jaccard._least_as_member(n, low, high, percent)).collect():
        least = min(overlap(row["n"], m) - own(m) + 1 for m in range(row["low"], row["high"] + 1))
        assert row["need"] == least if percent > 30 else least - 1 <= row["need"] <= least


def test_one_of_each_class_stays(spark, items):
    docs = spark.createDataFrame([(i, t, "a") for i, t in items], "doc_id long, text string, row string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    classes = brute(items, 5, 80)
    want = sorted([smallest for i, n, smallest in classes if n and (smallest is None or i == smallest)], key=repr)
    empty = [i for i, n, _ in classes if not n]
    # The fixture's row 5 is there twice, one of the two stays.
    assert sorted([r["doc_id"] for r in kept.collect()], key=repr) == sorted({*want, *empty}, key=repr)


def test_rows_move_once(spark):
    docs = documents(spark, ["one two three four five six"] * 3)
    assert exchanges(spark, lambda: jaccard.keep_one(docs)) == 2


def test_components(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(99, i) for i in range(100, 140)] + [(7, 7), (3, 1), (1, 3)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    want = [(i, 10) for i in range(10, 41)] + [(i, 99) for i in range(99, 140)] + [(1, 1), (3, 1)]
    assert rows(found) == sorted(want, key=repr)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    assert jaccard.link_classes(documents(spark, [])).count() == 0
    assert jaccard.keep_one(documents(spark, [None, ""])).count() == 2
