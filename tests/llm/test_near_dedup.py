import numpy as np
import pytest

from retourlens.llm import near_dedup
from tests.llm.helpers import documents, prose, rows
from tests.llm.test_jaccard import brute, edited, items  # noqa: F401


@pytest.mark.parametrize("words, percent, cell", [(4, 80, 500_000), (5, 80, 200), (4, 85, 60)])
def test_classes_against_brute_force(spark, items, words, percent, cell, monkeypatch):  # noqa: F811
    """Small cells meet often; the answer stays."""
    monkeypatch.setattr(near_dedup, "CELL_SHINGLES", cell)
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in items], "doc_id long, text string, value string, digest string")
    found = near_dedup.near_classes(docs.repartition(5), words, percent)
    assert rows(found, "id", "n_shingles", "component_id") == brute(items, words, percent)


def test_family_around_the_threshold(spark, monkeypatch):
    """Versions of one text, some of which link with each other but not with the first: no link is lost."""
    monkeypatch.setattr(near_dedup, "CELL_SHINGLES", 1_000)
    base = prose("family", 150, 5000)
    texts = [edited(base, n, 2 + n % 7) for n in range(120)] + [edited(edited(base, n % 5, 8), 900 + n, 1) for n in range(40)]
    pairs = list(enumerate(texts))
    found = near_dedup.near_classes(documents(spark, texts), 4, 80)
    assert rows(found, "id", "n_shingles", "component_id") == brute(pairs, 4, 80)


def test_a_large_cell_travels_once_for_many_guests(spark, monkeypatch):
    """Every two cells that are to meet do, the larger one's sets once for each group of bounded size; no other two sets are compared."""
    cells = [(1000 * c + i, 10, 0, (c, -1, 0)) for c in range(41) for i in range(1 if c else 50)]
    cells = spark.createDataFrame(cells, "rid long, n long, class long, cell struct<home:long,pool:long,piece:int>")
    cell = lambda c: (c, -1, 0)
    wanted = [(cell(0), cell(c)) for c in range(1, 41)] + [(cell(3), cell(4)), (cell(0), cell(0)), (cell(5), cell(5))]
    pairs = spark.createDataFrame(wanted, "a struct<home:long,pool:long,piece:int>, b struct<home:long,pool:long,piece:int>")
    for most, fewest in ((500_000, 0), (100, 4)):
        monkeypatch.setattr(near_dedup, "CELL_SHINGLES", most)
        placed = near_dedup._meetings(pairs, cells).collect()
        met, held = set(), {}
        for r in placed:
            held.setdefault(r["meeting"], []).append(r)
        for there in held.values():
            asks = [r["rid"] // 1000 for r in there if r["asks"]]
            met |= {tuple(sorted((a, r["rid"] // 1000))) for a in asks for r in there if r["asked"]}
        assert met == {(a[0], b[0]) for a, b in wanted}
        assert len(held) > fewest and len(placed) <= 50 * (len(held) - 2) + 40 + 51 + 1


def test_hashes_agree_as_often_as_sets_do():
    signer, r = near_dedup.Signer(400, 1), np.random.default_rng(3)
    whole = np.unique(r.integers(-(2**63), 2**63 - 1, 3_000))
    same = np.mean([np.mean(signer(np.sort(whole[:2400])) == signer(np.sort(whole[600:]))) for _ in range(1)])
    assert abs(same - 1800 / 3000) < 0.06
    assert (signer(whole) == signer(whole)).all() and len(near_dedup.Signer()(whole[:1])) == 2 * near_dedup.HASHES


def test_empty_table(spark):
    assert near_dedup.near_classes(documents(spark, [])).count() == 0
    assert rows(near_dedup.near_classes(documents(spark, [None, "", " "])), "id", "n_shingles", "component_id") == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]
