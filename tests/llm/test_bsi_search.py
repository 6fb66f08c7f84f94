import numpy as np
import pytest

from retourlens.llm import bsi_search
from tests.llm.helpers import rows

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(vectors, queries, k):
    out = []
    for qid, q in queries:
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors if i != qid)[:k]
        out += [(qid, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


def test_slices_give_back_values():
    rng = np.random.default_rng(1)
    values = rng.integers(-300, 300, (130, 5))
    lows, slices, _ = bsi_search.make_slices(values)
    assert (bsi_search.values_of(lows, slices, np.arange(130)) == values).all()


@pytest.mark.parametrize("low", [0, 2, 9])
@pytest.mark.parametrize("size, dims, limit", [(1, 1, 2), (70, 4, 300), (900, 16, 40), (64, 8, 1)])
def test_block_against_brute_force(size, dims, limit, low):
    rng = np.random.default_rng(size)
    values, ids = rng.integers(-limit, limit + 1, (size, dims)), rng.permutation(size)
    lows, slices, _ = bsi_search.make_slices(values)
    for n in range(8):
        query = rng.integers(-limit, limit + 1, dims) * (n > 0)
        found, scores = bsi_search.top_rows(ids, lows, slices, ~slices, query, ids[n % size], 5, low)
        best = sorted((-int(v @ query), int(i)) for i, v in zip(ids, values) if i != ids[n % size])[:5]
        assert [(-s, i) for i, s in zip(found.tolist(), scores.tolist())] == best


def test_search_over_several_blocks(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.integers(-64, 64, 6) / 256], "x") for i in range(300)]
    data += [(1000, data[3][1], "tie"), (1001, data[3][1], "tie"), (1001, data[3][1], "repeated")]
    table = spark.createDataFrame(data, SCHEMA)
    queries = table.where("vec_id % 50 = 0")
    found = bsi_search.search(table, queries, k=5, block_rows=64, block_queries=3)
    numbers = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in data]
    assert rows(found) == brute(numbers, [n for n in numbers if n[0] % 50 == 0], 5)


def test_unsound_vectors_take_no_part(spark):
    data = [
        (0, [1.0, 0.5], ""), (50, None, ""), (1, [1.0, None], ""), (2, [float("nan"), 1.0], ""),
        (3, [float("inf"), 1.0], ""), (None, [1.0, 1.0], ""), (4, [0.5], ""), (5, [], ""), (6, [1e30, 1.0], ""),
    ]
    table = spark.createDataFrame(data, SCHEMA)
    found = bsi_search.search(table, table.where("vec_id % 50 = 0"))
    assert rows(found) == [(0, 1, 4, 256 * 128), (0, 2, 5, 0)]


def test_large_components_take_part(spark):
    """Components of 2**24 and more after scaling, next to ordinary ones."""
    rng = np.random.default_rng(7)
    data = [(i, [float(x) for x in rng.integers(-64, 64, 4) / 256], "") for i in range(60)]
    data += [(100 + i, [float(x) for x in rng.integers(-64, 64, 4) * 2.0 ** (10 + i % 14)], "") for i in range(30)]
    data += [(200, [70_000.0, 0.5, 0.0, 0.0], ""), (250, [-70_000.0, 3.0, 1.0, 0.0], "")]
    table = spark.createDataFrame(data, SCHEMA)
    numbers = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in data]
    found = bsi_search.search(table, table.where("vec_id in (0, 50, 200, 250)"), k=5, block_rows=16, block_queries=2)
    queries = [n for n in numbers if n[0] in (0, 50, 200, 250)]
    assert rows(found) == brute(numbers, queries, 5)


def test_block_of_wide_rows_and_scores_beyond_64_bits():
    values = np.array([[(1 << 62) + 3, -(1 << 62)], [-(1 << 63) + 1, 1 << 62], [5, 7]])
    lows, slices, _ = bsi_search.make_slices(values)
    assert (bsi_search.values_of(lows, slices, np.arange(3)) == values).all()
    ids = np.array([4, 9, 2])
    found, scores = bsi_search.top_rows(ids, lows, slices, ~slices, np.array([1, 1]), -1, 3, 2)
    assert list(zip(found.tolist(), scores.tolist())) == [(2, 12), (4, 3), (9, -(1 << 62) + 1)]
    with pytest.raises(OverflowError):
        bsi_search.top_rows(ids, lows, slices, ~slices, np.array([4, 0]), -1, 1, 2)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(0, [1.0], "")], SCHEMA)
    assert rows(bsi_search.search(empty, empty)) == []
    assert rows(bsi_search.search(some, some)) == []
    assert rows(bsi_search.search(some, empty)) == []


def many_blocks(spark):
    rng = np.random.default_rng(9)
    data = [(i, [float(x) for x in rng.integers(-64, 64, 6) / 256], "x") for i in range(400)]
    numbers = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in data]
    return spark.createDataFrame(data, SCHEMA), brute(numbers, [n for n in numbers if n[0] % 10 == 0], 5)


def test_queries_are_broadcast_once_not_once_a_block(spark):
    """The driver collects what is broadcast, which must not grow with the index."""
    table, best = many_blocks(spark)
    found = bsi_search.search(table, table.where("vec_id % 10 = 0"), block_rows=16, block_queries=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan and "Generate" not in plan
    assert rows(found) == best


@pytest.mark.parametrize("cell", [200, 1 << 20])
def test_more_queries_meet_the_index_on_a_grid(spark, monkeypatch, cell):
    monkeypatch.setattr(bsi_search, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(bsi_search, "CELL_BYTES", cell)
    table, best = many_blocks(spark)
    found = bsi_search.search(table, table.where("vec_id % 10 = 0"), block_rows=16, block_queries=4)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == best
