"""Exact top-k search by inner product on a bit-sliced index.

A block of rows keeps one bitmap per dimension and bit of its quantised
components, a row a bit. For a query, the slices are added with bitmap
arithmetic: each bit of a query component shifts the component's slices, a tree
of carry-save adders sums them, and complements stand for negative factors. The
sums are bitmaps too, so the k largest are found from the most significant
slice downward. The lowest slices are left out of the sums; rows that this
leaves undecided, and ties, are resolved by their exact scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retourlens.session import settle

#: Rows of a block and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 256
#: Slices left out of bitmap sums.
LOW_SLICES = 2
#: Vectors with a component of this size or more are kept in blocks of their own, of fewer rows.
WIDE, WIDE_SHARE = 1 << 24, 4
#: Components of this size or more are no 64-bit numbers; such vectors take no part.
TOO_LARGE = 1 << 63
#: Query bytes that every task may hold; with more, cells of a grid hold about ``CELL_BYTES`` of the index and of queries.
BROADCAST_BYTES, CELL_BYTES = 16 << 20, 8 << 20
INDEX = "block string, rows int, dims int, bits int, ids binary, lows binary, slices binary"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null where one is null, not finite or beyond 64 bits."""
    values = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(F.lit(scale) * x.cast("double")) < float(TOO_LARGE), F.lit(False)))
    return F.when(sound, values)


def make_slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(lows, slices, bits) of integer rows: bit b of ``row - lows`` in slices[:, b]."""
    rows, dims = values.shape
    lows = values.min(0)
    # Differences of 64-bit numbers fit unsigned ones.
    raised = values.astype(np.uint64) - lows.astype(np.uint64)
    bits = max(1, int(raised.max()).bit_length())
    padded = np.zeros((dims, -(-rows // 64) * 64), np.uint64)
    padded[:, :rows] = raised.T
    planes = [np.packbits((padded >> np.uint64(b)) & np.uint64(1) > 0, axis=1, bitorder="little") for b in range(bits)]
    return lows, np.stack(planes, 1).view("<u8"), bits


def values_of(lows: np.ndarray, slices: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer components of some rows, from their bits."""
    words = slices[:, :, rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)
    weights = (np.uint64(1) << np.arange(slices.shape[1], dtype=np.uint64))[:, None]
    return (words * weights).sum(1).astype(np.int64).T + lows


def add_slices(columns: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """Sum bitmaps by weight: columns[w] holds stacks of bitmaps worth 2**w each."""
    sums: dict[int, np.ndarray] = {}
    while columns:
        weight = min(columns)
        stack = np.concatenate(columns.pop(weight))
        carries = []
        while len(stack) > 1:
            third = len(stack) // 3
            if third:
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                half = a ^ b
                carries.append(a & b | half & c)
                stack = np.concatenate((half ^ c, stack[3 * third :]))
            else:
                carries.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
        sums[weight] = stack[0]
        if carries:
            columns.setdefault(weight + 1, []).extend(carries)
    return sums


def query_sums(slices: np.ndarray, flipped: np.ndarray, query: np.ndarray, low: int) -> dict[int, np.ndarray]:
    """Bit-sliced sums of |q| times a component (or of its complement, if q < 0), without the lowest slices."""
    chosen = np.where((query < 0)[:, None, None], flipped[:, low:], slices[:, low:])
    size, columns = np.abs(query), {}
    for shift in range(int(size.max()).bit_length()):
        factors = chosen[(size >> shift) & 1 > 0]
        if len(factors):
            for b in range(factors.shape[1]):
                columns.setdefault(shift + low + b, []).append(factors[:, b])
    return add_slices(columns)


def ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def at_least_kth(sums: dict[int, np.ndarray], allowed: np.ndarray, k: int) -> int:
    """The k-th largest sum among allowed rows, found from the top slice down."""
    value, left, open_rows = 0, k, allowed
    for weight in sorted(sums, reverse=True):
        with_bit = open_rows & sums[weight]
        count = ones(with_bit)
        if count >= left:
            value, open_rows = value + (1 << weight), with_bit
        else:
            left, open_rows = left - count, open_rows & ~sums[weight]
    return value


def not_below(sums: dict[int, np.ndarray], allowed: np.ndarray, bound: int) -> np.ndarray:
    """Bitmap of allowed rows whose sum is at least ``bound``."""
    if bound <= 0:
        return allowed
    top = max(max(sums, default=0) + 1, bound.bit_length())
    above, equal = np.zeros_like(allowed), allowed
    for weight in range(top, -1, -1):
        bitmap = sums.get(weight)
        if bound >> weight & 1:
            equal = equal & bitmap if bitmap is not None else np.zeros_like(equal)
        elif bitmap is not None:
            above |= equal & bitmap
            equal = equal & ~bitmap
    return above | equal


def top_rows(
    ids: np.ndarray, lows: np.ndarray, slices: np.ndarray, flipped: np.ndarray, query: np.ndarray, own: int, k: int,
    low: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of a block's k best rows for a query, ties to smaller ids."""
    allowed = np.zeros(slices.shape[2] * 64, bool)
    allowed[: len(ids)] = ids != own
    allowed = np.packbits(allowed, bitorder="little").view("<u8")
    total = ones(allowed)
    if not total:
        return ids[:0], ids[:0]
    low = min(low, slices.shape[1] - 1)
    sums = query_sums(slices, flipped, query, low) if query.any() else {}
    kth = at_least_kth(sums, allowed, min(k, total))
    # The slices left out add between 0 and this much to a sum.
    spread = ((1 << low) - 1) * sum(np.abs(query).tolist())
    near = not_below(sums, allowed, kth - spread)
    rows = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
    values = values_of(lows, slices, rows)
    largest = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    if largest * sum(np.abs(query).tolist()) < 1 << 63:
        scores = values @ query
        best = np.lexsort((ids[rows], -scores))[:k]
        return ids[rows][best], scores[best]
    exact = [sum(map(int.__mul__, v, query.tolist())) for v in values.tolist()]
    best = sorted(range(len(rows)), key=lambda at: (-exact[at], ids[rows[at]]))[:k]
    if any(not -(1 << 63) <= exact[at] < 1 << 63 for at in best):
        raise OverflowError("a score does not fit 64 bits")
    return ids[rows][best], np.array([exact[at] for at in best], np.int64)


def build_index(vectors: DataFrame, id_column: str, vector: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of bit slices of (id, quantised vector) rows, made where the rows lie, without a shuffle.

    Vectors shorter than others of their block count as ending in zeros.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Ordinary rows and wide ones, whose many slices would be made for all rows of a block.
        held: dict[bool, list[tuple[int, list[int]]]] = {False: [], True: []}
        most = {False: block_rows, True: max(1, block_rows // WIDE_SHARE)}
        for batch in batches:
            for row in zip(batch["id"].tolist(), batch["v"]):
                held[len(row[1]) > 0 and max(max(row[1]), -min(row[1])) >= WIDE].append(row)
            for wide, part in held.items():
                while len(part) >= most[wide]:
                    yield block(part[: most[wide]])
                    part = held[wide] = part[most[wide] :]
        for part in held.values():
            if part:
                yield block(part)

    def block(part: list[tuple[int, list[int]]]) -> pd.DataFrame:
        dims = max(1, max(len(v) for _, v in part))
        values = np.zeros((len(part), dims), np.int64)
        for i, (_, v) in enumerate(part):
            values[i, : len(v)] = v
        ids = np.array([i for i, _ in part], "<i8")
        lows, slices, bits = make_slices(values)
        name = f"{ids[0]}.{ids[-1]}.{len(ids)}"
        packed = [x.astype(t, copy=False).tobytes() for x, t in ((ids, "<i8"), (lows, "<i8"), (slices, "<u8"))]
        return pd.DataFrame([[name, len(ids), dims, bits, *packed]], columns=[c.split()[0] for c in INDEX.split(", ")])

    return rows.mapInPandas(pack, INDEX)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
    scale: float = 256.0, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES, low_slices: int = LOW_SLICES,
) -> DataFrame:
    """The k rows of ``vectors`` with the highest inner product, for every row of ``queries``.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id, a
    query's own id is no candidate, fewer candidates give fewer rows. Rows with
    a null id or a vector that is null, holds a null or non-finite component, or
    one that after scaling is no 64-bit number, take no part; empty vectors score
    0 with all. One of the k best of a block whose score is no 64-bit number
    fails the search. Repeated rows are each a candidate, repeated queries are answered once;
    other columns are ignored.

    Blocks of the index meet blocks of queries where they lie if the queries are
    few, else on a grid; a pair returns k rows a query.
    """
    index = settle(build_index(_numbers(vectors, id_column, vector, scale), "id", "v", block_rows), "bsi-index")
    asked = _numbers(queries, id_column, vector, scale).withColumn("h", F.xxhash64("v")).dropDuplicates(["id", "h"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), block_queries):
                part = batch[start : start + block_queries]
                values = [np.array(v, "<i8").tobytes() for v in part["v"]]
                columns = {"q_ids": [part["id"].tolist()], "q_hashes": [part["h"].tolist()], "q_values": [values]}
                yield pd.DataFrame({"q_block": [f"{part['id'].iloc[0]}.{part['h'].iloc[0]}"], **columns})

    schema = "q_block string, q_ids array<bigint>, q_hashes array<bigint>, q_values array<binary>"
    blocks = settle(asked.mapInPandas(gather, schema), "bsi-queries")
    pairs = _paired(index, blocks).select("dims", "bits", "ids", "lows", "slices", "q_ids", "q_hashes", "q_values")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _answer(batch.slice(at, 1).to_pylist()[0], k, low_slices)

    found = pairs.mapInArrow(answer, "query_id long, query_hash long, vec_id long, score long")
    best = W.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _paired(index: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every index block beside every query block.

    Few queries go to all tasks, once each. More of them and the index are dealt to the columns
    and rows of a grid, so each travels once a row or column; never is a copy broadcast.
    """
    asked = blocks.agg(F.sum(F.aggregate("q_values", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + 16))).first()[0] or 0
    if asked <= BROADCAST_BYTES:
        return index.crossJoin(F.broadcast(blocks))
    held = index.agg(F.sum(F.octet_length("slices").cast("long"))).first()[0] or 0
    height, width = -(-held // CELL_BYTES) or 1, -(-asked // CELL_BYTES)
    left = index.withColumn("i", F.pmod(F.xxhash64("block"), F.lit(height)))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))))
    right = blocks.withColumn("j", F.pmod(F.xxhash64("q_block"), F.lit(width)))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(height - 1).cast("long"))))
    return left.hint("merge").join(right, ["i", "j"])


def _numbers(df: DataFrame, id_column: str, vector: str, scale: float) -> DataFrame:
    rows = df.select(F.col(id_column).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"))
    return rows.where("id is not null and v is not null")


def _answer(pair: dict, k: int, low: int) -> pa.RecordBatch:
    """The k best rows of one index block for each query of one query block."""
    ids, lows = np.frombuffer(pair["ids"], "<i8"), np.frombuffer(pair["lows"], "<i8")
    slices = np.frombuffer(pair["slices"], "<u8").reshape(pair["dims"], pair["bits"], -1)
    flipped, out = ~slices, ([], [], [], [])
    for query_id, query_hash, packed in zip(pair["q_ids"], pair["q_hashes"], pair["q_values"]):
        query, given = np.zeros(pair["dims"], np.int64), np.frombuffer(packed, "<i8")
        shared = min(len(query), len(given))
        query[:shared] = given[:shared]
        rows, scores = top_rows(ids, lows, slices, flipped, query, query_id, k, low)
        for column, values in zip(out, ([query_id] * len(rows), [query_hash] * len(rows), rows.tolist(), scores.tolist())):
            column += values
    names = ["query_id", "query_hash", "vec_id", "score"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
