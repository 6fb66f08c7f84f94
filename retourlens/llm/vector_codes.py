"""Product-quantised vector codes, fitted on anchors-hierarchy metric trees.

Vectors become integers and are cut into equal parts. Every block of vectors
keeps one metric tree a part, built middle-out: about as many anchors as the
square root of the points each own the points nearest to them, anchors are
merged upward into balls and split downward by anchors of their own. A ball
caches the sum and count of its points. A round of fitting sends the codebooks
to the blocks: a ball inherits its parent's list of candidate entries and drops
those that lose to another one all over the ball; a ball with one candidate left
adds its cached sum, leaves compare their points exactly. Only sums by entry
leave a task. All arithmetic that decides is on integers, so results are exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096.0
#: Vectors and components of a block, and points up to which a ball is not split.
BLOCK_ROWS, BLOCK_VALUES, LEAF = 4096, 1 << 20, 24
#: Larger than any squared distance.
FAR = 1 << 62


@dataclass
class Tree:
    """Balls in arrays, the root first; the points of a ball lie next to each other in ``order``."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    sums: np.ndarray


def _anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner of each point, and pivots and radii of about square-root-many anchors.

    A new anchor is the point furthest from its owner. It takes the points that
    are nearer to it; those nearer to their owner than half the way between both
    anchors can't be, and are not looked at.
    """
    owner = np.zeros(len(points), np.int64)
    pivots = [points[0]]
    away = np.sqrt(((points - points[0]) ** 2).sum(1))
    for number in range(1, int(np.ceil(np.sqrt(len(points))))):
        new = int(away.argmax())
        if not away[new]:
            break
        half = np.sqrt(((np.stack(pivots) - points[new]) ** 2).sum(1)) / 2
        near = np.flatnonzero(away >= half[owner])
        distance = np.sqrt(((points[near] - points[new]) ** 2).sum(1))
        taken = distance < away[near]
        owner[near[taken]], away[near[taken]] = number, distance[taken]
        pivots.append(points[new])
    radii = np.zeros(len(pivots))
    np.maximum.at(radii, owner, away)
    return owner, np.stack(pivots), radii


def _split(points: np.ndarray, own: np.ndarray, leaf: int):
    """A leaf's point numbers, or a pair of subtrees."""
    if len(own) <= leaf:
        return own
    owner, pivots, radii = _anchors(points[own])
    if len(pivots) == 1:
        return own
    balls = [_split(points, own[owner == a], leaf) for a in range(len(pivots))]
    # Upward: merge the two balls whose common ball is the smallest.
    gaps = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(2))
    size = np.bincount(owner, minlength=len(pivots)).astype(float)
    merged = (gaps + radii[:, None] + radii[None]) / 2
    np.fill_diagonal(merged, np.inf)
    for _ in range(len(balls) - 1):
        a, b = np.unravel_index(merged.argmin(), merged.shape)
        balls[a], balls[b] = (balls[a], balls[b]), None
        radii[a] = merged[a, b]
        pivots[a] = (size[a] * pivots[a] + size[b] * pivots[b]) / (size[a] + size[b])
        size[a] += size[b]
        gone = np.isinf(merged[a]) & (np.arange(len(balls)) != b)
        merged[a] = (np.sqrt(((pivots - pivots[a]) ** 2).sum(1)) + radii + radii[a]) / 2
        merged[a, gone] = merged[a, a] = merged[a, b] = np.inf
        merged[:, a] = merged[a]
        merged[b] = merged[:, b] = np.inf
        root = a
    return balls[root]


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The metric tree of integer points; of wide (object) integers, one ball that is never tested."""
    wide = points.dtype == object
    everything = np.arange(len(points))
    shape = everything if wide else _split(points.astype(float), everything, leaf)
    order, rows, stack = [], [], [(shape, -1, 0)]
    placed = 0
    while stack:
        ball, parent, side = stack.pop()
        number = len(rows)
        rows.append([placed, placed, -1, -1])
        if parent >= 0:
            rows[parent][2 + side] = number
        if isinstance(ball, tuple):
            stack += [(ball[1], number, 1), (ball[0], number, 0)]
        else:
            order.append(ball)
            placed += len(ball)
            rows[number][1] = placed
    # Depth first: a ball ends where its right subtree does.
    for row in reversed(rows):
        if row[3] >= 0:
            row[1] = rows[row[3]][1]
    first, last, left, right = (np.array(c, np.int64) for c in zip(*rows))
    order = np.concatenate(order)
    if wide:
        return Tree(order, first, last, left, right, points[:1], np.full(1, np.inf), points.sum(0)[None])
    placed_points = points[order].astype(np.int64)
    upto = np.concatenate((np.zeros((1, points.shape[1]), np.int64), placed_points.cumsum(0)))
    sums = upto[last] - upto[first]
    centres = sums // (last - first)[:, None]
    radii = np.array([np.sqrt(((placed_points[a:b] - c) ** 2).sum(1).max()) for a, b, c in zip(first, last, centres)])
    return Tree(order, first, last, left, right, centres, radii * (1 + 1e-9), sums)


def nearest(points: np.ndarray, entries: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest allowed entry of each point, the first of several, and its squared distance."""
    squares = ((points[:, None] - entries[None]) ** 2).sum(2)
    squares = np.where(allowed, squares, 1 << 4096 if points.dtype == object else FAR)
    best = squares.argmin(1)
    return best, squares[np.arange(len(points)), best]


def _add(sums: np.ndarray, counts: np.ndarray, entry: np.ndarray, values: np.ndarray, n: np.ndarray) -> None:
    """Add values and how many points they stand for to their entries."""
    for e in range(len(sums)):
        own = entry == e
        sums[e] += values[own].sum(0)
        counts[e] += n[own].sum()


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray, owners: np.ndarray | None = None):
    """Sums and counts of the points of each entry; ``owners``, if given, receives every point's entry."""
    k = len(entries)
    sums, counts = np.zeros(entries.shape, entries.dtype), np.zeros(k, np.int64)
    # An entry equal to an earlier one never wins.
    firsts = {tuple(e): -i for i, e in reversed(list(enumerate(entries.tolist())))}
    distinct = np.zeros(k, bool)
    distinct[[-i for i in firsts.values()]] = True
    balls, candidates = np.zeros(1, np.int64), distinct[None]
    apart = 2 * np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2).astype(float))
    while len(balls):
        if points.dtype != object:
            squares = ((tree.centres[balls][:, None] - entries[None]) ** 2).sum(2)
            best = np.where(candidates, squares, FAR).argmin(1)
            gap = (squares - squares[np.arange(len(balls)), best][:, None]).astype(float)
            # |x - e|^2 - |x - best|^2 is linear in x: beyond this gap at the centre it is positive in the whole ball.
            candidates = candidates & ~(gap > tree.radii[balls][:, None] * apart[best] * (1 + 1e-9) + 1)
            owned = candidates.sum(1) == 1
            whole, winner = balls[owned], best[owned]
            _add(sums, counts, winner, tree.sums[whole], tree.last[whole] - tree.first[whole])
            if owners is not None:
                for ball, entry in zip(whole, winner):
                    owners[tree.order[tree.first[ball] : tree.last[ball]]] = entry
            balls, candidates = balls[~owned], candidates[~owned]
        leaves = tree.left[balls] < 0
        sizes = (tree.last - tree.first)[balls[leaves]]
        if sizes.sum():
            starts = np.repeat(tree.first[balls[leaves]] - np.concatenate(([0], sizes.cumsum()[:-1])), sizes)
            own = tree.order[starts + np.arange(sizes.sum())]
            best, _ = nearest(points[own], entries, np.repeat(candidates[leaves], sizes, 0))
            _add(sums, counts, best, points[own], np.ones(len(own), np.int64))
            if owners is not None:
                owners[own] = best
        balls, candidates = balls[~leaves], candidates[~leaves]
        balls, candidates = np.concatenate((tree.left[balls], tree.right[balls])), np.concatenate((candidates, candidates))
    return sums, counts


def sound(vector: str) -> Column:
    """Whether a vector is neither null nor holds a null or non-finite component."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.col(vector).isNotNull() & finite


def _integers(rows: list | np.ndarray, scale: float, wide: bool, width: int) -> np.ndarray:
    """floor(scale * x) of every component, zeros appended up to ``width``."""
    values = np.floor(scale * np.asarray(rows, float))
    if not wide:
        whole = values.astype(np.int64)
    elif np.isfinite(values).all():
        whole = np.array([[int(x) for x in row] for row in values.tolist()], object).reshape(values.shape)
    else:
        # Only a component near the end of the doubles; it is a whole number itself.
        whole = np.array([[int(x) * int(scale) for x in row] for row in rows], object)
    return np.pad(whole, ((0, 0), (0, width - whole.shape[1])))


def _blocks(dims: int, width: int, parts: int, scale: float, wide: bool, rows: int, leaf: int):
    """For mapInArrow: vectors of a task as blocks with their trees."""

    def block(ids: list, labels: list, values: list) -> pa.RecordBatch:
        joined = np.concatenate(values)
        points = _integers(joined, scale, wide, width)
        trees = [build_tree(p, leaf) for p in np.split(points, parts, axis=1)]
        kept = points if wide or np.abs(points).max(initial=0) >= 1 << 31 else points.astype(np.int32)
        offsets = pa.array([0, len(joined)], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.concat_arrays(c)) for c in (ids, labels)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps((kept, trees), 5)], pa.binary())], ["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, values, held = [], [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - held)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float)
                ids.append(part.column("id"))
                labels.append(part.column("label"))
                values.append(flat.reshape(-1, dims))
                held, at = held + part.num_rows, at + part.num_rows
                if held == rows:
                    yield block(ids, labels, values)
                    ids, labels, values, held = [], [], [], 0
        if held:
            yield block(ids, labels, values)

    return run


def _round(trees: DataFrame, books: list[np.ndarray]) -> dict[tuple[int, int, int], int]:
    """Sums of the points of every (part, entry, position); position -1 counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for item in batch.column("trees"):
                points, own = pickle.loads(item.as_py())
                points = points if points.dtype == object else points.astype(np.int64)
                for p, (tree, part) in enumerate(zip(own, np.split(points, len(books), axis=1))):
                    more, n = assign(tree, part, books[p])
                    sums[p] += more
                    counts[p] += n
        found = [
            (p, e, position, str(total))
            for p in range(len(books))
            for e in np.flatnonzero(counts[p]).tolist()
            for position, total in enumerate([counts[p][e], *sums[p][e]], -1)
        ]
        columns = list(zip(*found)) or [[], [], [], []]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "position", "total"])

    made = trees.select("trees").mapInArrow(run, "part int, entry int, position int, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    return {(r[0], r[1], r[2]): int(r[3]) for r in made.groupBy("part", "entry", "position").agg(total).collect()}


def _coder(books: list[np.ndarray], schema: T.StructType):
    """For mapInArrow: id, label, code and error of every vector of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                points, own = pickle.loads(one.column("trees")[0].as_py())
                points = points if points.dtype == object else points.astype(np.int64)
                entries = np.zeros((len(books), len(points)), np.int64)
                error = np.zeros(len(points), points.dtype)
                for p, (tree, part) in enumerate(zip(own, np.split(points, len(books), axis=1))):
                    assign(tree, part, books[p], entries[p])
                    error = error + ((part - books[p][entries[p]]) ** 2).sum(1)
                digits = np.array([f"{e:02x}" for e in range(max(map(len, books)))])[entries]
                codes = ["".join(d) for d in digits.T.tolist()]
                columns = [one.column("ids").flatten(), one.column("labels").flatten(), pa.array(codes), pa.array(error.tolist(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return run


@dataclass(frozen=True)
class Codes:
    """``rows`` (id, label, code, error) and one array (entry, position) of integers for each part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def listed(self) -> str:
        """All components by part, entry and position."""
        return ",".join(str(v) for book in self.codebooks for v in book.ravel().tolist())


def compress(
    vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE, block_rows: int = BLOCK_ROWS, leaf: int = LEAF,
) -> Codes:
    """Codes of all vectors, and the codebooks they refer to.

    Components become floor(``scale`` * x). A part's codebook starts as that part
    of the ``entries`` smallest ids, is moved ``rounds`` times to the floored
    means of the nearest parts, ties to the first entry, and entries without a
    part stay. ``code`` has two hex digits a part; ``error`` is the squared
    distance between the integers and their entries.

    Vectors that are null, or hold a null or non-finite component, are left out;
    so are vectors of another length than most have (the longer of two equally
    frequent lengths). Lengths that ``parts`` does not divide are filled up with
    zeros. Null ids come last, equal ids are ordered by their vectors; repeated
    rows are rows of their own. With fewer vectors than ``entries`` there are
    fewer entries, and an empty table gives no rows and no codebooks. Components
    of any finite size are computed exactly; an ``error`` beyond 64 bits is an
    exception. Other columns are ignored.

    The driver holds the codebooks, ``entries`` vectors, and nothing that grows
    with the rows. Trees are written once to the shared folder, so a lost
    executor only repeats its blocks.
    """
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits a part: 1 to 256 entries")
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")).where(sound("vector"))
    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    greatest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    lengths = rows.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"), greatest.alias("greatest"))
    usual = lengths.where("dims > 0").orderBy(F.desc("n"), F.desc("dims")).first()
    if usual is None:
        return Codes(spark.createDataFrame([], schema), [])
    dims, width = usual["dims"], -(-usual["dims"] // parts) * parts
    # Squared distances of whole vectors must fit 64 bits; otherwise Python's integers are used.
    wide = not (scale * usual["greatest"] + 1) ** 2 * 4 * width < FAR
    rows = rows.where(F.size("vector") == dims)
    start = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    seeds = _integers([r["vector"] for r in start], scale, wide, width)
    books = np.split(seeds, parts, axis=1)

    per_block = max(1, min(block_rows, BLOCK_VALUES // width))
    block_schema = T.StructType([
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
        T.StructField("trees", T.BinaryType()),
    ])
    trees = settle(rows.mapInArrow(_blocks(dims, width, parts, scale, wide, per_block, leaf), block_schema), "vector-trees")
    for _ in range(rounds):
        found = _round(trees, books)
        books = [book.copy() for book in books]
        for (p, e, position), total in found.items():
            if position >= 0:
                books[p][e, position] = total // found[p, e, -1]
    return Codes(trees.mapInArrow(_coder(books, schema), schema), books)


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the sum of ``error`` over equal labels; nulls are equal."""
    coded = settle(rows, "vector-codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(settle(sums, "vector-labels"), F.col("label").eqNullSafe(F.col("of"))).drop("of")
