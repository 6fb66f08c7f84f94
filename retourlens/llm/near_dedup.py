"""Near-duplicate classes by MinHash with tensored banding.

Two texts link when the Jaccard similarity of their word shingles is at least a
threshold. Every set of shingles gets two small collections of hashes, each
hash made of a few minhashes. The key of a table is a hash of the first
collection with one of the second: m + m hashes make m * m tables, so about the
square root of the minhashes that as many separate tables would take. Two sets
share a table exactly if they share a hash in both collections, so keys are
only formed for sets that do, and every candidate is compared by whole sets.

A first round compares each set with the set it shares most hashes with, its
hub; what that puts into one class leaves the tables. The sets that remain are
dealt into cells of bounded size. Cells that share a table meet once, however
many tables they share, and what travels are cells, never pairs of sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.graph import connected_components
from retourlens.llm.jaccard import forgetting, shingles
from retourlens.llm.tables import free_name, whole_text
from retourlens.session import settle

#: Hashes of a collection, and minhashes of a hash. Sets of a similarity of 0.8 share no
#: table with a probability of 2 * (1 - 0.8**3)**22, about 3 in ten million.
HASHES, DEPTH = 22, 3
#: Shingles of a cell, and of the sets that meet their hub in one task.
CELL_SHINGLES = 500_000
#: Shingles that are hashed at once.
CHUNK = 1024


def _splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` well mixed 64-bit numbers."""
    state = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    state = (state ^ (state >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    state = (state ^ (state >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return state ^ (state >> np.uint64(31))


class Signer:
    """The two collections of hashes of a set."""

    def __init__(self, hashes: int = HASHES, depth: int = DEPTH):
        self.shape = (2 * hashes, depth)
        self.flips = _splitmix(2 * hashes * depth, 1)[:, None]
        self.factors = _splitmix(2 * hashes * depth, 2)[:, None] | np.uint64(1)

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        """One number for each hash of both collections, of a set that is not empty."""
        least = np.full(len(self.flips), np.iinfo(np.uint64).max, np.uint64)
        values = tokens.view(np.uint64)
        for at in range(0, len(values), CHUNK):
            np.minimum(least, ((values[None, at : at + CHUNK] ^ self.flips) * self.factors).min(1), out=least)
        mixed = np.zeros(self.shape[0], np.uint64)
        for part in least.reshape(self.shape).T:
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed.view(np.int64)


def _signed(docs: DataFrame, text: str, id_column: str, words: int, signer: Signer) -> DataFrame:
    """Every row's id, text key, set size, set digest and hashes."""
    value = free_name(docs, "value")
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text).alias(value)).withColumn("text_key", F.xxhash64(value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, hashes = [], [], []
            for item in batch.column(value):
                found = shingles(item.as_py(), words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                hashes.append(signer(found) if len(found) else None)
            columns = [
                batch.column("id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(hashes, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "n", "digest", "hashes"])

    schema = T.StructType([
        rows.schema["id"], T.StructField("text_key", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("hashes", T.ArrayType(T.LongType())),
    ])
    made = rows.mapInArrow(forgetting(run), schema).withColumn("row", F.monotonically_increasing_id())
    # Written before the numbers are used, so that they cannot change.
    return settle(made, "near-rows")


def _shared_keys(signs: DataFrame, hashes: int, percent: int) -> DataFrame:
    """(key, second, rid, n, like) of all hashes that several sets have; ``second`` tells the collections apart."""
    one = signs.select("rid", "n", F.posexplode("hashes").alias("place", "hash"))
    keys = one.select(
        F.xxhash64("place", "hash").alias("key"), (F.col("place") >= hashes).alias("second"), "rid", "n",
        F.floor(F.log("n") / math.log(100 / percent)).cast("int").alias("like"),
    )
    several = keys.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select("key")
    return settle(keys.join(several.hint("merge"), "key"), "near-keys")


def _homes(shared: DataFrame, percent: int) -> DataFrame:
    """(rid, n, home) of the sets with shared hashes in both collections: the hub met most often, or the set itself.

    A hub is the first set of like size with a hash; it is its own home. Which
    home a set has changes no result.
    """
    hubs = shared.where("not second").groupBy("key", "like").agg(F.min(F.struct("rid", "n")).alias("hub"))
    met = shared.where("not second").join(hubs.hint("merge"), ["key", "like"]).where("rid <> hub.rid")
    fits = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    counted = met.where(fits).groupBy("rid", F.col("hub.rid").alias("hub")).agg(F.count("*").alias("met"))
    most = F.min(F.struct((-F.col("met")).alias("met"), "hub"))["hub"]
    chosen = settle(counted.groupBy("rid").agg(most.alias("hub")), "near-hubs")
    joined = chosen.join(chosen.select(F.col("hub").alias("rid")).distinct(), "rid", "left_anti")
    both = shared.groupBy("rid").agg(F.first("n").alias("n"), F.bool_or("second").alias("b"), F.bool_or(~F.col("second")).alias("a"))
    homes = both.where("a and b").select("rid", "n").join(joined, "rid", "left")
    return settle(homes.select("rid", "n", F.coalesce("hub", "rid").alias("home")), "near-homes")


def _pieces(members: DataFrame, *keys: str) -> DataFrame:
    """``members`` with the ``piece`` of bounded size that they have in the group of ``keys``."""
    sizes = members.groupBy(*keys).agg(F.sum("n").alias("held"))
    piece = F.pmod(F.xxhash64("rid"), F.ceil(F.col("held") / CELL_SHINGLES)).cast("int")
    return members.join(sizes, list(keys)).withColumn("piece", piece).drop("held")


def _table_pairs(shared: DataFrame, cells: DataFrame) -> DataFrame:
    """(a, b): cells with sets of different classes in one table, each two once.

    Hashes and then tables whose sets are all of one class are left out before
    keys are formed. ``cells`` has (rid, class, cell).
    """
    differ = (F.min("class").alias("low"), F.max("class").alias("high"))
    marked = shared.select("key", "second", "rid").join(cells.select("rid", "class").hint("merge"), "rid")
    open_keys = marked.groupBy("key").agg(*differ).where("low <> high").select("key")
    left = marked.join(open_keys.hint("merge"), "key")
    pick = lambda second: F.collect_set(F.when(F.col("second") == second, F.col("key")))
    sides = left.groupBy("rid").agg(pick(False).alias("firsts"), pick(True).alias("seconds"))
    tables = sides.select("rid", F.explode("firsts").alias("f"), "seconds").select("rid", "f", F.explode("seconds").alias("s"))
    tables = tables.select("rid", F.xxhash64("f", "s").alias("table"))
    placed = tables.join(cells.hint("merge"), "rid")
    held = settle(placed.groupBy("table", "cell").agg(F.count("*").alias("sets"), *differ), "near-tables")
    several = held.groupBy("table").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("table")
    held = held.join(several.hint("merge"), "table")
    one, two = held.alias("one"), held.alias("two")
    other = (F.col("one.cell") < F.col("two.cell")) & ((F.col("one.cell.pool") != F.col("two.cell.pool")) | (F.col("one.cell.pool") == -1))
    itself = (F.col("one.cell") == F.col("two.cell")) & (F.col("one.cell.pool") == -1) & (F.col("one.sets") > 1)
    met = one.join(two.hint("merge"), F.col("one.table") == F.col("two.table")).where(other | itself)
    return settle(met.select(F.col("one.cell").alias("a"), F.col("two.cell").alias("b")).distinct(), "near-pairs")


def _ask(rows: DataFrame, asks: bool, asked: bool) -> DataFrame:
    """(meeting, asks, asked, rid) of ``rows`` (meeting, rid)."""
    return rows.select("meeting", F.lit(asks).alias("asks"), F.lit(asked).alias("asked"), "rid")


def _meetings(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """(meeting, asks, asked, rid) of all pairs of cells that are to meet.

    Of two cells the larger is the host. A host meets as many of its guests at
    once as a cell may hold, so its sets travel once for so many, not for each.
    """
    sizes = settle(cells.groupBy("cell").agg(F.sum("n").alias("held")), "near-sizes")
    one, two = (sizes.select(F.col("cell").alias(c), F.struct("held", "cell").alias(f"own_{c}")) for c in ("a", "b"))
    sized = pairs.where("a <> b").join(one.hint("merge"), "a").join(two.hint("merge"), "b")
    large, small = F.greatest("own_a", "own_b"), F.least("own_a", "own_b")
    sized = settle(sized.select(large["cell"].alias("host"), small["cell"].alias("guest"), small["held"].alias("n")), "near-guests")
    groups = sized.groupBy("host").agg(F.ceil(F.sum("n") / CELL_SHINGLES).alias("groups"))
    group = F.pmod(F.xxhash64("guest"), F.col("groups"))
    met = sized.join(groups, "host").select("host", "guest", F.xxhash64("host", group).alias("meeting"))
    members = lambda side: cells.select("rid", F.col("cell").alias(side))
    hosts = met.select("meeting", "host").distinct()
    alone = pairs.where("a = b").select(F.col("a").alias("alone"), F.xxhash64("a").alias("meeting"))
    return (
        _ask(met.join(members("guest"), "guest"), True, False).union(_ask(hosts.join(members("host"), "host"), False, True))
        .union(_ask(alone.join(members("alone"), "alone"), True, True))
    )


def _links(placed: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links between the sets of a meeting that ask and those that are asked, by their whole sets.

    ``placed`` has (meeting, asks, asked, rid); meetings of one number are one
    meeting. As many links as put all linked sets of a meeting into one class.
    """
    rows = placed.join(texts.hint("merge"), "rid")
    dealt = rows.repartition("meeting").sortWithinPartitions("meeting").select("meeting", "asks", "asked", "rid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, meeting = None, Meeting(percent)
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("meeting", "asks", "asked", "rid", "text")]):
                key, asks, asked, rid, text = (v.as_py() for v in row)
                if key != current:
                    yield meeting.links()
                    current, meeting = key, Meeting(percent)
                meeting.add(rid, shingles(text, words), asks, asked)
        yield meeting.links()

    return dealt.mapInArrow(forgetting(run), "a long, b long")


class Meeting:
    """Sets that ask and sets that are asked."""

    def __init__(self, percent: int):
        self.percent, self.rids, self.sets, self.asks, self.asked = percent, [], [], [], []

    def add(self, rid: int, own: np.ndarray, asks: bool, asked: bool) -> None:
        for held, at in ((self.asks, asks), (self.asked, asked)):
            if at:
                held.append(len(self.rids))
        self.rids.append(rid)
        self.sets.append(own)

    def links(self) -> pa.RecordBatch:
        root = list(range(len(self.rids)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        if self.asks and self.asked:
            sizes = np.array([len(self.sets[i]) for i in self.asked])
            tokens, owners = np.concatenate([self.sets[i] for i in self.asked]), np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            for i in self.asks:
                own = self.sets[i]
                first, after = (np.searchsorted(tokens, own, side) for side in ("left", "right"))
                held = after - first
                # In common with the union of all sets asked: the bound for each of them.
                if 100 * np.count_nonzero(held) < self.percent * len(own):
                    continue
                starts = np.repeat(first - np.concatenate(([0], np.cumsum(held)[:-1])), held)
                common = np.bincount(owners[starts + np.arange(held.sum())], minlength=len(sizes))
                for at in np.flatnonzero(100 * common >= self.percent * (len(own) + sizes - common)):
                    a, b = find(i), find(self.asked[at])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found.append((self.rids[i], self.rids[self.asked[at]]))
        return pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in (0, 1)], ["a", "b"])


def _texts(docs: DataFrame, text: str, id_column: str, sets: DataFrame, rids: DataFrame) -> DataFrame:
    """(rid, text) of some sets, from the row that stands for each; merged at every size."""
    wanted = sets.join(rids, "rid").select("rid", F.col("id").alias("own_id"), F.col("text_key").alias("own_key"))
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text).alias("text")).withColumn("key", F.xxhash64("text"))
    same = (F.col("key") == F.col("own_key")) & F.col("id").eqNullSafe(F.col("own_id"))
    return settle(rows.join(wanted.hint("merge"), same).select("rid", "text").dropDuplicates(["rid"]), "near-texts")


def near_classes(
    docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id", hashes: int = HASHES,
    depth: int = DEPTH,
) -> DataFrame:
    """One row for each of ``docs``: (id, text_key, n_shingles, class_id, component_id).

    ``n_shingles`` counts distinct runs of ``words`` words, A-Z in lower case;
    ``component_id`` is the smallest id reachable by links of ``percent`` or
    more, ``class_id`` numbers the classes. A text of fewer words is one shingle.
    Null and empty texts, or those of white space, have no shingle and are a
    class of their own. Null ids come after all others, a class of nulls has a
    null component. Equal sets, so repeated rows too, are one set and always
    linked. ``text_key`` is xxhash64 of the text. Very long texts are hashed in
    chunks and compared in full. Other columns are ignored; an empty table gives
    an empty result.

    Links are exact; a pair just at the threshold is no candidate with the
    probability 2 * (1 - (percent / 100) ** depth) ** hashes. Lower thresholds
    need more ``hashes``.
    """
    rows = _signed(docs, text, id_column, words, Signer(hashes, depth))
    stands = F.min(F.struct("row", "id", "text_key", "n"))
    sets = settle(
        rows.where("n > 0").groupBy("digest").agg(stands.alias("s"), F.min("id").alias("least"))
        .select("digest", F.col("s.row").alias("rid"), F.col("s.id").alias("id"), "s.text_key", "s.n", "least"),
        "near-sets",
    )
    # Merged at every size, as the sets grow with the input.
    signs = rows.join(sets.select(F.col("rid").alias("row")).hint("merge"), "row", "left_semi")
    shared = _shared_keys(signs.select(F.col("row").alias("rid"), "n", "hashes"), hashes, percent)
    homes = _homes(shared, percent)
    texts = _texts(docs, text, id_column, sets, homes.select("rid"))

    guests = _pieces(homes.where("rid <> home"), "home").select(F.xxhash64("home", "piece").alias("meeting"), "home", "rid")
    hosts = guests.select("meeting", F.col("home").alias("rid")).distinct()
    near = settle(_links(_ask(guests, True, False).union(_ask(hosts, False, True)), texts, words, percent), "near-stars")

    classes = settle(connected_components(near, "near-star"), "near-classes").withColumnRenamed("node", "rid")
    pooled = homes.join(classes, "rid", "left").select("rid", "n", "home", F.coalesce("root", "rid").alias("class"), F.coalesce("root", F.lit(-1)).alias("pool"))
    cells = _pieces(pooled, "home", "pool").select("rid", "n", "class", F.struct("home", "pool", "piece").alias("cell"))
    cells = settle(cells, "near-cells")
    meetings = _meetings(_table_pairs(shared, cells), cells)
    links = settle(near.union(_links(meetings, texts, words, percent)), "near-links")

    roots = settle(connected_components(links, "near"), "near-roots").withColumnRenamed("node", "rid")
    labelled = sets.join(roots, "rid", "left").withColumn("class_id", F.coalesce("root", "rid"))
    least = labelled.groupBy("class_id").agg(F.min("least").alias("component_id"))
    labels = labelled.join(least, "class_id").select("digest", "class_id", "component_id")
    marked = rows.join(labels.hint("merge"), "digest", "left")
    return marked.select(
        "id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("class_id", "row").alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )

