"""N-gram Jaccard join by a token-group matrix, as classes of linked documents.

Two texts link when the Jaccard similarity of their word shingles is at least a
threshold. Equal shingle sets are one set first. In one order of all shingles,
frequent ones last, two linked sets share a shingle of their short prefixes, so
only prefixes travel.

Similar sets are partitioned into groups: a set joins the hub that it meets in
most of its prefix buckets. A matrix holds, for every part of a group, the union
of the prefix shingles of its members. A set of another group is bound against
it: from the number of its prefix shingles in the union follows the most that it
can have in common with any member. Only parts that qualify are opened; there
the union of the whole sets bounds again before members are compared exactly.
Within a group, sets are first compared with the hub; what that puts into one
class is not compared any more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.graph import connected_components
from retourlens.llm.tables import free_name, give_back, whole_text
from retourlens.session import settle

#: At most this many frequent shingles are put last; a hint that changes no result.
FREQUENT = 100_000
#: Shingles counted at once in a task, and how often one must occur there to be passed on.
COUNT_AT_ONCE, LEAST_COUNT = 2_000_000, 4
#: Words whose hashes a process remembers, and rows that are shingled at once.
CACHE_WORDS, ROWS_AT_ONCE = 50_000, 1_000
#: Rows of a frequent shingle's bucket, members of a group's part, queries that meet it in one task.
BUCKET_ROWS, PART_MEMBERS, PART_QUERIES = 4096, 128, 256

_MULTIPLY, _FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_words = _Words()


def forget() -> None:
    """Drop the words that this process remembers."""
    _words.clear()


def forgetting(run):
    """A task's function that leaves no remembered words in the worker it ran in."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            # By its name, so that the module's own words are meant, not a copy sent along.
            forget()
            give_back()

    return task


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words, A-Z in lower case.

    A text of fewer words is one shingle, one without words has none.
    """
    parts = text.encode("utf-8", "replace").lower().split()
    if len(parts) < words:
        whole = xxhash.xxh3_64_intdigest(b" ".join(parts), seed=words)
        return np.array([whole] if parts else [], np.uint64).view(np.int64)
    hashes = np.array(list(map(_words.__getitem__, parts)), np.uint64)
    count = len(parts) - words + 1
    mixed = hashes[:count].copy()
    for n in range(1, words):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MULTIPLY + hashes[n : n + count]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _FINISH
    return np.unique((mixed ^ (mixed >> np.uint64(29))).view(np.int64))


def _frequent_shingles(texts: DataFrame, words: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent shingles and the power of two of their counts, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One buffer for the whole task, sorted where it lies.
        held, size = np.empty(COUNT_AT_ONCE, np.int64), 0

        def result() -> pa.RecordBatch:
            run = held[:size]
            run.sort()
            starts = np.flatnonzero(np.concatenate(([size > 0], run[1:] != run[:-1])))
            counts = np.diff(starts, append=size)
            often = counts >= LEAST_COUNT
            return pa.RecordBatch.from_arrays([pa.array(run[starts[often]]), pa.array(counts[often])], ["token", "n"])

        for batch in batches:
            for item in batch.column(0):
                found = shingles(item.as_py(), words)
                while len(found):
                    part, found = np.split(found, [COUNT_AT_ONCE - size])
                    held[size : size + len(part)] = part
                    size += len(part)
                    if size == COUNT_AT_ONCE:
                        yield result()
                        size = 0
        yield result()

    counted = texts.mapInArrow(forgetting(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = settle(counted.select("token", F.log2("n").cast("int").alias("power")), "jaccard-counts")
    # The rarest power of two whose shingles, with all above, are few enough.
    least, total = 64, 0
    for power, n in sorted(counted.groupBy("power").count().collect(), reverse=True):
        total += n
        if total > most:
            break
        least = power
    rows = sorted(tuple(r) for r in counted.where(F.col("power") >= least).collect())
    return np.array([t for t, _ in rows], np.int64), np.array([p for _, p in rows], np.int32)


def least_overlap(first: Column, second: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share to link."""
    return F.ceil(percent * (first + second) / F.lit(100 + percent)).cast("long")


def least_own(size: Column, percent: int) -> Column:
    """Shingles of its own that a set of this size must share with any set it links to."""
    return F.ceil(percent * size / F.lit(100)).cast("long")


def _least_as_member(n: Column, low: Column, high: Column, percent: int) -> Column:
    """The least of ``least_overlap(n, m) - least_own(m) + 1`` over the sizes m from ``low`` to ``high``.

    Without rounding it falls with m, and both roundings together are less than
    one off in each direction; so it is least within so many steps of ``high``.
    """
    steps = 100 * (100 + percent) // percent**2
    need = lambda m: least_overlap(n, m, percent) - least_own(m, percent) + 1
    if steps > 16:
        return need(high) - 1
    return F.least(need(high), *[need(F.greatest(low, high - step)) for step in range(1, steps + 1)])


def _shingled(docs: DataFrame, text: str, id_column: str, words: int, percent: int, frequent) -> DataFrame:
    """Every row's id, text key, set size, set digest and prefix with the order's last key."""
    value = free_name(docs, "value")
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text).alias(value)).withColumn("text_key", F.xxhash64(value))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, powers = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                sizes, digests, ends, entries = [], [], [0], []
                for item in batch.column(value):
                    found = shingles(item.as_py(), words)
                    n = len(found)
                    sizes.append(n)
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()) if n else None)
                    power = np.zeros(n, np.int32)
                    if len(tokens) and n:
                        near = np.minimum(np.searchsorted(tokens, found), len(tokens) - 1)
                        power = np.where(tokens[near] == found, powers[near], 0).astype(np.int32)
                    order = np.lexsort((found, power))[: n - -(-percent * n // 100) + 1] if n else np.zeros(0, int)
                    entries.append((found[order], power[order]))
                    ends.append(ends[-1] + len(order))
                # Columns of numbers, not an object for each entry.
                flat = [pa.array(np.concatenate(column)) for column in zip(*entries)]
                prefixes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(flat, ["token", "power"]))
                columns = [batch.column("id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), prefixes]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "n", "digest", "prefix"])

    kind = T.ArrayType(T.StructType([T.StructField("token", T.LongType()), T.StructField("power", T.IntegerType())]))
    schema = T.StructType([
        rows.schema["id"], T.StructField("text_key", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("prefix", kind),
    ])
    made = rows.mapInArrow(forgetting(run), schema).withColumn("row", F.monotonically_increasing_id())
    # Written before the numbers are used, so that they cannot change.
    return settle(made, "jaccard-docs")


def _shared_entries(sets: DataFrame, percent: int) -> DataFrame:
    """Prefix shingles that several sets have, each with the hub of its bucket.

    A bucket holds the sets with one shingle; those of frequent shingles are
    dealt into pieces of bounded size by the set's number, and ``first`` is the
    hub of the pieces' hubs. A hub is the first set of like size.
    """
    last = F.element_at("prefix", -1)
    rows = sets.select(
        "rid", "n", F.struct(last["power"].alias("power"), last["token"].alias("token")).alias("last"),
        F.size("prefix").alias("p"), F.explode("prefix").alias("e"),
    )
    pieces = F.greatest(F.lit(1), F.ceil(F.pow(2.0, F.col("e.power") + 1) / BUCKET_ROWS)).cast("int")
    rows = rows.select(
        F.col("e.token").alias("token"), pieces.alias("pieces"), F.pmod(F.xxhash64("rid"), pieces).cast("int").alias("piece"),
        "rid", "n", "p", "last", F.floor(F.log("n") / math.log(100 / percent)).cast("int").alias("like"),
    )
    bucket = W.partitionBy("token", "piece")
    found = rows.withColumn("sets", F.count("*").over(bucket)).where("sets > 1 or pieces > 1").drop("sets")
    hub = F.min(F.struct("rid", "n")).over(W.partitionBy("token", "piece", "like"))
    return settle(found.withColumn("hub", hub), "jaccard-entries")


def _groups(entries: DataFrame, percent: int) -> DataFrame:
    """(rid, grp) of all sets with shared shingles: the hub met in most buckets, or the set itself.

    A hub stays in its own group. Which group a set is in changes no result.
    """
    own = entries.where("rid <> hub.rid").select("rid", "n", "p", "hub")
    hubs = entries.where("pieces > 1 and rid = hub.rid")
    hubs = hubs.withColumn("hub", F.min(F.struct("rid", "n")).over(W.partitionBy("token", "like")))
    met = own.union(hubs.where("rid <> hub.rid").select("rid", "n", "p", "hub"))
    fits = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    counted = met.where(fits).groupBy("rid", F.col("hub.rid").alias("hub")).agg(F.count("*").alias("met"), F.first("p").alias("p"))
    most = F.min(F.struct((-F.col("met")).alias("met"), "hub"))["hub"]
    chosen = settle(counted.where("10 * met >= p").groupBy("rid").agg(most.alias("hub")), "jaccard-hubs")
    all_hubs = chosen.select(F.col("hub").alias("rid")).distinct()
    joined = chosen.join(all_hubs, "rid", "left_anti")
    grouped = entries.select("rid").distinct().join(joined, "rid", "left")
    return settle(grouped.select("rid", F.coalesce("hub", "rid").alias("grp")), "jaccard-groups")


def _parts(members: DataFrame, *keys: str) -> DataFrame:
    """``members`` with the part (``piece`` and how many there are) of their group that they are in."""
    sizes = members.groupBy(*keys).agg(F.count("*").alias("members"))
    piece = F.pmod(F.xxhash64("rid"), F.ceil(F.col("members") / PART_MEMBERS)).cast("int")
    return members.join(sizes, list(keys)).withColumn("piece", piece)


def _other_groups(entries: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(grp, piece, rid): sets that a part of another group qualifies for, by the matrix."""
    rows = entries.select("token", "rid", "n", "last").join(_parts(groups, "grp"), "rid")
    bounds = rows.groupBy("grp", "piece").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("last").alias("first_last"), F.max("last").alias("last_last")
    )
    matrix = rows.select("token", "grp", "piece", "members").distinct().join(bounds, ["grp", "piece"])
    g, q = matrix.alias("g"), rows.alias("q")
    n = F.col("n")
    low, high = F.greatest("low", least_own(n, percent)), F.least("high", F.floor(100 * n / F.lit(percent)).cast("long"))
    # Each two groups meet once: the smaller one asks, where some member's size can fit.
    asks = (F.col("q.token") == F.col("g.token")) & (low <= high) & (
        F.struct(F.col("q.members"), F.col("q.grp")) < F.struct(F.col("g.members"), F.col("g.grp"))
    )
    part = ["g.grp", "g.piece", "low", "high", "first_last", "last_last"]
    met = q.join(g, asks).groupBy(*part, "q.rid", "q.n", "q.last").agg(F.count("*").alias("shared"))
    as_query = least_overlap(n, low, percent) - least_own(n, percent) + 1
    as_member = _least_as_member(n, low, high, percent)
    need = (
        F.when(F.col("last") <= F.col("first_last"), as_query)
        .when(F.col("last") > F.col("last_last"), as_member)
        .otherwise(F.least(as_query, as_member))
    )
    qualifying = met.where(F.col("shared") >= need).select("grp", "piece", "rid")
    return settle(qualifying, "jaccard-asks")


def _own_group(groups: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(grp, pool, piece, rid) of what is left to compare within groups, and of the parts' members.

    A class has parts of its own, sets without links to their hub share parts.
    Each two parts meet once, except two of one class.
    """
    several = groups.join(groups.groupBy("grp").count().where("count > 1").select("grp"), "grp", "left_semi")
    pooled = several.join(near, several.rid == near.node, "left").select("grp", F.coalesce("root", F.lit(-1)).alias("pool"), "rid")
    members = settle(_parts(pooled, "grp", "pool").select("grp", "pool", "piece", "rid"), "jaccard-parts")
    part = members.select("grp", F.struct("pool", "piece").alias("part")).distinct()
    pairs = part.alias("a").join(part.alias("b"), "grp").where("a.part <= b.part and (a.part.pool <> b.part.pool or a.part.pool = -1)")
    pairs = pairs.select("grp", F.col("a.part").alias("part"), F.col("b.part.pool").alias("to_pool"), F.col("b.part.piece").alias("to_piece"))
    asking = members.withColumn("part", F.struct("pool", "piece")).drop("pool", "piece").join(pairs, ["grp", "part"])
    asks = asking.select("grp", F.col("to_pool").alias("pool"), F.col("to_piece").alias("piece"), "rid")
    return settle(asks, "jaccard-own"), members


def _open(members: DataFrame, asks: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links between the sets that ask and members of the parts (grp, pool, piece) they ask.

    As many as put all linked sets of a part and its askers into one class.
    """
    keys = ["grp", "pool", "piece"]
    blocks = asks.groupBy(*keys).agg(F.ceil(F.count("*") / PART_QUERIES).cast("int").alias("blocks"))
    asking = asks.join(blocks, keys).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    held = members.join(blocks, keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = [*keys, "block", "asks", "rid"]
    both = asking.withColumn("asks", F.lit(True)).select(columns).union(held.withColumn("asks", F.lit(False)).select(columns))
    placed = both.join(texts, "rid").repartition(*keys, "block").sortWithinPartitions(*keys, "block", "asks")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, part, links = None, None, []
        for batch in batches:
            for grp, pool, piece, block, asks, rid, text in zip(*[batch[c] for c in (*columns, "text")]):
                if (grp, pool, piece, block) != current:
                    current, part = (grp, pool, piece, block), _Part(percent)
                if asks:
                    links += part.ask(rid, shingles(text, words))
                else:
                    part.add(rid, shingles(text, words))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
            links = []

    return placed.select(*columns, "text").mapInPandas(forgetting(compare), "a long, b long")


class _Part:
    """The whole sets of a part's members, as one sorted list of (shingle, member)."""

    def __init__(self, percent: int):
        self.percent, self.rids, self.sets, self.tokens = percent, [], [], None
        self.roots: dict[int, int] = {}

    def add(self, rid: int, own: np.ndarray) -> None:
        self.rids.append(rid)
        self.sets.append(own)

    def _root(self, rid: int) -> int:
        while (up := self.roots.get(rid, rid)) != rid:
            rid = up
        return rid

    def ask(self, rid: int, own: np.ndarray) -> list[tuple[int, int]]:
        """New links of a set to members it is not yet known to be in one class with."""
        if self.tokens is None:
            self.sizes = np.array([len(s) for s in self.sets])
            tokens, owners = np.concatenate(self.sets), np.repeat(np.arange(len(self.sets)), self.sizes)
            order = np.argsort(tokens, kind="stable")
            self.tokens, self.owners = tokens[order], owners[order]
        first, after = (np.searchsorted(self.tokens, own, side) for side in ("left", "right"))
        held = after - first
        # In common with the union of all members: the bound for each of them.
        if 100 * np.count_nonzero(held) < self.percent * len(own):
            return []
        starts = np.repeat(first - np.concatenate(([0], np.cumsum(held)[:-1])), held)
        common = np.bincount(self.owners[starts + np.arange(held.sum())], minlength=len(self.rids))
        linked = 100 * common >= self.percent * (len(own) + self.sizes - common)
        links = []
        for at in np.flatnonzero(linked):
            a, b = self._root(rid), self._root(self.rids[at])
            if a != b:
                self.roots[max(a, b)] = min(a, b)
                links.append((rid, self.rids[at]))
        return links


def _texts(docs: DataFrame, text: str, id_column: str, sets: DataFrame, rids: DataFrame) -> DataFrame:
    """(rid, text) of some sets, from the row that stands for each.

    The list of sets grows with the input, so it is merged at every size.
    """
    wanted = sets.join(rids, "rid").select("rid", F.col("id").alias("own_id"), F.col("text_key").alias("own_key"))
    wanted = wanted.hint("merge")
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text).alias("text")).withColumn("key", F.xxhash64("text"))
    same = (F.col("key") == F.col("own_key")) & F.col("id").eqNullSafe(F.col("own_id"))
    return settle(rows.join(wanted, same).select("rid", "text").dropDuplicates(["rid"]), "jaccard-texts")


def link_classes(
    docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id",
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row for each of ``docs``: (id, text_key, n_shingles, class_id, component_id).

    ``n_shingles`` counts distinct runs of ``words`` words, ``component_id`` is
    the smallest id reachable by links of ``percent`` or more, ``class_id``
    numbers the classes. Null and empty texts, or those of white space, have no
    shingle and are a class of their own. Shorter texts than ``words`` are one
    shingle. Null ids come after all others, a class of nulls has a null
    component; repeated rows are one set. ``text_key`` is xxhash64 of the text.
    Other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(whole_text(text).alias("text"))
    rows = _shingled(docs, text, id_column, words, percent, _frequent_shingles(texts, words, frequent))
    stands = F.min(F.struct("row", "id", "text_key", "n"))
    sets = settle(
        rows.where("n > 0").groupBy("digest").agg(stands.alias("s"), F.min("id").alias("least"))
        .select("digest", F.col("s.row").alias("rid"), F.col("s.id").alias("id"), "s.text_key", "s.n", "least"),
        "jaccard-sets",
    )
    # Merged at every size, as the sets grow with the input.
    prefixes = rows.join(sets.select(F.col("rid").alias("row")).hint("merge"), "row", "left_semi")
    entries = _shared_entries(prefixes.select(F.col("row").alias("rid"), "n", "prefix"), percent)

    groups = _groups(entries, percent)
    asks = _other_groups(entries, groups, percent).withColumn("pool", F.lit(-2).cast("long"))
    asked = _parts(groups, "grp").select("grp", "piece", "rid").join(asks.select("grp", "piece").distinct(), ["grp", "piece"])
    asked = settle(asked.withColumn("pool", F.lit(-2).cast("long")), "jaccard-asked")
    stars = groups.where("rid <> grp").withColumns({"pool": F.lit(-2).cast("long"), "piece": F.lit(0)})
    hubs = stars.select("grp", "pool", "piece", F.col("grp").alias("rid")).distinct()
    involved = asks.select("rid").union(asked.select("rid")).union(stars.select("rid")).union(hubs.select("rid")).distinct()
    contents = _texts(docs, text, id_column, sets, involved)

    near = settle(_open(hubs, stars, contents, words, percent), "jaccard-near")
    inner, members = _own_group(groups, settle(connected_components(near, "jaccard-near"), "jaccard-classes"))
    found = [_open(asked, asks, contents, words, percent), _open(members, inner, contents, words, percent)]
    links = settle(near.union(found[0]).union(found[1]), "jaccard-links")
    roots = settle(connected_components(links, "jaccard"), "jaccard-roots").withColumnRenamed("node", "rid")
    labelled = sets.join(roots, "rid", "left").withColumn("class_id", F.coalesce("root", "rid"))
    least = labelled.groupBy("class_id").agg(F.min("least").alias("component_id"))
    labels = labelled.join(least, "class_id").select("digest", "class_id", "component_id")
    marked = rows.join(labels, "digest", "left")
    return marked.select(
        "id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("class_id", "row").alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id.

    Documents without a shingle all stay. Of rows alike in id and text one stays.
    """
    classes = link_classes(docs, words, percent, text, id_column)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    key = ["key", "id", "no_id"]

    def parts(hashed: Column, id_: Column) -> list[Column]:
        # Plain columns, so that the join's partitions serve the last step too and rows move once.
        return [hashed.alias("key"), F.coalesce(id_.cast("string"), F.lit("")).alias("id"), id_.isNull().alias("no_id")]

    kept = classes.groupBy("class_id").agg(first.alias("k")).select(*parts(F.col("k.text_key"), F.col("k.id")))
    kept = settle(kept.distinct(), "jaccard-kept")
    boxed = docs.select(F.struct("*").alias("row"), *parts(F.xxhash64(whole_text(text)), F.col(id_column)))
    return boxed.join(kept, key, "left_semi").dropDuplicates(key).select("row.*")
