"""Interaction audit of five text filters: what each order of them removes.

Duplicates are found by radix tries. While texts are read, each task puts them
into a trie of bounded size, so that copies it meets again leave no text behind.
The texts that remain are dealt out by adaptive prefixes: a prefix that holds
too much text is replaced by longer ones, and ranges of prefixes go to tasks in
order. There, whole texts are inserted into compressed tries whose terminals
hold the smallest id; a traversal gives each remembered text its smallest id,
and with it the duplicate flag of every row. Rows, as masks of five bits, are
then counted, and all orders of the filters follow from at most 32 counts a part
and label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.tables import whole_text
from retourlens.session import settle

FILTERS = "ABCDE"
#: The least words, and percentages of distinct words and capital letters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
MARKS = re.compile(r"[#$%&*|]")
#: Memory of a trie and of a node, and text that one range of prefixes may hold.
TRIE_BYTES, NODE_BYTES, RANGE_BYTES = 16 << 20, 500, 32 << 20
#: A prefix may hold a share of all text, within limits, so that ranges can be even at every size.
PREFIX_SHARE, LEAST_PREFIX = 1024, 512 << 10
#: Characters of the first prefix, how many times longer the next one is, and the longest one kept beside the text.
FIRST_PREFIX, LONGER, HEAD = 4, 4, 64
#: Rows and bytes of a batch of texts that a task returns.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)


class Trie:
    """A compressed radix trie of byte strings. A node is [label, children by first byte, value]."""

    def __init__(self):
        self.root: list = [b"", {}, None]
        #: An estimate of the memory held.
        self.bytes = 0

    def terminal(self, key: bytes) -> list:
        """The node where ``key`` ends, made if it isn't there."""
        node, at, end = self.root, 0, len(key)
        while at < end:
            child = node[1].get(key[at])
            if child is None:
                child = node[1][key[at]] = [key[at:], {}, None]
                self.bytes += end - at + NODE_BYTES
                return child
            label = child[0]
            if key.startswith(label, at):
                at += len(label)
                node = child
                continue
            same = _common(label, key, at)
            upper = node[1][key[at]] = [label[:same], {label[same]: child}, None]
            child[0] = label[same:]
            self.bytes += NODE_BYTES
            node, at = upper, at + same
        return node

    def items(self) -> Iterator[tuple[bytes, list]]:
        """Strings with a value, in their order."""
        stack = [(b"", self.root)]
        while stack:
            above, node = stack.pop()
            key = above + node[0]
            if node[2] is not None:
                yield key, node[2]
            stack += [(key, node[1][first]) for first in sorted(node[1], reverse=True)]

    def values(self) -> Iterator[list]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2] is not None:
                yield node[2]
            stack += node[1].values()


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key`` from ``at``, by doubling and halving."""
    low, high = 0, min(len(label), len(key) - at)
    step = 16
    while low < high:
        step = min(step, high - low)
        if label[low : low + step] == key[at + low : at + low + step]:
            low += step
            step *= 2
        elif step == 1:
            break
        else:
            high, step = low + step - 1, max(1, step // 2)
    return low


def failures(text: str) -> int:
    """Bits of the first four filters that fail: few words, few distinct ones, many capitals, marks."""
    data = text.encode()
    words = data.split()
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * len(data.translate(None, _NOT_CAPITAL)) > MOST_CAPITALS * len(text)) << 2
        | (MARKS.search(text) is not None) << 3
    )


def _smaller(a, b):
    """The smaller id; None comes after all ids."""
    return b if a is None else a if b is None or a <= b else b


def _remember(trie_bytes: int, fields: list[str]):
    """For mapInArrow: a narrow row (id, part, mask, record) for every row, and, as often as a
    trie is full, a row (record, own, text) for each of its texts with the smallest id there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, number = Trie(), TaskContext.get().partitionId() << 40

        def batch_of(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            kinds = {"id": pa.int64(), "part": pa.string(), "mask": pa.int32(), "record": pa.int64(), "own": pa.int64(), "text": pa.string()}
            return pa.RecordBatch.from_arrays([columns[f] if f in columns else pa.nulls(n, kinds[f]) for f in fields], fields)

        def texts() -> Iterator[pa.RecordBatch]:
            for part in _bounded(trie.items()):
                keys, values = zip(*part)
                columns = {
                    "record": pa.array([v[0] for v in values], pa.int64()), "own": pa.array([v[2] for v in values], pa.int64()),
                    "text": pa.array(keys, pa.binary()).cast(pa.string()),
                }
                yield batch_of(columns, len(part))

        for batch in batches:
            masks, records = [], []
            for item, own in zip(batch.column("text"), batch.column("id").to_pylist()):
                text = item.as_py()
                node = trie.terminal(text.encode())
                if node[2] is None:
                    node[2] = [number, failures(text), own]
                    number += 1
                else:
                    node[2][2] = _smaller(node[2][2], own)
                records.append(node[2][0])
                masks.append(node[2][1])
                if trie.bytes >= trie_bytes:
                    yield from texts()
                    trie = Trie()
            columns = {"id": batch.column("id"), "part": batch.column("part"), "mask": pa.array(masks, pa.int32()), "record": pa.array(records, pa.int64())}
            yield batch_of(columns, batch.num_rows)
        yield from texts()

    return run


def _bounded(items: Iterator[tuple[bytes, list]]) -> Iterator[list]:
    """Items in lists of bounded size."""
    part, held = [], 0
    for item in items:
        part.append(item)
        held += len(item[0])
        if len(part) == BATCH_ROWS or held >= BATCH_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def _resolve(trie_bytes: int):
    """For mapInArrow: (record, least id) of texts that arrive in the order of their prefixes.

    A prefix is complete before the next one comes, so a full trie is emptied there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result() -> pa.RecordBatch:
            rows = [(record, ids[0]) for ids in trie.values() for record in ids[1]]
            columns = list(zip(*rows)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["record", "least"])

        trie, current = Trie(), None
        for batch in batches:
            columns = (batch.column(c) for c in ("prefix", "text", "record", "own"))
            for prefix, text, record, own in zip(*columns):
                if (prefix := prefix.as_py()) != current:
                    if trie.bytes >= trie_bytes:
                        yield result()
                        trie = Trie()
                    current = prefix
                node = trie.terminal(text.as_py().encode())
                if node[2] is None:
                    node[2] = [own.as_py(), [record.as_py()]]
                else:
                    node[2][0] = _smaller(node[2][0], own.as_py())
                    node[2][1].append(record.as_py())
        yield result()

    return run


def with_prefixes(texts: DataFrame, prefix_bytes: int) -> DataFrame:
    """``texts`` (text, head, bytes, chars, ..) with an adaptive ``prefix``, and whether that is one ``hot`` text.

    Prefixes start with ``FIRST_PREFIX`` characters; those that hold more than
    ``prefix_bytes`` grow ``LONGER`` times, until what they hold is one text. Up to
    ``HEAD`` characters they are measured on the narrow column ``head``. Of the
    tables of heavy prefixes, each with at most total / ``prefix_bytes`` rows,
    Spark broadcasts the small ones by their measured size.
    """
    found, left, length = texts.withColumns({"prefix": F.substring("head", 1, FIRST_PREFIX), "hot": F.lit(False)}), texts, FIRST_PREFIX
    while True:
        here = F.substring("head" if length <= HEAD else "text", 1, length)
        sized = left.groupBy(here.alias("heavy")).agg(F.sum("bytes").alias("held"), (F.max("chars") <= length).alias("one"))
        heavy = settle(sized.where(F.col("held") > prefix_bytes).select("heavy", "one"), "audit-prefixes")
        if heavy.isEmpty():
            return found
        # Prefixes measured last lie within heavy ones of all rounds before, so these need not be joined again.
        left = texts.join(heavy.where("not one"), here == F.col("heavy"), "left_semi")
        longer = F.substring("head" if LONGER * length <= HEAD else "text", 1, LONGER * length)
        found = found.join(heavy, (F.col("prefix") == F.col("heavy")) & ~F.col("hot"), "left").withColumns({
            "prefix": F.when(F.col("one"), F.col("prefix")).when(F.col("heavy").isNotNull(), longer).otherwise(F.col("prefix")),
            "hot": F.col("hot") | F.coalesce("one", F.lit(False)),
        }).drop("heavy", "one")
        length *= LONGER


def masks(
    docs: DataFrame, text: str = "text", part: str = "lang", id_column: str = "doc_id", trie_bytes: int = TRIE_BYTES,
    prefix_bytes: int | None = None, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """(id, part, mask) of every row: bit n is set if it fails filter n of A to E.

    A null text is empty, a null part the empty string. A row is a duplicate (E)
    if its text is that of a row with a smaller id; rows alike in text and id
    are none of each other, and null ids come after all others. Long texts are
    compared in full. An empty table gives no rows; other columns are ignored.

    ``prefix_bytes`` is the text that a prefix may hold before it grows; by
    default a ``PREFIX_SHARE``-th of all text, but not less than ``LEAST_PREFIX``
    and not more than a range.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole_text(text).alias("text")
    )
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("part", T.StringType()), T.StructField("mask", T.IntegerType()),
        T.StructField("record", T.LongType()), T.StructField("own", T.LongType()), T.StructField("text", T.StringType()),
    ])
    # Written before records are used, so that they cannot change.
    held = rows.mapInArrow(_remember(trie_bytes, schema.names), schema)
    held = held.withColumns({"head": F.substring("text", 1, HEAD), "bytes": F.octet_length("text"), "chars": F.length("text")})
    held = settle(held, "audit-rows")
    narrow = held.where("mask is not null").select("id", "part", "mask", "record")
    total = held.agg(F.sum("bytes")).first()[0] or 0
    limit = prefix_bytes or min(range_bytes, max(LEAST_PREFIX, total // PREFIX_SHARE))
    texts = with_prefixes(held.where("mask is null").select("record", "own", "text", "head", "bytes", "chars"), limit)
    ranges = max(1, -(-total // range_bytes))
    placed = texts.where("not hot").select("prefix", "text", "record", "own").repartitionByRange(ranges, "prefix").sortWithinPartitions("prefix")
    least = placed.mapInArrow(_resolve(trie_bytes), "record long, least long")
    # A hot prefix is a whole text: minima are combined before they move, and joined back.
    hot = texts.where("hot").select("prefix", "record", "own")
    least = least.union(hot.join(hot.groupBy("prefix").agg(F.min("own").alias("least")), "prefix").select("record", "least"))
    least = settle(least, "audit-least")
    later = F.coalesce(F.col("id") > F.col("least"), F.col("least").isNotNull())
    mask = F.col("mask") + F.when(later, F.lit(1 << 4)).otherwise(F.lit(0))
    return narrow.join(least, "record").select("id", "part", mask.alias("mask"))


def audit(counts: DataFrame) -> DataFrame:
    """All orders of the filters for (part, mask, good, toxic, n).

    One row for each part, order and step, zeros included, with the rows kept
    and removed there, removed before though failing this filter, failing this
    filter only, the good and toxic ones among those removed, and the filter's
    removals summed over all orders.
    """
    orders = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"), F.lit(step + 1).alias("step"), F.lit(name).alias("filter"),
            F.lit(1 << FILTERS.index(name)).alias("own"), F.lit(sum(1 << FILTERS.index(f) for f in order[:step])).alias("before"),
        )
        for order in permutations(FILTERS)
        for step, name in enumerate(order)
    ]
    steps = counts.select("*", F.explode(F.array(*orders)).alias("o")).select("*", "o.*")
    mask, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails, reached = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) == 0

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    found = steps.groupBy("part", "filter_order", "step", "filter").agg(
        total(reached & ~fails).alias("kept"), total(reached & fails).alias("removed"), total(~reached & fails).alias("redundant"),
        total(mask == own).alias("unique_fails"), total(reached & fails & F.col("good")).alias("good_lost"),
        total(reached & fails & F.col("toxic")).alias("toxic_lost"),
    )
    found = settle(found, "audit-steps")
    shares = found.groupBy(F.col("part").alias("of"), F.col("filter").alias("by")).agg(F.sum("removed").cast("long").alias("shapley"))
    return found.join(shares, (F.col("part") == F.col("of")) & (F.col("filter") == F.col("by"))).drop("of", "by", "filter")


def audit_filters(
    docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "lang", id_column: str = "doc_id", **settings
) -> DataFrame:
    """``audit`` of the rows of ``docs``; ``labels`` has (``id_column``, quality, toxic).

    A row is good, or toxic, if any of its labels says 1; rows without a label
    are neither. Labels without a document count nothing.
    """
    marked = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    rows = masks(docs, text, part, id_column, **settings).join(marked, F.col("id") == F.col("of"), "left")
    keys = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")}
    counts = rows.select("part", "mask", *[v.alias(c) for c, v in keys.items()]).groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    return audit(settle(counts, "audit-counts"))
