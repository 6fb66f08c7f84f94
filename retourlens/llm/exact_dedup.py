"""Exact deduplication by Grace hash partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retourlens.llm.tables import SPACE, free_name, giving_back, whole_text
from retourlens.session import settle

#: Text that one task's table may hold, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS, MAX_LEVELS = 32 << 20, 64, 8
#: Rows and bytes of a batch that a task returns.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
GROUPS = "hash long, content string, keep_id long, copies long"
KEPT = "sha string, keep_id long, copies long"


def normalised(text: str) -> Column:
    """Each run of white space as one space; null is empty."""
    return F.regexp_replace(whole_text(text), f"[{SPACE}]+", " ")


class ContentTable:
    """Open-addressing table from whole contents to (smallest id, copies)."""

    def __init__(self, slots: int = 1 << 10):
        self.slots: list[int] = [-1] * slots
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, key: int, content: bytes, smallest, copies: int) -> None:
        mask = len(self.slots) - 1
        at = key & mask
        while (entry := self.slots[at]) >= 0:
            held = self.entries[entry]
            if held[0] == key and held[1] == content:
                held[3] += copies
                if smallest is not None and (held[2] is None or smallest < held[2]):
                    held[2] = smallest
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.entries.append([key, content, smallest, copies])
        self.bytes += len(content)
        if 2 * len(self.entries) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, (key, *_) in enumerate(self.entries):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _batches(entries: list[list]) -> Iterator[pa.RecordBatch]:
    """Entries as batches of bounded size."""
    part, held = [], 0
    for entry in entries:
        part.append(entry)
        held += len(entry[1])
        if len(part) == BATCH_ROWS or held >= BATCH_BYTES:
            yield _batch(part)
            part, held = [], 0
    if part:
        yield _batch(part)


def _batch(part: list[list]) -> pa.RecordBatch:
    keys, contents, ids, copies = zip(*part)
    texts = pa.array(contents, pa.binary()).cast(pa.string())
    columns = [pa.array(keys, pa.int64()), texts, pa.array(ids, pa.int64()), pa.array(copies, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["hash", "content", "keep_id", "copies"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    contents = batch.column("content").cast(pa.binary())
    keys, ids, copies = (batch.column(c).to_pylist() for c in ("hash", "keep_id", "copies"))
    return zip(keys, (c.as_py() for c in contents), ids, copies)


def _collapser(limit: int):
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copies that one task meets, as one row; the table is emptied when full."""
        table = ContentTable()
        for batch in batches:
            for row in _rows(batch):
                table.add(*row)
                if table.bytes >= limit:
                    yield from _batches(table.entries)
                    table = ContentTable()
        yield from _batches(table.entries)

    return giving_back(collapse)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets arrive one after another; each has a table of its own."""

    def result(table: ContentTable) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(table.entries), BATCH_ROWS):
            part = table.entries[start : start + BATCH_ROWS]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(e[1]).hexdigest() for e in part], pa.string()),
                    pa.array([e[2] for e in part], pa.int64()),
                    pa.array([e[3] for e in part], pa.int64()),
                ],
                ["sha", "keep_id", "copies"],
            )

    table, current = ContentTable(), None
    for batch in batches:
        for bucket, row in zip(batch.column("bucket").to_pylist(), _rows(batch)):
            if bucket != current:
                yield from result(table)
                table, current = ContentTable(), bucket
            table.add(*row)
    yield from result(table)


def distinct_contents(records: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(sha, keep_id, copies) of each distinct ``content`` of (hash, content, keep_id, copies).

    Records, collapsed within each task, are written to spill files in the
    shared folder. Buckets of their hash that hold more than ``bucket_bytes``
    are read again, collapsed and spilt by further bits of the hash, until each
    fits a task's table or is one hash. A content held by a third of all rows
    thus comes to at most one row a task, and to one row when spilt again.
    """
    collapse = _collapser(bucket_bytes)
    spill, ready = settle(records.mapInArrow(collapse, GROUPS), "dedup-spill0"), []
    for level in range(MAX_LEVELS):
        total = spill.agg(F.sum(F.octet_length("content"))).first()[0] or 0
        buckets = max(LEAST_BUCKETS, -(-2 * total // bucket_bytes))
        number = F.pmod(F.xxhash64(F.lit(level), F.col("hash")), F.lit(buckets))
        spill = spill.withColumn("bucket", F.concat(F.lit(f"{level}."), number.cast("string")))
        sized = spill.groupBy("bucket").agg(F.sum(F.octet_length("content")).alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        large = settle(sized.where((F.col("bytes") > bucket_bytes) & (F.col("low") != F.col("high"))).select("bucket"), f"dedup-large{level}")
        if level + 1 == MAX_LEVELS or large.isEmpty():
            ready.append((spill, buckets))
            break
        ready.append((spill.join(large, "bucket", "left_anti"), buckets))
        again = spill.join(large, "bucket", "left_semi").drop("bucket")
        again = again.repartition(buckets, F.xxhash64(F.lit(-1 - level), F.col("hash")))
        spill = settle(again.mapInArrow(collapse, GROUPS), f"dedup-spill{level + 1}")
    columns = ["bucket", "hash", "content", "keep_id", "copies"]
    rows = ready[0][0].select(columns)
    for other, _ in ready[1:]:
        rows = rows.unionByName(other.select(columns))
    placed = rows.repartition(sum(n for _, n in ready), "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(giving_back(_finish), KEPT)


def _groups(docs: DataFrame, text: str, id_column: str, bucket_bytes: int) -> DataFrame:
    """(sha, keep_id, copies) of each group of equal texts, written."""
    records = docs.select(
        F.xxhash64(normalised(text)).alias("hash"), normalised(text).alias("content"),
        F.col(id_column).cast("long").alias("keep_id"), F.lit(1).cast("long").alias("copies"),
    )
    return settle(distinct_contents(records, bucket_bytes), "dedup-groups")


def mark_copies(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", bucket_bytes: int = BUCKET_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with the group of equal texts it belongs to.

    Returns the columns ``carry`` (those of ``docs`` unless given) and keep_id,
    group_size, kept, text_sha256; columns of those names are replaced. Texts
    are equal when identical after each run of white space is one space; null
    is empty. The smallest id stays, null ids come last; rows alike in text and
    id are all marked kept (``deduplicate`` leaves one). An empty table gives
    an empty result.
    """
    results = ["keep_id", "group_size", "kept", "text_sha256"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in results]
    content, sha = free_name(docs, "content"), free_name(docs, "sha")
    groups = _groups(docs, text, id_column, bucket_bytes).alias("groups")
    rows = docs.withColumn(content, normalised(text)).withColumn(sha, F.sha2(content, 256)).alias("rows")
    own = F.col(f"rows.`{id_column}`").eqNullSafe(F.col("groups.keep_id"))
    return rows.join(groups, F.col(f"rows.`{sha}`") == F.col("groups.sha")).select(
        *[F.col(f"rows.`{c}`") for c in carry], F.col("groups.keep_id").alias("keep_id"),
        F.col("groups.copies").alias("group_size"), own.alias("kept"), F.col("groups.sha").alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the smallest id.

    Rows move once, to their (text, id): copies have ids of their own, so a
    group with a third of all rows is spread, and rows alike in both meet.
    """
    key = ["sha", "id", "no_id"]

    def parts(sha: Column, id_: Column) -> list[Column]:
        # Plain columns, so that the join's partitions serve the last step too.
        return [sha.alias("sha"), F.coalesce(id_, F.lit(0).cast("long")).alias("id"), id_.isNull().alias("no_id")]

    stay = _groups(docs, text, id_column, bucket_bytes).select(*parts(F.col("sha"), F.col("keep_id")))
    boxed = docs.select(F.struct("*").alias("row"), *parts(F.sha2(normalised(text), 256), F.col(id_column).cast("long")))
    return boxed.join(stay, key, "left_semi").dropDuplicates(key).select("row.*")
