"""Mixing sources to target weights by nested hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retourlens.llm.tables import SPACE, free_name, whole_text, with_results
from retourlens.session import settle

#: Bits of a row's hash, and how many of them one histogram resolves.
HASH_BITS, STEP_BITS = 48, 12
RESULTS = ["size", "source_size", "target", "copies", "taken"]


def words(text: str) -> Column:
    """Number of runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def row_hash(id_column: str, text: str, seed: int) -> Column:
    """48 bits that depend on the row alone, so that reruns and retries agree."""
    whole = F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), whole_text(text)
    )
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key(source: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, ceiling: float) -> DataFrame:
    """Words to take of each source, from one row (key, source, source_size) a source.

    Sources by code point, null last, have the weights in turn and share
    ``share`` times all words. A target stops at ``ceiling`` times its source;
    what is too much goes to the others by weight until none is above. In order
    of size by weight the full sources come first, so the level that all others
    reach follows from running sums. One row a source meets in one task here.
    """
    # Casts keep whole numbers exact up to 2**53, the same in any order of summing.
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_level = W.orderBy("full_at", "turn")
    every = W.partitionBy(F.lit(0))
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, W.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    levels = (
        sizes.withColumn("turn", F.row_number().over(order))
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", ceiling * F.col("source_size").cast("double"))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("whole", share * F.sum("source_size").over(every).cast("double"))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("whole") - F.col("full")) / F.sum("weight").over(after))
    )
    reached = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "turn", "level"))).over(every)
    target = F.least("cap", F.coalesce(F.col("weight") * reached["level"], F.col("cap")))
    return levels.withColumn("target", target).select("key", "source_size", "target")


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Whole passes over each source, and the hash below which it is taken once more.

    ``rows`` has (key, hash, size). Words are summed by source and leading hash
    bits; only the bucket where the running sum reaches the rest of the budget
    is summed again by its next bits, until a bucket is one hash. That hash is
    taken if this comes nearer to the budget.
    """
    step, last = 1 << STEP_BITS, HASH_BITS // STEP_BITS
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = settle(
        goals.withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long")),
        "mix-goals",
    )
    cuts = state.where("rest <= 0").select("key", F.lit(0).cast("long").alias("cut"))
    running = state.where("rest > 0").select("key", "rest", "prefix")
    in_order = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    for level in range(1, last + 1):
        shift = HASH_BITS - level * STEP_BITS
        inside = rows.join(running, "key").where(F.shiftright("hash", shift + STEP_BITS) == F.col("prefix"))
        found = (
            inside.groupBy("key", "rest", "prefix", (F.shiftright("hash", shift) % step).alias("bucket"))
            .agg(F.sum("size").alias("words"))
            .withColumn("sum", F.sum("words").over(in_order))
            .where(F.col("sum") >= F.col("rest"))
            .groupBy("key", "rest", "prefix")
            .agg(F.min(F.struct("bucket", "words", "sum")).alias("at"))
        )
        rest = F.col("rest") - (F.col("at.sum") - F.col("at.words"))
        running = found.select(
            "key", rest.alias("rest"), (F.col("prefix") * step + F.col("at.bucket")).alias("prefix"),
            (F.col("at.words") - rest < rest).cast("long").alias("taken"),
        )
        if level < last:
            running = running.drop("taken")
        running = settle(running, f"mix-level{level}")
    cuts = cuts.unionByName(running.select("key", (F.col("prefix") + F.col("taken")).alias("cut")))
    return settle(state.join(cuts, "key").select("key", "source_size", "target", "passes", "cut"), "mix-cuts")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0, seed: int = 0,
    text: str = "text", id_column: str = "doc_id", source: str = "source", keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with how often the mix takes it.

    Adds ``size`` (words), ``source_size`` and ``target`` (of its source),
    ``copies`` (0 to ``ceiling``) and ``taken`` (``copies * size``); columns of
    those names are replaced. ``copies`` is the number of whole passes, and one
    more where the row's hash lies below its source's threshold, so no row is
    sorted. A null text has size 0, a null source is a source of its own, rows
    alike in id and text share one fate, an empty table gives an empty result.
    ``keep_text=False`` returns only id, source and results, from the small
    table of sizes, without a second scan of the texts.
    """
    key, hashed = free_name(docs, "key"), free_name(docs, "hash")
    base = with_results(docs, RESULTS)
    sized = base.withColumns({"size": words(text), hashed: row_hash(id_column, text, seed), key: source_key(source)})
    small = settle(
        sized.select(
            F.col(id_column).alias("id"), F.col(source).alias("source"), "size",
            F.col(hashed).alias("hash"), F.col(key).alias("key"),
        ),
        "mix-sizes",
    )
    sizes = small.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    cuts = thresholds(small.select("key", "hash", "size"), targets(sizes, weights, share, ceiling))
    if not keep_text:
        sized = small.select(
            F.col("id").alias(id_column), F.col("source").alias(source), "size",
            F.col("hash").alias(hashed), F.col("key").alias(key),
        )
    cuts = cuts.select(F.col("key").alias(key), "source_size", "target", "passes", "cut")
    copies = (F.col("cuts.passes") + (F.col(f"rows.{hashed}") < F.col("cuts.cut")).cast("long")).alias("copies")
    marked = sized.alias("rows").join(cuts.alias("cuts"), F.col(f"rows.{key}") == F.col(f"cuts.{key}"))
    kept = [F.col(f"rows.`{c}`") for c in sized.columns if c not in (key, hashed)]
    return marked.select(*kept, "cuts.source_size", "cuts.target", copies).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def take(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", source: str = "source", **settings
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix_sources`` takes it.

    All columns stay as they are, whatever their names; a row without words, or
    of a source that gets none, may be taken never. Rows alike in id and text
    share one fate.
    """
    boxed = docs.select(F.struct("*").alias("row"))
    mixed = mix_sources(boxed, text=f"row.{text}", id_column=f"row.{id_column}", source=f"row.{source}", **settings)
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("once")
    return mixed.where("copies > 0").select("row", once).select("row.*")
