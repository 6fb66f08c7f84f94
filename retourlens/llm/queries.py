"""One query per operator, over the whole tables the driver provides."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retourlens.llm import (
    bpe, bsi_search, chat, exact_dedup, filter_audit, jaccard, langid, licences, mixing, near_dedup, pii, quality, vector_codes,
)
from retourlens.llm.tables import read, whole_text

Query = Callable[[SparkSession, str], DataFrame]


def op1_bsi_topk(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return bsi_search.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = (langid.id_hash("doc_id") % 5 == 0).alias("held_out")
    model = langid.fit(docs.where(langid.id_hash("doc_id") % 5 != 0))
    return langid.identify(docs, model, carry=["doc_id"]).select("doc_id", held_out, "lang_pred", "score", "rejected")


def byte_bpe_50k() -> str:
    """Where the public byte-level vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark, sf_dir):
    path = byte_bpe_50k()
    ids = bpe.encode(read(spark, sf_dir, "documents"), path, carry=["doc_id"])
    return bpe.decode(ids, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _listed(spans) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op4_pii(spark, sf_dir):
    found = pii.detect(read(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = [_count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def op5_mix_sources(spark, sf_dir):
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"), keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_chat_format(spark, sf_dir):
    said = F.lit(chat.END + chat.START + "assistant ok")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    columns = ["conv_id", "turn", "role", "text"]
    turns = read(spark, sf_dir, "conversations").select(columns).unionByName(probe)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.read_back(chat.expand(turns)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_copies(read(spark, sf_dir, "documents"), carry=["doc_id"])


def op8_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    learn = docs.where(langid.id_hash("doc_id") % 3 != 1)
    held_out = (langid.id_hash("doc_id") % 3 == 1).alias("held_out")
    scored = quality.score(docs, quality.fit(learn, marks=labels), carry=["doc_id"])
    return scored.select("doc_id", held_out, "score", "predicted")


def op9_jaccard_join(spark, sf_dir):
    classes = jaccard.link_classes(read(spark, sf_dir, "documents"), words=4, percent=85)
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def repository_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source/hundreds/tens/id.txt; every tenth id is a licence file in the folder of its hundreds."""
    hundreds, tens = F.floor(F.col("doc_id") / 100), F.floor(F.col("doc_id") / 10) % 10
    top = F.concat_ws("/", "source", hundreds.cast("string"))
    file = F.concat_ws("/", top, tens.cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.withColumn("path", F.when(F.col("doc_id") % 10 == 0, F.concat(top, F.lit("/LICENSE"))).otherwise(file))


def op10_licence_scan(spark, sf_dir):
    files = repository_paths(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return licences.scan(files, carry=["doc_id", "path"])


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_minhash_dedup(spark, sf_dir):
    classes = near_dedup.near_classes(read(spark, sf_dir, "documents"), words=4, percent=80)
    own = F.col("id").eqNullSafe(F.col("component_id"))
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", own.alias("kept"))


def op13_vector_codes(spark, sf_dir):
    codes = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    rated = vector_codes.label_errors(codes.rows)
    books = hashlib.sha256(codes.listed().encode()).hexdigest()
    return rated.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books).alias("codebooks_sha256"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_bsi_topk": op1_bsi_topk,
        "op2_language_id": op2_language_id,
        "op3_bpe": op3_bpe,
        "op4_pii": op4_pii,
        "op5_mix_sources": op5_mix_sources,
        "op6_chat_format": op6_chat_format,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_quality": op8_quality,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_licence_scan": op10_licence_scan,
        "op11_filter_audit": op11_filter_audit,
        "op12_minhash_dedup": op12_minhash_dedup,
        "op13_vector_codes": op13_vector_codes,
    }
