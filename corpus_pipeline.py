"""From raw documents to a mixed, encoded corpus; each stage works on what its predecessor kept.

Stages but the last return the columns of documents, extra ones too, whatever
their names. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retourlens.llm import bpe, exact_dedup, jaccard, langid, mixing
from retourlens.llm.queries import byte_bpe_50k
from retourlens.llm.tables import read
from retourlens.session import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty ones too), or too far from every language of the
    labelled ones, go; if no document has a label, none is too far."""
    return langid.keep_identified(docs, langid.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, the document with the smallest id stays; null ids come
    last, and of rows alike in id and text one stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles and a similarity of 0.8 or more, the smallest id stays.
    Texts without a word all stay."""
    return jaccard.keep_one(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its sources takes it; a null source is one of its own."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, source and language with the packed token ids and what they decode to; whole texts,
    however long, a null text as an empty one. Ids are stored before they are decoded, so that no
    task holds a worker of each kind."""
    path = byte_bpe_50k()
    ids = settle(bpe.encode(docs, path, carry=["doc_id", "lang", "source"]), "pipeline-ids")
    return bpe.decode(ids, path).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("language id", identify_language), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix), ("BPE encoding and decoding", encode),
]

#: The language model and the encoder can't be written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs, f"pipeline-{number}")
    return docs
