"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.tables import free_name, giving_back
from retourlens.session import settle

#: Hash buckets of character n-grams, and the longest n-gram.
DIMS, LONGEST = 1 << 12, 3
#: Language of texts without a letter, and of texts no centroid is near enough to.
UNDETERMINED = "und"
#: Part of the usual similarity (of texts of like length) under which a text is rejected.
REJECT_BELOW = 0.5
#: Length classes are powers of two of the letters and word ends.
LENGTH_CLASSES = 32
RESULTS = ["lang_pred", "score", "rejected"]

# Odd multipliers for hashing n-grams of 1, 2 and 3 characters.
_MIX = [np.uint32(m) for m in (2654435761, 2246822519, 3266489917)]
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter; made once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngram_counts(text: str) -> tuple[np.ndarray, int]:
    """Counts of hashed n-grams of the lower-cased text, other characters than
    letters as one gap; and how many letters and gaps there are, 0 without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[codes]
    if not letter.any():
        return np.zeros(DIMS, np.int64), 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.where(letter, codes, 32)[keep]
    codes = np.concatenate(([32], codes, [32] if codes[-1] != 32 else [])).astype(np.uint32)
    counts = np.zeros(DIMS, np.int64)
    mixed = np.zeros(len(codes), np.uint32)
    for n in range(LONGEST):
        if len(codes) <= n:
            break
        mixed = (mixed[: len(codes) - n] ^ codes[n:]) * _MIX[n]
        mixed ^= mixed >> np.uint32(15)
        counts += np.bincount((mixed * _MIX[0]) >> np.uint32(20), minlength=DIMS)
    return counts, len(codes)


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A vector of length 1 (or 0) from counts."""
    vector = np.log1p(counts) * idf
    length = np.sqrt(vector @ vector)
    return vector / length if length else vector


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from a start that spreads the centroids; the same at each run."""
    centroids = [vectors.mean(0)]
    near = vectors @ centroids[0]
    for _ in range(min(k, len(vectors)) - 1):
        centroids.append(vectors[int(np.argmin(near))])
        near = np.maximum(near, vectors @ centroids[-1])
    found = np.stack(centroids)
    for _ in range(rounds):
        own = np.argmax(vectors @ found.T, 1)
        for c in range(len(found)):
            if (own == c).any():
                found[c] = vectors[own == c].mean(0)
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
    return found


@dataclass
class Model:
    """Weights of n-grams, centroids with their languages, and the least
    similarity by length class; of bounded size whatever was learned from."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray = field(default_factory=lambda: np.zeros(LENGTH_CLASSES))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Nearest language, cosine, and whether even that is too far."""
        counts, size = ngram_counts(text or "")
        if not size or not self.languages:
            return UNDETERMINED, 0.0, True
        near = self.centroids @ tfidf(counts, self.idf)
        best = int(np.argmax(near))
        score = float(min(1.0, max(0.0, near[best])))
        return self.languages[best], score, bool(score < self.least[min(LENGTH_CLASSES - 1, size.bit_length())])


def id_hash(id_column: str) -> Column:
    """crc32 of the id as text, 0 without an id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(0).cast("long"))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's texts each n-gram occurs; number -1 counts the texts."""
    total, texts = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for item in batch.column(0):
            total += ngram_counts(item.as_py())[0] > 0
            texts += 1
    numbers = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *numbers.tolist()], pa.int64()), pa.array([texts, *total[numbers].tolist()], pa.int64())],
        ["gram", "n"],
    )


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", centroids_per_language: int = 3,
    sample_per_language: int = 300, reject_below: float = REJECT_BELOW,
) -> Model:
    """Learn from rows with text and language; rows without are left out.

    Document frequencies count every row. Centroids and similarities come from
    about ``sample_per_language`` different whole texts of each language, chosen by
    a hash of the text and taken once however many copies there are, clustered in
    one task a language. The driver holds the result, which grows with the number
    of languages only. Without rows it knows none.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counted = rows.select("text").mapInArrow(giving_back(_document_counts), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    frequency = np.zeros(DIMS + 1)
    for gram, n in counted.collect():
        frequency[gram] = n
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1

    # Written, so that Spark knows how small it is and leaves the texts where they are.
    sizes = settle(rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("texts")), "languages")
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    # Copies are chosen together, so they collapse within their tasks, before anything moves.
    sample = rows.join(sizes, "lang").where(place * F.col("texts") < sample_per_language).select("lang", "text").distinct()

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        made = [(tfidf(c, idf), size) for c, size in map(ngram_counts, sorted(group["text"])) if size]
        if not made:
            return pd.DataFrame({"lang": [], "centroids": [], "near": [], "sizes": []})
        vectors = np.stack([v for v, _ in made])
        found = cluster(vectors, centroids_per_language)
        return pd.DataFrame({
            "lang": group["lang"].iloc[:1], "centroids": [found.ravel().tolist()],
            "near": [(vectors @ found.T).max(1).tolist()], "sizes": [[s.bit_length() for _, s in made]],
        })

    schema = "lang string, centroids array<double>, near array<double>, sizes array<int>"
    learned = sorted(sample.groupBy("lang").applyInPandas(learn, schema).collect(), key=lambda r: r["lang"])
    if not learned:
        return Model(idf, np.zeros((0, DIMS)), [])
    blocks = [np.array(r["centroids"]).reshape(-1, DIMS) for r in learned]
    near = np.concatenate([r["near"] for r in learned])
    classes = np.minimum(np.concatenate([r["sizes"] for r in learned]), LENGTH_CLASSES - 1)
    names = [r["lang"] for r, b in zip(learned, blocks) for _ in b]
    return Model(idf, np.concatenate(blocks), names, _least(near, classes, reject_below))


def _least(near: np.ndarray, classes: np.ndarray, part: float) -> np.ndarray:
    """Similarity below which a text of each length class is rejected.

    A part of the low end of its class; longer texts are more similar, so a
    class without enough examples takes the limit of the next shorter one, and
    the shortest reject nothing.
    """
    least = np.zeros(LENGTH_CLASSES)
    for c in range(1, LENGTH_CLASSES):
        own = near[classes == c]
        least[c] = part * np.quantile(own, 0.02) if len(own) >= 10 else least[c - 1]
    return least


def identify(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns unless given), ``lang_pred``, ``score`` and ``rejected``.

    ``lang_pred`` is the nearest language, ``score`` the cosine to its centroid
    (0 to 1). Texts that are null or have no letter are ``und``, score 0,
    rejected. ``rejected`` also marks texts too far from every centroid. Columns
    of these names are replaced; equal rows get equal results.
    """
    carry = [c for c in (carry or docs.columns) if c.lower() not in RESULTS]
    value = free_name(docs, "value")
    rows = docs.select(*carry, F.col(text).alias(value))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(item.as_py()) for item in batch.column(value)]
            langs, scores, rejected = zip(*found) if found else ((), (), ())
            results = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *results], [*carry, *RESULTS])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in carry], *added]))


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``identify`` rejects; all columns stay, whatever their names.

    Texts that are null or have no letter go. If ``model`` knows no language, as
    when every label is null, no other text is rejected: nothing can be too far
    from what was not learned. Repeated rows are judged alike; an empty table
    stays empty. Only the text goes to Python, the flag comes back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        fits = (lambda t: not known.predict(t)[2]) if known.languages else (lambda t: ngram_counts(t or "")[1] > 0)
        for texts in batches:
            yield texts.map(fits).astype(bool)

    @F.pandas_udf("boolean")
    def stays(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from giving_back(run)(batches)

    return docs.where(stays(F.col(text)))
