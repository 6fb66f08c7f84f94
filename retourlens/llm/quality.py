"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.tables import free_name, whole_text
from retourlens.session import settle

#: Labelled rows that a model is fitted on, at about this number; the rest only count.
FIT_ROWS = 20_000
RESULTS = ["score", "predicted"]

#: Statistics of a document, in the order of the matrix.
STATISTICS = (
    "log_chars", "log_words", "log_lines", "letters", "upper", "digits", "spaces", "stops", "commas",
    "other_marks", "beyond_ascii", "word_length", "word_length_spread", "short_words", "long_words",
    "distinct_words", "top_word", "upper_words", "marked_words", "capital_words", "words_a_line",
    "line_ends_in_stop", "repeated_lines", "distinct_lines", "repeated_words", "distinct_chars",
    "longest_word", "empty_lines", "char_entropy", "digit_words",
)
_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _COMMA, _MARK, _WIDE = range(8)


def _classes() -> np.ndarray:
    """Class of every byte of UTF-8."""
    table = np.full(256, _MARK)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            table[b] = _WIDE
        elif c.isalpha():
            table[b] = _UPPER if c.isupper() else _LETTER
        elif c.isdigit():
            table[b] = _DIGIT
        elif c.isspace():
            table[b] = _SPACE
        elif c in ".!?":
            table[b] = _STOP
        elif c in ",;:":
            table[b] = _COMMA
    return table


_CLASS = _classes()


def statistics(text: str) -> np.ndarray:
    """All statistics of a whole text; zeros for an empty one."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    by_byte = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, weights=by_byte, minlength=8)
    total = len(data)
    used = by_byte[by_byte > 0] / total
    lines, words = text.split("\n"), text.split()
    full = [s for line in lines if (s := line.strip())]
    n, sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    distinct = set(full)
    out[:3] = np.log1p([len(text), n, len(full)])
    out[3] = (kinds[_LETTER] + kinds[_UPPER]) / total
    out[4] = kinds[_UPPER] / max(1.0, kinds[_LETTER] + kinds[_UPPER])
    out[5:11] = np.array([kinds[_DIGIT], kinds[_SPACE], kinds[_STOP], kinds[_COMMA], kinds[_MARK], kinds[_WIDE]]) / total
    if n:
        out[11:15] = sizes.mean(), sizes.std(), (sizes <= 2).mean(), (sizes >= 12).mean()
        out[15], out[16] = len(counts) / n, max(counts.values()) / n
        out[17] = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n
        out[18] = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?") / n
        out[19] = sum(c for w, c in counts.items() if w[0].isupper()) / n
        out[24] = sum(a == b for a, b in zip(words, words[1:])) / n
        out[26], out[29] = np.log1p(sizes.max()), sum(c for w, c in counts.items() if w[0].isdigit()) / n
    if full:
        out[20] = n / len(full)
        out[21] = sum(line[-1] in ".!?" for line in full) / len(full)
        out[22], out[23] = 1 - len(distinct) / len(full), len(distinct) / len(full)
    out[25], out[27] = len(used) / 256, 1 - len(full) / len(lines)
    out[28] = -(used * np.log2(used)).sum()
    return out


@dataclass
class Forest:
    """Full binary trees of one depth, flattened: node i has the children 2i+1 and 2i+2.

    ``feature`` and ``limit`` are (trees, inner nodes), ``value`` is (trees,
    leaves). A row goes right where its statistic is above the limit; a node
    that was not split sends every row left.
    """

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1, for all rows and trees at once."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(rows), 1 / (1 + np.exp(-self.start)))
        node = np.zeros((len(rows), trees), np.int64)
        tree, row = np.arange(trees), np.arange(len(rows))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (rows[row, self.feature[tree, node]] > self.limit[tree, node])
        return 1 / (1 + np.exp(-(self.start + self.value[tree, node - inner].sum(1))))


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64,
    least_weight: float = 2.0, shrink: float = 1.0,
) -> Forest:
    """Boost trees on the logistic loss from histograms of binned statistics."""
    inner = (1 << depth) - 1
    empty = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    if not len(rows):
        return empty
    mean = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    empty.start = float(np.log(mean / (1 - mean)))
    if labels.min() == labels.max():
        return empty
    n, width = rows.shape
    limits = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(limits[f], rows[:, f], "left") for f in range(width)], 1)
    flat = binned + np.arange(width) * bins
    margin, feature, limit, value = np.full(n, empty.start), [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, weight = labels - chance, chance * (1 - chance)
        node, features, cuts = np.zeros(n, np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            cell = ((node - first)[:, None] * (width * bins) + flat).ravel()
            size = count * width * bins
            by_slope = np.bincount(cell, np.repeat(slope, width), size).reshape(count, width, bins).cumsum(2)
            by_weight = np.bincount(cell, np.repeat(weight, width), size).reshape(count, width, bins).cumsum(2)
            all_slope, all_weight = by_slope[:, :, -1:], by_weight[:, :, -1:]
            gain = by_slope**2 / (by_weight + shrink) + (all_slope - by_slope) ** 2 / (all_weight - by_weight + shrink)
            gain -= all_slope**2 / (all_weight + shrink)
            gain[(by_weight < least_weight) | (all_weight - by_weight < least_weight)] = -1
            best = gain.reshape(count, -1).argmax(1)
            for k, at in enumerate(best):
                f, b = divmod(int(at), bins)
                if gain[k, f, b] > 1e-9 and b < len(limits[f]):
                    features[first + k], cuts[first + k] = f, limits[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), features[node]] > cuts[node])
        leaf = node - inner
        step = np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, weight, inner + 1) + shrink)
        margin += rate * step[leaf]
        feature.append(features), limit.append(cuts), value.append(rate * step)
    return Forest(np.array(feature), np.array(limit), np.array(value), empty.start)


def _with_statistics(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    value = free_name(docs, "value")
    rows = docs.select(*carry, whole_text(text).alias(value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([statistics(item.as_py()).tolist() for item in batch.column(value)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], made], [*carry, "statistics"])

    added = T.StructField("statistics", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in carry], added]))


def fit(
    labelled: DataFrame, text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS, marks: DataFrame | None = None,
    id_column: str = "doc_id", **settings,
) -> Forest:
    """Fit on about ``fit_rows`` different labelled texts, chosen by a hash of the text.

    Labels are a column of ``labelled``, or of ``marks``, which has one or more
    rows for an ``id_column``; then digests of texts meet the labels, and only
    texts chosen move. Copies of a text, however many, are one row with the mean
    of their labels. Rows without a label are left out; null texts count as
    empty. Rows are taken in a fixed order, so a repeated fit gives the same
    model. Without rows every score is 0.5.
    """
    value = whole_text(text)
    place = F.pmod(F.xxhash64(value, F.lit(8)), F.lit(1 << 30)) / float(1 << 30)
    own = {"key": F.xxhash64(value), "digest": F.unhex(F.md5(value.cast("binary"))), "place": place}
    narrow = [c.alias(n) for n, c in own.items()]
    if marks is None:
        rated = labelled.select(*narrow, F.col(label).cast("double").alias("label"))
    else:
        held = marks.select(F.col(id_column).alias("id"), F.col(label).cast("double").alias("label")).where("label is not null")
        rated = labelled.select(F.col(id_column).alias("id"), *narrow).join(held, "id").drop("id")
    rated = settle(rated.where("label is not null"), "quality-labels")
    different = rated.agg(F.approx_count_distinct("key")).first()[0]
    least = fit_rows / max(different, 1)
    means = rated.where(F.col("place") < least).groupBy("digest").agg(F.avg("label").alias("label"))
    means = settle(means, "quality-means")
    texts = labelled.select(value.alias("text"), own["place"].alias("place")).where(F.col("place") < least)
    texts = texts.select("text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    # At most about fit_rows means are sent; copies collapse within their tasks, before anything moves.
    chosen = texts.join(F.broadcast(means), "digest").groupBy("text").agg(F.first("label").alias("label"))
    got = sorted((tuple(r["statistics"]), r["label"]) for r in _with_statistics(chosen, "text", ["label"]).collect())
    matrix = np.array([s for s, _ in got]).reshape(-1, len(STATISTICS))
    return fit_trees(matrix, np.array([y for _, y in got]), **settings)


def score(docs: DataFrame, forest: Forest, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns unless given), ``score`` (chance of label 1) and ``predicted``.

    Every whole text is scored, null and empty ones by statistics of zero.
    Columns of these names are replaced; equal texts get equal scores.
    """
    carry = [c for c in (carry or docs.columns) if c.lower() not in RESULTS]
    value = free_name(docs, "value")
    rows = docs.select(*carry, whole_text(text).alias(value))
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            matrix = [statistics(item.as_py()) for item in batch.column(value)]
            scores = model.score(np.array(matrix).reshape(-1, len(STATISTICS)))
            results = [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype("int32"), pa.int32())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *results], [*carry, *RESULTS])

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in carry], *added]))
