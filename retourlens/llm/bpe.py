"""Byte-level BPE encoding by tree concatenation, and decoding.

Byte pair merges never look further than adjacent tokens: a sequence of tokens
is the encoding of its bytes exactly when each pair of neighbours is the
encoding of the pair's bytes. So two encoded halves are joined by encoding a
window around the join anew; where the window's first and last token get along
with the tokens outside, the result is the encoding of the whole, else the
window grows. Words of a text are joined alike: a window of words is split
anew until a word boundary agrees with one of the right half.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.tables import free_name, giving_back, whole_text, with_results

# The word pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters at the end of a piece that its word pattern may see otherwise once text follows.
UNSURE = 3
#: Bytes of a run that are merged at once; longer runs are halved.
LEAF_BYTES = 256
#: Encoded words that a task remembers.
CACHE_WORDS = 50_000
#: Texts with more characters are cut into pieces of this size, encoded in parallel.
PIECE_CHARS = 1 << 16
BATCH_BYTES = 4 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, by letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters, vocab = byte_letters(), stored["model"]["vocab"]
        added = {t["content"]: t["id"] for t in stored.get("added_tokens", [])}
        self.pieces = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, number in vocab.items():
            self.pieces[number] = bytes(letters[c] for c in token)
        for content, number in added.items():
            self.pieces[number] = content.encode()
        self.single = {self.pieces[vocab[c]][0]: vocab[c] for c in letters if c in vocab}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.added = added
        results = [merged for _, merged in self.merges.values()]
        made = [self.single[b] for b in range(256) if b in self.single] + results
        #: Whether ids rank the merges, one way to make each token; a compiled merger can then be used.
        self.ranked = results == sorted(results) and len(set(made)) == len(made) == 256 + len(results)

    def __getstate__(self) -> dict:
        """What travels to tasks: the merges only if they are used there."""
        return self.__dict__ | ({"merges": {}} if self.ranked else {})


class Encoder:
    """Encodes words and texts with one vocabulary; remembers words it has seen."""

    def __init__(self, vocabulary: Vocabulary, leaf_bytes: int = LEAF_BYTES):
        self.vocabulary, self.leaf_bytes = vocabulary, leaf_bytes
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.find = regex.compile(WORDS).findall
        if vocabulary.ranked:
            ranks = {p: i for i, p in enumerate(vocabulary.pieces) if p and i not in vocabulary.added.values()}
            compiled = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            self.merge = compiled._encode_single_piece
        marks = sorted(vocabulary.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def merge(self, data: bytes) -> list[int]:
        """Merge neighbours by rank, leftmost first, until none is left."""
        single, merges = self.vocabulary.single, self.vocabulary.merges
        ids = [single[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, merged, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = merged, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if found := merges.get((merged, ids[after[j]])):
                    heapq.heappush(heap, (*found, i, merged, ids[after[j]]))
            if before[i] >= 0 and (found := merges.get((ids[before[i]], merged))):
                heapq.heappush(heap, (*found, before[i], ids[before[i]], merged))
        return [t for t in ids if t >= 0]

    def agree(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are beside each other."""
        known = self.pairs.get((left, right))
        if known is None:
            pieces = self.vocabulary.pieces
            known = self.pairs[left, right] = self.merge(pieces[left] + pieces[right]) == [left, right]
            if len(self.pairs) > CACHE_WORDS:
                self.pairs.clear()
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings within one word."""
        if not left or not right:
            return left + right
        pieces, width = self.vocabulary.pieces, 1
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.merge(b"".join(pieces[t] for t in left[a:] + right[:b]))
            if (a == 0 or self.agree(left[a - 1], window[0])) and (b == len(right) or self.agree(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def run(self, data: bytes) -> list[int]:
        """Encode one word; long ones by halves."""
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.run(data[:half]), self.run(data[half:]))

    def word(self, word: str) -> bytes:
        """The ids of a word, packed."""
        packed = self.words.get(word)
        if packed is None:
            packed = np.array(self.run(word.encode()), "<u4").tobytes()
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = packed
        return packed

    def split(self, text: str) -> list[str]:
        """Stretches of text and, at odd places, the added tokens between them."""
        return self.marks.split(text) if self.marks else [text]

    def text(self, text: str) -> bytes:
        """The ids of a text, packed as little-endian 32-bit integers."""
        known, out = self.words, []
        for place, part in enumerate(self.split(text)):
            if place % 2:
                out.append(np.array([self.vocabulary.added[part]], "<u4").tobytes())
            else:
                out += [known.get(w) or self.word(w) for w in self.find(part)]
        return b"".join(out)

    def join_words(self, left: tuple[list, list], right: tuple[list, list]) -> tuple[list, list]:
        """Words and their packed ids of two pieces of one stretch of text, as of the whole."""
        (words, ids), (others, other_ids) = left, right
        if not words or not others:
            return words + others, ids + other_ids
        width, n_left = 1, len(words)
        while True:
            a = max(0, n_left - width)
            while a and sum(map(len, words[a:])) < UNSURE:
                a -= 1
            b = min(len(others), width)
            tail, head = "".join(words[a:]), "".join(others[:b])
            window, end = self.find(tail + head), len(tail) + len(head)
            limit = end if b == len(others) else end - UNSURE
            boundaries = {len(tail) + n: i for i, n in enumerate(accumulate(map(len, others[:b]), initial=0))}
            for count, at in enumerate(accumulate(map(len, window)), 1):
                if at in boundaries and at <= limit:
                    new = [
                        np.array(self.join(self._ids(ids[-1]), self._ids(other_ids[0])), "<u4").tobytes()
                        if w == words[-1] + others[0] and len(w) > 64 else self.word(w)
                        for w in window[:count]
                    ]
                    kept = boundaries[at]
                    return words[:a] + window[:count] + others[kept:], ids[:a] + new + other_ids[kept:]
            width *= 2

    @staticmethod
    def _ids(packed: bytes) -> list[int]:
        return np.frombuffer(packed, "<u4").tolist()


def _tree(encoder: Encoder, parts: list[tuple[list, list]]) -> tuple[list, list]:
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [encoder.join_words(*p) if len(p) == 2 else p[0] for p in pairs]
    return parts[0]


def _by_bytes(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[slice]:
    """Consecutive rows of a batch with a bounded sum of sizes."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= BATCH_BYTES:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def _mapper(text: str, carry: list[str], output: str, kind: pa.DataType, convert):
    """A function for mapInArrow: the columns to carry, and one made of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = convert()
        for batch in batches:
            values = batch.column(text)
            lengths = pc.binary_length(values).fill_null(0).to_pylist()
            for rows in _by_bytes(batch, lengths):
                part = batch.slice(rows.start, rows.stop - rows.start)
                made = pa.array([work(v.as_py()) for v in part.column(text)], kind)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carry], made], [*carry, output])

    return giving_back(run)


def _schema(df: DataFrame, carry: list[str], *added: T.StructField) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in carry], *added])


def encode(
    docs: DataFrame, vocabulary_path: str, text: str = "text", output: str = "ids", carry: list[str] | None = None,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """``carry`` (all columns unless given) and ``ids``, the packed ids of each text.

    Ids are little-endian unsigned 32-bit integers in one binary value
    (``unpack`` gives an array). Null and empty texts have none; a column named
    as the output is replaced. Texts of more than ``piece_chars`` characters are
    cut into pieces, which tasks encode in parallel; the pieces of one text meet
    again to be joined. Equal long texts are encoded once. An empty table gives
    an empty result.
    """
    docs = docs if carry else with_results(docs, [output])
    carry = [c for c in (carry or docs.columns)]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))
    value = free_name(docs, "value")
    rows = docs.select(*carry, whole_text(text).alias(value))
    long = F.length(value) > piece_chars
    ids = T.StructField(output, T.BinaryType())
    one_by_one = _mapper(value, carry, output, pa.binary(), lambda: Encoder(shared.value).text)
    short = rows.where(~long).mapInArrow(one_by_one, _schema(rows, carry, ids))

    key = free_name(docs, "key")
    keyed = rows.where(long).withColumn(key, F.sha2(value, 256))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for own, whole in zip(batch["key"], batch["value"]):
                parts = [
                    (own, stretch, at // piece_chars, part[at : at + piece_chars])
                    for stretch, part in enumerate(encoder.split(whole))
                    for at in range(0, max(1, len(part)), piece_chars)
                ]
                yield pd.DataFrame(parts, columns=["key", "stretch", "piece", "part"])

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for batch in batches:
            words = [
                [p] if s % 2 else encoder.find(p) for s, p in zip(batch["stretch"], batch["part"])
            ]
            packed = [
                [encoder.text(p)] if s % 2 else [encoder.word(w) for w in ws]
                for s, p, ws in zip(batch["stretch"], batch["part"], words)
            ]
            yield pd.DataFrame({
                "key": batch["key"], "stretch": batch["stretch"], "piece": batch["piece"], "part": batch["part"],
                "chars": [np.array([len(w) for w in ws], "<u4").tobytes() for ws in words],
                "counts": [np.array([len(b) // 4 for b in bs], "<u4").tobytes() for bs in packed],
                "packed": [b"".join(bs) for bs in packed],
            })

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Texts arrive one after another, their pieces in order."""
        encoder, current, stretch, parts, out = Encoder(shared.value), None, None, [], []
        for batch in batches:
            for row in batch.itertuples():
                if parts and (row.key, row.stretch) != (current, stretch):
                    out += _tree(encoder, parts)[1]
                    parts = []
                if current is not None and row.key != current:
                    yield pd.DataFrame({"key": [current], "packed": [b"".join(out)]})
                    out = []
                current, stretch = row.key, row.stretch
                ends = np.cumsum(np.frombuffer(row.chars, "<u4")).tolist()
                stops = (4 * np.cumsum(np.frombuffer(row.counts, "<u4"))).tolist()
                words = [row.part[a:b] for a, b in zip([0, *ends], ends)]
                parts.append((words, [row.packed[a:b] for a, b in zip([0, *stops], stops)]))
        if current is not None:
            yield pd.DataFrame({"key": [current], "packed": [b"".join(out + _tree(encoder, parts)[1])]})

    texts = keyed.select(F.col(key).alias("key"), F.col(value).alias("value")).dropDuplicates(["key"])
    pieces = texts.mapInPandas(giving_back(cut), "key string, stretch long, piece long, part string")
    spread = pieces.repartition(F.col("key"), F.col("stretch"), F.col("piece"))
    encoded = spread.mapInPandas(
        giving_back(leaves), "key string, stretch long, piece long, part string, chars binary, counts binary, packed binary"
    )
    met = encoded.repartition("key").sortWithinPartitions("key", "stretch", "piece")
    joined = met.mapInPandas(giving_back(whole), "key string, packed binary")
    joined = joined.select(F.col("key").alias(key), F.col("packed").alias(output))
    return short.unionByName(keyed.join(joined, key).select(*carry, output))


def unpack(ids: str) -> Column:
    """Packed ids as an array of integers."""
    count = (F.octet_length(ids) / 4).cast("int")

    def number(i: Column) -> Column:
        digits = [F.hex(F.substring(F.col(ids), i * 4 + k, F.lit(1))) for k in (4, 3, 2, 1)]
        return F.conv(F.concat(*digits), 16, 10).cast("long")

    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), number)).otherwise(
        F.array().cast("array<bigint>")
    )


def decode(
    encoded: DataFrame, vocabulary_path: str, ids: str = "ids", output: str = "decoded", carry: list[str] | None = None
) -> DataFrame:
    """``carry`` (all columns unless given) and the text of packed ids.

    Bytes that are no UTF-8 become replacement characters; null ids give an
    empty text. Added tokens give their content.
    """
    carry = [c for c in (carry or encoded.columns) if c.lower() != output.lower()]
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path).pieces)
    value = free_name(encoded, "value")
    rows = encoded.select(*carry, F.col(ids).alias(value))

    def decoder():
        piece = shared.value.__getitem__
        return lambda packed: b"".join(map(piece, np.frombuffer(packed or b"", "<u4").tolist())).decode("utf-8", "replace")

    run = _mapper(value, carry, output, pa.string(), decoder)
    return rows.mapInArrow(run, _schema(rows, carry, T.StructField(output, T.StringType())))
