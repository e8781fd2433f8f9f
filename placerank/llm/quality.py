"""Quality classifier: supervised subword embeddings.

A text's features are its words, their byte n-grams between word marks, and its word pairs, all hashed into one table
of vectors. A word is the mean of its own vector and those of its n-grams; a text is the mean of its words and word
pairs; a softmax over two classes follows. Vectors and output are learned by plain stochastic gradient descent in numpy, one
text a step with a falling rate, on at most `sample` labelled texts, chosen by a hash of doc_id (the bound is this parameter).

Scoring: output times table is one number per bucket (a few MB whatever the corpus), so a task needs one sum per distinct word
of a chunk and one look-up per word and pair. Whole texts are read; nothing is shuffled.

Defined results: null and empty texts get the score of the bias alone. A null doc_id is held out. Several labels of one
doc_id are averaged, 0.5 and more is 1; null labels are ignored. Without any label, or with one class only, the score is that of the
prior. Repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import chunks, crc32_mod, mix, spread, word_hashes, words

BUCKETS, DIMENSIONS, NGRAMS = 1 << 18, 16, (3, 4)
#: bytes of text scored at once
CHUNK = 4 << 20
SCORES = "doc_id long, held_out boolean, score double, predicted int"


def ngram_buckets(entries: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry number, bucket) of each word's own feature and its n-grams."""
    joined = np.frombuffer(b"".join(b"<" + e + b">" for e in entries), np.uint8)
    lengths = np.fromiter((len(e) + 2 for e in entries), np.int64, len(entries))
    number = np.repeat(np.arange(len(entries), dtype=np.int32), lengths)
    left = np.repeat(np.cumsum(lengths, dtype=np.int32), lengths) - np.arange(len(joined), dtype=np.int32)  # bytes of the word from here on
    numbers, found = [np.arange(len(entries))], [hashes]
    for n in NGRAMS:
        at = np.flatnonzero(left >= n)
        gram = np.zeros(len(at), np.uint64)
        for i in range(n):
            gram |= joined[at + i].astype(np.uint64) << np.uint64(8 * i)
        numbers.append(number[at])
        found.append(mix(gram + (np.uint64(n) << np.uint64(56))))
    return np.concatenate(numbers), (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words, from the words' hashes."""
    with np.errstate(over="ignore"):
        return (mix(hashes[:-1] * np.uint64(3) + mix(hashes[1:])) % np.uint64(BUCKETS)).astype(np.int64)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, weights) of a text; the weights sum to 1, or there are none."""
    import xxhash

    parts = text.split()
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    entries, counts = np.unique(np.array(parts, object), return_counts=True)
    entries = entries.tolist()
    hash_of = {w: xxhash.xxh64_intdigest(w) for w in entries}
    hashes = np.fromiter((hash_of[w] for w in entries), np.uint64, len(entries))
    number, bucket = ngram_buckets(entries, hashes)
    weight = (counts / np.bincount(number, minlength=len(entries)))[number]
    pairs = pair_buckets(np.fromiter((hash_of[w] for w in parts), np.uint64, len(parts)))
    bucket, weight = np.concatenate([bucket, pairs]), np.concatenate([weight, np.ones(len(pairs))])
    found, place = np.unique(bucket, return_inverse=True)
    return found.astype(np.int32), (np.bincount(place, weight) / weight.sum()).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 1.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """(score per bucket, bias): the difference of the two outputs, as learned from (buckets, weights, label) rows."""
    if not rows:
        return np.zeros(BUCKETS, np.float32), 0.0
    share = (sum(y for _, _, y in rows) + 0.5) / (len(rows) + 1)
    prior = float(np.log(share / (1 - share)))
    if len({y for _, _, y in rows}) < 2:
        return np.zeros(BUCKETS, np.float32), prior
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((2, DIMENSIONS), np.float32), np.array([-prior / 2, prior / 2], np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            bucket, weight, label = rows[i]
            now = rate * (1 - done / steps)
            done += 1
            text = weight @ table[bucket] if len(bucket) else np.zeros(DIMENSIONS, np.float32)
            z = out @ text + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1  # the gradient of the loss by the outputs
            back = p @ out
            out -= now * p[:, None] * text
            bias -= now * 0.1 * p
            if len(bucket):
                # vectors of a text share its gradient by weight; scaled by their number, as each is seen rarely
                table[bucket] -= (now * min(len(bucket), 100) * weight)[:, None] * back
    return (table @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, column: str = "quality") -> tuple[np.ndarray, float]:
    """The model from rows of docs whose id has a label and is not held out."""
    known = (
        labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod("doc_id", 5) != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(column) >= 0.5).cast("int").alias("label"))
        .orderBy(spread(F.col("doc_id")), "doc_id").limit(sample)
    )
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(known), "doc_id"  # `sample` rows of two numbers
    )
    rows = chosen.orderBy(spread(F.col("doc_id")), "doc_id", "text").limit(sample)
    return train([(*features((r["text"] or "").encode()), r["label"]) for r in rows.toLocalIterator()])


def scores(batch: pa.RecordBatch, table: np.ndarray, bias: float, column: str = "text") -> np.ndarray:
    """Score of each row of a batch."""
    encoded, starts = words(batch, column)
    hashes, index = word_hashes(encoded)
    number, bucket = ngram_buckets(encoded.dictionary.cast(pa.large_binary()).to_pylist(), hashes) if len(hashes) else (index, index)
    own = np.bincount(number, table[bucket], len(hashes)) / np.maximum(1, np.bincount(number, minlength=len(hashes)))
    per_word = own[index]
    count = np.diff(starts)
    full = np.flatnonzero(count)
    first = starts[full]
    if len(index) > 1:
        per_word[1:] += table[pair_buckets(hashes[index])]
        late = first[first > 0]  # a text's first word has no pair with the text before
        per_word[late] -= table[_pairs_at(hashes, index, late)]
    total = np.zeros(len(count))
    if len(full):
        total[full] = np.add.reduceat(per_word, first) / (2 * count[full] - 1)
    return 1 / (1 + np.exp(-(total + bias)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            made = scores(batch, *model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(made, pa.float64()), pa.array((made >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (crc32_mod("doc_id", 5) == 0).alias("held_out"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, SCORES)


def accepted(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """The rows of docs, with all columns, that score the threshold or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            yield batch.filter(pa.array(scores(batch, *model) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def _pairs_at(hashes: np.ndarray, index: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Buckets of the pairs that end at the given words."""
    with np.errstate(over="ignore"):
        return (mix(hashes[index[at - 1]] * np.uint64(3) + mix(hashes[index[at]])) % np.uint64(BUCKETS)).astype(np.int64)


def classify(docs: DataFrame, labels: DataFrame, sample: int = 6000, threshold: float = 0.3) -> DataFrame:
    return score(docs, fit(docs, labels, sample), threshold)
