"""Toxicity classifier: compression distance to two zstandard dictionaries.

One dictionary is trained on toxic, one on ordinary labelled text, each on the words that set its class apart, so that neither spends
its bytes on what both share. A window is a word between blanks, A-Z lower-cased, without the marks around it, and a tail that both dictionaries hold:
its length above an empty window's is what the word itself costs. A window is toxic if the toxic dictionary leaves at most `most`
bytes of it and saves at least `least` against the ordinary one; both thresholds, and the logistic curve over a text's number and
share of such windows, are calibrated on labelled texts that the dictionaries have not seen.

At most `sample` labelled texts of each class are used, chosen by a hash of doc_id (the bound is this parameter); near copies among
them count once. All texts are scored whole where they lie: the distinct windows of a chunk are compressed once; nothing is shuffled, and a
task is sent the dictionaries (2 * SIZE bytes) and five numbers.

Defined results: null and empty texts have no window and get the score of a text without toxic windows. A null doc_id is not held out. Several labels
of one doc_id are averaged, 0.5 and more is 1; null labels are ignored. Without labels of both classes every text scores the share of
toxic labels, or 0 without any. Repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import chunks, crc32_mod, spread, words

#: bytes of a dictionary, bytes of text scored at once
SIZE, CHUNK = 8192, 4 << 20
MARKS = b".,;:!?'\"()"
#: zstandard looks for no match in the last bytes of its input, and stores what it cannot shorten: a tail both dictionaries hold avoids both
TAIL = b"\n" + b"0123456789abcdef~" * 2
SCORES = "doc_id long, held_out boolean, score double, predicted int, n_windows long, n_toxic long"


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    most: int
    least: int
    weights: tuple[float, float, float]


def word(entry: bytes) -> bytes:
    return entry.lower().strip(MARKS)


class Lengths:
    """Bytes that a dictionary leaves of a window."""

    def __init__(self, content: bytes):
        import zstandard as zs

        # the match finder's tables hold the whole dictionary; three bytes are a match
        parameters = zs.ZstdCompressionParameters(
            window_log=15, chain_log=14, hash_log=14, search_log=5, min_match=3, target_length=16, strategy=zs.STRATEGY_BTULTRA,
            format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        dictionary = zs.ZstdCompressionDict(content + TAIL, dict_type=zs.DICT_TYPE_RAWCONTENT)
        self._compress = zs.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress
        self._empty = len(self._compress(b"  " + TAIL))

    def of(self, entries: list[bytes]) -> np.ndarray:
        compress = self._compress
        return np.fromiter((len(compress(b" " + w + b" " + TAIL)) for w in entries), np.int64, len(entries)) - self._empty


def dictionary(samples: list[bytes], size: int = SIZE) -> bytes:
    """What zstandard trains on the samples; what there is of them if they are too few to train on."""
    import zstandard as zs

    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


def distinctive(own: list[list[bytes]], other: list[list[bytes]], deviations: float = 4, ratio: float = 3) -> set[bytes]:
    """Words in a significantly larger share of own texts than of others', and in `ratio` times that share."""
    a, b = Counter(w for t in own for w in set(t)), Counter(w for t in other for w in set(t))
    n, m = len(own), max(1, len(other))

    def far(w: bytes) -> bool:
        p = (a[w] + b[w] + 1) / (n + m + 2)
        return a[w] / n > ratio * b[w] / m and a[w] / n - b[w] / m >= deviations * math.sqrt(p * (1 - p) * (1 / n + 1 / m))

    return {w for w in a if w and far(w)}


def without_copies(texts: list[list[bytes]]) -> list[list[bytes]]:
    """Texts of which at most half the runs of three words occur in an earlier one."""
    seen, kept = set(), []
    for t in texts:
        runs = {hash(tuple(t[i : i + 3])) for i in range(max(1, len(t) - 2))}
        if 2 * len(runs & seen) <= len(runs):
            kept.append(t)
        seen |= runs
    return kept


def _shapes(hits: np.ndarray, count: np.ndarray) -> np.ndarray:
    """What the logistic curve sees of a text: one, and the logarithms of its number and its share of toxic windows."""
    share = hits / np.maximum(1, count)
    return np.stack([np.ones(len(hits)), np.log1p(hits), np.log1p(100 * share)], 1)


def _logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Weights of least weighted log loss with a small ridge, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (importance * (p - y)) + 0.01 * w
        step = np.linalg.solve((x * (importance * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _loss(x: np.ndarray, y: np.ndarray, importance: np.ndarray, w: np.ndarray) -> float:
    z = np.clip(x @ w, -30, 30) * (2 * y - 1)
    return float((importance * np.log1p(np.exp(-z))).sum())


def train(toxic: list[list[bytes]], ordinary: list[list[bytes]], share: float, size: int = SIZE) -> Model:
    """The model from the words of labelled texts; `share` of all labels are toxic."""
    toxic, ordinary = without_copies(toxic), without_copies(ordinary)
    if not toxic or not ordinary:
        return Model(b"", b"", 0, 1, (math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0, 0.0))
    learn = [[t for i, t in enumerate(s) if i % 3 or len(s) < 3] for s in (toxic, ordinary)]
    check = [[t for i, t in enumerate(s) if i % 3 == 0] for s in (toxic, ordinary)]
    content = []
    for own, other in (learn, learn[::-1]):
        good = distinctive(own, other)
        kept = [[w for w in t if w in good] for t in own]
        content.append(dictionary([b" " + b" ".join(k) + b" " for k in kept if k], size))
    texts = check[0] + check[1]
    y = np.repeat([1.0, 0.0], [len(check[0]), len(check[1])])
    importance = np.where(y == 1, share / len(check[0]), (1 - share) / len(check[1])) * len(y)
    entries = sorted({w for t in texts for w in t})
    number = {w: i for i, w in enumerate(entries)}
    left, saved = _window_lengths(content[0], content[1], entries)
    count = np.array([len(t) for t in texts])
    flat = np.fromiter((number[w] for t in texts for w in t), np.int64, int(count.sum()))
    of = np.repeat(np.arange(len(texts)), count)
    best = None
    for most in range(1, 9):
        for least in range(1, 9):
            hits = np.bincount(of, ((left <= most) & (saved >= least))[flat], len(texts))
            x = _shapes(hits, count)
            w = _logistic(x, y, importance)
            found = (_loss(x, y, importance, w), most, -least, w)
            best = found if best is None or found[:3] < best[:3] else best
    _, most, least, w = best
    return Model(content[0], content[1], most, -least, tuple(w.tolist()))


def _window_lengths(toxic: bytes, ordinary: bytes, entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    left = Lengths(toxic).of(entries)
    return left, Lengths(ordinary).of(entries) - left


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, column: str = "toxic") -> Model:
    """The model from rows of docs whose id has a label and is not held out."""
    known = (
        labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod("doc_id", 4) != 2))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(column) >= 0.5).cast("int").alias("label"))
    )
    total = known.agg(F.avg("label")).first()[0] or 0.0
    texts = {}
    for label in (1, 0):
        some = known.filter(F.col("label") == label).orderBy(spread(F.col("doc_id")), "doc_id").limit(sample)
        chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
            F.broadcast(some), "doc_id"  # `sample` rows of two numbers
        )
        rows = chosen.orderBy(spread(F.col("doc_id")), "doc_id", "text").limit(sample)
        texts[label] = [[word(w) for w in (r["text"] or "").encode().split()] for r in rows.toLocalIterator()]
    return train(texts[1], texts[0], total)


class Scorer:
    """Scores of the rows of batches; made once a task."""

    def __init__(self, model: Model):
        self.model, self.toxic, self.ordinary = model, Lengths(model.toxic), Lengths(model.ordinary)

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, number of windows, number of toxic windows) of each row."""
        encoded, starts = words(batch)
        entries = [word(w) for w in encoded.dictionary.cast(pa.large_binary()).to_pylist()]
        found = {w: i for i, w in enumerate(dict.fromkeys(entries))}
        distinct = list(found)
        left = self.toxic.of(distinct)
        hit = left <= self.model.most
        # the ordinary dictionary has a say only where the toxic one leaves little
        few = np.flatnonzero(hit)
        hit[few] = self.ordinary.of([distinct[i] for i in few]) - left[few] >= self.model.least
        of_entry = hit[np.fromiter((found[w] for w in entries), np.int64, len(entries))] if entries else np.zeros(0, bool)
        total = np.concatenate([[0], np.cumsum(of_entry[np.asarray(encoded.indices).astype(np.int64)])])
        count, hits = np.diff(starts), total[starts[1:]] - total[starts[:-1]]
        z = _shapes(hits, count) @ np.array(self.model.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), count, hits


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, and the numbers of windows and toxic windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in chunks(batches, most=CHUNK):
            made, count, hits = scorer.of(batch)
            columns = [pa.array(made, pa.float64()), pa.array((made >= threshold).astype(np.int32)), pa.array(count), pa.array(hits.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *columns], [c.split()[0] for c in SCORES.split(", ")]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (crc32_mod("doc_id", 4) == 2).alias("held_out"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, SCORES)


def classify(docs: DataFrame, labels: DataFrame, sample: int = 3000, threshold: float = 0.3) -> DataFrame:
    return score(docs, fit(docs, labels, sample), threshold)
