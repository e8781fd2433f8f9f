"""Removal of long passages that an earlier document has, found by recompression.

Every word has a global name, a 64-bit hash. In each round, names whose hash bit is 0 join a right neighbour whose bit is 1,
and the pair gets a name made from both, so the same pair has the same name in every document; a pair longer than the
round's cap is left alone. Names come from the pair itself and not from a counter, so a round needs no
exchange between documents. A run of one word never pairs with itself and stays a run of single names; its places share one
key like any other.

What a pair becomes depends on its neighbours only, so two occurrences of a passage are cut alike except near its ends: with
the caps below, at most 21 words on either side. Between, every 8 words or less, there is a cut whose surrounding 42
words lie in the passage: its key. So each window of 50 words that two documents share has keys that both share, and
the search goes on only where all keys around are shared:

1. texts with equal word sequences are one class; all but its smallest doc_id are repeats as a whole;
2. keys are gathered per task, dealt by hash and merged: those of two or more documents are shared;
3. shared keys go back to their texts by a join; windows whose keys are all shared get the hash of their 50 words;
4. these are gathered in the same way, and windows go back where a smaller doc_id has them;
5. the words they cover are removed.

A task combines its keys before they are dealt, so a key that a third of all documents hold comes once per chunk, and the joins back are
split by adaptive execution. Nothing is kept per pair of documents. Equality is that of 64-bit hashes of 42 and 50 words, made from the words' own 64-bit hashes.

Defined results: null text has no words. A null doc_id is neither earlier nor later than another: its words stay. Rows with the same
doc_id are not earlier than each other. An empty table gives an empty result; other columns are ignored. Texts are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import chunks, cut_lineage, mix, texts, word_hashes, words

#: the window, and the most words that a name may cover after each round
WINDOW, CAPS = 50, (2, 3, 4, 5, 6, 8)
#: words at either end of a shared passage where cuts may differ: the longest name before each round
EDGE = 1 + sum(CAPS[:-1])
assert WINDOW - 2 * EDGE >= CAPS[-1]
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)
#: entries that one merging task gets, about
PER_BUCKET = 1 << 20


def cuts(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions where names begin after all rounds; starts: where each text begins, one entry more."""
    at, length = np.arange(len(names)), np.ones(len(names), np.int8)
    text = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    with np.errstate(over="ignore"):
        for number, cap in enumerate(CAPS, 1):
            bit = (mix(names + np.uint64(number * BASE % (1 << 64))) >> np.uint64(17)) & np.uint64(1)
            left = np.flatnonzero((bit[:-1] == 0) & (bit[1:] == 1) & (text[:-1] == text[1:]) & (length[:-1] + length[1:] <= cap))
            names[left] = mix(names[left] * np.uint64(3) + mix(names[left + 1]))
            length[left] += length[left + 1]
            stay = np.ones(len(names), bool)
            stay[left + 1] = False
            names, at, length, text = names[stay], at[stay], length[stay], text[stay]
    return at


def spans(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of `length` words from each start."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(hashes), BASE, np.uint64)]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])])
        del powers
        back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(hashes), BACK, np.uint64)]))
        return mix((sums[starts + length] - sums[starts]) * back[starts])


def anchors(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, text number, key) of all cuts that have the words of a key around them."""
    at = cuts(hashes.copy(), starts)
    text = np.searchsorted(starts, at, "right") - 1
    inside = (at - EDGE >= starts[text]) & (at + EDGE <= starts[text + 1]) & (starts[text + 1] - starts[text] >= WINDOW)
    at, text = at[inside], text[inside]
    return at, text, spans(hashes, at - EDGE, 2 * EDGE)


def content(text: bytes) -> tuple[int, bytes]:
    """(number of words, SHA-256 of the words joined by a space)."""
    parts = text.split()
    return len(parts), hashlib.sha256(b" ".join(parts)).digest()


def _short(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "little", signed=True)


# ------------------------------------------------------------- keys of two or more documents

def packed(keys: np.ndarray, doc_ids: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, keys with their smallest and largest doc_id): one entry per distinct key of a chunk."""
    if not len(keys):
        return
    order = np.lexsort((doc_ids, keys))
    keys, doc_ids = keys[order], doc_ids[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    last = np.concatenate([first[1:], [len(keys)]]) - 1
    keys, low, high = keys[first], doc_ids[first], doc_ids[last]
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    for b in np.unique(bucket).tolist():
        some = order[ends[b - 1] if b else 0:ends[b]]
        ids, place = np.unique(np.concatenate([low[some], high[some]]), return_inverse=True)
        place = place.astype(np.uint32)
        head = np.array([len(some), len(ids)], np.int64)
        a, z = place[:len(some)], place[len(some):] - place[:len(some)]
        kind = np.uint16 if len(ids) < 1 << 16 else np.uint32
        yield b, head.tobytes() + ids.tobytes() + keys[some].tobytes() + a.astype(kind).tobytes() + z.astype(kind).tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, m = np.frombuffer(blob, np.int64, 2).tolist()
    ids = np.frombuffer(blob, np.int64, m, 16)
    keys = np.frombuffer(blob, np.uint64, n, 16 + 8 * m)
    kind = np.uint16 if m < 1 << 16 else np.uint32
    a, z = np.frombuffer(blob, kind, 2 * n, 16 + 8 * (m + n)).reshape(2, -1)
    return keys, ids[a], ids[a.astype(np.int64) + z]


def shared(blobs: DataFrame) -> DataFrame:
    """Rows (key, first): the keys that documents of different ids hold, with the smallest id."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(b) for b in pdf["blob"]]
        keys, low, high = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.argsort(keys)
        keys, low, high = keys[order], low[order], high[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        some = low < high
        return pd.DataFrame({"key": keys[at][some].view(np.int64), "first": low[some]})

    return blobs.groupBy("bucket").applyInPandas(merge, "key long, first long")


# ------------------------------------------------------------- the passes over texts

def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _contents(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [content(t) for t in texts(batch)]
            yield _batch("doc_id n_words sha same", batch.column("doc_id"), pa.array([n for n, _ in made], pa.int64()),
                         pa.array([s for _, s in made], pa.binary()), pa.array([_short(s) for _, s in made], pa.int64()))

    return docs.mapInArrow(run, "doc_id long, n_words long, sha binary, same long")


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("doc_id")).astype(np.int64)


def _key_blobs(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            encoded, starts = words(batch)
            names, index = word_hashes(encoded)
            _, text, keys = anchors(names[index], starts)
            for b, blob in packed(keys, _ids(batch)[text], buckets):
                yield _batch("bucket blob", pa.array([b], pa.int32()), pa.array([blob], pa.binary()))

    return docs.mapInArrow(run, "bucket int, blob binary")


def _key_places(docs: DataFrame) -> DataFrame:
    """Rows (key, same, spot): a text's keys, once per class and chunk; spot counts from the text's first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            same = np.array([_short(content(t)[1]) for t in texts(batch)], np.int64)
            once = np.unique(same, return_index=True)[1]
            once.sort()
            batch, same = batch.take(pa.array(once)), same[once]
            encoded, starts = words(batch)
            names, index = word_hashes(encoded)
            at, text, keys = anchors(names[index], starts)
            for i in range(0, len(at), 1 << 17):
                s = slice(i, i + (1 << 17))
                yield _batch("key same spot", keys[s].view(np.int64), same[text[s]], (at[s] - starts[text[s]]).astype(np.int32))

    return docs.mapInArrow(run, "key long, same long, spot int")


def _windows(chosen: DataFrame) -> DataFrame:
    """Rows (key, doc_id, same, spot) of the windows whose keys are all shared; chosen: doc_id, text, same, spots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own = np.asarray(batch.column("same"))
            right = np.array([_short(content(t)[1]) for t in texts(batch)], np.int64) == own
            batch = batch.filter(pa.array(right))  # a repeated id may stand on another text
            if not batch.num_rows:
                continue
            encoded, starts = words(batch)
            names, index = word_hashes(encoded)
            hashes = names[index]
            at, text, _ = anchors(hashes, starts)
            lists = batch.column("spots")
            many = np.diff(np.asarray(lists.offsets))
            held = np.asarray(lists.flatten()).astype(np.int64) + np.repeat(starts[:-1], many)
            alone = np.zeros(len(hashes) + 1, np.int32)
            alone[at] = 1
            alone[held] = 0
            before = np.concatenate([[0], np.cumsum(alone)])
            whose = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            p = np.flatnonzero(np.arange(len(hashes)) + WINDOW <= starts[1:][whose])
            p = p[before[p + WINDOW - EDGE + 1] == before[p + EDGE]]
            keys, ids, own = spans(hashes, p, WINDOW), _ids(batch), np.asarray(batch.column("same"))
            for i in range(0, len(p), 1 << 17):
                s = slice(i, i + (1 << 17))
                w = whose[p[s]]
                yield _batch("key doc_id same spot", keys[s].view(np.int64), ids[w], own[w], (p[s] - starts[w]).astype(np.int32))

    return chosen.mapInArrow(run, "key long, doc_id long, same long, spot int")


def _window_blobs(windows: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "key", 16 << 20):
            for b, blob in packed(np.asarray(batch.column("key")).view(np.uint64), _ids(batch), buckets):
                yield _batch("bucket blob", pa.array([b], pa.int32()), pa.array([blob], pa.binary()))

    return windows.select("key", "doc_id").mapInArrow(run, "bucket int, blob binary")


def _kept(chosen: DataFrame) -> DataFrame:
    """Rows (doc_id, same, n_removed, kept, text) of texts with windows to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out = []
            for doc_id, text, same, spots in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("same").to_pylist(), batch.column("spots")):
                parts = text.split()
                if _short(hashlib.sha256(b" ".join(parts)).digest()) != same:
                    continue
                edge = np.zeros(len(parts) + 1, np.int64)
                np.add.at(edge, spots.values.to_numpy(), 1)
                np.add.at(edge, spots.values.to_numpy() + WINDOW, -1)
                stay = np.cumsum(edge[:-1]) == 0
                left = b" ".join(w for w, s in zip(parts, stay.tolist()) if s)
                out.append((doc_id, same, int(len(parts) - stay.sum()), hashlib.sha256(left).digest(), left))
            yield _batch("doc_id same n_removed kept text", *(pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])))

    return chosen.mapInArrow(run, "doc_id long, same long, n_removed long, kept binary, text binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256.

    `_kept` also gives the remaining text of the rows it changes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut_lineage(_contents(docs))
    known = docs.filter(F.col("doc_id").isNotNull())
    firsts = cut_lineage(rows.filter(F.col("doc_id").isNotNull()).groupBy("sha", "same", "n_words").agg(F.min("doc_id").alias("first")))
    total = rows.agg(F.sum("n_words")).first()[0] or 0
    buckets = 1 + total // (4 * PER_BUCKET)  # about every fourth word begins a key
    keys = cut_lineage(shared(_key_blobs(known, buckets)).select("key"))
    spots = cut_lineage(_key_places(known).join(keys, "key", "left_semi").groupBy("same").agg(F.collect_set("spot").alias("spots")))
    firsts_long = firsts.filter(F.col("n_words") >= WINDOW).select("same", F.col("first").alias("doc_id"))
    windows = cut_lineage(_windows(known.join(spots.join(firsts_long, "same"), "doc_id")))
    earlier = cut_lineage(shared(_window_blobs(windows, 1 + windows.count() // PER_BUCKET)))
    matched = (
        windows.join(earlier, "key").filter(F.col("doc_id") > F.col("first"))
        .groupBy("doc_id", "same").agg(F.collect_set("spot").alias("spots"))
    )
    changed = cut_lineage(_kept(known.join(matched, "doc_id")).drop("text").dropDuplicates(["doc_id", "same"]))
    whole = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW)
    return (
        rows.join(firsts.select("sha", "first"), "sha", "left").join(changed, ["doc_id", "same"], "left")
        .select(
            "doc_id", "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.lower(F.hex(F.coalesce("kept", "sha")))).alias("kept_sha256"),
        )
    )
