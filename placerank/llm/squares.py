"""Runs of repeated words, by online dyadic square catching.

Words are appended; when a block of 2**j words at a multiple of 2**j is complete, it becomes a catcher for the periods from 2**j to
2**(j+1) - 1. Each word that is appended completes one suffix of 2**j words for each j, which is compared with the catcher whose
periods fit. An equal suffix opens a square: its second half is the first one moved by the period. Its right end moves on with the
words that come, its left end is found by comparing backwards, and squares of one period that overlap are one run, which closes at
the first word that differs. Suffixes are compared by their fingerprints in two prime fields, prefix sums of the words' values times
powers; the ends of a run are compared word by word afterwards, so a run is never a matter of fingerprints.

A run of exponent 4 holds a whole block at its period's level among its first words, so none is missed. All catchers of a level
compare the suffixes of a step at once; documents of a chunk follow each other, divided by words that occur once. Work grows with
words times the logarithm of the longest text. Nothing is shuffled.

Defined results: null and empty texts have no words and no run. A null doc_id has no periodic tail planted. Repeated rows get a row
each; an empty table gives an empty result; other columns are ignored; a text is never divided.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import chunks, mix, words

#: two primes below 2**31 and a base for each
FIELDS = ((2147483647, 1103515245), (2147483629, 1664525))
#: words appended at once, and bytes of text in a chunk
STEP, CHUNK = 1 << 16, 4 << 20
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _powers(n: int, prime: int, base: int) -> np.ndarray:
    made = np.ones(1, np.int64)
    while len(made) < n:
        made = np.concatenate([made, made * pow(base, len(made), prime) % prime])
    return made[:n]


class Catchers:
    """Runs of at least `exponent` (4 or more) periods and `shortest` words, in words appended step by step."""

    def __init__(self, capacity: int, exponent: int = 4, shortest: int = 6):
        self.exponent, self.shortest, self.n = exponent, shortest, 0
        self.x = np.zeros(capacity, np.int64)
        self.fields = [(p, _powers(capacity + 1, p, b), np.zeros(capacity + 1, np.int64)) for p, b in FIELDS]
        self.done: dict[int, int] = {}
        #: squares that may still grow: place of a block, period
        self.open = np.zeros((0, 2), np.int64)
        self.runs: list[np.ndarray] = []

    def append(self, ids: np.ndarray, longest: int) -> None:
        """ids of more words; `longest` is the most words of a document that reaches into them."""
        old, self.n = self.n, self.n + len(ids)
        self.x[old : self.n] = ids
        value = mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for i, (prime, power, total) in enumerate(self.fields):
            part = ((value >> np.uint64(32 * i)) & np.uint64(0x7FFFFFFF)).astype(np.int64) % prime
            total[old + 1 : self.n + 1] = total[old] + np.cumsum(part * power[old : self.n] % prime)
        caught, width = [self.open], 1
        while self.exponent * width <= longest:
            caught.append(self._catch(width))
            width *= 2
        self._grow(np.concatenate(caught))

    def _catch(self, b: int) -> np.ndarray:
        """(block, period) for each suffix of b words completed since the last time that equals its catcher."""
        first, self.done[b] = max(b, self.done.get(b, 0)), max(b, self.n - b + 1)
        if first > self.n - b:
            return np.zeros((0, 2), np.int64)
        prime, power, total = self.fields[0]
        at = np.arange(first, self.n - b + 1)
        lap = at // b * b - b
        period = at - lap
        suffix = (total[at + b] - total[at]) % prime
        # the catchers' own fingerprints, once a block
        blocks = np.arange(lap[0], lap[-1] + 1, b)
        own = ((total[blocks + b] - total[blocks]) % prime)[(lap - lap[0]) // b]
        hit = suffix == own * power[period] % prime
        block, period = lap[hit], period[hit]
        # blocks that continue a match of the block before are part of its square
        return np.stack([block, period], 1)[self._equal(block, period, np.full(len(block), b)) & ~self._before(block, period, b)]

    def _before(self, block: np.ndarray, period: np.ndarray, b: int) -> np.ndarray:
        inside = block >= b
        return inside & self._equal(np.where(inside, block - b, block), period, np.full(len(block), b))

    def _equal(self, at: np.ndarray, period: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words from `at` equal those a period later."""
        same = np.ones(len(at), bool)
        for prime, power, total in self.fields:
            here = (total[at + length] - total[at]) % prime
            there = (total[at + period + length] - total[at + period]) % prime
            same &= here * power[period] % prime == there
        return same

    def _extend(self, at: np.ndarray, period: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
        """How many words, `room` at most, from `at` (or before it) equal those a period later."""
        length = np.zeros(len(at), np.int64)
        step = 1 << max(0, int(room.max(initial=0)).bit_length() - 1)
        while step:
            fits = length + step <= room
            try_ = np.where(fits, step, 0)
            place = at + length if forward else at - length - try_
            length += np.where(fits & self._equal(place, period, try_), step, 0)
            step >>= 1
        return length

    def _grow(self, squares: np.ndarray) -> None:
        """Moves the ends of open squares to the words there are; those that a word has ended become runs if they are long enough."""
        if not len(squares):
            self.open = squares
            return
        at, period = squares.T
        # the first block of a run of exponent 4 is followed by two more periods
        ready = at + 3 * period <= self.n
        keep = ~ready
        keep[ready] = self._equal(at[ready], period[ready], 2 * period[ready])
        at, period = at[keep], period[keep]
        right = self._extend(at, period, self.n - at - period, True)
        going = at + period + right == self.n
        self.open = self._primitive(np.stack([at[going], period[going]], 1))
        self._close(at[~going], period[~going], right[~going])

    def _primitive(self, squares: np.ndarray) -> np.ndarray:
        """Open squares without those that lie in another and whose period is a multiple of its: they are of the same run."""
        kept, left = [], squares[np.argsort(squares[:, 1], kind="stable")]
        while len(left):
            at, d = left[:1].T
            kept.append(left[:1])
            start = at - self._extend(at, d, at, False)
            left = left[1:]
            left = left[(left[:, 0] < start) | (left[:, 1] % d != 0)]
        return np.concatenate(kept) if kept else squares

    def _close(self, at: np.ndarray, period: np.ndarray, right: np.ndarray) -> None:
        left = self._extend(at, period, np.minimum(at, period), False)
        long = left + period + right >= np.maximum(self.shortest, self.exponent * period)
        at, period, left, right = at[long], period[long], left[long], right[long]
        order = np.lexsort((period, at + period + right, at - left))
        ends = np.stack([at - left, at + period + right], 1)[order]
        order = order[np.concatenate([[True], (ends[1:] != ends[:-1]).any(1)])[: len(order)]]  # of one run the smallest period
        at, period, left, right = at[order], period[order], left[order], right[order]
        found = []
        for a, d, lo, hi in zip(at.tolist(), period.tolist(), left.tolist(), right.tolist()):
            lo, hi = self._exact(a, d, lo, hi)
            if lo + d + hi >= max(self.shortest, self.exponent * d):
                found.append((a - lo, a + d + hi, d))
        if found:
            self.runs.append(np.array(found, np.int64))

    def _exact(self, a: int, d: int, lo: int, hi: int) -> tuple[int, int]:
        """The ends by the words themselves; other than lo and hi only if a fingerprint misled."""
        x, n = self.x, self.n
        differ = np.flatnonzero(x[a : a + hi] != x[a + d : a + d + hi])
        hi = int(differ[0]) if len(differ) else hi
        while a + d + hi < n and x[a + hi] == x[a + d + hi]:
            hi += 1
        differ = np.flatnonzero(x[a - lo : a] != x[a - lo + d : a + d])
        lo = lo - int(differ[-1]) - 1 if len(differ) else lo
        while lo < a and x[a - lo - 1] == x[a - lo - 1 + d]:
            lo += 1
        return lo, hi

    def finish(self) -> np.ndarray:
        """Rows (start, end, period) by start and period: each run once, with its smallest period."""
        at, period = self.open.T
        self._close(at, period, self._extend(at, period, self.n - at - period, True))
        if not self.runs:
            return np.zeros((0, 3), np.int64)
        found = np.concatenate(self.runs)
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), bool)
        first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)  # a multiple of the period has the same ends
        found = found[first]
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs(index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, (start, end, period)) of all runs, in words of the document; document i has the words starts[i] to starts[i + 1]."""
    count = np.diff(starts)
    number = np.repeat(np.arange(len(count)), count)
    stream = np.empty(len(index) + len(count), np.int64)
    stream[np.arange(len(index)) + number] = index
    ends = starts[1:] + np.arange(len(count))
    stream[ends] = -1 - np.arange(len(count))  # a word that occurs once ends each document
    catchers = Catchers(len(stream))
    for at in range(0, len(stream), STEP):
        to = min(len(stream), at + STEP)
        inside = slice(np.searchsorted(ends, at), np.searchsorted(ends, to) + 1)
        catchers.append(stream[at:to], int(count[inside].max(initial=0)))
    found = catchers.finish()
    document = np.searchsorted(ends, found[:, 0])
    found[:, :2] -= (starts[:-1] + np.arange(len(count)))[document][:, None]
    return document, found


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of the check's input, None where the text is as it is: every tenth document by crc32 of
    its id ends in copies of the words from a on."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _joined_sha256(entries: np.ndarray, index: np.ndarray) -> str:
    made = hashlib.sha256()
    for at in range(0, len(index), 1 << 18):
        if at:
            made.update(b" ")
        made.update(b" ".join(entries[index[at : at + (1 << 18)]].tolist()))
    return made.hexdigest()


def _best(found: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Greatest length / period, compared in whole numbers; then smallest start, then period."""
    best = found[0]
    for s, e, d in found[1:]:  # by start and period, so an equal one does not replace
        if (e - s) * best[2] > (best[1] - best[0]) * d:
            best = s, e, d
    return best


def _rows(batch: pa.RecordBatch, plant: bool) -> Iterator[tuple]:
    encoded, starts = words(batch)
    index = np.asarray(encoded.indices).astype(np.int64)
    ids = batch.column("doc_id").to_pylist()
    if plant:
        index = index.copy()
        for i, doc_id in enumerate(ids):
            place = periodic_tail(doc_id, int(starts[i + 1] - starts[i]))
            if place is not None:
                index[starts[i] : starts[i + 1]] = index[starts[i] : starts[i + 1]][place]
    entries = np.array(encoded.dictionary.cast(pa.large_binary()).to_pylist() + [b""], object)[:-1]
    document, found = runs(index, starts)
    of = {}
    for i, row in zip(document.tolist(), found.tolist()):
        of.setdefault(i, []).append(tuple(row))
    for i, doc_id in enumerate(ids):
        own, mine = index[starts[i] : starts[i + 1]], of.get(i, [])
        if mine:
            cover = np.zeros(len(own) + 1, np.int64)
            for s, e, d in mine:
                cover[s + d] += 1
                cover[e] -= 1
            own = own[np.cumsum(cover[:-1]) == 0]
            s, e, d = _best(mine)
            best = (s, e - s, d, 1000 * (e - s) // d)
        else:
            best = (None,) * 4
        listed = hashlib.sha256("".join(f"{s},{e - s},{d}\n" for s, e, d in mine).encode()).hexdigest()
        yield doc_id, len(mine), *best, listed, _joined_sha256(entries, own)


def find_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_runs, the run of greatest exponent, and digests of all runs and of the text without repeats.

    A word is dropped if a run holds it after its first period. With `plant` the words are those of `periodic_tail`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in chunks(batches, most=CHUNK):
            columns = list(zip(*_rows(batch, plant)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)
