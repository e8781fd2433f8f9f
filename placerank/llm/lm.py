"""Scoring by an n-gram language model in Elias-Fano tries.

Level 1 holds every word of the training rows (a 64-bit hash stands for a word) with running sums of the counts; a word's rank is its id.
Level k holds the k-grams that occur `cutoffs[k - 1]` times or more (all of them, unless a caller asks for less), in the order of their
contexts, the nodes of their first k-1 words one level up. A level has pointers to the range of each context and the successors, each
relative to its context's base (context times number of words), so both are growing sequences. They are Elias-Fano coded: low bits packed,
high bits in unary with counts per 64 bits. A look-up searches the successor from the context's base; the pointers give a context's range.

A node's discounted probability (count - discount) / count(context) is rounded down to one of 256 values; what a context's
nodes leave goes to the next shorter context, and at the end to (c + 0.1) / (N + 0.1 (V + 1)). So all probabilities after a
context, with one class for all unknown words, sum to one, whatever was rounded or cut off.

Counting: after the words, one pass counts levels 2 and 3. A task counts the distinct triples of a chunk (a bigram before the end of a text has no
third word), codes them as Elias-Fano blobs and deals them to ranges of about `PER_SHARD` tokens: the running sum of the counts up to the first word,
and within it the id of the second, give the range by arithmetic, with nothing sampled, and split a frequent word. Triples of one bigram
stay together, so the task that gets a range merges it, derives the bigrams' counts and writes both levels' shard, a file in the shared folder that
tasks map into memory. The driver sees a row per shard.

Defined results: null text is empty and scores the end alone. A null doc_id is held out. Repeated rows are counted as
often as they stand there. Without training rows N = V = 0 and every token is unknown. Other columns are ignored. Whole texts are
read. Ids must stay below 2**31 (an error says so).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import chunks, crc32_mod, new_path, word_hashes, words

PRIOR, DISCOUNT, STEP = 0.1, 0.75, 8
CHUNK, PER_SHARD, TEXT_PER_SHARD = 8 << 20, 2_000_000, 16 << 20
#: contexts with more successors keep their sum, those of the others are added up when asked for
NARROW = 4
#: mapped bytes a worker keeps open
HELD = 256 << 20
#: b" " is no word, so its hash can stand for the end of a text, which is also the context of a first word
END_MARK = b" "
U, ONE = np.uint64, np.uint64(1)
TAKES = np.exp2(-np.arange(256, dtype=np.float64) / STEP)
#: position of the set bit of each rank in each byte
IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[:8] for byte in range(256)], np.uint8).ravel()
_open: dict[str, dict] = {}


# ------------------------------------------------------------- Elias-Fano

def packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Values of `bits` bits each, one after the other in 64-bit words."""
    n = len(values)
    out = np.zeros(n * bits // 64 + 2, np.uint64)
    if n and bits:
        bit = np.arange(n, dtype=np.uint64) * U(bits)
        word, shift = (bit >> U(6)).astype(np.int64), bit & U(63)
        part = values & U((1 << bits) - 1)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] = np.bitwise_or.reduceat(part << shift, first)
        over = np.flatnonzero(shift + U(bits) > 64)
        out[word[over] + 1] |= part[over] >> (U(64) - shift[over])
    return out


def unpacked(words_: np.ndarray, bits: int, i: np.ndarray) -> np.ndarray:
    """The values of packed() at i."""
    if not bits:
        return np.zeros(len(i), np.uint64)
    bit = i.astype(np.uint64) * U(bits)
    word, shift = (bit >> U(6)).astype(np.int64), bit & U(63)
    upper = np.where(shift > 0, words_[word + 1] << ((U(64) - shift) & U(63)), U(0))
    return ((words_[word] >> shift) | upper) & U((1 << bits) - 1)


def ef_build(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Arrays of a growing sequence of whole numbers."""
    n, top = len(values), int(values[-1]) if len(values) else 0
    bits = max(0, ((top + 1) // max(1, n)).bit_length() - 1)
    at = (values >> U(bits)) + np.arange(n, dtype=np.uint64)
    high = np.zeros(int(at[-1] >> U(6)) + 2 if n else 1, np.uint64)
    if n:
        word = (at >> U(6)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        high[word[first]] = np.bitwise_or.reduceat(ONE << (at & U(63)), first)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.uint64)]).astype(np.uint32 if n < 1 << 32 else np.uint64)
    return {f"{name}.low": packed(values, bits), f"{name}.high": high, f"{name}.before": before, f"{name}.n": np.array([n, bits], np.int64)}


def ef_values(low: np.ndarray, high: np.ndarray, n: int, bits: int) -> np.ndarray:
    """All values of a sequence."""
    i = np.arange(n)
    part = np.flatnonzero(np.unpackbits(high.view(np.uint8), bitorder="little"))[:n] - i
    return (part.astype(np.uint64) << U(bits)) | unpacked(low, bits, i)


def _trailing(x: np.ndarray) -> np.ndarray:
    """Number of zero bits below the lowest set one."""
    return np.bitwise_count(~x & (x - ONE)).astype(np.int64)


class Sequence:
    """Random access and successor search on the arrays of ef_build; all methods take and return arrays."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, self.high, self.before = (arrays[f"{name}.{k}"] for k in ("low", "high", "before"))
        self.n, self.bits = arrays[f"{name}.n"].tolist()
        self.zeros = np.arange(len(self.before), dtype=np.int64) * 64 - self.before.astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        return unpacked(self.low, self.bits, i)

    @staticmethod
    def _nth(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Position of the set bit of this rank in each word: counts per byte, then a table."""
        n = word - ((word >> ONE) & U(0x5555555555555555))
        n = (n & U(0x3333333333333333)) + ((n >> U(2)) & U(0x3333333333333333))
        n = ((n + (n >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * U(0x0101010101010101)  # of all bytes up to each
        rank, tops = rank.astype(np.uint64), U(0x8080808080808080)
        byte = np.minimum(np.bitwise_count(((rank * U(0x0101010101010101)) | tops) - n & tops), 7).astype(np.uint64) << U(3)
        rank = rank - (((n << U(8)) >> byte) & U(255))
        return IN_BYTE[((((word >> byte) & U(255)) << U(3)) | (rank & U(7))).astype(np.int64)].astype(np.int64) + byte.astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, i, "right") - 1
        at = word * 64 + self._nth(self.high[word], i - self.before[word].astype(np.int64))
        return ((at - i).astype(np.uint64) << U(self.bits)) | self._low(i)

    def pair(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at i and i + 1."""
        word = np.searchsorted(self.before, i, "right") - 1
        bit = self._nth(self.high[word], i - self.before[word].astype(np.int64))
        rest = (self.high[word] >> bit.astype(np.uint64)) >> ONE
        at = word * 64 + bit
        first = ((at - i).astype(np.uint64) << U(self.bits)) | self._low(i)
        second = ((at + _trailing(rest) - i).astype(np.uint64) << U(self.bits)) | self._low(i + 1)
        far = np.flatnonzero(rest == 0)
        second[far] = self.get(i[far] + 1)
        return first, second

    def _start(self, part: np.ndarray) -> np.ndarray:
        """Number of values whose high part is below `part`."""
        k = part - 1
        known = np.clip(k, 0, max(0, int(self.zeros[-1]) - 1))
        word = np.minimum(np.searchsorted(self.zeros, known, "right") - 1, len(self.high) - 1)
        at = word * 64 + self._nth(~self.high[word], known - self.zeros[word])
        return np.where(part <= 0, 0, np.where(k >= self.zeros[-1], self.n, np.minimum(at - known, self.n)))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value that is at least x (n if there is none)."""
        if not self.n:
            return np.zeros(len(x), np.int64)
        part, low = (x >> U(self.bits)).astype(np.int64), x & U((1 << self.bits) - 1)
        lo, hi = self._start(part), self._start(part + 1)
        busy = np.flatnonzero(lo < hi)
        while len(busy):
            mid = (lo[busy] + hi[busy]) // 2
            less = self._low(mid) < low[busy]
            lo[busy[less]] = mid[less] + 1
            hi[busy[~less]] = mid[~less]
            busy = busy[lo[busy] < hi[busy]]
        return lo

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x, -1 where it is absent; the values with its high bits are a run of ones after a zero."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        part, low = (x >> U(self.bits)).astype(np.int64), x & U((1 << self.bits) - 1)
        part = np.minimum(part, len(self.high) * 64)
        lo = self._start(part)
        at = lo + part
        rest = ~self.high[np.minimum(at >> 6, len(self.high) - 1)] >> (at & 63).astype(np.uint64)
        hi = np.where(lo < self.n, lo + _trailing(rest), lo)
        far = np.flatnonzero((rest == 0) & (lo < self.n))
        hi[far] = self._start(part[far] + 1)
        out, end = np.full(len(x), -1, np.int64), np.minimum(hi, self.n)
        hi = end.copy()
        busy = np.flatnonzero(lo < hi)
        while len(busy):
            mid = (lo[busy] + hi[busy]) // 2
            value = self._low(mid)
            less, same = value < low[busy], value == low[busy]
            out[busy[same]] = mid[same]
            lo[busy[less]] = mid[less] + 1
            hi[busy[~less]] = mid[~less]
            busy = busy[~same & (lo[busy] < hi[busy])]
        return out


# ------------------------------------------------------------- shard files

def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of arrays that can be mapped; complete under its name or not there."""
    system, path = _system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = [str(a.dtype), len(a), at]
        at += -(-a.nbytes // 8) * 8
    raw = json.dumps(head).encode()
    raw += b" " * (-len(raw) % 8)
    hidden = f"{path}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with system.open_output_stream(hidden, compression=None) as out:
        out.write(np.int64(len(raw)).tobytes() + raw)
        for a in arrays.values():
            out.write(a.tobytes() + bytes(-a.nbytes % 8))
    system.move(hidden, path)


def open_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory; a file of another store is copied to an unnamed local file first."""
    from pyarrow import fs

    system, path = _system(uri)
    if isinstance(system, fs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        import shutil
        import tempfile

        with tempfile.TemporaryFile() as held, system.open_input_stream(path) as source:
            shutil.copyfileobj(source, held)
            raw = np.memmap(held, np.uint8, "r")
    size = int(raw[:8].view(np.int64)[0])
    return {
        k: raw[8 + size + at:8 + size + at + n * np.dtype(kind).itemsize].view(kind)
        for k, (kind, n, at) in json.loads(raw[8:8 + size].tobytes()).items()
    }


def _shard(uri: str, names: tuple[str, ...]) -> dict:
    """Arrays and sequences of a shard; a worker keeps those that it used last open, up to HELD bytes."""
    if uri not in _open:
        arrays = open_arrays(uri)
        held = arrays | {k: Sequence(arrays, k) for k in names} | {"bytes": sum(a.nbytes for a in arrays.values())}
        size = held["bytes"] + sum(h["bytes"] for h in _open.values())
        while _open and size > HELD:
            size -= _open.pop(next(iter(_open)))["bytes"]
        _open[uri] = held
    return _open[uri]


class Model:
    """Where the shards are and what they cover; tasks get this and map the files."""

    def __init__(self, base: str, shift: int, first: pd.DataFrame):
        self.base, self.shift = base, shift
        n, tokens = (np.zeros(1 << (64 - shift), np.int64) for _ in range(2))
        n[first["shard"]], tokens[first["shard"]] = first["n"], first["tokens"]
        self.offsets, self.sums = (np.concatenate([[0], np.cumsum(x)]) for x in (n, tokens))
        self.tokens, self.types = int(tokens.sum()), int(n.sum())
        self.shards, self.first, self.last, self.nodes = [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, rows: pd.DataFrame) -> None:
        """The manifest of levels 2 and 3: shard, number of bigrams, first and last bigram."""
        rows = rows.sort_values("first")
        self.shards, self.first, self.last = rows["shard"].tolist(), rows["first"].to_numpy(), rows["last"].to_numpy()
        self.nodes = np.concatenate([[0], np.cumsum(rows["n"].to_numpy())]).astype(np.int64)

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, count, count of all words before) of each word hash; -1, 0 and 0 where unknown."""
        order = np.argsort(hashes)
        ids, counts, sums = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        shard = (hashes[order] >> U(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(hashes), np.int64)
        for s in np.unique(shard).tolist():
            if self.offsets[s] == self.offsets[s + 1]:
                continue
            held = _shard(f"{self.base}/1/{s}", ("words", "sums"))
            at = order[np.searchsorted(shard, s):np.searchsorted(shard, s, "right")]
            found = held["words"].find(hashes[at] - U((s << self.shift) & ((1 << 64) - 1)))
            hit = found >= 0
            ids[at[hit]] = found[hit] + self.offsets[s]
            a, b = (x.astype(np.int64) for x in held["sums"].pair(found[hit]))
            counts[at[hit]], sums[at[hit]] = b - a, a + self.sums[s]
        return ids, counts, sums

    def count_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted word ids."""
        out = np.zeros(len(ids), np.int64)
        where = np.searchsorted(self.offsets, ids, "right") - 1
        for s in np.unique(where).tolist():
            a, b = np.searchsorted(where, s), np.searchsorted(where, s, "right")
            begin, end = _shard(f"{self.base}/1/{s}", ("words", "sums"))["sums"].pair(ids[a:b] - self.offsets[s])
            out[a:b] = (end - begin).astype(np.int64)
        return out

    def bigrams(self, first: np.ndarray, second: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of ids in order: (node or -1, probability); for sorted ids: the sum that their nodes take, over all their shards."""
        keys = first * self.types + second
        nodes, share, mass = np.full(len(keys), -1, np.int64), np.zeros(len(keys)), np.zeros(len(contexts))
        for i in range(len(self.shards)):
            low, high = int(self.first[i]) // self.types, int(self.last[i]) // self.types
            a, b = np.searchsorted(keys, self.first[i]), np.searchsorted(keys, self.last[i], "right")
            c, d = np.searchsorted(contexts, low), np.searchsorted(contexts, high, "right")
            if a == b and c == d:
                continue
            found, share[a:b], more = self._in(i, 2, first[a:b] - low, second[a:b], contexts[c:d] - low)
            mass[c:d] += more
            nodes[a:b] = np.where(found >= 0, found + self.nodes[i], -1)
        return nodes, share, mass

    def trigrams(self, place: np.ndarray, third: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted nodes: the sum that their successors take; for (place in nodes, id) in order: the probability."""
        share, mass = np.zeros(len(place)), np.zeros(len(nodes))
        for i in range(len(self.shards)):
            c, d = np.searchsorted(nodes, self.nodes[i]), np.searchsorted(nodes, self.nodes[i + 1])
            if c == d:
                continue
            local = nodes[c:d] - self.nodes[i]
            a, b = np.searchsorted(place, c), np.searchsorted(place, d)
            _, share[a:b], mass[c:d] = self._in(i, 3, local[place[a:b] - c], third[a:b], local)
        return share, mass

    def _in(self, shard: int, level: int, at: np.ndarray, words_: np.ndarray, contexts: np.ndarray):
        """In a shard, (index or -1, probability) of successors of the contexts `at`, and the sums of `contexts`, both counted from the shard's first."""
        held = _shard(f"{self.base}/2/{self.shards[shard]}", tuple(f"{k}.{name}" for k in (2, 3) for name in ("pointers", "successors", "wide")))
        codes = held[f"{level}.codes"]
        begin, end = (x.astype(np.int64) for x in held[f"{level}.pointers"].pair(contexts))
        size, mass = end - begin, np.zeros(len(contexts))
        narrow = np.flatnonzero((size > 0) & (size <= NARROW))
        for j in range(NARROW):
            narrow = narrow[size[narrow] > j]
            mass[narrow] += TAKES[codes[begin[narrow] + j]]
        wide = np.flatnonzero(size > NARROW)
        mass[wide] = held[f"{level}.mass"][held[f"{level}.wide"].find(contexts[wide].astype(np.uint64))]
        found = held[f"{level}.successors"].find(at.astype(np.uint64) * U(self.types) + words_.astype(np.uint64))
        share = np.zeros(len(at))
        hit = np.flatnonzero(found >= 0)
        share[hit] = TAKES[codes[found[hit]]]
        return found, share, mass


# ------------------------------------------------------------- counting

def _tokens(batch: pa.RecordBatch):
    """(hash per dictionary entry, entry per token, first token of each text and the end): words and one end per text."""
    encoded, starts = words(batch)
    hashes, index = word_hashes(encoded, lower=True)
    end = np.array([_hash_end()], np.uint64)
    index = np.insert(index, starts[1:], len(hashes))
    return np.concatenate([hashes, end]), index, starts + np.arange(len(starts))


def _hash_end() -> int:
    import xxhash

    return xxhash.xxh64_intdigest(END_MARK)


def _blob(keys: np.ndarray, counts: np.ndarray, third: np.ndarray | None = None) -> bytes:
    """Growing keys with counts, and a number beside each: Elias-Fano coded from the first key, packed, and plain."""
    ef = ef_build(keys - keys[0], "k")
    bits = 0 if third is None else int(third.max()).bit_length()
    beside = packed(third, bits) if bits else np.zeros(0, np.uint64)
    size = 1 if counts.max() < 256 else 4
    head = np.array([len(keys), keys[0], ef["k.n"][1], len(ef["k.low"]), len(ef["k.high"]), bits, len(beside), size], np.uint64)
    return b"".join(x.tobytes() for x in (head, ef["k.low"], ef["k.high"], beside, counts.astype(f"u{size}")))


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, counts, third) of _blob."""
    n, first, low_bits, low, high, bits, beside, size = np.frombuffer(blob, np.uint64, 8).tolist()
    raw = np.frombuffer(blob, np.uint64, low + high + beside, 64)
    keys = ef_values(raw[:low], raw[low:low + high], n, low_bits) + U(first)
    third = unpacked(raw[low + high:], bits, np.arange(n))
    return keys, np.frombuffer(blob, f"u{size}", n, 64 + 8 * len(raw)).astype(np.int64), third


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array starts."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)


def _dealt(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A blob per bucket; buckets grow."""
    at = _starts(bucket)
    for a, b in zip(at, [*at[1:], len(bucket)]):
        yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a])], pa.int64()), pa.array([_blob(*(c[a:b] for c in columns))], pa.binary())], ["bucket", "blob"])


def _count_words(rows: DataFrame, base: str, shift: int) -> pd.DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            hashes, index, _ = _tokens(batch)
            keys, place = np.unique(hashes, return_inverse=True)
            n = np.bincount(place[index], minlength=len(keys))
            keys, n = keys[n > 0], n[n > 0]
            yield from _dealt((keys >> U(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64), keys, n)

    def write(key, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = (np.concatenate(x) for x in list(zip(*map(_unblob, pdf["blob"])))[:2])
        order = np.argsort(keys)
        keys = keys[order]
        at = _starts(keys)
        keys, n = keys[at], np.add.reduceat(n[order], at)
        sums = np.concatenate([[0], np.cumsum(n)]).astype(np.uint64)
        write_arrays(f"{base}/1/{key[0]}", {**ef_build(keys - U((int(key[0]) << shift) & ((1 << 64) - 1)), "words"), **ef_build(sums, "sums")})
        return pd.DataFrame({"shard": [key[0]], "n": [len(keys)], "tokens": [int(n.sum())]})

    return rows.mapInArrow(count, "bucket long, blob binary").groupBy("bucket").applyInPandas(write, "shard long, n long, tokens long").toPandas()


def _count_triples(rows: DataFrame, model: Model) -> DataFrame:
    """Rows (bucket, blob): keys first * types + second, and the third word, `types` where the text has ended."""
    types, per = model.types, -(-model.tokens // (1 + model.tokens // PER_SHARD))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            hashes, index, starts = _tokens(batch)
            ids, n, sums = model.ids(hashes)
            ids, one, rank = np.unique(ids, return_index=True, return_inverse=True)
            second, none = rank[index], len(ids)
            first, third = np.empty_like(second), np.empty_like(second)
            first[1:], third[:-1] = second[:-1], second[1:]
            first[starts[:-1]], third[starts[1:] - 1] = rank[-1], none
            bits = none.bit_length()
            pair, place = (first << bits) | second, None
            if 3 * bits > 62:  # a text of millions of different words
                pair, place = np.unique(pair, return_inverse=True)
            triple, many = np.unique(((pair if place is None else place) << bits) | third, return_counts=True)
            third, pair = triple & ((1 << bits) - 1), triple >> bits if place is None else pair[triple >> bits]
            first, second = pair >> bits, ids[pair & ((1 << bits) - 1)]
            # the range that holds this share of the first word's count
            at = sums[one][first] + (n[one][first] * (second / types)).astype(np.int64)
            yield from _dealt(at // per, (ids[first] * types + second).astype(np.uint64), many, np.append(ids, types)[third].astype(np.uint64))

    return rows.mapInArrow(count, "bucket long, blob binary")


def _level(level: int, context: np.ndarray, contexts: int, words_: np.ndarray, share: np.ndarray, types: int) -> dict[str, np.ndarray]:
    """Arrays of a level of a shard; context counts from the shard's first."""
    codes = np.minimum(255, np.ceil(-np.log2(share) * STEP)).astype(np.uint8)
    many = np.bincount(context, minlength=contexts)
    pointers = np.concatenate([[0], np.cumsum(many)])
    wide = np.flatnonzero(many > NARROW)
    mass = np.add.reduceat(TAKES[codes], pointers[:-1][many > 0]) if len(codes) else np.zeros(0)
    return {
        **ef_build(pointers.astype(np.uint64), f"{level}.pointers"),
        **ef_build(context.astype(np.uint64) * U(types) + words_.astype(np.uint64), f"{level}.successors"),
        **ef_build(wide.astype(np.uint64), f"{level}.wide"), f"{level}.codes": codes, f"{level}.mass": mass[many[many > 0] > NARROW],
    }


def _write_levels(triples: DataFrame, model: Model, cutoffs: tuple[int, ...]) -> pd.DataFrame:
    types = model.types

    def write(key, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n, third = (np.concatenate(x) for x in zip(*map(_unblob, pdf.pop("blob"))))
        pairs, place = np.unique(keys, return_inverse=True)
        triple = (place.astype(np.uint64) << U(32)) | third
        order = np.argsort(triple)
        triple = triple[order]
        at = _starts(triple)
        n, place, third = np.add.reduceat(n[order], at), (triple[at] >> U(32)).astype(np.int64), (triple[at] & U(0xFFFFFFFF)).astype(np.int64)
        del keys, triple, order
        total = np.bincount(place, n, len(pairs)).astype(np.int64)
        kept = total >= cutoffs[1]
        node = np.cumsum(kept) - 1
        good = kept[place] & (n >= cutoffs[2]) & (third < types)
        made = _level(3, node[place[good]], int(kept.sum()), third[good], (n[good] - DISCOUNT) / total[place[good]], types)
        pairs, total = pairs[kept].astype(np.int64), total[kept]
        if not len(pairs):
            return pd.DataFrame({"shard": [], "n": [], "first": [], "last": []}, dtype="int64")
        first, second = pairs // types, pairs % types
        made |= _level(2, first - first[0], int(first[-1] - first[0]) + 1, second, (total - DISCOUNT) / model.count_of(first), types)
        write_arrays(f"{model.base}/2/{key[0]}", made)
        return pd.DataFrame({"shard": [key[0]], "n": [len(pairs)], "first": [pairs[0]], "last": [pairs[-1]]})

    return triples.groupBy("bucket").applyInPandas(write, "shard long, n long, first long, last long").toPandas()


def train(rows: DataFrame, cutoffs: tuple[int, ...] = (1, 1, 1)) -> Model:
    """The model of order 3 of all rows (column text); the first level keeps every word."""
    if len(cutoffs) != 3 or list(cutoffs) != sorted(cutoffs):
        raise ValueError("three cutoffs are needed, and they must not fall")
    base = new_path(rows.sparkSession, "trie")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shift = 64 - (size // TEXT_PER_SHARD).bit_length()
    model = Model(base, shift, _count_words(rows, base, shift))
    if model.types >= 1 << 31:
        raise ValueError("more than 2**31 words")
    if model.tokens:
        model.add(_write_levels(_count_triples(rows, model), model, cutoffs))
    return model


def _interpolated(model: Model, hashes: np.ndarray, index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, base probability, probability) of each token."""
    ids, counts, _ = model.ids(hashes)
    counts = counts[index]
    plain = (counts + PRIOR) / (model.tokens + PRIOR * (model.types + 1))
    ids, rank = np.unique(ids, return_inverse=True)
    word, base = rank[index], len(ids)
    before = np.empty_like(word)
    before[1:], before[starts[:-1]] = word[:-1], rank[-1]
    pairs, pair = np.unique(before * base + word, return_inverse=True)
    first, second = pairs // base, pairs % base
    known = np.flatnonzero((ids[first] >= 0) & (ids[second] >= 0))
    node, share, mass = np.full(len(pairs), -1, np.int64), np.zeros(len(pairs)), np.zeros(base)
    some = np.flatnonzero(ids >= 0)
    node[known], share[known], mass[some] = model.bigrams(ids[first[known]], ids[second[known]], ids[some])
    p = share[pair] + (1 - mass[before]) * plain
    # the pair before a token is its context; pairs are in the order of their nodes
    context = np.empty_like(pair)
    context[1:] = pair[:-1]
    context[starts[:-1]] = -1
    deep = np.flatnonzero((context >= 0) & (node[context] >= 0))
    nodes = np.flatnonzero(node >= 0)
    place = np.zeros(len(pairs), np.int64)
    place[nodes] = np.arange(len(nodes))
    triples, back = np.unique(place[context[deep]] * base + word[deep], return_inverse=True)
    sought = np.flatnonzero(ids[triples % base] >= 0)
    share, (at, third) = np.zeros(len(triples)), (triples // base, ids[triples % base])
    share[sought], mass = model.trigrams(at[sought], third[sought], node[nodes])
    p[deep] = share[back] + (1 - mass[place[context[deep]]]) * p[deep]
    return counts > 0, plain, p


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs (doc_id, held_out, text): also n_tokens, n_known, train_tokens, base_score, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            hashes, index, starts = _tokens(batch)
            known, plain, p = _interpolated(model, hashes, index, starts)
            per = [np.add.reduceat(x, starts[:-1]) for x in (np.log10(plain), np.log10(p), known.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(starts)), pa.array(per[2]),
                 pa.array(np.full(batch.num_rows, model.tokens)), pa.array(per[0]), pa.array(per[1])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_held_out(docs: DataFrame, cutoffs: tuple[int, ...] = (1, 1, 1)) -> DataFrame:
    """Scores all rows of docs by a model of those whose crc32(doc_id as text) mod 10 is not 0."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (crc32_mod("doc_id", 10) == 0).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return score(rows, train(rows.filter(~F.col("held_out")).select("text"), cutoffs))
