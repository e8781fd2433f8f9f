"""Packing token pieces into sequences by minimum bin slack.

A document's ids are cut at every `capacity` ids; what remains at its end is shorter. The numbers of pieces of each
length, at most `capacity` counts however many documents there are, go to the driver. There each window is opened by
the longest piece left, and a subset-sum over a bitset of reachable sums picks from the remaining lengths the multiset that
fills it closest to capacity; the counts are backtracked from the bitsets. The pattern found is used as often as the
counts allow. Then Spark ranks the pieces of each length (prefix sums split by hash) and joins them with the table of patterns,
which says for each length and range of ranks the sequence and the offset. The table has a row per pattern and length and is bounded by
the capacity, not by the data.

Padding is paid up to the capacity; a sequence whose ids number a power of two is not padded.

Defined results: null and empty texts have the end id alone. Repeated rows and null doc_ids are documents of their own.
An empty table gives an empty result. Other columns are ignored. Texts are tokenised whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import chunks, cut_lineage, running_sum, spread

PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: a space with white space or nothing after it; elsewhere a space starts a token of its own
LOOSE = re.compile(r" (?=\s|$)")
_tokenizers: dict = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker."""
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def token_ids(column: pa.Array, path: str, end: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, each with the end id; where each text's ids start, one entry more).

    The byte-level tokenizer never joins a space before a word with what stands left of it, so words with their space
    are encoded once per distinct word. Texts where a space is followed by white space or by the end, and those that hold an added token
    of the file (a special one, which the tokenizer takes out of the text before all else), are encoded whole.
    """
    import pyarrow.compute as pc

    loaded = tokenizer(path)
    column = pc.fill_null(column, "").cast(pa.large_string())
    loose = pc.match_substring_regex(column, r" (\s|$)|[^\x00-\x7F]")  # then looked at once more, with all white space
    added = np.zeros(len(column), bool)
    for token in loaded.get_added_tokens_decoder().values():
        # one with a space in it could also come about between two words that are encoded side by side
        added |= " " in token.content or np.asarray(pc.match_substring(column, token.content))
    whole = [i for i in np.flatnonzero(np.asarray(loose) | added).tolist() if added[i] or LOOSE.search(column[i].as_py())]
    tight = column
    if whole:
        mask = np.zeros(len(column), bool)
        mask[whole] = True
        tight = pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), column)
    lists = pc.split_pattern(tight, " ")
    offsets = np.asarray(lists.offsets).astype(np.int64)
    offsets -= offsets[0]
    flat = lists.flatten()
    first = pc.take(flat, pa.array(offsets[:-1])).to_pylist()
    later = np.ones(len(flat), bool)
    later[offsets[:-1]] = False
    flat = flat.filter(pa.array(later)).dictionary_encode()
    order = np.empty(len(later), np.int32)
    order[later] = np.asarray(flat.indices)
    # entries: distinct words with their space, then first words (without one) and whole texts, then the end id
    bounds = np.cumsum(np.asarray(pc.binary_length(flat.dictionary)).astype(np.int64) + 1)
    words = len(bounds)
    word_ids = [np.zeros(0, np.uint32)]
    for i in range(0, words, 4096):  # an encoding takes a hundred bytes a token, so not all at once
        text = " " + " ".join(flat.dictionary.slice(i, 4096).to_pylist())
        word_ids.append(np.array(loaded.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32))
    word_ids = np.concatenate(word_ids)
    word_ends = np.searchsorted(np.cumsum(_byte_lengths(path)[word_ids]), bounds) + 1
    for i in whole:
        first[i] = column[i].as_py()
    firsts = [loaded.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in first] + [[end]]
    lengths = np.concatenate([np.diff(word_ends, prepend=0), np.fromiter(map(len, firsts), np.int64, len(firsts))])
    values = np.concatenate([word_ids, np.fromiter((i for e in firsts for i in e), np.uint32)])
    lengths = lengths.astype(np.int32)  # a chunk of texts has far fewer ids than 2**31
    at = np.cumsum(lengths, dtype=np.int32) - lengths
    n = len(column)
    order[offsets[:-1]] = words + np.arange(n)
    order = np.insert(order, offsets[1:], len(lengths) - 1)
    many = lengths[order]
    ends = np.cumsum(many, dtype=np.int32)
    take = np.repeat(at[order] - (ends - many), many)
    take += np.arange(len(take), dtype=np.int32)
    ids = values[take]
    starts = np.concatenate([[0], ends[offsets[1:] + np.arange(n)]]).astype(np.int64)
    return ids, starts


def _byte_lengths(path: str) -> np.ndarray:
    """Bytes of each id's token; a byte-level vocabulary writes one character per byte."""
    if (path, "bytes") not in _tokenizers:
        vocabulary = tokenizer(path).get_vocab()
        found = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            found[i] = len(token)
        _tokenizers[path, "bytes"] = found
    return _tokenizers[path, "bytes"]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 1, keep_ids: bool = False) -> DataFrame:
    """Rows (row, doc_id, start, length, ids_crc32, doc_tokens), and ids if asked for; row numbers the rows of docs."""
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 24 << 20):
            ids, starts = token_ids(batch.column("text"), path, end)
            total = np.diff(starts)
            per = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), per)
            begin = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * capacity
            length = np.minimum(capacity, total[doc] - begin)
            at = starts[doc] + begin
            ids = np.ascontiguousarray(ids.astype("<u4"))
            crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(at.tolist(), length.tolist())]
            columns = [batch.column("row").take(pa.array(doc)), batch.column("doc_id").take(pa.array(doc)), pa.array(begin), pa.array(length),
                       pa.array(crc, pa.int64()), pa.array(total[doc])]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([at, [len(ids)]]).astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, schema)


# ------------------------------------------------------------- the plan

def fill(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of the given lengths with the largest sum up to `room`, as length -> count.

    reach has bit s set if s can be reached; copies of a length are added in doubling steps and each step's bitset is kept.
    """
    reach, steps, whole = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        left, step = min(counts[length], room // length), 1
        while left:
            n = min(step, left)
            steps.append((length, n, reach))
            reach |= (reach << (length * n)) & whole
            left, step = left - n, step * 2
        if reach >> room:
            break
    found, total = {}, reach.bit_length() - 1
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            found[length] = found.get(length, 0) + n
            total -= length * n
    return found


def plan_windows(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, copies per sequence, first sequence, offset of the first copy)."""
    left, used, rows, sequence = dict(counts), dict.fromkeys(counts, 0), [], 0
    order = sorted(left, reverse=True)
    while order:
        seed = order[0]
        left[seed] -= 1
        pattern = fill(left, order, capacity - seed)
        left[seed] += 1
        pattern[seed] = pattern.get(seed, 0) + 1
        times, offset = min(left[n] // k for n, k in pattern.items()), 0
        for n, k in sorted(pattern.items(), reverse=True):
            rows.append((n, used[n], used[n] + k * times, k, sequence, offset))
            offset += n * k
            used[n] += k * times
            left[n] -= k * times
        sequence += times
        order = [n for n in order if left[n]]
    return rows


def assign(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces."""
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    rows = plan_windows(counts, capacity)
    plan = cut.sparkSession.createDataFrame(
        rows, "length long, first_rank long, end_rank long, copies long, first_sequence long, first_offset long"
    )
    ranked = running_sum(cut.withColumn("_order", spread(F.concat_ws("-", "row", "start"))), ["length"], "_order", ["row", "start"], F.lit(1), "rank")
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    number = F.col("rank") - F.col("first_rank")
    # the plan is bounded by the capacity: each of its patterns uses up a length or most of one
    return ranked.join(F.broadcast(plan), "length").filter(inside).withColumn(
        "sequence_id", F.col("first_sequence") + F.floor(number / F.col("copies"))
    ).withColumn("offset", F.col("first_offset") + (number % F.col("copies")) * F.col("length")).drop(
        "first_rank", "end_rank", "copies", "first_sequence", "first_offset", "rank", "_order"
    )


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: row, doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset."""
    return assign(cut_lineage(pieces(docs, path, capacity, end, keep_ids)), capacity)
