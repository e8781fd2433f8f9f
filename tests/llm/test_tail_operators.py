"""Merkle proofs, runs of words and toxicity against plain versions, with nulls, ties, repeated rows, long texts and empty tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from placerank.llm import merkle, squares, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx long, n long, part long, level int, held_out int"


def frame(spark, rows):
    """rows of (doc_id, text, lang, source, n_chars), with further columns whose names the operators use themselves"""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """(root, siblings of each leaf as (left, right))"""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            other = nodes[a ^ 1] if a ^ 1 < len(nodes) else ""
            paths[i].append((other, "") if a & 1 else ("", other))
        nodes, at = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [a >> 1 for a in at]
    return nodes[0], paths


def plain_merkle(rows):
    langs = sorted({r[2] for r in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for lang in langs]
    made = [tree([leaf(*r) for r in g]) for g in groups]
    root, over = tree([sub for sub, _ in made])
    out = []
    for g, (sub, paths), high in zip(groups, made, over):
        for r, path in zip(g, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            folded = leaf(*r[:4], r[4] + 1) if hit else leaf(*r)
            for a, b in path + high:
                folded = h(a, folded, b)
            out.append((r[0], leaf(*r), sub, root, h(*[a or b for a, b in path + high]), folded, folded == root))
    return sorted(out, key=str)


MERKLE_ROWS = [
    [(i, f"text {i}", ["de", "en", "é", None, "z"][min(4, i % 9)], f"s{i % 3}", None if i % 11 == 0 else i) for i in range(157)]
    + [(None, "a", "en", None, 1), (None, None, "en", "s", 1), (None, "a", "en", None, 1), (5, "text 5", "z", "s2", 5), (5, "text 5", "z", "s2", 5), (5, "", "z", "s2", 5)],
    [(1, "only", "en", "s", 2**63 - 1)],
    [(7, "w " * 400_000, "en", "s", 1), (2**60 + 1, None, None, None, None), (2**60 + 3, "", None, None, 0)],
]


@pytest.mark.parametrize("bits", [1, 3, 12])
@pytest.mark.parametrize("rows", MERKLE_ROWS, ids=["many", "one", "long"])
def test_merkle(spark, rows, bits):
    got = merkle.prove(frame(spark, rows), bits=bits)
    assert [f.name for f in got.schema] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_merkle(rows)


def test_merkle_gives_proofs_and_takes_none(spark):
    got = merkle.prove(frame(spark, MERKLE_ROWS[0]), proofs=True).collect()
    assert all(h(*r.proof) == r.proof_sha256 for r in got)
    assert any(not r.verified for r in got) and all(r.verified for r in got if zlib.crc32(str(r.doc_id).encode()) % 7)
    assert merkle.prove(frame(spark, [])).collect() == []


def test_merkle_takes_any_tampering(spark):
    rows = MERKLE_ROWS[0]
    got = merkle.prove(frame(spark, rows), tamper=lambda f: {**f, "text": F.when(f["doc_id"] == 9, "other").otherwise(f["text"])}).collect()
    assert [r.doc_id for r in got if not r.verified] == [9]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 100])
def test_missing_is_least(n):
    """Every proof can be written with what is fetched and derived, and nothing fetched could have been derived."""
    rng = random.Random(n)
    for _ in range(20):
        known = sorted(rng.sample(range(n), rng.randrange(1, n + 1)))
        needed = merkle.missing(np.array(known), n)
        have = {(0, i) for i in known} | set(needed)
        for level, size in enumerate(merkle.level_sizes(n)[:-1]):
            derived = {i >> 1 for lev, i in have if lev == level and ((level, i ^ 1) in have or i ^ 1 >= size)}
            assert not derived & {i for lev, i in needed if lev == level + 1}
            have |= {(level + 1, i) for i in derived}
        for i in known:
            for level, size in enumerate(merkle.level_sizes(n)[:-1]):
                assert (i >> level) ^ 1 >= size or (level, (i >> level) ^ 1) in have


def plain_runs(w):
    found, seen = [], set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                j = i
                while j + q < len(w) and w[j] == w[j + q]:
                    j += 1
                if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                    seen.add((i, j + q))
                    found.append((i, j + q, q))
                i = j
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    n = rng.choice([0, 1, 5, 6, 7, 8, 9, 20, 60, 200, 400])
    w = [rng.randrange(rng.choice([1, 2, 2, 3, 50])) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 8 else 0):
        a, p = rng.randrange(n), rng.randrange(1, max(2, n // 4))
        for i in range(a + p, min(n, a + rng.randrange(1, n))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("step", [1, 7, 64, 1 << 16])
def test_runs_of_random_words(step, monkeypatch):
    monkeypatch.setattr(squares, "STEP", step)
    rng = random.Random(step)
    for _ in range(60 if step > 1 else 15):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 8))]
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        document, found = squares.runs(np.array([x for t in texts for x in t], np.int64), starts)
        got = [[] for _ in texts]
        for i, r in zip(document.tolist(), found.tolist()):
            got[i].append(tuple(r))
        assert got == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("fields", [((2, 1), (3, 1)), ((7, 3), (11, 2))])
def test_runs_do_not_rest_on_fingerprints(fields, monkeypatch):
    """With fingerprints that nearly always agree, every run that is reported is one, with its very ends."""
    monkeypatch.setattr(squares, "FIELDS", fields)
    rng = random.Random(5)
    for _ in range(40):
        text = random_words(rng)
        _, found = squares.runs(np.array(text, np.int64), np.array([0, len(text)]))
        for s, e, q in found.tolist():
            assert e - s >= max(6, 4 * q) and text[s : e - q] == text[s + q : e]
            assert (s == 0 or text[s - 1] != text[s - 1 + q]) and (e == len(text) or text[e] != text[e - q])


def test_runs_in_long_texts_take_little():
    """A text of one word, and one of two that differ at every 121st place: squares that grow together are kept once."""
    for text in (np.zeros(300_000, np.int64), (np.arange(300_000) % 121 == 0).astype(np.int64)):
        catchers = squares.Catchers(len(text))
        most = 0
        for at in range(0, len(text), 5000):
            catchers.append(text[at : at + 5000], len(text))
            most = max(most, len(catchers.open))
        found = catchers.finish()
        assert most < 5000 and (0, len(text)) in {(s, e) for s, e, _ in found.tolist()}


def plain_find_runs(doc_id, text, plant):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(w)
    if plant and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = (None,) * 4
    if found:
        s, e, q = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
        best = s, e - s, q, 1000 * (e - s) // q
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return doc_id, len(found), *best, h(listed), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("plant", [False, True])
def test_find_runs(spark, plant):
    rng = random.Random(3)
    texts = [" ".join(f"é{x}" for x in random_words(rng)) for _ in range(80)]
    texts += [None, "", " \t\n", "a b " * 9, "x y x y x y x y z z z z z z", "r " * 3000]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1), (None, "q q q q q q", None, None, None), (None, None, None, None, None)]
    got = squares.find_runs(frame(spark, rows), plant).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_find_runs(r[0], r[1], plant) for r in rows), key=str)
    assert squares.find_runs(frame(spark, [])).collect() == []


def test_find_runs_in_a_text_of_many_chunks(spark):
    """A text longer than a chunk is not divided."""
    text = " ".join(f"w{i % 700_001}" for i in range(2_900_000))
    (r,) = squares.find_runs(frame(spark, [(1, text, "en", "s", 1)])).collect()
    assert len(text) > 4 * squares.CHUNK and (r.n_runs, r.start, r.length, r.period) == (1, 0, 2_900_000, 700_001)


BAD = [f"{a}{b}" for a in ("grak", "morv", "skel") for b in ("ot", "ash", "ing", "ed", "um", "el")]


def toxic_corpus(n, seed, each=3):
    rng, rows, labels = random.Random(seed), [], []
    plain = ["".join(rng.choice("abcdefghinorst") for _ in range(rng.randrange(2, 9))) for _ in range(1500)]
    for i in range(n):
        w, bad = [rng.choice(plain) for _ in range(rng.randrange(20, 300))], int(i % each == 0)
        for _ in range(rng.randrange(1, 6) * bad):
            w.insert(rng.randrange(len(w)), rng.choice(BAD).capitalize() + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, bad))
    return rows, labels


def test_toxicity_on_held_out_texts(spark):
    rows, labels = toxic_corpus(900, 1)
    rows += [(None, None, None, None, None), (5001, "", "en", "s", 1), (5002, None, "en", "s", 1), rows[2], (5003, "x" * 9_000_000 + " grakot morvash", "en", "s", 1)]
    labels += [(0, 0, None), (None, 1, 1)]
    got = toxicity.classify(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels[:900]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 150 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    caught = [r.predicted for r in held if truth[r.doc_id]]
    alone = [1 - r.predicted for r in held if not truth[r.doc_id]]
    assert sum(caught) / len(caught) > 0.95 and sum(alone) / len(alone) > 0.98
    by_id = {r.doc_id: r for r in got}
    assert by_id[5001].n_windows == 0 and by_id[5001].score == by_id[5002].score == by_id[None].score < 0.3
    assert not by_id[None].held_out and by_id[5003].n_toxic == 2


def test_toxicity_without_both_labels(spark):
    docs = frame(spark, [(1, "a b", "en", "s", 1), (2, None, None, None, None)])
    of = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert {r.score < 0.01 for r in toxicity.classify(docs, of([(1, 1, 0), (3, 1, 0)])).collect()} == {True}
    assert {r.predicted for r in toxicity.classify(docs, of([])).collect()} == {0}
    assert {r.predicted for r in toxicity.classify(docs, of([(1, 0, 1), (2, 0, 1), (3, 0, 1)])).collect()} == {1}
    assert toxicity.classify(frame(spark, []), of([(1, 1, 0)])).collect() == []


def test_windows_are_compared_by_their_compressed_length():
    """A word that only the toxic dictionary holds costs few bytes there and is stored with the other; a part of it costs more."""
    toxic, ordinary = toxicity.Lengths(b" grakot morvash skelum "), toxicity.Lengths(b" house window garden ")
    entries = [b"morvash", b"garden", b"blorvash", b""]
    left, other = toxic.of(entries), ordinary.of(entries)
    assert left[0] < left[2] and left[0] + 3 <= other[0] and other[1] < left[1] and left[3] == other[3] == 0


def test_copies_among_labelled_texts_count_once():
    base = [f"w{i}" for i in range(50)]
    texts = [base, [*base[:49], "x"], [f"v{i}" for i in range(50)], base[::-1], []]
    assert toxicity.without_copies(texts) == [texts[0], texts[2], texts[3], texts[4]]
