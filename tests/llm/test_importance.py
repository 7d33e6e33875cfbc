"""Importance resampling against a plain version, and the parts of its hashing."""

import hashlib
import math
import random
import re
import zlib

import numpy as np

from fleetzone.llm import importance

DOCS = "doc_id long, text string, n_words long, score string, buckets string, rank string"
ITEMS = "item_id long, text string, doc_id long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]], len(words)


def plain(docs, items, percent=25, min_words=20):
    feats = [plain_features(t) for _, t in docs]
    s, t = np.zeros(10000), np.zeros(10000)
    for ids, _ in feats:
        np.add.at(s, ids, 1)
    for _, text in items:
        np.add.at(t, plain_features(text)[0], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s, t)]
    rows = []
    for (i, _), (ids, n) in zip(docs, feats):
        weight = sum(gain[x] for x in ids) // len(ids) if ids else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(ids), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    eligible = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = len(eligible) * percent // 100
    return sorted(map(repr, [(*r, k + 1 if k < drawn else None) for k, r in enumerate(eligible)]
                      + [(*r, None) for r in rows if r[1] < min_words]))


def texts(n, seed=1):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "été", "日本語", "x1", "7", "the", "A", "naïve", "é" * 70, "q" * 65, "q" * 64]
    out = []
    for _ in range(n):
        gaps = [" ", "-", "\n\t", "  ", "!", "\x00", "_"]
        out.append("".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.choice([0, 1, 2, 19, 20, 60]))))
    return out


def test_buckets_equal_a_plain_hash():
    rows = texts(200) + ["", "...", "one", "  lead", "trail  ", "a" * 500, "b" * 70 + " " + "c" * 80 + " d"]
    ids, n, words = importance.buckets([t.encode() for t in rows])
    end = np.cumsum(n)
    for t, e, k, w in zip(rows, end, n, words):
        want, count = plain_features(t)
        assert sorted(ids[e - k:e].tolist()) == sorted(want) and w == count


def test_long_texts_are_cut_at_delimiters(monkeypatch):
    rows = texts(60, 2)
    whole = importance.buckets([t.encode() for t in rows])
    monkeypatch.setattr(importance, "BLOCK", 16)
    for a, b in zip(whole, importance.buckets([t.encode() for t in rows])):
        assert np.array_equal(a, b)


def test_checksums_of_joined_strings():
    rnd = random.Random(3)
    parts = [(rnd.randbytes(rnd.randint(0, 50)), rnd.randbytes(rnd.choice([0, 1, 7, 64, 5000]))) for _ in range(300)]
    left, right = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    got = importance.joined(left, right, np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


def run(spark, docs, items, **kw):
    frame = spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in docs], DOCS).repartition(3)
    target = spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS)
    out = importance.resample(frame, target, **kw)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(repr(tuple(r)) for r in out.collect())


def test_resample_equals_a_plain_version(spark):
    """Nulls, repeated ids and rows, ties, long texts and clashing column names."""
    docs = list(enumerate(texts(150, 4))) + [(5, "repeated id " * 30), (None, "null id " * 30), (None, None), (900, None), (901, ""),
                                             (6, "same row " * 12), (6, "same row " * 12), (902, "long " * 300_000)]
    items = list(enumerate(texts(20, 5))) + [(None, None), (3, "")]
    assert run(spark, docs, items) == plain(docs, items)
    assert run(spark, docs, []) == plain(docs, [])
    assert run(spark, docs, items, percent=60, min_words=2) == plain(docs, items, 60, 2)


def test_empty_table(spark):
    assert run(spark, [], [(1, "a b c")]) == []


def test_draw_leans_towards_the_target(spark):
    docs = [(i, ("target words here " if i % 4 == 0 else "other things there ") * 10) for i in range(400)]
    rows = importance.resample(spark.createDataFrame([(i, t, 1, "", "", "") for i, t in docs], DOCS),
                               spark.createDataFrame([(1, "target words here " * 50, 1)], ITEMS)).collect()
    ranks = sorted(r.rank for r in rows if r.rank)
    assert ranks == list(range(1, 101))
    assert sum(r.doc_id % 4 == 0 for r in rows if r.rank) > 60
