"""Near-duplicate groups against brute force over all pairs."""

import random

import numpy as np
import pytest

from fleetzone.llm import near_dedup, sketch, vectext


def shingles(text, k):
    w = [x for x in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if x]
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in w]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + min(k, len(w))]) for i in range(max(len(w) - k + 1, 1)))


def brute(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in sets}


def corpus(seed, n=260):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    base = [rnd.choices(words, k=rnd.choice([3, 8, 30, 120])) for _ in range(25)]
    while len(rows) < n:
        b = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            b[rnd.randrange(len(b))] = rnd.choice(words)
        rows.append((i, rnd.choice([" ", "\n", "\t ", "  "]).join(b)))
        i += rnd.choice([1, 1, 3])
    return rows


EDGE = [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "one"), (9004, "ONE"), (9005, "one two"),
        (9006, "É é"), (9007, "é é"), (9008, "a\x0bb"), (9009, "a b"), (9010, "x" * 5000)]


@pytest.mark.parametrize("words", [2, 5])
def test_groups_equal_brute_force(spark, words):
    rows = corpus(words) + EDGE
    docs = spark.createDataFrame([(t, i, 1, "k") for i, t in rows], "text string, doc_id long, comp int, `key` string")
    got = near_dedup.near_duplicates(docs, words=words).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(rows, words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_split_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, words=2).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(rows, 2)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (3, "A b c d e f g"), (None, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, 2).collect())
    assert got == [(-1, None, True), (3, 3, True), (5, 3, False), (5, 3, False)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).collect() == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.comp for r in near_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_sketch_is_mergeable_and_estimates():
    rng = np.random.RandomState(1)
    a, b = np.unique(rng.randint(0, 1 << 40, 900).astype(np.uint64)), np.unique(rng.randint(0, 1 << 40, 300).astype(np.uint64))
    both = np.unique(np.concatenate([a, b]))
    ra, rb, ru = sketch.build([a, b, both])
    assert (np.maximum(ra, rb) == ru).all()
    errors = []
    for j in range(40):
        x = np.unique(rng.randint(0, 1 << 60, 500).astype(np.uint64))
        y = np.concatenate([x[:400], np.unique(rng.randint(0, 1 << 60, 100).astype(np.uint64))])
        regs = sketch.build([x, y])
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        errors.append(sketch.estimate(regs[:1], regs[1:], np.array([len(x)]), np.array([len(y)]))[0] - true)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_words_of_a_long_text_in_chunks(monkeypatch):
    text = b"Alpha beta  gamma\n" * 300
    whole = vectext.word_hashes([text, b"x", b""])
    monkeypatch.setattr(vectext, "CHUNK", 64)
    cut = vectext.word_hashes([text, b"x", b""])
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all() and len(whole[0]) == 901
