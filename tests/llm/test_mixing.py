"""Mixing: targets, sizes near them, and the SQL twin."""

import re

from fleetzone.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string"


def water(sizes, weights, share, cap):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target = share * sum(sizes.values()), {}
    todo = set(names)
    while todo:
        level = left / sum(w[s] for s in todo)
        over = [s for s in todo if level * w[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target | {s: level * w[s] for s in todo}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            todo.discard(s)
    return target


def rows():
    out = []
    for i in range(3000):
        s = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"s{i % 9}"
        out.append((i, " ".join(["w"] * (i % 60)) if i % 50 else None, s, "x"))
    return out + [(7, "again a b", "s7", "x"), (7, "again a b", "s7", "x"), (None, "no id", "zz", "x"), (9001, "", "empty", "x")]


def test_targets_and_words(spark):
    data = rows()
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    sizes = {}
    for _, t, s, _ in data:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = water(sizes, [5, 2, 1], 1.5, 2.0)
    assert len(got) == len(data)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 60
    again = mixing.mix(spark.createDataFrame(data, SCHEMA).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_draws_are_unequal_by_source_and_fair_within(spark):
    data = [(i, "a b c", "big" if i % 10 else "small", "x") for i in range(8000)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA), weights=[1, 9], share=0.5, cap=2.0).collect()
    big = [r.doc_id for r in got if r.source == "big" and r.copies]
    assert abs(sum(1 for i in big if i < 4000) / len(big) - 0.5) < 0.1


def test_empty_and_no_python(spark):
    df = spark.createDataFrame(rows()[:50], SCHEMA)
    assert mixing.mix(df.limit(0)).collect() == []
    assert not re.search("Python|Pandas|Arrow", mixing.mix(df)._jdf.queryExecution().executedPlan().toString())


def test_scale_of_the_inclusion_odds(spark):
    """Expected words are the rest, and only the largest measures are certain."""
    cases = {"a": ([(1, 10), (3, 90), (6, 400)], 250.0), "b": ([(1, 500), (9, 40)], 480.0), None: ([(2, 7)], 0.0),
             "none": ([(1, 0)], 0.0)}
    data = [(s, float(m), w, rest) for s, (parts, rest) in cases.items() for m, w in parts]
    got = {r.s: r.scale for r in mixing.inclusion_scales(
        spark.createDataFrame(data, "source string, measure double, words long, rest double")).collect()}
    for s, (parts, rest) in cases.items():
        if s != "none":
            assert abs(sum(w * min(1, got[s] * m) for m, w in parts) - rest) < 1e-9
    assert got["none"] is None and got["b"] * 9 > 1 > got["b"]


def test_long_documents_have_the_better_odds(spark):
    """Inside one source: shares taken by size agree with the inclusion probabilities."""
    sizes = [1, 3, 15, 200]
    data = [(i, " ".join(["w"] * sizes[i % 4]), "s", "x") for i in range(12000)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA), weights=[1], share=0.4, cap=2.0).collect()
    digits = {n: n.bit_length() for n in sizes}
    total = sum(sizes) * 3000
    scale = 0.4 * total / sum(digits[n] * n * 3000 for n in sizes)
    for n in sizes:
        share = sum(r.copies for r in got if r.size == n) / 3000
        assert abs(share - scale * digits[n]) < 0.05
    assert abs(sum(r.taken for r in got) - 0.4 * total) <= 200


def test_certain_documents_are_taken_first(spark):
    """Where the rest is nearly the whole source, the long documents are certain."""
    data = [(i, " ".join(["w"] * (900 if i % 10 == 0 else 2)), "s", "x") for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA), weights=[1], share=0.999, cap=2.0).collect()
    assert all(r.copies == 1 for r in got if r.size == 900)
    assert 0 < sum(r.copies for r in got if r.size == 2) < 1800
    assert abs(sum(r.taken for r in got) - 0.999 * (200 * 900 + 1800 * 2)) <= 2
